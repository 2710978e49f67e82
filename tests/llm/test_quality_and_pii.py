import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridwright.llm import pii, quality
from tests.llm.conftest import prose


def _junk(seed, n):
    return " ".join(w.upper() + "!!" for w in prose(seed, n).split())


@pytest.fixture(scope="module")
def labelled(spark, documents):
    pairs = [(i, prose(i, 80) if i % 3 else _junk(i, 80)) for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i, _ in pairs] + [(None, 1, 0), (9999, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    return documents(pairs), labels


def test_model_separates_held_out_documents(labelled):
    docs, labels = labelled
    scored = quality.score(docs, quality.train(docs, labels)).join(labels, "doc_id").filter(quality.held_out())
    rows = scored.select("score", "quality").collect()
    assert len(rows) > 30
    assert all((r.score >= quality.ACCEPT) == (r.quality == 1) for r in rows)


def test_bound_on_labelled_rows_is_kept_and_fit_is_repeatable(labelled):
    docs, labels = labelled
    one, two = (quality.train(docs, labels, max_labelled=60) for _ in range(2))
    assert one.intercept == two.intercept and all((a == b).all() for a, b in zip(one.tables, two.tables))


def test_quality_of_awkward_rows(spark, labelled, documents, awkward):
    docs, labels = labelled
    model = quality.train(docs, labels)
    frame = documents(awkward)
    scores = [r.score for r in quality.score(frame, model).collect()]
    assert len(scores) == len(awkward) and all(0 <= s <= 1 for s in scores)
    kept = quality.accepted(frame, model)
    assert kept.columns == frame.columns and kept.count() == sum(s >= quality.ACCEPT for s in scores)
    assert quality.score(frame.limit(0), model).count() == 0


def test_quality_without_labels_is_flat(spark, labelled):
    docs, labels = labelled
    assert quality.train(docs, labels.limit(0)).score(np.zeros((1, len(quality.FEATURES)))) == pytest.approx(0.5)
    ones = quality.train(docs, labels.withColumn("quality", F.lit(1)))
    assert ones.score(np.zeros((1, len(quality.FEATURES)))) > 0.99


def test_pairs_take_up_what_single_features_cannot():
    rng = np.random.default_rng(3)
    x = rng.uniform(-1, 1, (4000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = quality.fit(x, y)
    assert (0, 1) in model.pairs
    assert ((model.score(x) > 0.5) == y).mean() > 0.95


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP, CARD = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(digits):
    total = 0
    for n, d in enumerate(reversed(digits)):
        value = int(d) * (1 + n % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _brute(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(0, *m.span()) for m in EMAIL.finditer(text)]
    out += [(1, *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(2, *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and _luhn(digits(m))]
    return out + [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]


def test_base_spans_equal_the_patterns():
    rng = np.random.default_rng(1)
    texts = ["".join(rng.choice(list("a.@-1234+ ()x,7"), 60)) for _ in range(4000)]
    texts += ["a@b.c_d@e.f", "x@@y.z a@b", "1.2.3.4.5.6.7.8", "a@b.c@d.e", "0255.1.1.1 256.1.1.1", "9" * 5000, "a" * 5000 + "@b.c",
              "4111 1111 1111 1111", "+1 (017) 555-7713", "é@b.de ﬁ 1.1.1.1"]
    for text in texts:
        assert pii.base_spans(text) == _brute(text)
        assert [(c.kind, c.start, c.end) for c in pii.candidates(text) if c.base] == _brute(text)


def test_added_spans_keep_the_base_and_leave_clean_text(spark, documents):
    plain = [(i, prose(i, 60) + f" mail me at user{i}@mail.example.com or call +49 30 1234{i:04d}") for i in range(80)]
    spelled = (500, "You can reach me by mail: anna.lee (at) example (dot) com or by phone (555) 123-4567 today.")
    clean = (501, "Look at the dot on the map, version 1.2.3 of page 12345678, ISBN 978 3 16 148410 0.")
    docs = documents([*plain, spelled, clean])
    rows = {r.doc_id: r for r in pii.find(docs, pii.learn(docs)).collect()}
    assert {(s.kind, spelled[1][s.start:s.end]) for s in rows[500].spans} == {
        ("email", "anna.lee (at) example (dot) com"), ("phone", "(555) 123-4567")}
    assert rows[500].base == [] and rows[501].spans == []
    for i, text in plain:
        assert [(s.kind, s.start, s.end) for s in rows[i].base] == [(pii.KINDS[k], a, b) for k, a, b in _brute(text)]
        assert set(rows[i].base) <= set(rows[i].spans)


def test_reliabilities_find_the_labeler_that_is_noise():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.6
    votes = np.zeros(len(truth), dtype=int)
    for n in range(len(pii.LABELERS)):
        right = rng.random(len(truth)) < (0.5 if n == 3 else 0.9)
        votes += np.where(truth == right, 2, 1) * 3**n
    patterns, at, counts = np.unique(votes, return_inverse=True, return_counts=True)
    posterior, given = pii.reliabilities(patterns, counts.astype(float))
    assert ((posterior[at] > 0.5) == truth).mean() > 0.97
    assert abs(given[3, 1, 2] - 0.5) < 0.05 and all(given[n, 1, 2] > 0.85 for n in (0, 1, 2, 4, 5))


def test_redaction_of_awkward_rows(documents, awkward):
    frame = documents([*awkward, (20, "x a@b.com y 10.0.0.1 z"), (21, "+1 (017) 555-7713")])
    model = pii.learn(frame)
    out = pii.redact(frame, model)
    assert out.columns == frame.columns and out.count() == frame.count()
    texts = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert texts[20] == ("x [EMAIL] y [IP] z", 18) and texts[21] == ("[PHONE]", 7)
    assert texts[1] == (None, None) and texts[11][0] == dict(awkward)[11]
    assert pii.find(frame.limit(0), pii.learn(frame.limit(0))).count() == 0


@pytest.mark.parametrize("text", [
    "anna.lee at example.com", "ANNA.LEE [AT] EXAMPLE [DOT] COM", "anna {at} example.com", "anna ( at ) example.com",
    "anna (AT) example.com", "anna\tAt\nexample.com", "anna@\texample.com", "anna\u00a0@\u00a0example dot com", "anna＠example.com",
    "anna.lee at example {Dot} co.uk and bob [at] example.org", "meet at noon", "anna @example.com", "look at this.that", "a" * 70 + " at example.com",
    "dead:beef::cafe", "at", " at ", "@ .", "server fe80::1 [at] example.org",
])
def test_gates_let_every_match_of_their_patterns_through(text):
    for padded in (text, f"write to {text} soon", f"({text})\n{text}"):
        found = {(c.kind, c.start, c.end) for c in pii.candidates(padded)}
        for kind, pattern in ((0, pii._SPELLED_EMAIL), (1, pii._IP6), (1, pii._OPEN_IP), (2, pii._WIDE_CARD)):
            assert {(kind, *m.span()) for m in pattern.finditer(padded)} <= found
