import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from gridwright.llm import language_model as L
from gridwright.llm import recurrent as R
from tests.llm.conftest import prose


def _held(i):
    return i is None or zlib.crc32(str(i).encode()) % 10 == 0


def _tokens(text):
    return [*(text or "").encode().lower().split(), b""]


@pytest.fixture(scope="module")
def scored(documents, awkward):
    line = prose(77, 40).split()
    pairs = [*awkward, *((100 + i, " ".join((line[i % 40:] + line[: i % 40]) * 4)) for i in range(200))]
    rows, known = L.likelihoods(documents(pairs))
    return pairs, rows.collect(), known


def test_base_equals_brute_force(scored):
    pairs, rows, known = scored
    counts = Counter(w for i, t in pairs if not _held(i) for w in _tokens(t))
    n, v = sum(counts.values()), len(counts)
    assert known.tokens == n and known.kinds == v
    want = sorted((str(i), len(_tokens(t)), sum(counts[w] > 0 for w in _tokens(t)),
                   round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in _tokens(t)), 5)) for i, t in pairs)
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 5)) for r in rows) == want


def test_model_is_better_than_the_base_on_held_out_text(scored):
    _, rows, _ = scored
    held = [r for r in rows if r.doc_id is not None and r.doc_id >= 100 and _held(r.doc_id)]
    assert len(held) > 5
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_empty_tables(documents, awkward):
    rows, known = L.likelihoods(documents(awkward).limit(0))
    assert rows.count() == 0 and known.tokens == 0
    only_held = [(i, "some words") for i in range(60) if _held(i)]
    rows, known = L.likelihoods(documents(only_held))
    assert all(np.isfinite(r.score) and r.n_known == 0 for r in rows.collect())


def _small(head=100, rare=5, seed=0):
    rng = np.random.default_rng(seed)
    w = R.initial(np.arange(head, 0, -1, dtype=float), np.ones(rare), seed)
    for name, value in vars(w).items():
        setattr(w, name, (value + rng.normal(0, 0.3, value.shape)).astype(np.float32) if "bias" not in name else value)
    return w


def test_probabilities_of_all_words_add_up_to_one():
    w = _small()
    state = np.random.default_rng(1).normal(0, 1, (1, R.HIDDEN)).astype(np.float32)
    rows = np.arange(len(w.inputs) - 1)
    classes, ids = R.targets(rows, w)
    total = np.exp(R.log_probabilities(w, np.repeat(state, len(rows), 0), classes, ids)).sum()
    assert total == pytest.approx(1, abs=1e-4)


def test_scores_do_not_depend_on_lanes_or_windows(monkeypatch):
    w, rng = _small(), np.random.default_rng(2)
    documents = [rng.integers(0, 100, n).astype(np.int32) for n in (1, 2, 63, 64, 65, 130, 700)]
    whole = R.score(w, documents)
    for number, words in enumerate(documents):
        state, total = np.zeros((1, R.HIDDEN), dtype=np.float32), 0.0
        for before, after in zip([len(w.inputs) - 1, *words[:-1]], words):
            state = R._step(w, np.array([before]), state)[0]
            total += R.log_probabilities(w, state, *R.targets(np.array([after]), w))[0]
        assert whole[number] == pytest.approx(total, rel=1e-4)
    monkeypatch.setattr(R, "LANES", 2)
    monkeypatch.setattr(R, "SCORE_STEPS", 7)
    assert np.allclose(R.score(w, documents), whole, rtol=1e-4)


def test_gradients_equal_differences(monkeypatch):
    """The first Adagrad step is a sign and scale of the slope; with plain steps it is the slope itself."""
    w, rng = _small(64, 3), np.random.default_rng(3)
    documents = [rng.integers(0, 64, 9).astype(np.int32), rng.integers(0, 67, 6).astype(np.int32)]
    slopes = {}
    monkeypatch.setattr(R.Trainer, "_apply", lambda self, name, slope, at=slice(None): slopes.setdefault(name, (slope.copy(), at)))
    R.Trainer(w).learn(documents)
    for name, place in (("gates", (3, 5)), ("gates", (10, 3 * R.HIDDEN - 8)), ("classes", (2, 1)), ("members", (7, 4)), ("class_bias", (0,))):
        slope, h = slopes[name][0][place], 1e-2
        ends = []
        for sign in (1, -1):
            moved = w.like(w.flat())
            getattr(moved, name)[place] += sign * h
            ends.append(-R.score(moved, documents).sum() / R.LANES)
        assert slope == pytest.approx((ends[0] - ends[1]) / (2 * h), rel=0.05, abs=2e-5)
    slope, used = slopes["inputs"]
    k = 2
    ends = []
    for sign in (1, -1):
        moved = w.like(w.flat())
        moved.inputs[used[k], 4] += sign * 1e-2
        ends.append(-R.score(moved, documents).sum() / R.LANES)
    assert slope[k, 4] == pytest.approx((ends[0] - ends[1]) / 2e-2, rel=0.05, abs=2e-5)


def test_training_learns_an_order():
    words = np.tile(np.arange(8), 200).astype(np.int32)
    w = R.initial(np.ones(8), np.ones(2))
    trainer = R.Trainer(w)
    for _ in range(4):
        trainer.learn([words] * 4)
    assert R.score(trainer.w, [words])[0] > 0.3 * R.score(w, [words])[0]


@pytest.mark.parametrize("parts", [1, 3])
def test_rounds_learn_once_from_every_training_token(documents, spark, monkeypatch, parts):
    """Whole texts with their ends, in one of the rounds each, however many rows a task has."""
    pairs = [(i, prose(i, n)) for i, n in enumerate([0, 1, 33, 40, 63, 64, 65, 400, 401, 3000] * 3)]
    docs = documents(pairs).repartition(parts).persist()
    known = L.vocabulary(L.count_words(docs))
    weights = R.initial(known.counts + L.SMOOTHING, known.rare_tokens)
    learned = spark.sparkContext.accumulator(0)

    class Noted(R.Trainer):
        def learn(self, texts):
            learned.add(sum(map(len, texts)))
            return super().learn(texts)

    monkeypatch.setattr(L, "Trainer", Noted)
    got = L.train(docs, known)
    docs.unpersist()
    assert learned.value == known.tokens == sum(len(_tokens(t)) for _, t in pairs)
    # The end, which every text has, is learned from too, and the input rows of all words that occur have moved.
    rows = sorted({int(r) for _, t in pairs for r in known.encode(_tokens(t))[:-1]})
    assert all((got.inputs[rows] != weights.inputs[rows]).any(1))
    assert (got.members[0] != weights.members[0]).any()


def _likelihoods(docs, monkeypatch, parts, **bounds):
    for name, value in bounds.items():
        monkeypatch.setattr(L, name, value)
    rows, _ = L.likelihoods(docs.repartition(parts))
    return {(r.doc_id, r.n_tokens): (r.n_known, r.base_score, r.score) for r in rows.collect()}


def test_scores_do_not_depend_on_partitioning(documents, monkeypatch):
    """The same rows give the same model, whether in one share or several."""
    docs = documents([(i, prose(i % 50, 20 + i % 90)) for i in range(240)])
    assert L.shares(L.SHARE_TOKENS) == 1 and L.shares(L.SHARE_TOKENS + 1) == 2 and L.shares(0) == 1
    for tokens in (L.SHARE_TOKENS, 3000):
        first, *others = [_likelihoods(docs, monkeypatch, parts, SHARE_TOKENS=tokens) for parts in (1, 4, 64)]
        for other in others:
            assert other.keys() == first.keys()
            for key, (n_known, base, score) in first.items():
                assert other[key] == (n_known, pytest.approx(base, rel=1e-9), pytest.approx(score, rel=1e-6))


def test_words_beyond_the_broadcast_ones_score_the_same(documents, awkward):
    docs = documents([*awkward, *awkward[:3], *((200 + i, prose(i, 60)) for i in range(60))])
    training = docs.filter(~L.held_out())
    counts = L.count_words(training)
    every, few = (L.vocabulary(counts, 8, middle) for middle in (1 << 18, 20))
    weights = R.initial(every.counts + L.SMOOTHING, every.rare_tokens)
    assert len(every.middle) > 20 >= len(few.middle) > 0
    one, two = (sorted(((str(r.doc_id), r.n_tokens, r.n_known, r.base_score, r.score) for r in
                        L.score(docs, known, weights, counts).collect())) for known in (every, few))
    assert len(one) == docs.count()
    for a, b in zip(one, two):
        assert a[:3] == b[:3] and a[3:] == pytest.approx(b[3:], rel=1e-6)


def test_texts_are_learned_whole_in_groups_of_any_size(monkeypatch):
    rng, seen = np.random.default_rng(5), []
    texts = [b" ".join(b"w%d" % k for k in rng.integers(0, 50, n)) for n in (0, 1, 33, 63, 400, 2000)]
    known = L.Vocabulary({b"": 0} | {b"w%d" % k: k + 1 for k in range(50)}, np.ones(51), 51, 51, np.zeros(32), np.zeros(32))
    monkeypatch.setattr(L, "TOGETHER", 100)
    encoded = (known.encode([*t.split(), b""]) for t in texts)
    L.learn_texts(type("Noted", (), {"learn": lambda self, part: seen.extend(part)})(), encoded)
    assert [s.tolist() for s in seen] == [known.encode([*t.split(), b""]).tolist() for t in texts]


def test_texts_are_taken_apart_once_to_count_and_once_to_encode(documents, awkward, spark, monkeypatch):
    """Both rounds and the scoring read the encoded table."""
    docs, plain, seen = documents(awkward), L.slices, spark.sparkContext.accumulator(0)

    def noted(batches, column="text", **bounds):
        for batch in plain(batches, column, **bounds):
            seen.add(batch.num_rows * (column == "text"))
            yield batch

    monkeypatch.setattr(L, "slices", noted)
    rows, _ = L.likelihoods(docs)
    assert rows.count() == len(awkward)
    assert seen.value == len(awkward) + sum(not _held(i) for i, _ in awkward)


def test_tokens_of_all_texts_are_those_of_each():
    odd = [None, "", " ", "\t\v a\x0c\r\n", "a\x1cb \x1f c\x85d\xa0e\u2028f", "\x00 x\x00", "\u0130I\u212aK \u00c9A\u017f", "A  b" * 9,
           *(f"{c}A{c}{c}b" for c in map(chr, range(1, 160)))]
    for texts in (odd, odd[:1], odd[1:3], ["x", *odd][2:9]):
        found, ends = L.tokens(pa.array(texts, pa.string()))
        want = [_tokens(t) for t in texts]
        assert found.to_pylist() == [w for t in want for w in t]
        assert ends.tolist() == np.cumsum([len(t) for t in want]).tolist()


def test_encoded_rows_hold_what_the_texts_say(documents, awkward):
    docs = documents([*awkward, *((300 + i, prose(i, 60)) for i in range(40))])
    known = L.vocabulary(L.count_words(docs.filter(~L.held_out())), 8, 20)
    logs = [math.log10(n + L.SMOOTHING) for n in [*known.counts, *known.middle]]
    texts = Counter((r.doc_id, r.text) for r in docs.collect())
    got = L.encoded(docs, known).collect()
    assert len(got) == texts.total()
    want = []
    for (doc_id, text), times in texts.items():
        tokens = _tokens(text)
        numbers = [known.rows.get(t, -1) for t in tokens]
        tail = Counter(t for t, k in zip(tokens, numbers) if k < 0)
        want += times * [(str(doc_id), len(tokens), known.encode(tokens).tolist(), sorted(tail.items()),
                          round(sum(logs[k] for k in numbers if k >= 0), 6),
                          round(sum(logs[k] for k in numbers if k >= len(known.counts)), 6))]
    assert sorted(want) == sorted(
        (str(r.doc_id), r.n_tokens, np.frombuffer(r.rows, "<u2").tolist(), sorted((bytes(w), n) for w, n in r.tail),
         round(r.log, 6), round(r.middle, 6)) for r in got)


@pytest.mark.parametrize("size", [1, 40])
def test_probabilities_equal_plain_arithmetic_whatever_the_weights(size):
    """Logits that leave the range of float32 exponentials have their maximum taken off first."""
    w, rng = _small(), np.random.default_rng(4)
    w.classes *= size
    w.members *= size
    rows = rng.integers(0, len(w.inputs) - 1, 1500)
    states = np.tanh(rng.normal(0, 2, (1500, R.HIDDEN))).astype(np.float32)
    assert R._bounded(R._output_rows(w)[1]) == (size == 1)
    classes, ids = R.targets(rows, w)
    wide = states.astype(float)
    want = np.empty(1500)
    for k, (c, i) in enumerate(zip(classes, ids)):
        logits = wide[k] @ w.classes + w.class_bias
        want[k] = logits[c] - np.logaddexp.reduce(logits)
        if c < w.head_classes:
            own = slice(c * R.MEMBERS, (c + 1) * R.MEMBERS)
            logits = w.members[own] @ wide[k] + w.member_bias[own]
            want[k] += logits[i % R.MEMBERS] - np.logaddexp.reduce(logits)
    assert np.allclose(R.log_probabilities(w, states, classes, ids), want, rtol=1e-4, atol=1e-4)


def test_learning_is_the_same_with_maxima_taken_off_and_memory_used_again(monkeypatch):
    rng = np.random.default_rng(6)
    documents = [rng.integers(0, 104, n).astype(np.int32) for n in (1, 31, 32, 33, 64, 200, 5)]
    first, again = R.Trainer(_small()), R.Trainer(_small())
    first.learn(documents)
    first.learn(documents[::-1])
    monkeypatch.setattr(R, "LARGEST", 0.0)
    monkeypatch.setattr(R, "PIECE", 7)
    again.learn(documents)
    again.rooms = {name: np.full_like(room, np.nan) for name, room in again.rooms.items()}
    again.learn(documents[::-1])
    assert np.allclose(first.w.flat(), again.w.flat(), rtol=1e-3, atol=1e-4)
