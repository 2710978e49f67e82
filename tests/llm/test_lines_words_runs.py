import hashlib
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from gridwright import session
from gridwright.llm import line_dedup, periodic_runs, queries, spelling_variants
from gridwright.llm.periodic_runs import Forest, collapse, find_runs, next_smaller
from tests.llm.conftest import prose


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _lower(text):
    return text.encode().lower().decode()


@pytest.fixture(scope="module")
def stored(spark, documents, tmp_path_factory):
    """Writes pairs as the documents table of a new folder."""

    def write(pairs):
        path = tmp_path_factory.mktemp("tables")
        documents(pairs).write.parquet(f"{path}/documents.parquet")
        return f"{path}"

    return write


# Lines


def _brute_lines(pairs, min_length=10, min_documents=2):
    holders = defaultdict(set)
    for i, t in pairs:
        for line in (t or "").split("\n"):
            key = _lower(line.strip(" \t\n\x0b\x0c\r"))
            if len(key) >= min_length:
                holders[key].add(i)
    out = []
    for i, t in pairs:
        lines = (t or "").split("\n")
        kept = []
        for line in lines:
            held = holders.get(_lower(line.strip(" \t\n\x0b\x0c\r")), ())
            if len(held) < min_documents or i == min((x for x in held if x is not None), default=None):
                kept.append(line)
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def _shared_lines(seed, n):
    rng = random.Random(seed)
    known = ["  The Same Line  ", "the same line", "Größe ÄÖ und mehr", "größe ÄÖ und mehr\t", "kurz", "", "\x0btab line here\r", "TAB LINE HERE"]
    known += [prose(k, 6) for k in range(20)]
    return [(rng.choice([i, i, i % 7, None]), "\n".join(rng.choices(known, k=rng.randint(0, 12)))) for i in range(n)]


def _dropped(docs, **settings):
    rows = line_dedup.drop_repeated_lines(docs, **settings).collect()
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in rows), key=str)


@pytest.mark.parametrize("heavy", [4096, 20, 1])
def test_repeated_lines_equal_brute_force(documents, awkward, heavy):
    pairs = awkward + _shared_lines(3, 60) + [(200, "\n".join(["a line many times"] * 500)), (201, "a line many times")]
    assert _dropped(documents(pairs), heavy=heavy) == _brute_lines(pairs)


@pytest.mark.parametrize("least, among", [(1, 2), (10, 3), (15, 1)])
def test_thresholds_for_lines(documents, least, among):
    pairs = _shared_lines(4, 40)
    assert _dropped(documents(pairs), min_length=least, min_documents=among) == _brute_lines(pairs, least, among)


def test_heavy_lines_are_few_and_rows_are_whole(documents):
    pairs = [(i, "the very same line\n" + prose(i, 8)) for i in range(300)]
    lines = line_dedup.line_hashes(documents(pairs))
    repeated = line_dedup.repeated_lines(lines)
    assert repeated.count() == 1 and repeated.first().keeper == 0 and repeated.first().n_lines == 300
    assert line_dedup.dropped_places(lines, repeated).count() == 299


def test_counts_of_lines_share_one_shuffle_and_are_not_written(spark, documents, monkeypatch):
    pairs, tables = _shared_lines(6, 120), []

    def written(df, label):
        tables.append(session.written(df, label))
        return tables[-1]

    monkeypatch.setattr(line_dedup, "written", written)
    settings = {"spark.sql.shuffle.partitions": "31", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        frame = line_dedup.drop_repeated_lines(documents(pairs).repartition(3), heavy=20)
        rows = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in frame.collect()), key=str)
        plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert rows == _brute_lines(pairs)
    assert len(tables) == 1 and len(tables[0].inputFiles()) <= 3
    assert plan.count("partial_min(doc_id") == 1


def test_lines_query_equals_its_sql(spark, stored, awkward):
    pairs = [(n, t) for n, (_, t) in enumerate(awkward + _shared_lines(5, 80))]
    folder = stored(pairs)
    duck = duckdb.connect()
    duck.sql(f"create view documents as select * from '{folder}/documents.parquet/*.parquet'")
    names = ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
    frame = queries.QUERIES["op11_lines"](spark, folder)
    assert frame.columns == names
    theirs = duck.sql(f"select {', '.join(names)} from ({queries.ORACLES['op11_lines']})").fetchall()
    mine = sorted(tuple(r) for r in frame.collect())
    assert mine == sorted(theirs)
    assert mine == sorted((i, n, d, _sha(t)) for i, n, d, t in _brute_lines(pairs))


# Words


def _near(u, v):
    if len(u) > len(v):
        u, v = v, u
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    return len(v) == len(u) + 1 and any(v[:i] + v[i + 1:] == u for i in range(len(v)))


def _brute_words(pairs, damaged, min_letters=6, min_count=5):
    counts = Counter()
    for i, t in pairs:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", t or ""):
            word = _lower(run)
            if damaged:
                h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
                if h % 199 == 0:
                    at = h % len(word)
                    word = word[:at] + word[at + 1:]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_letters and n >= min_count}


def _brute_variants(counts, ratio=5):
    form, near = {}, {}
    for w, n in counts.items():
        near[w] = [v for v in counts if _near(w, v)]
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
    rows = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(rows)


def _misspelt(seed, n):
    """Words and their misspellings in falling numbers, some of them chains."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("abéÿz", k=rng.randint(6, 9))) for _ in range(25)]
    out = []
    for w in words:
        times = 130
        while times >= 5:
            out += [w.upper() if rng.random() < 0.2 and w.isascii() else w] * times
            at = rng.randrange(len(w))
            w = rng.choice([w[:at] + w[at + 1:], w[:at] + rng.choice("abé") + w[at:], w[:at] + "q" + w[at + 1:]])
            times //= rng.choice([1, 5, 6])
            if times == 130:
                times = 90
    rng.shuffle(out)
    return [(i if i % 9 else None, " ".join(out[i::n]) + rng.choice([".", "1x2", " ×÷ ", "日本"])) for i in range(n)]


@pytest.mark.parametrize("max_route", [20_000, 40, 2])
def test_variants_equal_brute_force(documents, awkward, max_route):
    pairs = awkward + _misspelt(6, 40)
    counts = _brute_words(pairs, False)
    words = spelling_variants.vocabulary(documents(pairs))
    rows = spelling_variants.variants(words, max_route=max_route).collect()
    got = sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows)
    assert got == _brute_variants(counts)
    assert len({r[2] for r in got}) < len(got) and any(r[1] not in (None, r[2]) for r in got)


def test_spelling_query_equals_brute_force(spark, stored, awkward, monkeypatch):
    monkeypatch.setattr(spelling_variants, "REMEMBERED", 50)
    pairs = awkward + _misspelt(7, 300) + [(i, "extraordinary " * 20 + "extraodinary") for i in range(400, 700)]
    frame = queries.QUERIES["op12_spelling"](spark, stored(pairs))
    assert frame.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = sorted(tuple(r) for r in frame.collect())
    assert got == _brute_variants(_brute_words(pairs, True))
    assert _brute_words(pairs, True) != _brute_words(pairs, False)


def test_short_words_ties_and_ratio(documents):
    text = "a " * 9 + "b " * 9 + "ab " * 4 + "abc " + "aab " * 30 + "zab " * 30
    words = spelling_variants.vocabulary(documents([(1, text)]), min_letters=1, min_count=1)
    rows = spelling_variants.variants(words, ratio=2).collect()
    got = sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows)
    counts = {"a": 9, "b": 9, "ab": 4, "abc": 1, "aab": 30, "zab": 30}
    assert got == _brute_variants(counts, 2)
    assert dict((r[0], r[1]) for r in got)["ab"] == "aab"
    with pytest.raises(ValueError):
        spelling_variants.variants(words, ratio=1)


def test_acceptor_is_minimal_and_a_word_may_be_very_long(documents):
    machine = spelling_variants.Acceptor(sorted(x + y for x in "abc" for y in ("ing", "ed")))
    assert len(machine.arcs) == 6
    long = "ab" * 30_000
    words = spelling_variants.vocabulary(documents([(n, f"{long} {long}a {long[:-1]}c") for n in range(5)]))
    rows = {r.word: (r.n_near, r.form) for r in spelling_variants.variants(words).collect()}
    assert rows == {long: (2, None), f"{long}a": (1, None), f"{long[:-1]}c": (1, None)}


# Runs


def _brute_runs(words, min_length=6, min_exponent=4):
    n, out = len(words), set()
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(min_length, min_exponent * q) and not any(
                    all(words[k] == words[k + p] for k in range(i, i + length - p)) for p in range(1, q)):
                out.add((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def _periodic(seed, n):
    rng = random.Random(seed)
    texts = []
    for _ in range(n):
        words = []
        for _ in range(rng.randint(0, 7)):
            words += rng.choices("abcd"[:rng.randint(1, 4)], k=rng.randint(1, 5)) * rng.randint(1, 7)
        texts.append(words)
    return texts


@pytest.mark.parametrize("least, exponent", [(6, 4), (2, 2), (4, 3)])
def test_runs_equal_brute_force(least, exponent):
    texts = _periodic(8, 400) + [[], ["a"], ["a"] * 50, list("ab" * 40 + "a"), list("aab" * 9)]
    got = find_runs([[w.encode() for w in t] for t in texts], least, exponent)
    assert got == [_brute_runs(t, least, exponent) for t in texts]
    assert find_runs([]) == []


def test_extensions_and_orders_equal_brute_force():
    texts = [[ord(w) - 96 for w in t] + [0] for t in _periodic(9, 30)]
    forest = Forest(texts, [5] * len(texts))
    base = 0
    for text in texts:
        places = range(len(text))
        pairs = [(i, j) for i in places for j in places if i != j]
        if pairs:
            i, j = (periodic_runs.np.array(x) for x in zip(*pairs))
            want = [next(k for k in range(len(text)) if text[a + k] != text[b + k]) for a, b in pairs]
            assert forest.extension(i + base, j + base).tolist() == want
        for rank, sign in ((forest.rank, 1), (forest.reverse, -1)):
            order = sorted(places, key=lambda i: [sign * s for s in text[i:-1]])
            assert (periodic_runs.np.argsort(rank[base:base + len(text)])).tolist() == order
        base += len(text)
    assert next_smaller(periodic_runs.np.array([3, 5, 4, 1, 2])).tolist() == [3, 2, 3, 5, 5]


def _brute_stutter(doc_id, words):
    h = zlib.crc32((b"" if doc_id is None else str(doc_id).encode()))
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def _brute_digest(doc_id, text):
    words = _brute_stutter(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    runs = _brute_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    first = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return (doc_id, len(runs), *first, _sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            _sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_runs_query_equals_brute_force(spark, stored, awkward):
    pairs = [p for p in awkward if p[0] != 11] + [(n + 50, " ".join(t)) for n, t in enumerate(_periodic(10, 120))]
    pairs += [(n + 300, prose(n, 150)) for n in range(60)]
    frame = queries.QUERIES["op13_runs"](spark, stored(pairs))
    assert frame.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = [_brute_digest(*p) for p in pairs]
    assert sorted((tuple(r) for r in frame.collect()), key=str) == sorted(want, key=str)
    assert any(w[1] > 1 for w in want) and any(w[3] and w[4] > 9 for w in want)


def test_very_long_and_deeply_nested_texts(documents):
    long = prose(11, 60_000).split()
    texts = {1: long[:30_000] + ["again"] * 40_000 + long[30_000:], 2: "a b a b c".split() * 4_000}
    rows = periodic_runs.periodic_runs(documents([(i, " ".join(t)) for i, t in texts.items()])).collect()
    runs = {r.doc_id: [tuple(x) for x in r.runs] for r in rows}
    assert runs == {1: [(30_000, 40_000, 1)], 2: [(0, 20_000, 5)]}
    assert {r.doc_id: len(r.collapsed.split()) for r in rows} == {1: len(long) + 1, 2: 5}


def test_collapse_drops_only_what_repeats():
    words = list("xababababy")
    runs = find_runs([[w.encode() for w in words]])[0]
    assert runs == [(1, 8, 2)] and "".join(collapse(words, runs)) == "xaby"
    assert collapse(words, []) == words


def test_next_smaller_follows_long_chains():
    chain = [*range(3000), *range(6000, 3000, -1)]
    for values in (chain, chain[::-1], [0, *range(5000, 0, -1)], [2, 2, 1, 1, 3], []):
        want = [next((j for j in range(i + 1, len(values)) if values[j] < v), len(values)) for i, v in enumerate(values[:60])]
        got = next_smaller(periodic_runs.np.array(values, dtype=int)).tolist()
        assert len(got) == len(values) and got[:60] == want


def test_few_python_steps_a_word():
    documents = [prose(n, 300).encode().split() for n in range(40)]
    steps = 0

    def count(frame, event, _):
        nonlocal steps
        steps += event == "line"
        return count if frame.f_code.co_filename == periodic_runs.__file__ else None

    tracer = sys.gettrace()
    sys.settrace(count)
    try:
        find_runs(documents)
    finally:
        sys.settrace(tracer)
    assert steps < 38 * sum(map(len, documents))


@pytest.mark.parametrize("name", ["op11_lines", "op12_spelling", "op13_runs"])
def test_empty_table(spark, stored, name, tmp_path):
    spark.read.parquet(f"{stored([(1, 'x')])}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.QUERIES[name](spark, f"{tmp_path}").count() == 0


def test_operators_are_registered_once():
    for n in (11, 12, 13):
        assert sum(q.startswith(f"op{n}_") for q in queries.QUERIES) == 1
