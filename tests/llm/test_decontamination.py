import random
import re

import numpy as np
import pytest

from gridwright.llm import decontamination as D
from tests.llm.conftest import prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _words(text):
    return WORD.findall((text or "").translate(LOWER))


def _brute(pairs, items):
    windows = {}
    for item, text in items:
        parts = _words(text)
        size = min(13, len(parts))
        for i in range(len(parts) - size + 1 if size else 0):
            windows.setdefault(tuple(parts[i:i + size]), set()).add("" if item is None else str(item))
    out = []
    for i, text in pairs:
        parts, found = _words(text), set()
        hit = [False] * len(parts)
        for size in {len(w) for w in windows}:
            for k in range(len(parts) - size + 1):
                if own := windows.get(tuple(parts[k:k + size])):
                    hit[k:k + size] = [True] * size
                    found |= own
        n = sum(hit)
        out.append((str(i), len(parts), n, sorted(found), n > 0 and 20 * n >= len(parts)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def case(awkward):
    rng = random.Random(2)
    items = [(n, prose(200 + n, 40, 60)) for n in range(12)] + [(77, "Short item, only five Words"), (78, "single"), (79, None), (80, " .. "),
             (None, prose(200, 40, 60)), (3, prose(300, 30))]
    pairs = list(awkward)
    for n in range(30):
        own = prose(400 + n, 80, 60)
        passage = items[n % len(items)][1] or ""
        cut = passage.split()[: rng.randint(5, 40)]
        pairs.append((2000 + n, f"{own} {' '.join(cut).upper()}! {own}" if n % 3 else own))
    pairs += [(3000, prose(1, 5) + " SHORT item only five words"), (3001, "single"), (3002, " ".join([prose(200, 40, 60)] * 5))]
    return pairs, items


@pytest.mark.parametrize("shard_words", [2_000_000, 64])
def test_findings_equal_brute_force(spark, documents, case, shard_words):
    pairs, items = case
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS words", "1 AS n")
    rows = D.find_contamination(documents(pairs), bench, shard_words).collect()
    got = sorted(((str(r.doc_id), r.n_words, r.n_hit, r.item_ids, r.contaminated) for r in rows), key=str)
    assert got == _brute(pairs, items)
    texts = dict(pairs)
    for r in rows:
        if r.doc_id is not None and r.doc_id >= 2000:
            assert sum(len(_words(texts[r.doc_id][s.start:s.end])) for s in r.spans) == r.n_hit


def test_clean_keeps_what_is_not_contaminated(spark, documents, case):
    pairs, items = case
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = documents(pairs)
    kept = D.clean(frame, bench)
    assert kept.columns == frame.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(r[0] for r in _brute(pairs, items) if not r[4])
    assert D.clean(frame, bench.limit(0)).count() == frame.count()
    assert D.find_contamination(frame.limit(0), bench).count() == 0


def test_suffix_array_and_ranks_on_random_text():
    rng = np.random.default_rng(0)
    for n, kinds in ((1, 3), (50, 3), (400, 4), (300, 40)):
        text = np.append(rng.integers(1, kinds, n), 0).astype(np.int32)
        order = D.suffix_array(text)
        assert order.tolist() == sorted(range(n + 1), key=lambda i: text[i:].tolist())
        wavelet = D.WaveletMatrix(text, kinds)
        symbol, before = wavelet.access(np.arange(n + 1))
        assert symbol.tolist() == text.tolist()
        assert before.tolist() == [int((text[:i] == text[i]).sum()) for i in range(n + 1)]
        index = D.FMIndex(text, kinds)
        assert index.locate(np.arange(n + 1)).tolist() == order.tolist()
