import random

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from gridwright.llm import simhash
from gridwright.llm.components import components
from tests.llm.conftest import prose


def _brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def _brute_components(codes):
    label = {c: c for c in codes}

    def find(c):
        while label[c] != c:
            c = label[c]
        return c

    codes = sorted(codes)
    for i, a in enumerate(codes):
        for b in codes[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                label[find(b)] = find(a)
    return {c: find(c) for c in codes}


def _check(rows, pairs):
    code = {(i, n): _brute_fingerprint(t) for n, (i, t) in enumerate(pairs)}
    root = _brute_components(set(code.values()))
    least = {}
    for (i, n), c in code.items():
        if i is not None:
            least[root[c]] = min(i, least.get(root[c], i))
    want = sorted(((str(i), c, str(least.get(root[c]))) for (i, n), c in code.items()))
    assert sorted((str(r.doc_id), r.code % 2**64, str(r.component_id)) for r in rows) == want


@pytest.mark.parametrize("max_route", [16_384, 3])
def test_components_equal_brute_force(documents, awkward, max_route):
    rng = random.Random(4)
    pairs = list(awkward)
    for group in range(12):
        words = prose(100 + group, 250).split()
        for copy in range(6):
            own = list(words)
            for _ in range(copy):
                own[rng.randrange(len(own))] = "changed"
            pairs.append((1000 + 10 * group + copy, " ".join(own)))
    _check(simhash.near_duplicates(documents(pairs), max_route).collect(), pairs)


def test_links_of_crowded_codes_lose_none(spark):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 2**63, 40, dtype=np.uint64)
    codes = {int(c) for c in centres}
    for c in centres:
        for _ in range(60):
            flips = rng.choice(64, rng.integers(1, 6), replace=False)
            codes.add(int(c) ^ sum(1 << int(b) for b in flips))
    signed = [(c - 2**64 if c >= 2**63 else c,) for c in codes]
    for limit in (16_384, 20):
        edges = simhash.links(spark.createDataFrame(signed, "code long"), limit)
        got = {r.node % 2**64: r.root % 2**64 for r in components(edges).collect()}
        want = _brute_components(codes)
        groups, mine = {}, {}
        for c in codes:
            groups.setdefault(want[c], set()).add(c)
            mine.setdefault(got.get(c, c), set()).add(c)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))
        assert edges.count() < 4 * (simhash.DEPTHS if limit == 20 else 1) ** 4 * len(codes)


def test_gray_rank_orders_codes_by_single_steps():
    order = np.argsort(simhash.gray_rank(np.arange(256, dtype=np.uint64)))
    assert all((int(a) ^ int(b)).bit_count() == 1 for a, b in zip(order, order[1:]))


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1100)] + [(5, 5), (3, 2), (2, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(201)} | {i: 1000 for i in range(1000, 1100)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_one_row_of_each_group_stays(documents, awkward):
    frame = documents(awkward)
    kept = simhash.representatives(frame)
    assert kept.columns == frame.columns
    root = _brute_components({_brute_fingerprint(t) for _, t in awkward})
    assert kept.count() == len({root[_brute_fingerprint(t)] for _, t in awkward})
    ids = [r.doc_id for r in kept.collect()]
    assert 1 in ids and 2 not in ids and 5 in ids and None in ids
    assert simhash.representatives(frame.limit(0)).count() == 0
