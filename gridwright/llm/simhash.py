"""SimHash near-duplicates: a Gray-order hierarchical index over fingerprints, searched within routes that lose no link.

Two fingerprints that differ in at most three of 64 bits agree on at least one of four blocks of bits, so each distinct
fingerprint goes to one route per block and links are searched within routes only. A route with too many fingerprints is
split again by four blocks of its remaining bits, and so on; at the last depth 15 bits are free, hence a route never
holds more than 32 768 fingerprints. Within a route, fingerprints are sorted by Gray rank and grouped into a tree whose
nodes keep the bits on which all their leaves agree. A search adds up the differences along a path and leaves a whole
subtree as soon as they exceed the radius. Each task gives a spanning forest of the links it finds, not all pairs.

A null text is an empty one; texts without words get fingerprint zero and link like others. Repeated rows repeat in the
result. The component id is the least doc_id reachable, leaving out nulls; it is null if a component has null ids only.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from gridwright.llm.batches import fresh, raw_texts, slices, text_rows
from gridwright.llm.components import components
from gridwright.session import written

RADIUS, SHINGLE, SEED = 3, 3, 42
BLOCKS, DEPTHS = RADIUS + 1, 5
MAX_ROUTE = 16_384
FANOUT, BUFFER, FRONTIER = 8, 65_536, 2_000_000
_BITS = (np.arange(256)[:, None] >> np.arange(8)) & 1
_OFFSETS = np.arange(8) * 256


def fingerprint(raw: bytes) -> int:
    """Bit majority over the hashes of all shingles of a text; 0 without words."""
    words = raw.lower().split()
    if not words:
        return 0
    parts = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)))) if len(words) >= SHINGLE else [b" ".join(words)]
    hashes = np.fromiter(map(xxh64_intdigest, parts, repeat(SEED)), dtype="<u8")
    where = hashes.view(np.uint8).reshape(-1, 8) + _OFFSETS
    counts = (np.bincount(where.ravel(), minlength=2048).reshape(8, 256) @ _BITS).ravel()
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash and code, the fingerprint's 64 bits as a long, of every row."""

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            got = np.fromiter(map(fingerprint, raw_texts(batch)), dtype=np.uint64, count=batch.num_rows)
            columns = [batch.column("doc_id"), batch.column("text_hash"), pa.array(got.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "code"])

    rows = text_rows(docs).select("doc_id", "text", _text_hash().alias("text_hash"))
    return rows.mapInArrow(codes, "doc_id long, text_hash long, code long")


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray order."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _free_blocks(path: int, depth: int) -> list[np.ndarray]:
    """Bit positions of the four blocks that the bits left over after the path's blocks are split into."""
    blocks = np.array_split(np.arange(64), BLOCKS)
    for level in range(depth):
        taken = path >> (2 * level) & 3
        left = np.concatenate([b for k, b in enumerate(blocks) if k != taken])
        blocks = np.array_split(left, BLOCKS)
    return blocks


def deeper(codes: np.ndarray, routes: np.ndarray, paths: np.ndarray, depth: int) -> tuple[np.ndarray, ...]:
    """(codes, routes, paths) one level down: every code once per block. A route is all bits fixed so far."""
    out: list[tuple[np.ndarray, ...]] = []
    for path in np.unique(paths):
        at = paths == path
        own, before = codes[at], routes[at]
        for k, bits in enumerate(_free_blocks(int(path), depth)):
            value = np.zeros(len(own), dtype=np.uint64)
            for n, bit in enumerate(bits):
                value |= (own >> np.uint64(bit) & np.uint64(1)) << np.uint64(n)
            route = (before << np.uint64(2 + len(bits))) | (np.uint64(k) << np.uint64(len(bits))) | value
            out.append((own, route, np.full(len(own), path | k << (2 * depth), dtype=np.int32)))
    return tuple(np.concatenate(x) for x in zip(*out))


def _ends(starts: np.ndarray, total: int) -> np.ndarray:
    return np.append(starts[1:], total)


class GrayTree:
    """Trees over codes sorted by Gray rank within groups, all groups level by level in the same arrays."""

    def __init__(self, codes: np.ndarray, groups: np.ndarray) -> None:
        """`groups`: where each group starts. Level 0 has the codes, the last level one node per group."""
        full = np.full(len(codes), ~np.uint64(0))
        self.groups, self.levels = groups, [(codes, full, None, np.arange(len(codes)))]
        low, high, last, heads = codes, codes, np.arange(len(codes)), groups
        while len(low) > len(groups):
            sizes = np.diff(np.append(heads, len(low)))
            nodes = -(-sizes // FANOUT)
            owner = np.repeat(np.arange(len(groups)), nodes)
            first = np.cumsum(nodes) - nodes
            starts = heads[owner] + FANOUT * (np.arange(len(owner)) - first[owner])
            low, high = np.bitwise_and.reduceat(low, starts), np.bitwise_or.reduceat(high, starts)
            last = last[_ends(starts, len(last)) - 1]
            self.levels.append((low, ~(low ^ high), starts, last))
            heads = first

    def links(self, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (i, j), i < j, of codes of one group within the radius, for one block of queries after another."""
        codes = self.levels[0][0]
        sizes = np.diff(np.append(self.groups, len(codes)))
        owner = np.repeat(np.arange(len(sizes)), sizes)
        work = np.cumsum(sizes[owner])
        start = 0
        while start < len(codes):
            base = work[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(work, base + FRONTIER, side="right")))
            query = np.arange(start, stop)
            query = query[sizes[owner[query]] > 1]
            yield self._descend(query, owner[query], radius)
            start = stop

    def _descend(self, query: np.ndarray, node: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        codes = self.levels[0][0]
        spent = np.zeros(len(query), dtype=np.int64)  # every query agrees with its own root's shared bits
        for level in range(len(self.levels) - 1, 0, -1):
            _, mask, starts, _ = self.levels[level]
            low, below, _, last = self.levels[level - 1]
            count = (_ends(starts, len(low)) - starts)[node]
            at = np.repeat(np.arange(len(node)), count)
            child = starts[node][at] + np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
            ahead = last[child] > query[at]
            at, child = at[ahead], child[ahead]
            news = below[child] & ~mask[node[at]]
            total = spent[at] + np.bitwise_count((codes[query[at]] ^ low[child]) & news)
            near = total <= radius
            query, node, spent = query[at[near]], child[near], total[near]
        return query, node


def forest(pairs: Iterator[tuple[np.ndarray, np.ndarray]], size: int) -> np.ndarray:
    """For each of `size` items the least item it is connected to by the pairs."""
    label = np.arange(size)
    for u, v in pairs:
        while len(u):
            a, b = label[u], label[v]
            apart = a != b
            if not apart.any():
                break
            u, v, a, b = u[apart], v[apart], a[apart], b[apart]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while (label != label[label]).any():
                label = label[label]
    return label


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each route; the rows come sorted by route and Gray rank, and whole routes are taken together."""

    def found(codes: np.ndarray, routes: np.ndarray) -> pa.RecordBatch:
        heads = np.flatnonzero(np.append(True, routes[1:] != routes[:-1]))
        label = forest(GrayTree(codes, heads).links(), len(codes))
        linked = np.flatnonzero(label != np.arange(len(codes)))
        ends = [codes[linked].view(np.int64), codes[label[linked]].view(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in ends], ["u", "v"])

    codes, routes = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    for batch in batches:
        codes = np.concatenate([codes, batch.column("code").to_numpy().view(np.uint64)])
        routes = np.concatenate([routes, batch.column("route").to_numpy()])
        cut = int(np.searchsorted(routes, routes[-1])) if len(routes) > BUFFER else 0
        if cut:
            yield found(codes[:cut], routes[:cut])
            codes, routes = codes[cut:], routes[cut:]
    if len(codes):
        yield found(codes, routes)


_ROUTED = "code long, route long, path int, rank long"


def _routes(codes: DataFrame, depth: int) -> DataFrame:
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("code").to_numpy().view(np.uint64)
            before, path = batch.column("route").to_numpy().view(np.uint64), batch.column("path").to_numpy()
            code, routes, paths = deeper(own, before, path, depth)
            rank = (gray_rank(code) ^ np.uint64(1 << 63)).view(np.int64)
            columns = [code.view(np.int64), routes.view(np.int64), paths, rank]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["code", "route", "path", "rank"])

    return codes.select("code", "route", "path").mapInArrow(route, _ROUTED)


def links(codes: DataFrame, max_route: int = MAX_ROUTE) -> DataFrame:
    """Edges (u, v) that connect all distinct codes within three bits of each other, in a written table."""
    edges = []
    pending = codes.select("code", F.lit(0).cast("long").alias("route"), F.lit(0).alias("path"))
    for depth in range(DEPTHS):
        routed = _routes(pending, depth)
        rows = written(routed, "routes")
        crowded = rows.groupBy("route").count().filter(F.col("count") > max_route).select("route")
        done = depth == DEPTHS - 1 or crowded.isEmpty()
        ready = rows if done else rows.join(crowded, "route", "left_anti")
        ready = ready.repartition("route").sortWithinPartitions("route", "rank")
        edges.append(written(ready.select("code", "route").mapInArrow(_search, "u long, v long"), "edges"))
        if done:
            break
        pending = rows.join(crowded, "route", "left_semi")
    out = edges[0]
    for more in edges[1:]:
        out = out.unionByName(more)
    return out


def near_duplicates(docs: DataFrame, max_route: int = MAX_ROUTE) -> DataFrame:
    """doc_id, text_hash, code, root and component_id of every row: rows with one root are near-duplicates, directly or in
    a chain."""
    rows = written(fingerprints(docs), "fingerprints")
    codes = written(rows.groupBy("code").agg(F.min("doc_id").alias("first")), "codes")
    roots = components(links(codes.select("code"), max_route)).select(F.col("node").alias("code"), "root")
    rooted = codes.join(roots, "code", "left").select("code", "first", F.coalesce("root", "code").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select("code", "root", "component_id")
    return rows.join(named, "code").select("doc_id", "text_hash", "code", "root", "component_id")


def representatives(docs: DataFrame, max_route: int = MAX_ROUTE) -> DataFrame:
    """One row of each group of near-duplicates, with all its columns: the one with the least doc_id, a null id only
    where there is no other. Rows that share that id are told apart by a hash of the text; equal rows count once."""
    near = near_duplicates(docs, max_route)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_hash"))
    least = near.groupBy("root").agg(F.min(order).alias("least")).select("least.*")
    key, text = fresh("kept_id", docs.columns), fresh("kept_hash", docs.columns)
    at = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    kept = least.select(at.alias(key), F.col("text_hash").alias(text))
    rows = docs.withColumns({key: at, text: _text_hash()})
    return rows.join(kept, [key, text], "left_semi").dropDuplicates([key, text]).select(docs.columns)
