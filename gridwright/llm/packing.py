"""Documents packed into token sequences by bin completion over the histogram of piece lengths.

Only how many pieces have each length matters for the number of sequences, and there are no more lengths than tokens in a
sequence. So the driver plans on that histogram: take the largest piece left, enumerate the undominated ways to fill the
rest of its sequence, and use one of them as often as the counts allow; branch over the ways, leave a branch whose waste
already rules out beating the incumbent, and begin with best-fit decreasing as incumbent. Pieces then find their place by
their rank among the pieces of the same length, which is a running number within a part plus a sum over earlier parts.

A null text is an empty one: its piece is the end token alone. Repeated rows and null ids are packed like any others; an
empty table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridwright.llm.batches import slices, text_rows, texts
from gridwright.llm.tokens import encoder
from gridwright.session import written

CAPACITY, END = 2048, 0
#: Work of the search: nodes of the branch and bound, steps of one enumeration, ways kept from it.
NODES, STEPS, WAYS = 12_000, 3_000, 4
Plan = list[tuple[tuple[int, ...], int]]


def _used(plan: Plan) -> int:
    return sum(times for _, times in plan)


def best_fit(counts: np.ndarray, capacity: int) -> Plan:
    """Best-fit decreasing, equal sequences taken together: (lengths, how many such sequences)."""
    rooms: list[int] = []
    groups: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def put(filled: tuple[int, ...], times: int, room: int) -> None:
        if room not in groups:
            rooms.insert(bisect_left(rooms, room), room)
            groups[room] = []
        groups[room].append((filled, times))

    for size in range(capacity, 0, -1):
        left = int(counts[size])
        while left:
            at = bisect_left(rooms, size)
            if at < len(rooms):
                room = rooms[at]
                filled, times = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[at]
                take = min(left, times)
                if times > take:
                    put(filled, times - take, room)
                put((*filled, size), take, room - size)
                left -= take
            else:
                each = capacity // size
                full, rest = divmod(left, each)
                if full:
                    put((size,) * each, full, capacity - size * each)
                if rest:
                    put((size,) * rest, 1, capacity - size * rest)
                left = 0
    return [group for held in groups.values() for group in held]


def completions(counts: np.ndarray, room: int, ways: int = WAYS, steps: int = STEPS) -> list[tuple[int, tuple[int, ...]]]:
    """(waste, lengths) of the best undominated fillings of the room: nothing left out would still fit, and of equal waste
    the one with fewer and larger pieces comes first."""
    sizes = np.flatnonzero(counts[: room + 1])[::-1].tolist()
    order = [-s for s in sizes]
    found: set[tuple[int, int, tuple[int, ...]]] = set()
    exact = 0
    stack = [(0, 0, room, (), room + 1)]
    while stack and steps and exact < ways:
        steps -= 1
        at, taken, room, chosen, skipped = stack.pop()
        fits = bisect_left(order, -room, lo=at)
        at, taken = (at, taken) if fits == at else (fits, 0)
        if at == len(sizes):
            if room < skipped:
                found.add((room, len(chosen), chosen))
                exact += room == 0
            continue
        size, more = sizes[at], taken < counts[sizes[at]]
        stack.append((at + 1, 0, room, chosen, size if more else skipped))
        if more:
            stack.append((at, taken + 1, room - size, (*chosen, size), skipped))
    best = sorted(found, key=lambda f: (f[0], f[1], [-size for size in f[2]]))
    return [(waste, chosen) for waste, _, chosen in best[:ways]]


def fewest(counts: np.ndarray, capacity: int) -> int:
    """A lower bound on the number of sequences: by total length, and by pieces that cannot share one."""
    lengths = np.arange(capacity + 1)
    bound = -(-int((counts * lengths).sum()) // capacity)
    for small in range(1, capacity // 2 + 1):
        big = int(counts[capacity - small + 1:].sum())
        middle = counts[capacity // 2 + 1: capacity - small + 1]
        room = int(((capacity - lengths[capacity // 2 + 1: capacity - small + 1]) * middle).sum())
        rest = int((counts[small: capacity // 2 + 1] * lengths[small: capacity // 2 + 1]).sum())
        bound = max(bound, big + int(middle.sum()) + max(0, -(-(rest - room) // capacity)))
    return bound


def bin_completion(counts: np.ndarray, capacity: int = CAPACITY, nodes: int = NODES) -> Plan:
    """A plan with as few sequences as the search finds; it ends early when a lower bound is met."""
    counts = counts.astype(np.int64).copy()
    best = best_fit(counts, capacity)
    bound, total = fewest(counts, capacity), int((counts * np.arange(capacity + 1)).sum())
    plan: Plan = []
    waste = 0
    branches: list[list[tuple[int, tuple[int, ...]]]] = []

    def ways() -> list[tuple[int, tuple[int, ...]]]:
        largest = int(np.flatnonzero(counts)[-1])
        counts[largest] -= 1
        out = [(w, (largest, *c)) for w, c in completions(counts, capacity - largest)]
        counts[largest] += 1
        return out[::-1]

    if counts.any():
        branches.append(ways())
    while branches and _used(best) > bound and nodes:
        nodes -= 1
        if not branches[-1]:
            branches.pop()
            if plan:
                filled, times = plan.pop()
                np.add.at(counts, list(filled), times)
                waste -= times * (capacity - sum(filled))
            continue
        lost, filled = branches[-1].pop()
        sizes, copies = np.unique(filled, return_counts=True)
        times = int((counts[sizes] // copies).min())
        # Beating the incumbent leaves so much waste in all.
        if waste + times * lost > (_used(best) - 1) * capacity - total:
            continue
        counts[sizes] -= times * copies
        plan.append((filled, times))
        waste += times * lost
        if counts.any():
            branches.append(ways())
            continue
        if _used(plan) < _used(best):
            best = list(plan)
        branches.append([])
    return best


class Places:
    """Where the n-th piece of a length goes, by lookup in the sorted first ranks of the plan's entries."""

    def __init__(self, plan: Plan) -> None:
        taken: dict[int, int] = {}
        rows, base = [], 0
        for filled, times in plan:
            sizes, copies = np.unique(filled, return_counts=True)
            offset = 0
            for size, n in zip(sizes.tolist()[::-1], copies.tolist()[::-1]):
                rows.append((size, taken.get(size, 0), n, base, offset))
                taken[size] = taken.get(size, 0) + n * times
                offset += n * size
            base += times
        table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
        self.keys, self.table = table[:, 0] << 48 | table[:, 1], table

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, length << 48 | rank, side="right") - 1
        _, first, copies, base, offset = self.table[at].T
        return base + (rank - first) // copies, offset + (rank - first) % copies * length


_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, part long, nth long"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Every document's ids and its end token, cut where longer than a sequence, in a written table. `nth` numbers the
    pieces of one length within a part."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = encoder(tokenizer), np.zeros(capacity + 1, dtype=np.int64)
        part = TaskContext.get().partitionId()
        for batch in slices(batches):
            rows, ids = [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                tokens = np.append(known.encode(text).astype("<u4"), np.uint32(END))
                for number, start in enumerate(range(0, len(tokens), capacity)):
                    own = tokens[start: start + capacity]
                    rows.append((doc_id, number, start, len(own), zlib.crc32(own), part, int(seen[len(own)])))
                    seen[len(own)] += 1
                    ids.append(own.astype(np.int32) if with_ids else None)
            columns = [pa.array(x, t) for x, t in zip(zip(*rows), [pa.int64(), pa.int32()] + [pa.int64()] * 5)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]
            if with_ids:
                columns, names = [*columns, pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = _PIECE + (", ids array<int>" if with_ids else "")
    return written(text_rows(docs).mapInArrow(cut, schema), "pieces")


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, its sequence_id and the offset there (and its ids)."""
    cut = pieces(docs, tokenizer, capacity, with_ids)
    by_part = cut.groupBy("part", "length").count()
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in by_part.groupBy("length").agg(F.sum("count")).collect():  # at most one row per length
        histogram[length] = n
    places = docs.sparkSession.sparkContext.broadcast(Places(bin_completion(histogram, capacity)))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_part.select("part", "length", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    ranked = cut.join(before, ["part", "length"]).withColumn("rank", F.col("nth") + F.col("before"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = places.value.find(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), *map(pa.array, found)], [*columns, "sequence_id", "offset"])

    schema = _PIECE.split(", part")[0] + (", ids array<int>" if with_ids else "") + ", sequence_id long, offset long"
    return ranked.select(*columns, "rank").mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and its ids, from pieces packed with their ids; a group has at most one sequence's tokens."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
