"""Shards of near equal bytes by a k-d tree over document metadata.

A node is split along the metadata dimension in which its documents spread widest, at the weighted median (or, for an odd
number of leaves, the matching quantile) of bytes, until each leaf has its share. The medians of all nodes of a level are
found together by bisection on histograms: one pass sums bytes by bucket of each node's key range, the next looks into
the bucket that holds the median. Only these sums reach the driver; rows never move for it.

Within one coordinate documents follow a hash of their text, so equal texts stay together unless the cut would miss its
target by more than `slack` of a leaf. Only then a group is cut, by a hash of doc_id.

A null text has no bytes and still takes its eight; null metadata counts as the least value. Repeated rows are placed one
by one. An empty table gives no rows; shards may stay empty if there are fewer documents than shards.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridwright.session import small_table, written

SHARDS, OVERHEAD, SLACK = 24, 8, 0.002
#: Sums per pass over all nodes together, and the most for one node.
SUMS, MOST_SUMS = 262_144, 1024
DIMENSIONS = ("source", "lang", "length", "position")
_SCALE, _TIES = 2**29, 2**32


def _first_bytes(column: str) -> Column:
    """The first six bytes of a string as a number in the order of the strings."""
    digits = F.substring(F.rpad(F.hex(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), 12, "0"), 1, 12)
    return F.conv(digits, 16, 10).cast("long")


def metadata(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, two tie-breaking hashes and the coordinates of every document, in a written table."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), _first_bytes("source").alias("source"),
        _first_bytes("lang").alias("lang"))
    size = F.octet_length("text").cast("long")
    return written(rows.select(
        "doc_id", (size + OVERHEAD).alias("size"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64("text"), F.lit(_TIES)).alias("tie"), F.pmod(F.xxhash64("doc_id", "text"), F.lit(2**61)).alias("own"),
        "source", "lang", size.alias("length"), F.coalesce("doc_id", F.lit(0)).alias("position")), "metadata")


@dataclass
class Search:
    """A node on its way to a cut: leaves from `node` on, and the key range that still holds the target."""

    node: int
    leaves: int
    dimension: int
    target: float
    slack: float
    low: int
    high: int
    below: int = 0
    deep: bool = False
    pivot: int = 0
    done: bool = False

    def settle(self, at: int) -> None:
        """Cut before `at`, in the key or, where one key is too heavy, in the hash of the rows that have it."""
        self.low, self.done = at, True

    def narrow(self, buckets: list[tuple[int, int, int]]) -> None:
        """Take in (bytes, least key, greatest key) of the buckets in order: a cut at an edge between two of them if one
        is near enough, else the bucket that holds the target."""
        before = self.below
        edges = []
        for weight, low, high in buckets:
            edges.append((abs(before - self.target), low))
            if before <= self.target < before + weight:
                inside = (before, low, high)
            before += weight
        edges.append((abs(before - self.target), self.high + 1))
        miss, at = min(edges)
        if miss <= self.slack or not self.below <= self.target < before:
            self.settle(at)
            return
        self.below, self.low, self.high = inside
        if self.low == self.high:
            if self.deep:
                self.settle(at)
            else:
                self.deep, self.pivot, self.low, self.high = True, self.low, 0, 2**61 - 1

    def cut(self) -> tuple[int, int, int, int, int]:
        """(node, right node, dimension, key, hash): rows at or after (key, hash) go right."""
        key, own = (self.pivot, self.low) if self.deep else (self.low, 0)
        return self.node, self.node + self.leaves // 2, self.dimension, key, own


def _with_keys(rows: DataFrame, ranges: dict[str, tuple[int, int]]) -> DataFrame:
    """The coordinates scaled to the same range over all documents."""
    scaled = []
    for name in DIMENSIONS:
        low, high = ranges[name]
        part = (F.col(name) - F.lit(low)) / F.lit(float(max(high - low, 1)))
        scaled.append(F.floor(part * (_SCALE - 1)).cast("long"))
    return rows.withColumn("at", F.array(*scaled))


_KEY = "at[dimension] * {} + tie".format(_TIES)


def _buckets(rows: DataFrame, searches: list[Search]) -> dict[int, list[tuple[int, int, int]]]:
    count = max(2, min(MOST_SUMS, SUMS // len(searches)))
    state = [(s.node, s.dimension, s.low, s.high, max(1, -(-(s.high - s.low + 1) // count)), s.deep, s.pivot) for s in searches]
    nodes = small_table(
        rows.sparkSession, state, "node int, dimension int, low long, high long, step long, deep boolean, pivot long")
    keyed = rows.join(F.broadcast(nodes), "node").withColumn("whole", F.expr(_KEY))
    keyed = keyed.withColumn("key", F.when(~F.col("deep"), F.col("whole")).when(F.col("whole") == F.col("pivot"), F.col("own")))
    summed = keyed.filter("key between low and high").groupBy("node", F.expr("(key - low) div step").alias("bucket")).agg(
        F.sum("size").alias("bytes"), F.min("key").alias("first"), F.max("key").alias("last"))
    out: dict[int, list[tuple[int, int, int]]] = {s.node: [] for s in searches}
    for node, _, weight, first, last in sorted(summed.collect()):
        out[node].append((weight, first, last))
    return out


def _level(rows: DataFrame, leaves: dict[int, int], slack: float) -> list[tuple[int, int, int, int, int]]:
    """The cuts of all nodes with more than one leaf."""
    bounds = [x for n in range(len(DIMENSIONS)) for x in (F.min(F.col("at")[n]), F.max(F.col("at")[n]))]
    searches = []
    for node, weight, *ends in rows.groupBy("node").agg(F.sum("size"), *bounds).collect():
        if leaves[node] > 1:
            widths = [high - low for low, high in zip(ends[::2], ends[1::2])]
            wide = widths.index(max(widths))
            share = leaves[node] // 2 / leaves[node]
            low, high = ends[2 * wide] * _TIES, (ends[2 * wide + 1] + 1) * _TIES - 1
            searches.append(Search(node, leaves[node], wide, weight * share, slack, low, high))
    while pending := [s for s in searches if not s.done]:
        found = _buckets(rows, pending)
        for search in pending:
            search.narrow(found[search.node])
    return [s.cut() for s in searches]


def kd_shards(docs: DataFrame, shards: int = SHARDS, target_bytes: int | None = None, slack: float = SLACK) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (numbered without gaps within a shard) of every document. With
    `target_bytes` there are as many shards as leaves of at most so many bytes need."""
    spark = docs.sparkSession
    rows = metadata(docs)
    ends = [x for name in DIMENSIONS for x in (F.min(name), F.max(name))]
    total, *ends = rows.agg(F.sum("size"), *ends).first()
    ranges = {name: (ends[2 * n] or 0, ends[2 * n + 1] or 0) for n, name in enumerate(DIMENSIONS)}
    if target_bytes is not None:
        shards = max(1, -(-(total or 0) // target_bytes))
    rows = _with_keys(rows, ranges).select("doc_id", "size", "text_crc32", "tie", "own", "at", F.lit(0).alias("node"))
    leaves = {0: shards}
    while max(leaves.values()) > 1:
        cuts = _level(rows, leaves, slack * (total or 0) / shards)
        table = small_table(spark, cuts, "node int, right int, dimension int, cut_key long, cut_own long")
        joined = rows.join(F.broadcast(table), "node", "left").withColumn("key", F.expr(_KEY))
        right = (F.col("key") > F.col("cut_key")) | ((F.col("key") == F.col("cut_key")) & (F.col("own") >= F.col("cut_own")))
        node = F.when(right, F.col("right")).otherwise(F.col("node"))
        rows = written(joined.select("doc_id", "size", "text_crc32", "tie", "own", "at", node.alias("node")), "nodes")
        leaves = {k: n for node, count in leaves.items() for k, n in (
            [(node, count)] if count == 1 else [(node, count // 2), (node + count // 2, count - count // 2)])}
    # Rows are numbered within a part of a shard, and parts by the rows before them.
    placed = written(rows.select("doc_id", "size", "text_crc32", F.col("node").alias("shard"),
                                 F.spark_partition_id().alias("part")), "placed")
    counts = placed.groupBy("shard", "part").count()
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("shard", "part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id")) - 1
    slots = placed.withColumn("own", own).join(counts, ["shard", "part"])
    return slots.select("doc_id", "size", "text_crc32", "shard", (F.col("own") + F.col("before")).alias("slot"))
