"""Boosted trees on histograms, grown for all horizons together.

The rows are binned once and kept as blocks of numbers, column by column. A pass over the blocks sums residuals and counts by
horizon, node, feature and bin; the sums of all tasks meet in a shuffle, where each feature proposes its best split of every
node, so the driver gets one short row per horizon and feature, whatever the number of rows. One pass grows a level of the
trees of all horizons that still learn. Columns of few bins share a histogram and are told apart afterwards. Where one task
has all blocks, only the lesser of two children is summed; the other has the rest of its parent's sums.

The losses on val come with the first pass of each round. A horizon stops when `patience` rounds have not done better, and
its model is the prefix of its ensemble that did best; nothing is fitted twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridwright.session import written

BLOCK_ROWS = 65_536
#: Blocks for each task at least, so that tasks get even shares of the rows.
TASK_BLOCKS = 4
#: Rows that a task holds: a pass over fewer costs less than starting another task for them.
TASK_ROWS = 524_288
#: Rounds after which the blocks are made from the written table again, which keeps their lineage short.
RENEW = 25
QUANTILE_ERROR = 0.001
#: Rows for each cell of a histogram that columns share.
SHARED_ROWS = 8


@dataclass(frozen=True)
class Boosting:
    """Boosted-tree settings. As many rounds are kept as do best on val; training ends once `patience` more have not
    done better. Without rows in val all rounds are kept."""

    rounds: int = 500
    rate: float = 0.05
    depth: int = 6
    min_rows: int = 10
    row_share: float = 0.8
    column_share: float = 0.8
    patience: int = 50
    seed: int = 7
    penalty: float = 1.0
    bins: int = 64


def best_rounds(errors: Sequence[float], patience: int) -> tuple[int, bool]:
    """How many rounds do best, and whether `patience` further ones have followed."""
    kept = min(range(len(errors)), key=lambda i: errors[i]) + 1
    for i, error in enumerate(errors):
        if i >= patience and min(errors[i - patience + 1: i + 1]) >= min(errors[: i - patience + 1]):
            return min(range(i + 1), key=lambda k: errors[k]) + 1, True
    return kept, False


@dataclass
class Tree:
    """Nodes in the order of their making; a node without a feature is a leaf. A row goes left if its bin is at most the
    node's."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, at: int, values: tuple[float, float]) -> tuple[int, int]:
        self.feature[node], self.bin[node], self.left[node] = feature, at, len(self.feature)
        self.feature += (-1, -1)
        self.bin += (0, 0)
        self.left += (0, 0)
        self.value += values
        return self.left[node], self.left[node] + 1

    def depth(self) -> int:
        """Splits on the longest way down."""
        below = [0] * len(self.feature)
        for node in reversed(range(len(below))):
            if self.feature[node] >= 0:
                below[node] = 1 + max(below[self.left[node]], below[self.left[node] + 1])
        return below[0]

    def leaves(self, binned: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
        """The node in which each row ends, of all rows or of those named. A leaf leads to itself, since no bin is beyond 255."""
        rows = np.arange(len(binned)) if rows is None else rows
        flat = binned.T.reshape(-1)
        feature = np.array(self.feature)
        ends = feature < 0
        start = np.where(ends, 0, feature) * len(binned)
        at = np.where(ends, 255, self.bin).astype(np.uint8)
        left = np.where(ends, np.arange(len(ends)), self.left)
        node = np.zeros(len(rows), np.intp)
        for _ in range(self.depth()):
            beyond = flat.take(start.take(node) + rows) > at.take(node)
            node = left.take(node) + beyond
        return node

    def predict(self, binned: np.ndarray) -> np.ndarray:
        return np.array(self.value).take(self.leaves(binned))


def into_bins(x: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """The bin of every value, column by column; what is missing counts as less than anything."""
    out = np.empty(x.shape, np.uint8, order="F")
    for k, edges in enumerate(cuts):
        column = x[:, k]
        out[:, k] = np.where(np.isnan(column), 0, np.searchsorted(edges, column, side="right") + 1)
    return out


@dataclass
class BoostedModel:
    """The trees of one horizon that are kept, and the losses on val after 0, 1, 2 ... of all that were grown."""

    features: list[str]
    cuts: list[np.ndarray]
    base: float
    trees: list[Tree]
    losses: list[float]

    def predict(self, x: np.ndarray) -> np.ndarray:
        binned = into_bins(x, self.cuts)
        return self.base + sum((t.predict(binned) for t in self.trees), np.zeros(len(x)))

    def transform(self, df: DataFrame) -> DataFrame:
        """The rows with a column `prediction`."""
        model = self

        @F.pandas_udf("double")
        def predicted(columns: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for batch in columns:
                yield pd.Series(model.predict(np.column_stack([c.to_numpy(np.float64, na_value=np.nan) for c in batch])))

        return df.withColumn("prediction", predicted(*[F.col(c).cast("double") for c in self.features]))


@dataclass
class Block:
    """Up to `BLOCK_ROWS` rows: a hash of each, bins of all columns, what predictions leave of the targets by horizon (not a
    number where there is no target), and which rows are val. Columns lie in one piece."""

    keys: np.ndarray
    binned: np.ndarray
    residuals: np.ndarray
    val: np.ndarray

    def sampled(self, round_no: int, share: float, seed: int) -> np.ndarray:
        """Which rows a round learns from. The row itself decides, so it is the same in whatever block or task it lies; equal
        rows are taken together."""
        if share >= 1:
            return np.ones(len(self.keys), bool)
        mixed = self.keys + np.uint64((seed * 100_003 + round_no) * 0x9E3779B97F4A7C15 % 2**64)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
        return (mixed >> np.uint64(11)) < np.uint64(share * 2**53)


@dataclass
class Growing:
    """A horizon while it learns. Trees see its own columns, by their place among all binned columns; `sizes` has the number
    of bins of each of those."""

    horizon: int
    at: int
    columns: list[int]
    sizes: list[int]
    base: float
    trees: list[Tree] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)


def _blocks(table: DataFrame, columns: Sequence[str], horizons: Sequence[int], cuts: Sequence[np.ndarray], bases: Sequence[float]) -> RDD:
    """The train and val rows as blocks, from a written table so that a lost block comes back the same. Blocks are dealt evenly
    to tasks, however the table is partitioned: to one if that is enough, else to a multiple of the cores."""
    names = [f"target_h{h}" for h in horizons]

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        numbers = [rows.column(c).to_numpy().astype(np.float64) for c in [*columns, *names]]
        binned = into_bins(np.column_stack(numbers[:len(columns)]), cuts)
        targets = np.column_stack(numbers[len(columns):])
        keys, val = (rows.column(c).to_numpy() for c in ("_key", "_is_val"))
        parts = (keys.astype(np.int64), binned, targets, val.astype(bool))
        return pa.RecordBatch.from_arrays([pa.array([x.tobytes("F")], pa.binary()) for x in parts], fields)

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            while batch.num_rows:
                held.append(batch.slice(0, block_rows - sum(part.num_rows for part in held)))
                batch = batch.slice(held[-1].num_rows)
                if sum(part.num_rows for part in held) == block_rows:
                    yield packed(held)
                    held = []
        if held:
            yield packed(held)

    fields = ["keys", "binned", "targets", "val"]
    rows = table.where(F.col("split").isin("train", "val")).select(
        *[F.col(c).cast("double").alias(c) for c in [*columns, *names]], (F.col("split") == "val").alias("_is_val"))
    count, cores = rows.count(), table.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, -(-count // TASK_ROWS))
    tasks = tasks if tasks == 1 else -(-tasks // cores) * cores
    block_rows = max(1, min(BLOCK_ROWS, -(-count // (TASK_BLOCKS * tasks))))
    rows = rows.withColumn("_key", F.xxhash64(*rows.columns)).coalesce(tasks)
    stored = written(rows.mapInArrow(pack, ", ".join(f"{f} binary" for f in fields)), "blocks")
    start, width = np.array(bases), len(columns)

    def unpack(row) -> Block:
        keys, val = np.frombuffer(row["keys"], np.uint64), np.frombuffer(row["val"], bool)
        binned = np.frombuffer(row["binned"], np.uint8).reshape(width, len(val)).T
        targets = np.frombuffer(row["targets"], np.float64).reshape(len(horizons), len(val)).T
        return Block(keys, binned, targets - start, val)

    if tasks == 1:
        return stored.rdd.coalesce(1).map(unpack)
    dealt = stored.rdd.zipWithIndex().map(lambda one: (one[1], one[0])).partitionBy(tasks, lambda place: place)
    return dealt.values().map(unpack)


@dataclass(frozen=True)
class Level:
    """What a pass needs to know of a horizon: its place, its tree so far, the nodes to split and the columns to try. Where
    the sums of the level above stay at hand, only half of the children is summed (`halved`): `parents` has the place of each
    pair's parent there, `lesser` which child of the pair has fewer rows."""

    horizon: int
    at: int
    tree: Tree
    nodes: list[int]
    columns: list[int]
    sizes: list[int]
    halved: bool = False
    parents: list[int] = field(default_factory=list)
    lesser: list[int] = field(default_factory=list)

    def summed(self) -> list[int]:
        """The nodes that a pass sums."""
        return [self.nodes[2 * n + side] for n, side in enumerate(self.lesser)] if self.parents else self.nodes

    def whole(self, sums: np.ndarray, above: np.ndarray | None) -> np.ndarray:
        """The sums of all nodes, from those of the summed ones and of the level above."""
        if not self.parents:
            return sums
        first, side = 2 * np.arange(len(self.parents)), np.array(self.lesser)
        rest = above[:, self.parents] - sums
        rest[0][rest[1] == 0] = 0.0
        out = np.empty((2, len(self.nodes), sums.shape[2]))
        out[:, first + side], out[:, first + 1 - side] = sums, rest
        return out


def _sharing(columns: Sequence[int], sizes: Sequence[int], nodes: int, rows: int) -> list[list[int]]:
    """Columns that share a histogram, those of few bins first, as long as it has few cells for its rows."""
    groups: list[list[int]] = []
    cells = 0
    for k in sorted(columns, key=lambda k: sizes[k]):
        if groups and cells * sizes[k] * SHARED_ROWS <= rows:
            groups[-1].append(k)
            cells *= sizes[k]
        else:
            groups.append([k])
            cells = nodes * sizes[k]
    return groups


def _sums(block: Block, level: Level, settings: Boosting, learning: np.ndarray) -> Iterator[tuple]:
    """((horizon, column), sums) over the block, where sums are residuals and counts by summed node and bin."""
    tree, nodes = level.tree, level.summed()
    residual = block.residuals[:, level.at]
    if not tree.left[0] and block.val.any():
        off = residual[block.val]
        off = off[~np.isnan(off)]
        yield (level.horizon, -1), np.array([np.square(off).sum(), len(off)])
    place = np.full(len(tree.feature), -1)
    place[nodes] = np.arange(len(nodes))
    residual, node = residual.take(learning), place.take(tree.leaves(block.binned, learning))
    here = np.flatnonzero((node >= 0) & ~np.isnan(residual))
    rows, node, residual = learning.take(here), node.take(here), residual.take(here)
    for group in _sharing(level.columns, level.sizes, len(nodes), len(rows)):
        cell, shape = node, [len(nodes), *[level.sizes[k] for k in group]]
        for k in group:
            cell = cell * level.sizes[k] + block.binned[:, k].take(rows)
        cells = int(np.prod(shape))
        shared = np.stack((np.bincount(cell, residual, cells), np.bincount(cell, minlength=cells))).reshape(2, *shape)
        for n, k in enumerate(group):
            sums = np.zeros((2, len(nodes), settings.bins + 1))
            sums[:, :, :level.sizes[k]] = shared.sum(axis=tuple(2 + i for i in range(len(group)) if i != n))
            yield (level.horizon, k), sums


def best_splits(sums: np.ndarray, settings: Boosting) -> np.ndarray:
    """(gain, bin, residuals and rows left, residuals and rows right) of the best split of each node by one feature."""
    left = np.cumsum(sums, axis=2)[:, :, :-1]
    total = sums.sum(axis=2)
    right = total[:, :, None] - left

    def score(part: np.ndarray) -> np.ndarray:
        return np.square(part[0]) / (part[1] + settings.penalty)

    gain = score(left) + score(right) - score(total)[:, None]
    gain[(left[1] < settings.min_rows) | (right[1] < settings.min_rows)] = -np.inf
    at = gain.argmax(axis=1)
    nodes = np.arange(len(at))
    return np.column_stack((gain[nodes, at], at, *left[:, nodes, at], *right[:, nodes, at]))


Found = dict[tuple[int, int], np.ndarray]


def _added(blocks: Iterable[Block], work: Sequence[Level], settings: Boosting, round_no: int) -> Found:
    totals: Found = {}
    for block in blocks:
        learning = np.flatnonzero(~block.val & block.sampled(round_no, settings.row_share, settings.seed))
        for level in work:
            for key, sums in _sums(block, level, settings, learning):
                totals[key] = totals[key] + sums if key in totals else sums
    return totals


def _whole(part: Iterable[tuple], work: Sequence[Level]) -> Iterator[tuple]:
    """(key, sums of all nodes) from (key, (sums of the summed ones, sums of the level above)); losses pass."""
    levels = {level.horizon: level for level in work}
    for key, (sums, above) in part:
        if sums is not None:
            yield key, sums if key[1] < 0 else levels[key[0]].whole(sums, above)


def _judged(part: Iterable[tuple[tuple[int, int], np.ndarray]], settings: Boosting) -> Iterator[tuple]:
    return ((key, sums if key[1] < 0 else best_splits(sums, settings)) for key, sums in part)


def _pass(blocks: RDD, work: Sequence[Level], settings: Boosting, round_no: int) -> Found:
    """Best splits by (horizon, column), and the loss on val under column -1, from one pass."""
    keys = sum(len(level.columns) for level in work)
    sums = blocks.mapPartitions(lambda part: iter(_added(part, work, settings, round_no).items()))
    reduced = sums.reduceByKey(np.add, min(max(1, keys // 8), blocks.getNumPartitions()))
    return dict(reduced.mapPartitions(lambda part: _judged(part, settings)).collect())


def _trees(starts: Sequence[Level], one_pass: Callable[[Sequence[Level]], Found], settings: Boosting) -> tuple[Found, list[Tree]]:
    """A tree for each start, level by level in common passes, and the losses before them."""
    losses: Found = {}
    work = list(starts)
    for depth in range(settings.depth):
        found = one_pass(work)
        if not depth:
            losses = {key: sums for key, sums in found.items() if key[1] < 0}
        work = [after for level in work if (after := _split(level, found, settings))]
        if not work:
            break
    return losses, [level.tree for level in starts]


def _grow_round(blocks: RDD, active: Sequence[Growing], settings: Boosting, round_no: int) -> list[Tree]:
    """One tree for each horizon; takes down the losses before it. Where all blocks are in one task, the round's passes run
    there, else each is a job."""
    starts, alone = [], blocks.getNumPartitions() == 1
    for growing in active:
        rng = np.random.default_rng([settings.seed, growing.horizon, round_no])
        taken = max(1, round(settings.column_share * len(growing.columns)))
        columns = sorted(rng.choice(growing.columns, taken, replace=False).tolist())
        starts.append(Level(growing.horizon, growing.at, Tree(), [0], columns, growing.sizes, alone))

    def in_task(part: Iterator[Block]) -> Iterator[tuple[Found, list[Tree]]]:
        held, above = list(part), {}

        def one_pass(work: Sequence[Level]) -> Found:
            nonlocal above
            sums = _added(held, work, settings, round_no)
            above = dict(_whole(((key, (v, above.get(key))) for key, v in sums.items()), work))
            return dict(_judged(above.items(), settings))

        yield _trees(starts, one_pass, settings)

    if alone:
        losses, trees = blocks.mapPartitions(in_task).first()
    else:
        losses, trees = _trees(starts, lambda work: _pass(blocks, work, settings, round_no), settings)
    for growing in active:
        squares, count = losses.get((growing.horizon, -1), (0.0, 0))
        growing.losses.append(float(squares / count) if count else np.nan)
    return trees


def _split(level: Level, found: Found, settings: Boosting) -> Level | None:
    """The next level of a tree, after splitting the nodes of this one where that gains anything."""
    if (level.horizon, level.columns[0]) not in found:
        return None
    options = np.stack([found[level.horizon, k] for k in level.columns])
    children: list[int] = []
    parents: list[int] = []
    lesser: list[int] = []
    for n, node in enumerate(level.nodes):
        pick = int(options[:, n, 0].argmax())
        gain, at, *sides = options[pick, n]
        if gain > 0:
            values = tuple(settings.rate * s / (c + settings.penalty) for s, c in (sides[:2], sides[2:]))
            children += level.tree.split(node, level.columns[pick], int(at), values)
            parents.append(n)
            lesser.append(int(sides[3] < sides[1]))
    pairs = {"parents": parents, "lesser": lesser} if level.halved else {}
    return replace(level, nodes=children, **pairs) if children else None


def _final_losses(blocks: RDD, active: Sequence[Growing]) -> dict[int, np.ndarray]:
    places = [(g.horizon, g.at) for g in active]

    def lost(block: Block) -> Iterator[tuple[int, np.ndarray]]:
        for horizon, at in places:
            off = block.residuals[:, at][block.val]
            off = off[~np.isnan(off)]
            yield horizon, np.array([np.square(off).sum(), len(off)])

    return dict(blocks.flatMap(lost).reduceByKey(np.add, 1).collect())


def _advanced(blocks: RDD, trees: Sequence[tuple[int, Sequence[Tree]]]) -> RDD:
    """The blocks with residuals that more trees leave, kept as soon as a pass reads them."""

    def advance(block: Block) -> Block:
        residuals = block.residuals.copy("F")
        for at, grown in trees:
            for tree in grown:
                residuals[:, at] -= tree.predict(block.binned)
        return replace(block, residuals=residuals)

    return blocks.map(advance).persist(StorageLevel.MEMORY_AND_DISK_DESER)


def boost_horizons(
    table: DataFrame, features: Mapping[int, Mapping[str, str]], settings: Boosting = Boosting(),
) -> dict[int, BoostedModel]:
    """A model for every horizon of `features`, which gives the source column of each feature there. The table has `split`
    and `target_h{h}`; rows without a target are left out, and a horizon without any in train has no model. Nulls among
    the features count as less than any value."""
    if not 2 <= settings.bins < 255:
        raise ValueError("bins are numbered in a byte")
    horizons = sorted(features)
    train = F.col("split") == "train"
    means = table.where(train).agg(*[F.avg(f"target_h{h}").alias(f"mean{h}") for h in horizons]).first()
    horizons = [h for h, mean in zip(horizons, means) if mean is not None]
    if not horizons:
        return {}
    bases = [float(mean) for mean in means if mean is not None]
    columns = sorted({c for h in horizons for c in features[h].values()})
    numbers = table.where(train).select(*[F.col(c).cast("double").alias(c) for c in columns])
    shares = [k / settings.bins for k in range(1, settings.bins)]
    cuts = [np.unique(q) for q in numbers.approxQuantile(columns, shares, QUANTILE_ERROR)]
    origin = _blocks(table, columns, horizons, cuts, bases)
    blocks, before = _advanced(origin, []), None
    sizes = [len(edges) + 2 for edges in cuts]
    growing = [
        Growing(h, k, sorted(columns.index(c) for c in features[h].values()), sizes, bases[k]) for k, h in enumerate(horizons)]
    active = list(growing)
    for round_no in range(settings.rounds):
        grown = _grow_round(blocks, active, settings, round_no)
        if before is not None:
            before.unpersist()
        for one, tree in zip(active, grown):
            one.trees.append(tree)
        active = [g for g in active if not _has_stopped(g, settings)]
        if not active:
            break
        renewed = (round_no + 1) % RENEW == 0
        before, blocks = blocks, _advanced(
            origin if renewed else blocks, [(g.at, g.trees[0 if renewed else -1:]) for g in active])
    for h, (squares, count) in (_final_losses(blocks, active) if active else {}).items():
        growing[horizons.index(h)].losses.append(float(squares / count) if count else np.nan)
    for rdd in (blocks, before):
        if rdd is not None:
            rdd.unpersist()
    return {g.horizon: _kept(g, features[g.horizon], columns, cuts) for g in growing}


def _has_stopped(growing: Growing, settings: Boosting) -> bool:
    """The loss before the first tree does not count: one tree is kept at least."""
    judged = growing.losses[1:]
    return bool(judged) and not np.isnan(judged[-1]) and best_rounds(judged, settings.patience)[1]


def _kept(growing: Growing, named: Mapping[str, str], columns: Sequence[str], cuts: Sequence[np.ndarray]) -> BoostedModel:
    """The best prefix of the ensemble, over the horizon's own features under their own names."""
    losses = np.array(growing.losses)
    count = len(growing.trees) if np.isnan(losses).all() else 1 + int(np.nanargmin(losses[1:]))
    place = {columns.index(c): n for n, c in enumerate(named.values())}
    trees = [
        Tree([place.get(f, -1) for f in t.feature], t.bin, t.left, t.value) for t in growing.trees[:count]]
    return BoostedModel(list(named), [cuts[columns.index(c)] for c in named.values()], growing.base, trees, growing.losses)
