"""Text quality by a generalised additive model with pairwise interactions.

Shape functions are lookup tables over quantile bins. Boosting goes round the features in turn: each step fits a tree of
a few leaves on one feature's gradient histogram and adds it to that feature's table. Afterwards the strongest pairs get
grids of their own in the same way. A score is an intercept plus one table entry per feature and pair.

A null text is an empty one and gets a score. Rows keep their number and repeat as often as they come; a doc_id may be
null. Labelled rows that match no document are not used. With no usable label of either kind, the score is the share of
ones seen, or 0.5 without any.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridwright.llm.batches import raw_texts, slices, text_rows

#: At most so many labelled documents, those with the least hash of doc_id, are used to fit the model.
MAX_LABELLED = 20_000
ROUNDS, RATE, LEAVES, BINS = 150, 0.1, 3, 48
PAIRS, PAIR_ROUNDS, PAIR_BINS = 8, 40, 12
ACCEPT = 0.3

FEATURES = (
    "log_bytes", "log_words", "word_length", "distinct_words", "top_word", "upper_words", "odd_endings", "lone_signs",
    "adjacent_repeats", "distinct_pairs", "repeated_lines", "line_words", "digits", "signs", "upper", "wide_bytes",
    "stops", "compressed",
)
_CLASS = np.zeros(256, dtype=np.int64)  # digits 1, upper case 2, signs 3, white space 4, bytes of wide characters 5
_CLASS[48:58], _CLASS[65:91], _CLASS[128:] = 1, 2, 5
_CLASS[[c for c in range(33, 127) if not chr(c).isalnum()]] = 3
_CLASS[[9, 10, 11, 12, 13, 32]] = 4
_PLAIN_END = frozenset(b".,;:?!)\"'")


def features(raw: bytes) -> list[float]:
    """The numbers in FEATURES for one whole text."""
    words = raw.split()
    n, size = len(words), len(raw)
    if not n:
        return [np.log1p(size)] + [0.0] * (len(FEATURES) - 1)
    counts = Counter(words)
    kinds = np.bincount(_CLASS[np.frombuffer(raw, dtype=np.uint8)], minlength=6) / size
    odd = alone = upper = 0
    for word, times in counts.items():
        last, signs = word[-1], 0
        if last < 128 and _CLASS[last] == 3:
            if len(word) == 1 or not any(_CLASS[c] != 3 for c in word):
                alone += times
            elif last not in _PLAIN_END or (word[-2] < 128 and _CLASS[word[-2]] == 3):
                odd += times
        upper += times * word.isupper()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return [
        np.log1p(size), np.log1p(n), sum(map(len, words)) / n, len(counts) / n, max(counts.values()) / n, upper / n,
        odd / n, alone / n, sum(map(eq, words, words[1:])) / n, len(set(zip(words, words[1:]))) / n,
        1 - len(set(lines)) / len(lines), np.log1p(n / len(lines)), kinds[1], kinds[3], kinds[2], kinds[5],
        (raw.count(b".") + raw.count(b"?")) / n, len(zlib.compress(raw, 1)) / size,
    ]


@dataclass
class AdditiveModel:
    """Edges of the bins, one table per feature, and one grid per pair of features with coarser edges."""

    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    grids: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for j, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[j], x[:, j], side="right")]
        for (i, j), grid in zip(self.pairs, self.grids):
            rows = np.searchsorted(self.coarse[i], x[:, i], side="right")
            total += grid[rows, np.searchsorted(self.coarse[j], x[:, j], side="right")]
        return 1 / (1 + np.exp(-total))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _shallow_tree(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """Values per bin of a tree over one feature: the best cut of the best leaf until there are so many leaves."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        best = (1e-9, None, 0)
        for k, (a, b) in enumerate(parts):
            gl, hl = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
            if len(gl):
                gains = _gain(gl, hl) + _gain(g[a:b].sum() - gl, h[a:b].sum() - hl) - _gain(g[a:b].sum(), h[a:b].sum())
                cut = int(np.argmax(gains))
                best = max(best, (gains[cut], k, a + cut + 1), key=lambda x: x[0])
        if best[1] is None:
            break
        a, b = parts.pop(best[1])
        parts += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + 1.0)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best tree that cuts a grid once along either feature."""
    best, out = 0.0, np.zeros_like(g)
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    if min(g.shape) < 2:
        return best, out
    a, b = cg[:-1, :-1], ch[:-1, :-1]
    parts = [(a, b), (cg[:-1, -1:] - a, ch[:-1, -1:] - b), (cg[-1:, :-1] - a, ch[-1:, :-1] - b)]
    parts.append((cg[-1, -1] - sum(p[0] for p in parts), ch[-1, -1] - sum(p[1] for p in parts)))
    gains = sum(_gain(*p) for p in parts)
    r, c = np.unravel_index(int(np.argmax(gains)), gains.shape)
    best = float(gains[r, c] - _gain(cg[-1, -1], ch[-1, -1]))
    values = [p[0][r, c] / (p[1][r, c] + 1.0) for p in parts]
    out[: r + 1, : c + 1], out[: r + 1, c + 1:], out[r + 1:, : c + 1], out[r + 1:, c + 1:] = values
    return best, out


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Cyclic boosting on logistic loss, features first, then the pairs with the largest gain on what is left."""
    share = float(y.mean()) if len(y) else 0.5
    if share in (0.0, 1.0) or not len(y):
        share = min(max(share, 1e-3), 1 - 1e-3)
        return AdditiveModel(float(np.log(share / (1 - share))))
    model = AdditiveModel(float(np.log(share / (1 - share))))
    count = x.shape[1]
    model.edges = [_edges(x[:, j], BINS) for j in range(count)]
    model.coarse = [_edges(x[:, j], PAIR_BINS) for j in range(count)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    bins = [np.searchsorted(model.edges[j], x[:, j], side="right") for j in range(count)]
    cells = [np.searchsorted(model.coarse[j], x[:, j], side="right") for j in range(count)]
    total = np.full(len(y), model.intercept)

    def slopes(where: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return np.bincount(where, y - p, size), np.bincount(where, p * (1 - p), size)

    for _ in range(ROUNDS):
        for j in range(count):
            step = RATE * _shallow_tree(*slopes(bins[j], len(model.tables[j])), LEAVES)
            model.tables[j] += step
            total += step[bins[j]]
    shapes = [len(e) + 1 for e in model.coarse]
    ranked = []
    for i in range(count):
        for j in range(i + 1, count):
            g, h = slopes(cells[i] * shapes[j] + cells[j], shapes[i] * shapes[j])
            ranked.append((_quadrants(g.reshape(shapes[i], -1), h.reshape(shapes[i], -1))[0], i, j))
    model.pairs = [(i, j) for gain, i, j in sorted(ranked, reverse=True)[:PAIRS] if gain > 0]
    model.grids = [np.zeros((shapes[i], shapes[j])) for i, j in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (i, j) in enumerate(model.pairs):
            where = cells[i] * shapes[j] + cells[j]
            g, h = slopes(where, shapes[i] * shapes[j])
            step = RATE * _quadrants(g.reshape(shapes[i], -1), h.reshape(shapes[i], -1))[1]
            model.grids[k] += step
            total += step.ravel()[where]
    return model


def held_out(doc_id: str = "doc_id"):
    """Rows that no model learns from: crc32 of the id as text is divisible by five. A null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> AdditiveModel:
    """A model from at most `max_labelled` labelled documents; only their features reach the driver."""
    rows = text_rows(docs).filter(~held_out())
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("quality"))
    known = known.filter(~held_out() & F.col("quality").isin(0.0, 1.0))
    # The bound on the rows bounds what is broadcast.
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(max_labelled)
    joined = rows.join(F.broadcast(chosen), "doc_id").select("text", "quality")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = pa.array([features(x) for x in raw_texts(batch)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([values, batch.column("quality")], ["x", "y"])

    got = joined.mapInArrow(measure, "x array<double>, y double").limit(4 * max_labelled).toArrow()
    x = np.array(got.column("x").to_pylist(), dtype=np.float64).reshape(-1, len(FEATURES))
    order = np.lexsort([got.column("y").to_numpy(), *x.T])
    return fit(x[order], got.column("y").to_numpy()[order])


def score(docs: DataFrame, model: AdditiveModel) -> DataFrame:
    """doc_id and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = np.array([features(t) for t in raw_texts(batch)]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(shared.value.score(x))], ["doc_id", "score"])

    return text_rows(docs).mapInArrow(rate, "doc_id long, score double")


def accepted(docs: DataFrame, model: AdditiveModel, threshold: float = ACCEPT) -> DataFrame:
    """The rows, with all their columns, whose text scores at least the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = np.array([features(t) for t in raw_texts(batch)]).reshape(-1, len(FEATURES))
            yield batch.filter(pa.array(shared.value.score(x) >= threshold))

    return docs.mapInArrow(keep, docs.schema)
