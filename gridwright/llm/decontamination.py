"""Benchmark passages in training text, found by backward search in an FM-index per shard of documents.

A shard is a few megabytes of whole documents as word symbols. Its index is a suffix array (kept only at every sixteenth
text position) and the Burrows-Wheeler transform in a wavelet matrix, whose ranks drive both the backward search of all
test windows at once and the walk from a match to the next sampled position. Overlapping matches merge into the spans to
remove. A document longer than a shard is cut with an overlap of one word less than a window, so no match is lost. The
index leaves out stretches that have fewer words of the benchmark in a row than its shortest window: no match can touch
them, and with a benchmark that knows every word nothing is left out.

The windows are those of the benchmark's items in a table in the shared folder; each task reads it in blocks, so that
neither the driver nor a broadcast holds it. A null text has no words; an item without words has no windows and a null
item_id reads as an empty string. Items that repeat an id count as one item. Repeated rows repeat in the result.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, count, repeat

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridwright.llm.batches import raw_texts, shared_files, slices, text_rows, texts
from gridwright.session import work_path

WINDOW = 13
SHARE = 20  # contaminated: at least one word in so many is hit
SHARD_WORDS, SAMPLE, BLOCK_ITEMS, LOCATE = 2_000_000, 16, 4096, 200_000
_WORD_BYTES = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(raw: bytes) -> list[bytes]:
    """Lower-cased (A to Z) words of ASCII letters and digits and of all wider characters."""
    return raw.lower().translate(_WORD_BYTES).split()


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Start positions in the order of their suffixes: sort by three symbols, then double the depth of what is tied."""
    n, width = len(symbols), np.int64(symbols.max(initial=0) + 2)
    padded = np.concatenate([symbols.astype(np.int64) + 1, [0, 0]])
    key = (padded[:-2] * width + padded[1:-1]) * width + padded[2:]
    order = np.argsort(key)
    where = np.arange(n)
    rank = np.empty(n + 1, dtype=np.int64)
    rank[n], depth, sorted_key = -1, 3, key[order]
    while len(where):
        fresh = np.append(True, sorted_key[1:] != sorted_key[:-1])
        heads = np.flatnonzero(fresh)
        sizes = np.diff(np.append(heads, len(where)))
        rank[order[where]] = np.repeat(where[heads], sizes)
        where = where[np.repeat(sizes > 1, sizes)]
        tied = order[where]
        key = rank[tied] * (n + 2) + rank[np.minimum(tied + depth, n)] + 1
        sort = np.argsort(key)
        order[where], sorted_key = tied[sort], key[sort]
        depth *= 2
    return order


class WaveletMatrix:
    """Rank and access over a sequence of symbols, one bit per level."""

    def __init__(self, sequence: np.ndarray, symbols: int) -> None:
        self.levels: list[tuple[np.ndarray, int]] = []
        self.shifts = range(max(1, int(symbols - 1).bit_length()) - 1, -1, -1)
        for shift in self.shifts:
            bit = sequence >> shift & 1
            ones = np.zeros(len(sequence) + 1, dtype=np.int32)
            np.cumsum(bit, dtype=np.int32, out=ones[1:])
            self.levels.append((ones, len(sequence) - int(ones[-1])))
            sequence = sequence[np.argsort(bit.astype(np.uint8), kind="stable")]
        self.base = self._descend(np.arange(symbols), np.zeros(symbols, dtype=np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, (ones, zeros) in zip(self.shifts, self.levels):
            before = ones[at]
            at = np.where(symbol >> shift & 1, zeros + before, at - before)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol comes before each place."""
        return self._descend(symbol, at) - self.base[symbol]

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it came before."""
        symbol = np.zeros(len(at), dtype=np.int64)
        for ones, zeros in self.levels:
            before = ones[at]
            bit = ones[at + 1] - before
            at = np.where(bit, zeros + before, at - before)
            symbol = symbol << 1 | bit
        return symbol, at - self.base[symbol]


class FMIndex:
    """Full-text index over symbols from 2 on; 1 ends each document and a single 0 ends the text."""

    def __init__(self, symbols: np.ndarray, kinds: int) -> None:
        order = suffix_array(symbols)
        self.size = len(symbols)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=kinds))])[:-1]
        self.wavelet = WaveletMatrix(symbols[order - 1], kinds)
        kept = order % SAMPLE == 0
        self.sampled = np.concatenate([[0], np.cumsum(kept, dtype=np.int32)])
        self.positions = order[kept]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pattern, low, high) of the patterns that occur; a row is a pattern, filled up with -1 on the left."""
        which = np.arange(len(patterns))
        low, high = np.zeros(len(patterns), dtype=np.int64), np.full(len(patterns), self.size, dtype=np.int64)
        done = []
        for column in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[which, column]
            over = symbol < 0
            done.append((which[over], low[over], high[over]))
            which, low, high, symbol = which[~over], low[~over], high[~over], symbol[~over]
            low = self.first[symbol] + self.wavelet.rank(symbol, low)
            high = self.first[symbol] + self.wavelet.rank(symbol, high)
            alive = low < high
            which, low, high = which[alive], low[alive], high[alive]
        done.append((which, low, high))
        return tuple(np.concatenate(x) for x in zip(*done))

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row: step back through the text until a sampled position comes."""
        found, pending, steps = np.empty(len(rows), dtype=np.int64), np.arange(len(rows)), 0
        while len(pending):
            known = self.sampled[rows + 1] > self.sampled[rows]
            found[pending[known]] = self.positions[self.sampled[rows[known]]] + steps
            pending, rows = pending[~known], rows[~known]
            symbol, before = self.wavelet.access(rows)
            rows, steps = self.first[symbol] + before, steps + 1
        return found


@dataclass
class Finding:
    """What a document has: its words, which of them are hit, and the items whose windows occur."""

    n_words: int
    hit: np.ndarray
    items: set[str]

    @property
    def contaminated(self) -> bool:
        hits = int(self.hit.sum())
        return hits > 0 and SHARE * hits >= self.n_words

    def runs(self) -> list[tuple[int, int]]:
        """Merged ranges of hit words, ends exclusive."""
        edges = np.flatnonzero(np.diff(np.concatenate([[0], self.hit.view(np.int8), [0]])))
        return list(zip(edges[::2].tolist(), edges[1::2].tolist()))

    def spans(self, text: str) -> list[dict[str, int]]:
        """The same ranges in code points."""
        if not self.hit.any():
            return []
        places = [m.span() for m in _WORD.finditer(text)]
        return [{"start": places[a][0], "end": places[b - 1][1]} for a, b in self.runs()]


def item_table(benchmark: DataFrame) -> str:
    """Path of a written table with item_id and words of each item that has any."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            lists = pa.array([words(x) for x in raw_texts(batch)], pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), lists], ["item_id", "words"])

    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col("text").cast("string"))
    path = work_path(benchmark.sparkSession, "items")
    rows.mapInArrow(split, "item_id string, words array<binary>").filter(F.size("words") > 0).write.parquet(path)
    return path


def _blocks(path: str) -> Iterator[list[tuple[str, list[bytes]]]]:
    system, folder = shared_files(path)
    for batch in ds.dataset(folder, filesystem=system, format="parquet").to_batches(batch_size=BLOCK_ITEMS, batch_readahead=1):
        if batch.num_rows:
            yield list(zip(batch.column("item_id").to_pylist(), batch.column("words").to_pylist()))


def _windows(block: list[tuple[str, list[bytes]]], symbol: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Distinct windows as rows of symbols, their lengths, and for each window the items it is from."""
    found: dict[tuple[int, ...], set[str]] = {}
    for item, parts in block:
        ids = [symbol[w] for w in parts]
        for end in range(min(WINDOW, len(ids)), len(ids) + 1):
            found.setdefault(tuple(ids[max(0, end - WINDOW): end]), set()).add(item)
    patterns = np.full((len(found), WINDOW), -1, dtype=np.int64)
    for row, window in enumerate(found):
        patterns[row, WINDOW - len(window):] = window
    return patterns, (patterns >= 0).sum(1), list(found.values())


def _passages(symbols: np.ndarray, shortest: int) -> np.ndarray:
    """Places of all runs of at least `shortest` known words, each with the end mark after it. A window has known words
    only, so whatever lies outside cannot be part of a match."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], (symbols > 1).view(np.int8), [0]])))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= shortest
    marks = np.zeros(len(symbols) + 1, dtype=np.int8)
    marks[starts[long]] += 1
    np.add.at(marks, ends[long] + 1, -1)
    return np.flatnonzero(np.cumsum(marks[:-1]))


def _search_shard(pieces: list[tuple[int, int, list[bytes]]], rows: list[Finding], path: str) -> None:
    """Index the pieces (row, first word, words) and mark in the rows what of the benchmark occurs."""
    lengths = np.array([len(p[2]) for p in pieces])
    starts, size = np.cumsum(lengths + 1) - lengths - 1, int(lengths.sum())
    places = np.arange(size) + np.repeat(np.arange(len(pieces)), lengths)
    for block in _blocks(path):
        symbol: dict[bytes, int] = defaultdict(count(2).__next__)
        patterns, sizes, owners = _windows(block, symbol)
        symbols = np.ones(size + len(pieces), dtype=np.int32)
        every = chain.from_iterable(p[2] for p in pieces)
        symbols[places] = np.fromiter(map(symbol.get, every, repeat(1)), dtype=np.int32, count=size)
        kept = _passages(symbols, int(sizes.min()))
        if not len(kept):
            continue
        index = FMIndex(np.append(symbols[kept], np.int32(0)), len(symbol) + 2)
        which, low, high = index.search(patterns)
        ends = np.cumsum(high - low)
        for first in range(0, int(ends[-1]) if len(ends) else 0, LOCATE):
            numbers = np.arange(first, min(first + LOCATE, int(ends[-1])))
            at = np.searchsorted(ends, numbers, side="right")
            place = kept[index.locate(high[at] - (ends[at] - numbers))]
            piece = np.searchsorted(starts, place, side="right") - 1
            edges = np.zeros(len(symbols) + 1, dtype=np.int32)
            np.add.at(edges, place, 1)
            np.add.at(edges, place + sizes[which[at]], -1)
            hit = np.cumsum(edges)[:-1] > 0
            for k, pattern in np.unique(np.stack([piece, which[at]], 1), axis=0).tolist():
                rows[pieces[k][0]].items.update(owners[pattern])
            for k in np.unique(piece).tolist():
                row, offset, parts = pieces[k]
                rows[row].hit[offset: offset + len(parts)] |= hit[starts[k]: starts[k] + len(parts)]


def findings(raws: list[bytes], path: str, shard_words: int = SHARD_WORDS) -> list[Finding]:
    rows, pieces, held = [], [], 0
    for row, raw in enumerate(raws):
        parts = words(raw)
        rows.append(Finding(len(parts), np.zeros(len(parts), dtype=bool), set()))
        for first in range(0, len(parts), shard_words):
            piece = parts[first: first + shard_words + WINDOW - 1]
            if pieces and held + len(piece) > shard_words:
                _search_shard(pieces, rows, path)
                pieces, held = [], 0
            pieces.append((row, first, piece))
            held += len(piece)
    if pieces:
        _search_shard(pieces, rows, path)
    return rows


def find_contamination(docs: DataFrame, benchmark: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, item_ids (sorted), spans to remove (code points, ends exclusive), contaminated."""
    path = item_table(benchmark)
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = findings(raw_texts(batch), path, shard_words)
            marked = [f.spans(t) for f, t in zip(rows, texts(batch))] if any(f.items for f in rows) else [[] for _ in rows]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([f.n_words for f in rows], pa.int64()),
                pa.array([int(f.hit.sum()) for f in rows], pa.int64()),
                pa.array([sorted(f.items) for f in rows], pa.list_(pa.string())), pa.array(marked, spans),
                pa.array([f.contaminated for f in rows], pa.bool_()),
            ], ["doc_id", "n_words", "n_hit", "item_ids", "spans", "contaminated"])

    return text_rows(docs).mapInArrow(
        scan, "doc_id long, n_words long, n_hit long, item_ids array<string>, "
        "spans array<struct<start: long, end: long>>, contaminated boolean")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows, with all their columns, that are not contaminated; texts with a lesser share of hits stay as they are."""
    path = item_table(benchmark)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array([not f.contaminated for f in findings(raw_texts(batch), path)], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
