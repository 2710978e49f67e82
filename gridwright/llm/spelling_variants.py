"""Groups of spelling variants: words one edit apart, found by composing finite-state machines.

The vocabulary counts every word of every text. Two words one edit apart share all letters before the last place at which
the edit can stand, and all letters after it. So a word enters a partition for every half of the places: the letters
before the half and after it are the partition's key, hence the path by which all its words leave the initial state, and
what remains of each word is a path from there. A partition with too many words is halved again by the place of the edit,
down to a single place; then a key leaves at most two letters open, so a partition holds at most 90 + 90 ** 2 words of
the alphabet, of 90 letters.

Within a partition, the remainders of each length form a minimised acyclic acceptor. Composing acceptor, one-edit
transducer and acceptor walks common prefixes as one state, makes the edit at the last place where it can stand, and then
meets the two right languages, which is done once per pair of states. Every pair of words is accepted exactly once.

A null text has no words; rows without an id count like others. Repeated rows count again. A word of any length is one
path. Ties between forms go to the least word in code-point order. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridwright.llm.batches import raw_texts, slices, text_rows
from gridwright.session import written

MIN_LETTERS, MIN_COUNT, RATIO = 6, 5, 5
MAX_ROUTE = 20_000
#: Words that a counting task remembers before it hands its counts on.
REMEMBERED = 400_000
#: Letters A to Z and U+00C0 to U+00FF in UTF-8; bytes.lower() changes A to Z only.
_WORD = re.compile(rb"(?:[a-z]+|\xc3[\x80-\xbf])+")
#: What becomes of the words of a document, given its id: distinct lower-cased words in UTF-8 to words.
Rewrite = Callable[[int | None], Callable[[bytes], bytes]]


def vocabulary(
    docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, rewrite: Rewrite | None = None,
) -> DataFrame:
    """word and n of the words with enough letters and occurrences."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flushed() -> pa.RecordBatch:
            words = pa.array(list(counts), pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], ["word", "n"])

        counts: Counter[bytes] = Counter()
        for batch in slices(batches):
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), raw_texts(batch)):
                words = _WORD.findall(raw.lower())
                if rewrite is None:
                    counts.update(words)
                    continue
                change = rewrite(doc_id)
                for word, n in Counter(words).items():
                    counts[change(word)] += n
            if len(counts) > REMEMBERED:
                yield flushed()
                counts.clear()
        yield flushed()

    counted = text_rows(docs).mapInArrow(count, "word string, n long")
    counted = counted.filter(F.char_length("word") >= min_letters).groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= min_count)


class Acceptor:
    """The minimal acyclic automaton of distinct words in ascending order; state 0 accepts the empty word only."""

    def __init__(self, words: Iterable[str]) -> None:
        self.arcs: list[dict[str, int]] = [{}]
        self.final = [True]
        self._known: dict[tuple, int] = {(True, ()): 0}
        open_states: list[tuple[dict[str, int], bool]] = [({}, False)]
        before = ""
        for word in words:
            shared = len(commonprefix((before, word)))
            self._close(open_states, before, shared)
            open_states += [({}, False) for _ in range(shared, len(word))]
            open_states[-1] = (open_states[-1][0], True)
            before = word
        self._close(open_states, before, 0)
        self.initial = self._state(*open_states[0])

    def _close(self, open_states: list[tuple[dict[str, int], bool]], word: str, depth: int) -> None:
        while len(open_states) > depth + 1:
            target = self._state(*open_states.pop())
            open_states[-1][0][word[len(open_states) - 1]] = target

    def _state(self, arcs: dict[str, int], final: bool) -> int:
        key = (final, tuple(arcs.items()))
        state = self._known.get(key)
        if state is None:
            state = self._known[key] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final)
        return state


class Meeting:
    """The words that states of two acceptors both accept, found once per pair of states."""

    def __init__(self, left: Acceptor, right: Acceptor) -> None:
        self.left, self.right, self._known = left, right, {}

    def __call__(self, p: int, q: int) -> list[str]:
        found = self._known.get((p, q))
        if found is None:
            found, waiting = [], [(p, q, "")]
            while waiting:
                a, b, read = waiting.pop()
                if self.left.final[a] and self.right.final[b]:
                    found.append(read)
                other = self.right.arcs[b]
                waiting += [(to, other[x], read + x) for x, to in self.left.arcs[a].items() if x in other]
            self._known[p, q] = found
        return found


def substitutions(words: Acceptor) -> Iterator[tuple[str, str]]:
    """Pairs of accepted words that differ in one letter, the lesser letter first."""
    meet, edits = Meeting(words, words), {}
    waiting = [(words.initial, "")]
    while waiting:
        state, read = waiting.pop()
        arcs = words.arcs[state]
        if state not in edits:
            order = list(arcs.items())
            edits[state] = [(a, b, rest) for k, (a, p) in enumerate(order) for b, q in order[k + 1:] if (rest := meet(p, q))]
        for a, b, rest in edits[state]:
            yield from ((read + a + t, read + b + t) for t in rest)
        waiting += [(to, read + x) for x, to in arcs.items()]


def insertions(words: Acceptor, longer: Acceptor, at_end: bool) -> Iterator[tuple[str, str]]:
    """Pairs of an accepted word and one of the longer words that has one letter more, at the last place where it can
    stand; at the end of the word only if `at_end`."""
    meet, edits = Meeting(words, longer), {}
    waiting = [(words.initial, longer.initial, "")]
    while waiting:
        p, q, read = waiting.pop()
        arcs, other = words.arcs[p], longer.arcs[q]
        if (p, q) not in edits:
            edits[p, q] = [
                (x, rest) for x, to in other.items()
                if (rest := [t for t in meet(p, to) if (t[0] != x if t else at_end)])]
        for x, rest in edits[p, q]:
            yield from ((read + t, read + x + t) for t in rest)
        waiting += [(to, other[x], read + x) for x, to in arcs.items() if x in other]


def near_in_partition(words: list[str], letters: int, low: int, high: int) -> Iterator[tuple[str, str]]:
    """Pairs of words one edit apart, the shorter of `letters` letters, that differ first (from their ends: last) within
    places low to high. All words have the same `low` first letters and the same letters after the place `high`."""
    tail = max(0, letters - 1 - high)
    sample = words[0]
    head, end = sample[:low], sample[len(sample) - tail:]
    short, long = (
        sorted(w[low:len(w) - tail] for w in words if len(w) == size) for size in (letters, letters + 1))
    if not short:
        return
    acceptor = Acceptor(short)
    pairs = substitutions(acceptor)
    for u, v in pairs:
        yield head + u + end, head + v + end
    if long:
        for u, v in insertions(acceptor, Acceptor(long), at_end=high == letters):
            yield head + u + end, head + v + end


_KEY = "concat(substring(word, 1, low), right(word, greatest(0, letters - 1 - high)))"
_ROUTE = ["letters", "low", "high", "route"]


def _halves(rows: DataFrame) -> DataFrame:
    """Each row for both halves of its places low to high, or as it is if there is one place only."""
    middle = "(low + high + 1) div 2"
    ranges = F.expr(
        f"if(low = high, array(struct(low as a, high as b)), array(struct(low as a, {middle} - 1 as b), struct({middle} as a, high as b)))")
    split = rows.select("word", "n", "letters", F.explode(ranges).alias("half"))
    split = split.select("word", "n", "letters", F.col("half.a").alias("low"), F.col("half.b").alias("high"))
    return split.withColumn("route", F.expr(_KEY))


def routes(words: DataFrame, max_route: int = MAX_ROUTE) -> DataFrame:
    """word, n and the partitions (letters, low, high, route) that it enters: pairs of a word of `letters` letters with
    one of as many, or of one more, whose edit stands at a place from low to high."""
    size = F.char_length("word")
    rows = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("letters"))
    rows = written(_halves(rows.selectExpr("word", "n", "letters", "0 as low", "letters as high")), "routes")
    done: DataFrame | None = None
    while True:
        counts = rows.groupBy(*_ROUTE).agg(F.count("*").alias("size"))
        crowded = written(counts.filter((F.col("size") > max_route) & (F.col("low") < F.col("high"))).drop("size"), "crowded")
        if crowded.isEmpty():
            return rows if done is None else done.unionByName(rows)
        kept = rows.join(crowded, _ROUTE, "left_anti")
        done = kept if done is None else done.unionByName(kept)
        rows = written(_halves(rows.join(crowded, _ROUTE, "left_semi")), "routes")


def near_words(words: DataFrame, max_route: int = MAX_ROUTE) -> DataFrame:
    """word, n, near, near_n: every word with every word that differs from it by one inserted, deleted or replaced code
    point, both ways round. The words must be distinct."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in (*_ROUTE, "word", "n"))))
        out: list[tuple] = []
        for (letters, low, high, _), group in groupby(rows, key=lambda r: r[:4]):
            counts = {r[4]: r[5] for r in group}
            if len(counts) < 2:
                continue
            for u, v in near_in_partition(list(counts), letters, low, high):
                out += ((u, counts[u], v, counts[v]), (v, counts[v], u, counts[u]))
                if len(out) >= 50_000:
                    yield _pairs(out)
                    out = []
        yield _pairs(out)

    routed = routes(words, max_route).repartition(*_ROUTE).sortWithinPartitions(*_ROUTE)
    return routed.mapInArrow(search, "word string, n long, near string, near_n long")


def _pairs(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 4
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["word", "n", "near", "near_n"])


def variants(words: DataFrame, ratio: int = RATIO, max_route: int = MAX_ROUTE) -> DataFrame:
    """word, n, form, root, n_near, form_n of every word: its form is the commonest word near it if that is at least `ratio`
    (2 or more) times as common, and its root is where the forms lead."""
    if ratio < 2:
        raise ValueError("forms must be commoner than their variants")
    words = written(words, "vocabulary")
    best = near_words(words, max_route).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best"))
    rows = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.near").alias("near"), (-F.col("best.n")).alias("near_n"))
    enough = F.col("near_n") >= ratio * F.col("n")
    rows = written(rows.select(
        "word", "n", "n_near", F.when(enough, F.col("near")).alias("form"), F.when(enough, F.col("near_n")).alias("form_n")), "forms")
    roots = _roots(rows.filter("form is not null").select("word", F.col("form").alias("root")))
    return rows.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def _roots(links: DataFrame) -> DataFrame:
    """word and the end of its chain of links. Every round doubles the reach; counts grow along a chain, so it ends."""
    links = written(links, "roots")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = links.join(onward, "root", "left")
        if further.filter("next is not null").isEmpty():
            return links
        links = written(further.select("word", F.coalesce("next", "root").alias("root")), "roots")
