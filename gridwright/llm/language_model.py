"""Text likelihoods under a unigram base and a gated recurrent language model learned from the same documents.

Counts cover every token of every training document. The commonest words are the recurrent model's head; every other word
belongs to one of a few rare classes, told by the word's ending, and has its smoothed share of that class. The next
`MIDDLE_WORDS` words' counts are broadcast; the words beyond those meet their counts in a join by word, so the vocabulary may
grow with the corpus.

Training deals the documents to shares by a hash of id and text; the number of shares follows from the number of training
tokens, up to `MOST_SHARES` tasks, beyond which shares grow. Training runs in rounds: each share starts from the same weights,
learns by truncated backpropagation, and the shares' weights are averaged, weighted by texts so that one very long text does
not outweigh all others, block by block. Each training document is learned from whole, its end included and the state carried
through, in one of the rounds, which the same hash tells: all rounds together are one pass over every training token. Nothing
in this depends on how the table is partitioned, so the same rows give the same model, but for the last digits of its sums.
Scoring reads whole documents with the state carried through, too. Texts are taken apart twice, once to be counted and once
to be encoded; the rounds and the scoring read the encoded table.

Documents that `held_out` names, and those with a null id, are scored but never learned from. A null text is an empty one:
its end is its only token. A very long text is one sequence in one task, two bytes a token. Repeated rows repeat in the result. Without training documents every count is zero.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridwright.llm import recurrent
from gridwright.llm.batches import raw_texts, slices, text_rows
from gridwright.llm.recurrent import Trainer, Weights
from gridwright.session import written

END, SMOOTHING = b"", 0.1
HEAD_WORDS, RARE_CLASSES = 4096, 32
#: Words after the head whose counts are broadcast. Longer words than these bytes meet theirs in the join.
MIDDLE_WORDS, LONGEST_HEAD = 1 << 18, 256
#: The pass over all training text is cut into so many rounds; a task learns from so many tokens at a time.
ROUNDS, TOGETHER = 2, 1 << 21
#: Training tokens of a share, and how many shares, and so tasks of a round, there may be.
SHARE_TOKENS, MOST_SHARES = 1 << 22, 4096
HELD, BLOCK, SALTS = 200_000, 16_384, 64
#: Bytes of text encoded at a time, and of input rows, two a token, scored at a time.
ENCODED_BYTES, SCORED_BYTES = 1 << 22, 1 << 21


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows never learned from: crc32 of the id as text is divisible by ten. A null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 10 == 0, F.lit(True))


def words(raw: bytes) -> list[bytes]:
    return raw.lower().split()


def tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """What `words` finds in all texts in a row, an end after each text, and where each text's tokens stop."""
    texts = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    # What follows the last space is the end; of nothing, nothing is split off.
    texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise(texts, "", " "))
    split = pc.ascii_split_whitespace(texts)
    return split.flatten().cast(pa.binary()), np.cumsum(pc.list_value_length(split).to_numpy(), dtype=np.int64)


def rare_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % RARE_CLASSES


def count_words(docs: DataFrame) -> DataFrame:
    """word, rare (its rare class) and n over all rows, the end of each text counted as the empty word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            columns = [pa.array(list(seen), pa.binary()), pa.array([rare_class(w) for w in seen], pa.int32()),
                       pa.array(list(seen.values()), pa.int64())]
            seen.clear()
            return pa.RecordBatch.from_arrays(columns, ["word", "rare", "n"])

        for batch in slices(batches):
            for raw in raw_texts(batch):
                seen.update(words(raw))
            seen[END] += batch.num_rows
            if len(seen) > HELD:
                yield flush()
        yield flush()

    counted = docs.select("text").mapInArrow(count, "word binary, rare int, n long")
    return counted.groupBy("word", "rare").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Head words with their counts (the end first), the counts of the words after them in `middle`, and sums over all
    words beyond the head by rare class. `rows` numbers the head and then the middle."""

    rows: dict[bytes, int]
    counts: np.ndarray
    tokens: int
    kinds: int
    rare_tokens: np.ndarray
    rare_kinds: np.ndarray
    middle: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def __post_init__(self) -> None:
        """Input rows of the recurrent model for the numbers in `rows`."""
        self.first = -(-len(self.counts) // recurrent.MEMBERS) * recurrent.MEMBERS
        listed = list(self.rows)
        self.listed = pa.array(listed, pa.binary())
        self.inputs = np.concatenate([np.arange(len(self.counts)), self.rare_rows(listed[len(self.counts):])]).astype(np.int32)

    @property
    def base_total(self) -> float:
        return self.tokens + SMOOTHING * (self.kinds + 1)

    def rare_rows(self, tokens: list[bytes]) -> np.ndarray:
        return self.first + np.fromiter(map(rare_class, tokens), dtype=np.int64, count=len(tokens))

    def numbers(self, tokens: pa.Array) -> np.ndarray:
        """Places of tokens in `rows`, -1 for all others."""
        return pc.index_in(tokens, value_set=self.listed).fill_null(-1).to_numpy()

    def encode(self, tokens: list[bytes]) -> np.ndarray:
        """Input rows of the recurrent model for tokens."""
        numbers = self.numbers(pa.array(tokens, pa.binary()))
        rows = self.inputs[numbers]
        rest = np.flatnonzero(numbers < 0)
        rows[rest] = self.rare_rows([tokens[at] for at in rest.tolist()])
        return rows


def vocabulary(counts: DataFrame, head_words: int = HEAD_WORDS, middle_words: int = MIDDLE_WORDS) -> Vocabulary:
    """Head and middle are bounded by their words, each of at most `LONGEST_HEAD` bytes; the rest stays where it is. The
    middle takes whole steps of sixteen to a doubling of the count, as many as fit, so that no task orders all words."""
    short = counts.filter((F.col("word") != END) & (F.octet_length("word") <= LONGEST_HEAD)).select(
        "word", "n", F.floor(16 * F.log2("n")).alias("step"))
    top = [(bytes(r["word"]), r["n"]) for r in short.orderBy(F.desc("n"), "word").limit(head_words - 1).collect()]
    room, least = head_words - 1 + middle_words, None
    for step, size in sorted(map(tuple, short.groupBy("step").count().collect()), reverse=True):
        room -= size
        if room < 0:
            break
        least = step
    common = short.filter(F.col("step") >= F.lit(least)).select("word", "n").toArrow()
    known = {word for word, _ in top}
    middle = sorted((-n, word) for word, n in zip(common.column("word").to_pylist(), common.column("n").to_pylist())
                    if word not in known)
    middle = [(word, -n) for n, word in middle]
    ends = counts.filter(F.col("word") == END).agg(F.sum("n")).first()[0] or 0
    head = [(END, ends), *top]
    rare_tokens, rare_kinds = np.zeros(RARE_CLASSES), np.zeros(RARE_CLASSES)
    for rare, n, kinds in counts.groupBy("rare").agg(F.sum("n"), F.count(F.lit(1))).collect():
        rare_tokens[rare], rare_kinds[rare] = n, kinds
    tokens, kinds = int(rare_tokens.sum()), int(rare_kinds.sum())
    for word, n in head:
        rare_tokens[rare_class(word)] -= n
        rare_kinds[rare_class(word)] -= n > 0
    return Vocabulary({w: k for k, (w, _) in enumerate([*head, *middle])}, np.array([n for _, n in head], dtype=float), tokens,
                      kinds, rare_tokens, rare_kinds, np.array([n for _, n in middle], dtype=float))


def shares(tokens: int) -> int:
    """Into how many shares that many training tokens are dealt."""
    return min(max(1, -(-tokens // SHARE_TOKENS)), MOST_SHARES)


def encoded(docs: DataFrame, words_known: Vocabulary) -> DataFrame:
    """Every row as both training and scoring read it, as a table in the shared folder: doc_id, key, text_hash, place (a
    hash of id and text), n_tokens, known, log and middle (sums over its listed words: how many occur in training text, of
    log10(count + smoothing), and of that over the middle alone), rows (the network's input rows, two bytes a token) and tail
    (its words beyond the listed ones). Texts are taken apart and looked up here alone."""
    known = docs.sparkSession.sparkContext.broadcast(words_known)
    listed = np.concatenate([words_known.counts, words_known.middle])
    logs, occurs, head = np.log10(listed + SMOOTHING), listed > 0, len(words_known.counts)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=ENCODED_BYTES):
            found, ends = tokens(batch.column("text"))
            starts = np.concatenate([[0], ends[:-1]])
            numbers = known.value.numbers(found)
            own = np.where(numbers < 0, 0, logs[numbers])
            rest = np.flatnonzero(numbers < 0)
            others = found.take(pa.array(rest)).dictionary_encode()
            kinds, codes = others.dictionary, others.indices.to_numpy()
            rows = known.value.inputs[numbers]
            rows[rest] = known.value.rare_rows(kinds.to_pylist())[codes]
            rows = rows.astype("<u2")
            # Each other word of a text once, in the order of the texts.
            pair, times = np.unique(np.searchsorted(ends, rest, side="right") * max(1, len(kinds)) + codes, return_counts=True)
            text, kind = np.divmod(pair, max(1, len(kinds)))
            tails = pa.StructArray.from_arrays([kinds.take(pa.array(kind)), pa.array(times, pa.int64())], ["word", "times"])
            columns = [*(batch.column(c) for c in ("doc_id", "key", "text_hash", "place")),
                       pa.array(ends - starts),
                       pa.array(np.add.reduceat((numbers >= 0) & occurs[numbers], starts, dtype=np.int64)),
                       pa.array(np.add.reduceat(own, starts)),
                       pa.array(np.add.reduceat(np.where(numbers < head, 0, own), starts)),
                       pa.array([rows[i:j].tobytes() for i, j in zip(starts.tolist(), ends.tolist())], pa.binary()),
                       pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(len(ends) + 1)), pa.int32()), tails)]
            yield pa.RecordBatch.from_arrays(columns, _ENCODED)

    schema = ("doc_id long, key long, text_hash long, place long, n_tokens long, known long, log double, middle double, "
              "rows binary, tail array<struct<word: binary, times: long>>")
    return written(_keyed(docs).mapInArrow(encode, schema), "encoded")


def _input_rows(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    return (np.frombuffer(rows, "<u2").astype(np.int32) for rows in batch.column("rows").to_pylist())


def learn_texts(trainer: Trainer, texts_encoded: Iterable[np.ndarray]) -> int:
    """One pass over every token of the texts, ends included; how many texts."""
    held: list[np.ndarray] = []
    tokens = texts = 0
    for texts, encoded in enumerate(texts_encoded, 1):
        held.append(encoded)
        tokens += len(held[-1])
        if tokens >= TOGETHER:
            trainer.learn(held)
            held, tokens = [], 0
    if held:
        trainer.learn(held)
    return texts


def _round(rows: DataFrame, share_count: int, weights: Weights) -> Weights:
    """The average of what all shares have learned from `weights` on. Texts come to their shares in an order of their own.
    Weights leave a task in blocks, which are summed in two steps, so that no task gathers all of them."""
    start = rows.sparkSession.sparkContext.broadcast(weights)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(start.value)
        texts = learn_texts(trainer, (text for batch in batches for text in _input_rows(batch)))
        if texts:
            salt = TaskContext.get().partitionId() % SALTS
            flat = trainer.w.flat().astype(np.float64) * texts
            blocks = [flat[i: i + BLOCK] for i in range(0, len(flat), BLOCK)]
            columns = [pa.array(range(len(blocks)), pa.int32()), pa.array([salt] * len(blocks), pa.int32()),
                       pa.array([b.tobytes() for b in blocks], pa.binary()),
                       pa.array([texts] * len(blocks), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["block", "salt", "sums", "texts"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, dtype=np.float64) for x in table.column("sums").to_pylist())
        return pa.table({
            "block": table.column("block")[:1], "salt": table.column("salt")[:1],
            "sums": pa.array([total.tobytes()], pa.binary()), "texts": pa.array([sum(table.column("texts").to_pylist())], pa.int64())})

    schema = "block int, salt int, sums binary, texts long"
    share = F.pmod(F.col("place"), F.lit(share_count)).cast("int")
    by_share = rows.select(share.alias("share"), "place", "rows").repartitionById(share_count, "share").sortWithinPartitions(
        "place", "rows")
    learned = by_share.mapInArrow(learn, schema)
    summed = learned.groupBy("block", "salt").applyInArrow(add, schema).groupBy("block").applyInArrow(add, schema)
    parts = sorted(summed.collect(), key=lambda row: row["block"])
    if not parts:
        return weights
    return weights.like(np.concatenate([np.frombuffer(row["sums"], dtype=np.float64) / row["texts"] for row in parts]))


def train(docs: DataFrame, words_known: Vocabulary, rounds: int = ROUNDS) -> Weights:
    return _trained(encoded(docs, words_known), words_known, rounds)


def _trained(table: DataFrame, words_known: Vocabulary, rounds: int = ROUNDS) -> Weights:
    """Learned from all rows of an encoded table."""
    weights = recurrent.initial(words_known.counts + SMOOTHING, words_known.rare_tokens)
    turn = F.pmod(F.shiftright("place", 40), F.lit(rounds))
    for number in range(rounds):
        weights = _round(table.filter(turn == number), shares(words_known.tokens), weights)
    return weights


def _tail_sums(parts: DataFrame, counts: DataFrame) -> DataFrame:
    """Per document: sums over its words beyond the broadcast ones of log10(count + smoothing), and of known ones."""
    share = 1 / F.size("tail")
    each = parts.select("key", "text_hash", share.alias("share"), F.explode("tail").alias("one"))
    each = each.select("key", "text_hash", "share", "one.word", "one.times")
    # Each word has one count, so a part of the counts is small and hashed as it is; the occurrences need no sort.
    met = each.join(counts.select("word", "n").hint("shuffle_hash"), "word", "left")
    log = F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(SMOOTHING))
    # A row's shares add up to one, so their sum over equal rows tells how many there are.
    copies = F.round(F.sum("share"))
    return met.groupBy("key", "text_hash").agg(
        (F.sum(log) / copies).alias("tail_log"),
        (F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)) / copies).alias("tail_known"))


def score(docs: DataFrame, words_known: Vocabulary, weights: Weights, counts: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score, both log10, of every row."""
    return _scored(encoded(docs, words_known), words_known, weights, counts)


def _scored(table: DataFrame, words_known: Vocabulary, weights: Weights, counts: DataFrame) -> DataFrame:
    model, first = table.sparkSession.sparkContext.broadcast(weights), words_known.first
    # Of an input row: what the share of a rare word in its class is less by than the word's own part.
    less = np.zeros(first + RARE_CLASSES)
    less[first:] = np.log10(words_known.rare_tokens + SMOOTHING * (words_known.rare_kinds + 1))

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "rows", limit=SCORED_BYTES):
            documents = list(_input_rows(batch))
            part = recurrent.score(model.value, documents) / np.log(10) - [less[rows].sum() for rows in documents]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in _PARTS[:-1]), pa.array(part)], _PARTS)

    schema = "doc_id long, key long, text_hash long, n_tokens long, known long, log double, middle double, part double"
    parts = written(table.select(*_PARTS[:-1], "rows").mapInArrow(rate, schema), "parts")
    whole = parts.join(_tail_sums(table, counts), ["key", "text_hash"], "left")
    tail_log = F.coalesce("tail_log", F.lit(0.0))
    base = F.col("log") + tail_log - F.col("n_tokens") * F.log10(F.lit(words_known.base_total))
    known_tokens = F.col("known") + F.coalesce("tail_known", F.lit(0.0)).cast("long")
    return whole.select("doc_id", "n_tokens", known_tokens.alias("n_known"), base.alias("base_score"),
                        (F.col("part") + F.col("middle") + tail_log).alias("score"))


_ENCODED = ["doc_id", "key", "text_hash", "place", "n_tokens", "known", "log", "middle", "rows", "tail"]
_PARTS = ["doc_id", "key", "text_hash", "n_tokens", "known", "log", "middle", "part"]


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return text_rows(docs).select(
        "doc_id", F.coalesce("doc_id", F.lit(-(2**63))).alias("key"), F.xxhash64(text).alias("text_hash"),
        F.xxhash64("doc_id", text).alias("place"), "text")


def likelihoods(docs: DataFrame) -> tuple[DataFrame, Vocabulary]:
    """Learns from the documents that are not held out and scores all."""
    rows = text_rows(docs)
    counts = written(count_words(rows.filter(~held_out())), "counts")
    known = vocabulary(counts)
    table = encoded(rows, known)
    return _scored(table, known, _trained(table.filter(~held_out()), known), counts), known
