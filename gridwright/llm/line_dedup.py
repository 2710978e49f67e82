"""Lines that several documents share, kept once, in Spark expressions only.

Every line is normalised, hashed and counted by the distinct documents that hold it. A line found in enough documents goes
from all of them except the one with the least doc_id, and the other lines are put together again in their places.

The text of a line never moves: only a 128-bit hash with its document and place does. Counting combines before it
shuffles. A hash that holds more than one in `HEAVY` of all lines meets its count in a broadcast table, and there can be
no more than `HEAVY` of these; the others are too rare to fill a partition. Both joins read the same shuffle of the counts;
only the hashes are written, so the files do not grow with the number of shuffle partitions.

A null text is an empty one, with one empty line. Rows with the same doc_id are one document, and so are all rows without
an id, which comes after all others; repeated rows repeat in the result. Equal lines of one document all stay or all go.
A text of any length is one row; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridwright.session import written

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH, MIN_DOCUMENTS = 10, 2
#: A hash is heavy if it has more than this part of all lines.
HEAVY = 4096
_HASH, _ROW = ["h1", "h2"], ["doc_id", "text_hash"]


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")


def _lowered(text: str) -> Column:
    """A to Z in lower case, other letters as they are."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def line_hashes(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """doc_id, text_hash, place and 128-bit hash of every line whose normalised form is long enough."""
    lowered = _texts(docs).select(*_ROW, _lowered("text").alias("lowered"))
    lines = lowered.select(*_ROW, F.posexplode(F.split("lowered", "\n")).alias("place", "line"))
    keys = lines.select(*_ROW, "place", F.btrim("line", F.lit(BLANKS)).alias("line_key"))
    return keys.filter(F.char_length("line_key") >= min_length).select(
        *_ROW, "place", F.xxhash64("line_key").alias("h1"), F.xxhash64(F.lit(1), "line_key").alias("h2"))


def repeated_lines(lines: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """h1, h2, keeper and n_lines of the hashes that enough documents hold; the keeper is the least doc_id."""
    per_document = lines.groupBy(*_HASH, "doc_id").agg(F.count("*").alias("n"))
    counted = per_document.groupBy(*_HASH).agg(
        F.count("*").alias("n_documents"), F.min("doc_id").alias("keeper"), F.sum("n").alias("n_lines"))
    return counted.filter(F.col("n_documents") >= min_documents).drop("n_documents")


def dropped_places(lines: DataFrame, repeated: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """doc_id, text_hash and the sorted places of the lines that go, of the documents that lose any."""
    most = lines.count() // heavy
    # Both branches need the keeper of `often`, so that all three uses of the counts are one plan with one shuffle.
    often = repeated.filter(F.col("n_lines") > most).select(*_HASH, F.struct("keeper").alias("often"))
    seldom = repeated.filter(F.col("n_lines") <= most).select(*_HASH, "keeper")
    marked = lines.join(F.broadcast(often), _HASH, "left")
    by_often = marked.filter("often is not null").select(*_ROW, "place", "often.keeper")
    by_seldom = marked.filter("often is null").select(*_ROW, "place", *_HASH).join(seldom, _HASH).select(*_ROW, "place", "keeper")
    gone = by_often.unionByName(by_seldom).filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    return gone.groupBy(*_ROW).agg(F.sort_array(F.collect_set("place")).alias("gone"))


def drop_repeated_lines(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_documents: int = MIN_DOCUMENTS, heavy: int = HEAVY,
) -> DataFrame:
    """doc_id, n_lines (before), n_dropped and kept_text of every document."""
    lines = written(line_hashes(docs, min_length), "lines")
    gone = dropped_places(lines, repeated_lines(lines, min_documents), heavy)
    gone = gone.select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash"), "gone")
    rows = _texts(docs)
    same = F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("text_hash") == F.col("gone_hash"))
    rows = rows.join(gone, same, "left").select(
        "doc_id", "text", F.split("text", "\n").alias("lines"), F.coalesce("gone", F.array().cast("array<int>")).alias("gone"))
    # The stretches between two dropped lines, each cut out whole.
    starts = F.concat(F.array(F.lit(0)), F.transform("gone", lambda p: p + 1))
    ends = F.concat("gone", F.array(F.size("lines")))
    kept = F.flatten(F.zip_with(starts, ends, lambda a, b: F.slice("lines", a + 1, b - a)))
    return rows.select(
        "doc_id", F.size("lines").cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_dropped"),
        F.when(F.size("gone") == 0, F.col("text")).otherwise(F.array_join(kept, "\n")).alias("kept_text"))
