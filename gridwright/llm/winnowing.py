"""Document fingerprints by winnowing, in Spark expressions only.

Words are hashed, five in a row make a rolling polynomial hash, and of every window of sixteen such hashes the least is
kept, the rightmost of equal ones. Each kept hash comes with its position. Any run of twenty words that two texts share
is a whole window in both, so they share the hash it keeps. Sliding hashes and minima come from arrays zipped with
shifted copies of themselves, doubling the reach each time.

A text of fewer than five words has one hash over all of them, and one of fewer than sixteen hashes one window. A null
text is an empty one: no words, an empty fingerprint, which is like another empty one (1) and unlike all others (0).
Documents follow each other by doc_id, nulls first, then by a hash of the text; repeated rows count as one document there
and repeat in the result. A single document follows itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridwright.session import written

GRAM, WINDOW = 5, 16
_PRIME, _BASE, _PLACES, _NULL_KEY = 2**31 - 1, 1_000_003, 2**32, -(2**63)


def _shifted(array: Column, shift: int, length: Column) -> Column:
    return F.slice(array, F.lit(shift + 1), F.greatest(length, F.lit(0)))


def with_marks(rows: DataFrame, text: str, out: str) -> DataFrame:
    """The rows with a column of marks: kept hash times 2 ** 32 plus 2 ** 32 - 1 - position, by position."""
    words, hashes, two, grams = (f"{out}_{x}" for x in ("words", "hashes", "two", "grams"))
    n = F.size(hashes)
    single = F.aggregate(hashes, F.lit(0).cast("long"), lambda a, h: (a * _BASE + h) % _PRIME)

    def pair(left: Column, right: Column, reach: int) -> Column:
        factor = pow(_BASE, reach, _PRIME)
        return F.zip_with(left, right, lambda x, y: (x * factor + y) % _PRIME)

    four = pair(_shifted(F.col(two), 0, n - 4), _shifted(F.col(two), 2, n - 4), 2)
    five = pair(four, _shifted(F.col(hashes), 4, n - 4), 1)
    rows = rows.withColumn(words, F.array_remove(F.split(F.lower(text), "[\\x20\\x09-\\x0D]+"), ""))
    rows = rows.withColumn(hashes, F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(_PRIME))))
    rows = rows.withColumn(two, pair(_shifted(F.col(hashes), 0, n - 1), _shifted(F.col(hashes), 1, n - 1), 1))
    kept = F.when(n >= GRAM, five).when(n > 0, F.array(single)).otherwise(F.array().cast("array<bigint>"))
    rows = rows.withColumn(grams, F.transform(kept, lambda g, i: g * F.lit(_PLACES) + (_PLACES - 1 - i)))
    least, reach, names = grams, 1, []
    while reach < WINDOW:
        # Both arguments are as long as the windows that fit; nothing is left of fewer than a whole window.
        size = F.size(least) - reach
        names.append(least)
        shorter = F.zip_with(_shifted(F.col(least), 0, size), _shifted(F.col(least), reach, size), lambda x, y: F.least(x, y))
        least = f"{out}_{reach * 2}"
        rows = rows.withColumn(least, shorter)
        reach *= 2
    count = F.size(grams)
    marks = F.when(count >= WINDOW, F.array_distinct(least)).when(count > 0, F.array(F.array_min(grams)))
    rows = rows.withColumn(out, F.coalesce(marks, F.array().cast("array<bigint>")))
    return rows.drop(words, hashes, two, least, *names)


def marked_hashes(marks: str) -> Column:
    """The distinct hashes of a column of marks."""
    return F.array_distinct(F.transform(marks, lambda m: F.shiftright(m, 32)))


def written_marks(marks: str) -> Column:
    """position:hash of each mark, hashes in hex, comma-joined."""
    return F.array_join(F.transform(marks, lambda m: F.concat(
        (F.lit(_PLACES - 1) - m.bitwiseAND(F.lit(_PLACES - 1))).cast("string"), F.lit(":"), F.hex(F.shiftright(m, 32)))), ",")


def likeness(left: Column, right: Column) -> Column:
    """Share of the hashes of either that both have; 1 for two empty fingerprints."""
    both = F.size(F.array_intersect(left, right))
    either = F.size(left) + F.size(right) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    # A null id sorts before all others, and joins as the least number does.
    return rows.select(F.coalesce("doc_id", F.lit(_NULL_KEY)).alias("key"), F.xxhash64("text").alias("text_hash"), "text")


def _doc_id() -> Column:
    return F.nullif(F.col("key"), F.lit(_NULL_KEY)).alias("doc_id")


def followers(docs: DataFrame) -> DataFrame:
    """(key, text_hash, n_chars, next_key, next_hash) of each document, in a written table; only keys move for it."""
    keys = _keyed(docs).select("key", "text_hash", F.char_length("text").cast("long").alias("n_chars"))
    keys = keys.groupBy("key", "text_hash").agg(F.first("n_chars").alias("n_chars"))
    ranged = written(keys.repartitionByRange("key", "text_hash").withColumn("part", F.spark_partition_id()), "keys")
    own = F.struct("key", "text_hash")
    firsts = ranged.groupBy("part").agg(F.min(own).alias("first"))
    by_part = Window.orderBy("part")  # one row per shuffle partition
    whole = by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = firsts.select("part", F.coalesce(F.lead("first").over(by_part), F.first("first").over(whole)).alias("after"))
    inside = F.lead(own).over(Window.partitionBy("part").orderBy("key", "text_hash"))
    following = ranged.withColumn("following", inside).join(F.broadcast(after), "part")
    following = following.withColumn("following", F.coalesce("following", "after"))
    return written(following.select("key", "text_hash", "n_chars", F.col("following.key").alias("next_key"),
                                    F.col("following.text_hash").alias("next_hash")), "followers")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text, marks and written fingerprint of every row."""
    marked = with_marks(_keyed(docs), "text", "marks")
    return marked.select(_doc_id(), "text", "marks", written_marks("marks").alias("fingerprint"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Each text against its edited version, whose last quarter is the beginning of the next document, and against that
    document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    rows, order = _keyed(docs), followers(docs)
    need = F.expr("n_chars div 4")
    wanted = order.select(F.col("next_key").alias("key"), F.col("next_hash").alias("text_hash"),
                          F.col("key").alias("for_key"), F.col("text_hash").alias("for_hash"), "n_chars", need.alias("need"))
    # The text moves once, by its key; both joins read the same shuffle.
    given = rows.join(wanted, ["key", "text_hash"])
    given = with_marks(given, "text", "next_marks")
    given = given.select("for_key", "for_hash", "n_chars", "need", F.expr("substring(text, 1, int(need))").alias("head"),
                         marked_hashes("next_marks").alias("next_hashes"))
    given = given.groupBy(F.col("for_key").alias("key"), F.col("for_hash").alias("text_hash")).agg(
        F.first("n_chars").alias("n_chars"), F.first("need").alias("need"), F.first("head").alias("head"),
        F.first("next_hashes").alias("next_hashes"))
    paired = rows.join(given, ["key", "text_hash"])
    edited = F.concat(F.expr("substring(text, 1, int(n_chars - need))"), F.col("head"))
    paired = with_marks(with_marks(paired.withColumn("edited", edited), "text", "marks"), "edited", "edited_marks")
    paired = paired.withColumn("hashes", marked_hashes("marks"))
    return paired.select(
        _doc_id(), "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        written_marks("marks").alias("fingerprint"), written_marks("edited_marks").alias("edited_fingerprint"),
        likeness(F.col("hashes"), marked_hashes("edited_marks")).alias("near_edited"),
        likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"))
