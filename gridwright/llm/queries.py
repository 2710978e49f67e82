"""One query per operator over its whole table, with the digest columns derived from the operator's own output."""

from __future__ import annotations

from collections.abc import Callable
from zlib import crc32

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwright.llm import (
    decontamination,
    language_model,
    line_dedup,
    packing,
    periodic_runs,
    pii,
    quality,
    sharding,
    simhash,
    spelling_variants,
    token_files,
    warc,
    winnowing,
)

#: The two public tokenizer files that the queries use; a path is a parameter of every operator that takes one.
PACKING_TOKENIZER, FILE_TOKENIZER = "word_bpe_49k.json", "byte_bpe_50k.json"
Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _joined(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _number(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.learn(docs))
    counts = [_number("base", kind).alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return token_files.read_token_files(token_files.write_token_files(docs, public_tokenizers.path(FILE_TOKENIZER)))


def op3_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, known = language_model.likelihoods(_table(spark, sf_dir, "documents"))
    return scored.select(
        "doc_id", language_model.held_out().alias("held_out"), "n_tokens", "n_known",
        F.lit(known.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    items = F.sha2(F.array_join("item_ids", ","), 256)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), items.alias("items_sha256"),
        "contaminated")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path(PACKING_TOKENIZER))


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.edited_fingerprints(_table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.kd_shards(_table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("code"), 16, "0"))
    return near.select("doc_id", digits.alias("fingerprint"), "component_id")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.read_archives(warc.write_archives(_table(spark, sf_dir, "pages")))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality.train(docs, _table(spark, sf_dir, "labels")))
    predicted = (F.col("score") >= quality.ACCEPT).cast("int")
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", predicted.alias("predicted"))


def op11_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated_lines(_table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def _id_text(doc_id: int | None) -> bytes:
    return b"" if doc_id is None else b"%d" % doc_id


def misspelled(doc_id: int | None) -> Callable[[bytes], bytes]:
    """The contract's damage: one code point less in every 199th word of a document by its checksum."""
    begun = crc32(_id_text(doc_id) + b":")

    def change(word: bytes) -> bytes:
        h = crc32(word, begun)
        if h % 199:
            return word
        letters = word.decode()
        at = h % len(letters)
        return (letters[:at] + letters[at + 1:]).encode()

    return change


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling_variants.vocabulary(_table(spark, sf_dir, "documents"), rewrite=misspelled)
    return spelling_variants.variants(words).select("word", "form", "root", "n", "n_near", "form_n")


def stuttering(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's repetition: the words of every tenth document by its checksum go round from some place on."""
    g, rest = divmod(crc32(_id_text(doc_id)), 10)
    n = len(words)
    if rest or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(_table(spark, sf_dir, "documents"), rewrite=stuttering)
    least = F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.array_min(least).alias("longest"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    length = -F.col("longest.less")
    return rows.select(
        "doc_id", "n_runs", F.col("longest.start").alias("start"), length.alias("length"), F.col("longest.period").alias("period"),
        F.expr("1000 * -longest.less div longest.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


QUERIES: dict[str, Query] = {
    "op1_pii": op1_pii,
    "op2_token_files": op2_token_files,
    "op3_language_model": op3_language_model,
    "op4_decontamination": op4_decontamination,
    "op5_packing": op5_packing,
    "op6_winnowing": op6_winnowing,
    "op7_sharding": op7_sharding,
    "op8_simhash": op8_simhash,
    "op9_warc": op9_warc,
    "op10_quality": op10_quality,
    "op11_lines": op11_lines,
    "op12_spelling": op12_spelling,
    "op13_runs": op13_runs,
}
_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
_WINDOWS = "list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))"
ORACLES: dict[str, str] = {
    "op4_decontamination": f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents)
, items AS (SELECT item_id, w, least({decontamination.WINDOW}, len(w)) AS k
    FROM (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0)
, windows AS (SELECT DISTINCT item_id, k, unnest({_WINDOWS}) AS t FROM items)
, places AS (SELECT doc_id, k, unnest({_WINDOWS}) AS t, unnest(range(1, len(w) - k + 2)) AS i
    FROM d, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)
, found AS (SELECT doc_id, i, k, item_id FROM places JOIN windows USING (k, t))
, hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM found) GROUP BY 1)
, named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND {decontamination.SHARE} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op9_warc": f"""WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n, sha256(coalesce(html, '')) AS d FROM pages)
, least AS (SELECT d, min(page_id) AS first_id FROM p WHERE n >= {warc.MIN_REVISIT} GROUP BY 1)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
  CASE WHEN n >= {warc.MIN_REVISIT} AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= {warc.MIN_REVISIT} AND page_id <> first_id THEN first_id END AS refers_to
FROM p LEFT JOIN least USING (d)""",
    "op11_lines": f"""WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)
, l AS (SELECT doc_id, unnest(range(len(lines))) AS place, unnest(lines) AS line FROM d)
, k AS (SELECT *, trim(translate(line, '{line_dedup.UPPER}', '{line_dedup.LOWER}'), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS line_key
    FROM l)
, repeated AS (SELECT line_key, min(doc_id) AS keeper FROM k WHERE length(line_key) >= {line_dedup.MIN_LENGTH}
    GROUP BY 1 HAVING count(DISTINCT doc_id) >= {line_dedup.MIN_DOCUMENTS})
, marked AS (SELECT doc_id, place, line, coalesce(doc_id <> keeper, FALSE) AS gone FROM k LEFT JOIN repeated USING (line_key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256 FROM marked GROUP BY 1""",
}
