import zlib

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from gridwright.llm import packing, queries
from tests.llm.conftest import CLASHING, prose


@pytest.fixture(scope="module")
def folder(spark, documents, tmp_path_factory):
    """Junk, copies, a contaminated document and personal data among clean documents."""
    junk = {i: " ".join(f"{w.upper()}!!" for w in prose(i, 90).split()) for i in range(0, 240, 4)}
    pairs = [(i, junk.get(i, prose(i, 90))) for i in range(240)]
    item = prose(900, 40, 300)
    pairs += [(1000, dict(pairs)[1]), (1001, dict(pairs)[1]), (1002, f"{prose(33, 20)} {item}"), (1003, prose(34, 60) + " me@a.example.com"),
              (None, prose(35, 60)), (1004, None), (1005, "")]
    path = tmp_path_factory.mktemp("tables")
    documents(pairs).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i % 4 > 0), 0) for i in range(240)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(7, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return f"{path}", pairs


def test_stages_take_effect_one_after_another(spark, folder):
    path, pairs = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, ids = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, path)
        assert docs.columns == columns
        docs = docs.cache()
        ids[name] = [r.doc_id for r in docs.select("doc_id").collect()]
    quality, near, clean, private = ids.values()
    assert not [i for i in quality if i is not None and i < 240 and i % 4 == 0]
    assert {i for i in range(240) if i % 4} <= set(quality) and {1000, 1002, 1003} <= set(quality)
    assert set(quality) - set(near) <= {1000, 1001, 1004, 1005} and 1 in near and len(near) == len(set(near))
    assert set(near) - set(clean) == {1002}
    assert sorted(map(str, private)) == sorted(map(str, clean))
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert "[EMAIL]" in texts[1003] and texts[2] == dict(pairs)[2]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, path)
    assert {r.doc_id for r in packed.collect()} == set(private)


def test_run_equals_the_stages_and_takes_an_empty_table(spark, folder, tmp_path):
    path, _ = folder
    rows = corpus_pipeline.run(spark, path).collect()
    assert len(rows) > 150 and all(r.length <= packing.CAPACITY for r in rows)
    for table in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{path}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}").count() == 0


def test_queries_are_registered():
    names = [f"op{n}_" for n in range(1, 11)]
    assert [sum(q.startswith(n) for q in entry.queries()) for n in names] == [1] * 10
    assert entry.queries()["pipeline"] is corpus_pipeline.run and set(queries.ORACLES) <= set(queries.QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "SimHash near-dedup", "benchmark decontamination", "PII", "best-fit packing"]


def test_small_queries_over_the_tables(spark, folder):
    path, pairs = folder
    for name in ("op1_pii", "op2_token_files", "op4_decontamination", "op5_packing", "op7_sharding", "op8_simhash", "op10_quality"):
        rows = queries.QUERIES[name](spark, path)
        assert rows.select("doc_id").distinct().count() == len(dict(pairs)) and not set(rows.columns) & (set(CLASHING) - {
            "score", "size", "shard", "spans", "start", "length"})
    held = {r.doc_id: r.held_out for r in queries.op10_quality(spark, path).collect()}
    assert all(held[i] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(240))
