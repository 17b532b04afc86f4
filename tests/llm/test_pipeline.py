import corpus_pipeline as cp
from helpers import SCHEMA, none, odd_docs, odd_rows, prose

from mergestat.llm.common import staged


def tables(spark, folder, docs, labels, bench):
    docs.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    bench.write.parquet(f"{folder}/benchmark.parquet")
    return folder


def through(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = [docs]
    for name, stage in cp.STAGES:
        docs = staged(stage(spark, docs, folder), f"test-{name}")
        seen.append(docs)
    return seen


def test_stage_names():
    assert [n for n, _ in cp.STAGES] == ["quality", "near_dedup", "decontaminate", "mix", "tokens"]


def test_odd_documents(spark, tmp_dir):
    labels = spark.createDataFrame([(3, 1, 0), (9, 1, 0), (None, 0, 0), (12, None, 1)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, prose(105, 35)), (2, None)], "item_id long, text string")
    seen = through(spark, tables(spark, tmp_dir, odd_docs(spark), labels, bench))
    for df in seen[:-1]:
        assert df.columns == seen[0].columns
    ids = [{r.doc_id for r in df.collect()} for df in seen]
    assert ids[1] >= ids[2] >= ids[3] >= ids[4] >= ids[5]
    assert 22 in ids[2] and 22 not in ids[3]           # holds item 1
    assert 5 in ids[2] and not {6, 7} & ids[2]         # copies of 5
    assert seen[5].count() == seen[4].count()


def test_empty_tables(spark, tmp_dir):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    seen = through(spark, tables(spark, tmp_dir, none(odd_docs(spark)), labels, bench))
    assert [df.count() for df in seen] == [0] * 6


def test_run_is_the_stages_in_turn(spark):
    sf = "/root/testdata/sf0.001"
    want = through(spark, sf)
    got = cp.run(spark, sf)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want[-1].collect()))
    toxic = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").where("toxic = 1").collect()}
    clean = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").where("toxic = 0 and quality = 1").collect()}
    kept = {r.doc_id for r in want[1].collect()}
    assert len(kept & clean) >= 0.98 * len(clean) and len(kept & toxic) <= 0.7 * len(toxic)
    assert len(odd_rows()[0]) == SCHEMA.count(",") + 1
