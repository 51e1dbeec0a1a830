import hashlib

import corpus_pipeline as cp
from helpers import docs_of, odd_rows, with_extra

from ordermart.llm import mixing, simhash, toxicity


def staged(spark, docs, sf_dir, tmp_dir):
    for i, (_, stage) in enumerate(cp.STAGES):
        before = docs
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_dir}/{i}")
        docs = spark.read.parquet(f"{tmp_dir}/{i}")
        yield before, docs


def test_stages_follow_each_other(spark, tmp_dir):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    steps = list(staged(spark, docs, sf, tmp_dir))
    assert all(after.columns == docs.columns for _, after in steps[:-1])
    (_, clean), (_, exact), (_, near), (_, mixed), (_, packed) = steps
    model = toxicity.learned(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    rejected = {r.doc_id for r in toxicity.scored(docs, model).where("rejected").collect()}
    assert rejected and {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect()} - rejected
    best = {}
    for r in clean.collect():
        key = hashlib.sha256((r.text or "").encode()).digest()
        best[key] = max(r.doc_id, best.get(key, r.doc_id))
    assert {r.doc_id for r in exact.collect()} == set(best.values()) and exact.count() == len(best)
    assert {r.doc_id for r in near.collect()} == {r.component_id for r in simhash.near_dedup(exact).collect()}
    want = {r["doc_id"]: r["__mix"]["repeats"] for r in mixing.mix(near).collect() if r["__mix"]["repeats"]}
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == want
    assert packed.agg({"length": "sum"}).first()[0] == sum(
        r.doc_tokens * (want[r.doc_id]) for r in packed.select("doc_id", "doc_tokens").distinct().collect())


def test_odd_rows_pass_every_stage(spark, tmp_dir):
    docs = with_extra(docs_of(spark, odd_rows()))
    assert [after.count() > 0 for _, after in staged(spark, docs, "/root/testdata/sf0.001", tmp_dir)] == [True] * 5


def test_empty_documents(spark, tmp_dir):
    assert [after.count() for _, after in staged(spark, docs_of(spark, []), "/root/testdata/sf0.001", tmp_dir)] == [0] * 5
