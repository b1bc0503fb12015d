"""The pipeline's stages take effect and keep the columns of documents."""

from pyspark.sql import functions as F
from test_simhash import kept_by_all_pairs

import corpus_pipeline
from rankstream.llm import catalog, common, decontaminate, quality_rules


def test_stages(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents")
    ids, columns = None, docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_dedup", "decontamination", "pii", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = common.settle(stage(spark, docs, sf_dir), name)
        assert docs.columns == columns
        ids = sorted(r.doc_id for r in docs.collect())
        if name == "quality_rules":
            judged = quality_rules.judge(before)
            assert ids == sorted(r.doc_id for r in judged.filter("counts.kept").collect())
        if name == "near_dedup":
            assert ids == kept_by_all_pairs([(r.doc_id, r.text) for r in before.collect()])
        if name == "decontamination":
            benchmark = common.table(spark, sf_dir, "benchmark")
            dirty = {r.doc_id for r in decontaminate.regions(before, benchmark).collect()}
            assert dirty and ids == sorted(r.doc_id for r in before.collect() if r.doc_id not in dirty)
        if name == "pii":
            assert ids == sorted(r.doc_id for r in before.collect())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(ids)
    ran = corpus_pipeline.run(spark, sf_dir)
    whole = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(map(tuple, ran.select(whole).collect())) == sorted(map(tuple, packed.select(whole).collect()))


def test_registered_names(sf_dir):
    import __spark_entry__ as contract

    names = contract.queries()
    assert "pipeline" in names
    assert sorted(catalog.QUERIES) == sorted(n for n in names if n.startswith("op") and n[2].isdigit())
    assert {n.split("_")[0] for n in catalog.QUERIES} == {f"op{i}" for i in range(1, 14)}


def test_empty_documents(spark, sf_dir, tmp_path):
    for name in ("documents", "benchmark"):
        common.table(spark, sf_dir, name).limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_odd_rows(spark, sf_dir, tmp_path):
    """Null ids and texts, repeated rows and ids, one more column, and no benchmark."""
    docs = common.table(spark, sf_dir, "documents").filter("doc_id < 40")
    first = docs.filter("doc_id < 4")
    none = docs.filter("doc_id = 5").withColumn("doc_id", F.lit(None).cast("long"))
    bare = docs.filter("doc_id = 6").withColumns({"text": F.lit(None).cast("string"), "doc_id": F.lit(99).cast("long")})
    odd = docs.unionByName(first).unionByName(none).unionByName(bare).withColumn("kept", F.lit("x"))
    odd.write.parquet(str(tmp_path / "documents.parquet"))
    common.table(spark, sf_dir, "benchmark").limit(0).write.parquet(str(tmp_path / "benchmark.parquet"))
    made = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = common.settle(stage(spark, made, str(tmp_path)), name)
        assert made.columns == odd.columns
    ids = [r.doc_id for r in made.collect()]
    assert len(ids) == len(set(ids)) and None not in ids and 99 not in ids
    packed = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert packed == set(ids)
