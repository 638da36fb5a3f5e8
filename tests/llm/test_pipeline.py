import corpus_pipeline
import __spark_entry__ as entry
from tallyloft.llm import queries

SF = "/root/testdata/sf0.001"


def test_stages_and_registration():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash_near_dedup", "decontamination", "mixing"]
    names = entry.queries()
    assert names.keys() >= {*queries.QUERIES, "pipeline"} and sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert entry.oracle_sql().keys() >= queries.ORACLES.keys()


def test_each_stage_keeps_what_its_operator_keeps(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    planted = spark.createDataFrame(
        [(9001, None, "en", "src0", 0), (9002, "12345 !!", "en", "src0", 8), (9003, "Это другой язык, которого никто здесь не учил " * 4, None, None, 10)],
        documents.schema)
    first = documents.filter("length(text) > 400").orderBy("doc_id").first()
    copies = spark.createDataFrame([(9004, first.text.replace("\n", " \n "), "en", "src1", 1), (9005, first.text + " zz", "en", "src1", 1)], documents.schema)
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    leak = spark.createDataFrame([(9006, item, "en", "src2", 1)], documents.schema)
    docs = documents.unionByName(planted).unionByName(copies).unionByName(leak)
    kept = {}
    for name, step in corpus_pipeline.STAGES:
        out = corpus_pipeline.stage(step(spark, docs, SF), name)
        kept[name] = {r.doc_id for r in out.select("doc_id").collect()}
        if name != "mixing":
            assert out.columns == documents.columns and out.count() == len(kept[name])
            docs = out
    assert kept["language_id"] == {r.doc_id for r in documents.filter("text <> ''").select("doc_id").collect()} | {9004, 9005, 9006}
    assert 9004 not in kept["exact_dedup"] and 9005 in kept["exact_dedup"]
    assert 9005 not in kept["simhash_near_dedup"] and first.doc_id in kept["simhash_near_dedup"]
    assert 9006 in kept["simhash_near_dedup"] and 9006 not in kept["decontamination"]
    assert kept["mixing"] <= kept["decontamination"] and len(kept["mixing"]) > 50


def test_run_and_empty_documents(spark, tmp_path):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 50 and {"mix_shard", "mix_copy"} <= set(out.columns)
    for t in ("documents", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
