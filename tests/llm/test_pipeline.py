import random

from llm_fixtures import SCHEMA, documents, prose
from test_tokens import check_pieces

import corpus_pipeline as P
from feeflow.llm.catalog import tokenizer_path


def test_stages_keep_clean_documents_and_take_effect(spark, scratch):
    rnd = random.Random(1)
    item = prose(rnd, 30, 9000)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    clean = [(i, prose(rnd, 120, 9000), "en", f"s{i % 15}") for i in range(30)]
    base = prose(rnd, 150, 9000)
    copies = [(100 + i, base if i % 2 else base.replace("w1", "v1", 2), "en", f"s{i % 15}") for i in range(20)]
    junk = [(200, "spam eggs " * 80, "en", "s1"), (201, "too short", "en", "s2"), (202, None, "en", "s3")]
    leaks = [(300, f"{prose(rnd, 60, 9000)} {item} {prose(rnd, 60, 9000)}", "en", "s4")]
    lined = [(400 + i, f"{prose(rnd, 90, 9000)}\nshared footer line", "en", f"s{i}") for i in range(15)]
    rows = clean + copies + junk + leaks + lined
    documents(spark, rows, clashing=False).write.parquet(f"{scratch}/documents.parquet")
    docs = spark.read.parquet(f"{scratch}/documents.parquet")
    columns, ids = docs.columns, {}
    for number, (name, stage) in enumerate(P.STAGES):
        docs = stage(spark, docs, scratch)
        if number < len(P.STAGES) - 1:
            assert docs.columns == columns and docs.schema.simpleString() == spark.createDataFrame(
                [], SCHEMA).schema.simpleString()
        docs.write.parquet(f"{scratch}/{number}")
        docs = spark.read.parquet(f"{scratch}/{number}")
        ids[name] = {r.doc_id for r in docs.collect()}
    assert ids["quality_rules"] == {r[0] for r in rows} - {200, 201, 202}
    assert ids["line_dedup"] == ids["quality_rules"]
    footers = [r for r in spark.read.parquet(f"{scratch}/1").collect() if "shared footer" in r.text]
    assert [r.doc_id for r in footers] == [400]
    assert all(r.n_chars == len(r.text) for r in spark.read.parquet(f"{scratch}/1").collect())
    assert len(ids["near_dedup"] & {r[0] for r in copies}) == 1
    assert ids["near_dedup"] >= {r[0] for r in clean + leaks + lined}
    assert ids["decontamination"] == ids["near_dedup"] - {300}
    left = [(r.doc_id, r.text) for r in spark.read.parquet(f"{scratch}/3").collect()]
    assert check_pieces(tokenizer_path(), left, docs.collect()) == 0
    run = P.run(spark, scratch).drop("ids")
    assert sorted(r.doc_id for r in run.select("doc_id").distinct().collect()) == sorted(ids["packing"])


def test_registered():
    import __spark_entry__ as E

    assert "pipeline" in E.queries() and len(P.STAGES) == 5
