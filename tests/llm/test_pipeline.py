import inspect

from pyspark.sql import functions as F

import corpus_pipeline as P
from quarrysight.llm import minhash_dedup, queries, toxicity
from quarrysight.llm.oracle import ORACLE

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_and_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in P.STAGES:
        before = docs
        docs = stage(spark, docs, SF)
        assert docs.columns[:len(columns)] == columns
        if name != "sentencepiece":
            docs = docs.cache()
            assert docs.columns == columns and 0 < docs.count() <= before.count()
        else:
            assert docs.count() == before.count() and docs.where("not round_trip").count() == 0
    ids = {r.doc_id for r in docs.collect()}
    whole = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    toxic = {r.doc_id for r in toxicity.score_documents(whole, labels).where("predicted = 1").collect()}
    assert not ids & toxic
    left = whole.where(~F.col("doc_id").isin(sorted(toxic)))
    copies = {r.doc_id for r in minhash_dedup.near_duplicates(left).where("not kept").collect()}
    assert not ids & copies
    assert {r.doc_id for r in P.run(spark, SF).select("doc_id").collect()} == ids


def test_null_ids_pass(spark):
    docs = spark.createDataFrame([(None, "some words of a text", "x"), (None, None, "y"), (1, None, "z")],
                                 "doc_id long, text string, source string")
    assert P.drop_near_duplicates(spark, docs, SF).count() == 3
    assert P.drop_benchmark_leaks(spark, docs, SF).count() == 3
    assert P.drop_toxic(spark, docs, SF).count() == 3


def test_queries_are_registered():
    names = list(queries.QUERIES)
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)]
    assert set(ORACLE) <= set(names)
    assert all(len(inspect.signature(f).parameters) == 2 for f in queries.QUERIES.values())


SCHEMA = "doc_id long, text string, source string"


def sources(df):
    return sorted(r.source for r in df.collect())


def test_a_row_shares_no_fate_by_doc_id(spark, monkeypatch):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy(F.length("text").desc()).first().text
    docs = spark.createDataFrame([(None, item, "leak 1"), (None, "clean words", "a"), (7, item, "leak 2"), (7, "other clean words", "b"),
                                  (None, None, "c")], SCHEMA)
    assert sources(P.drop_benchmark_leaks(spark, docs, SF)) == ["a", "b", "c"]
    kept = P.decontaminate.decontaminated(docs, spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert sources(kept) == ["a", "c"]       # as documents: those of doc_id 7 go together

    monkeypatch.setattr(toxicity, "_scoring", lambda docs, labels: lambda texts: [float("bad" in t) for t in texts])
    docs = spark.createDataFrame([(None, "bad", "x"), (None, "good", "a"), (7, "bad", "x"), (7, "good", "b"), (8, None, "c")], SCHEMA)
    out = P.drop_toxic(spark, docs, SF)
    assert out.schema == docs.schema and sources(out) == ["a", "b", "c"]


def test_one_row_of_each_group_of_copies(spark):
    text = " ".join(f"w{i}" for i in range(60))
    near, other = text + " more", " ".join(f"v{i}" for i in range(60))
    docs = spark.createDataFrame([(None, text, "copy"), (None, text, "copy"), (5, near, "a"), (5, other, "b"), (5, other, "b"),
                                  (9, text, "copy"), (None, "", "c"), (None, "", "c"), (None, "alone here", "d"), (None, "alone here", "d")], SCHEMA)
    out = P.drop_near_duplicates(spark, docs, SF)
    assert out.columns == docs.columns and sources(out) == ["a", "b", "c", "c", "d"]


def test_columns_may_have_any_name(spark):
    text = " ".join(f"w{i}" for i in range(60))
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy(F.length("text").desc()).first().text
    names = ["_row_key", "_row", "_copy", "_leak", "_key", "_bad_key", "_bad_doc", "_kept", "_of", "component_id", "rank", "_ROW_"]
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` long" for n in names)
    rows = [(1, text), (2, text + " x"), (3, item), (4, "all clean here"), (None, None)]
    docs = spark.createDataFrame([(i, t, *range(k * 100, k * 100 + len(names))) for k, (i, t) in enumerate(rows)], schema)

    def left(df):
        assert df.columns == docs.columns
        return sorted(tuple(r)[2:] for r in df.collect())

    own = [tuple(range(k * 100, k * 100 + len(names))) for k in range(len(rows))]
    assert left(P.drop_near_duplicates(spark, docs, SF)) == [own[0], *own[2:]]
    assert left(P.drop_benchmark_leaks(spark, docs, SF)) == [*own[:2], *own[3:]]
    assert left(P.decontaminate.decontaminated(docs, spark.read.parquet(f"{SF}/benchmark.parquet"))) == [*own[:2], *own[3:]]
    assert left(P.drop_toxic(spark, docs, SF)) == own


def test_a_worker_keeps_one_thing():
    from quarrysight.llm import common

    made = []
    for name in ("a", "a", "b", "a"):
        common.worker_keeps(name, lambda: made.append(name) or len(made))
    assert made == ["a", "b", "a"] and list(common._KEPT) == ["a"]
    common.worker_drops()
    assert not common._KEPT


def test_decontamination_goes_by_fingerprints(spark, monkeypatch):
    from quarrysight.llm import decontaminate

    asked, near = [], decontaminate.within_radius
    monkeypatch.setattr(decontaminate, "within_radius", lambda *a: (asked.append(1), near(*a))[1])
    monkeypatch.setattr(decontaminate, "_rare_items", None)
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    docs = spark.createDataFrame([(1, f"before {item} after"), (2, "clean words")], "doc_id long, text string")
    assert [r.doc_id for r in P.drop_benchmark_leaks(spark, docs, SF).collect()] == [2] and asked
