import sys

from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from inkgrid.llm import jaccard, mixing, pii, quality

DATA = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    start, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, docs, DATA).cache()
        seen[name] = (docs, kept)
        docs = kept
    names = [n for n, _ in corpus_pipeline.STAGES]
    for n in names[:-1]:
        assert seen[n][1].columns == start.columns
    before, after = seen[names[0]]
    model = quality.train(before, spark.read.parquet(f"{DATA}/labels.parquet"))
    assert after.count() == quality.score(before, model).where(F.col("score") >= quality.THRESHOLD).count() <= before.count()
    before, after = seen[names[1]]
    ids = sorted(r.component for r in jaccard.classes(before).select("component").distinct().collect())
    assert sorted(r.doc_id for r in after.select("doc_id").collect()) == ids
    before, after = seen[names[2]]
    assert after.count() == before.count() and pii.found(after).where(" + ".join(f"size({k})" for k in pii.KINDS) + " > 0").count() == 0
    before, after = seen[names[3]]
    want = {r.doc_id: r.copies for r in mixing.mix(before).collect() if r.copies}
    assert {r.doc_id: r.n for r in after.groupBy("doc_id").agg(F.count("*").alias("n")).collect()} == want
    before, after = seen[names[4]]
    assert after.where("start = 0").count() == before.count()


def test_runs_as_a_query(spark):
    assert __spark_entry__.queries()["pipeline"](spark, DATA).count() > 0
    names = [k for k in __spark_entry__.queries() if k.startswith("op")]
    assert sorted(int(k[2:].split("_")[0]) for k in names) == list(range(1, 14))


def test_entry_without_the_llm_folder(monkeypatch):
    monkeypatch.setitem(sys.modules, "inkgrid.llm", None)
    monkeypatch.setitem(sys.modules, "inkgrid.llm.queries", None)
    assert not any(k.startswith("op") for k in __spark_entry__.queries())
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    assert "pipeline" not in __spark_entry__.queries() and __spark_entry__.oracle_sql()


def test_stages_on_odd_rows(spark):
    """Nulls in every column, empty and very long texts, repeated rows, columns of clashing names, and no rows at all."""
    long = " ".join(f"word{i % 977} and{i % 31}" for i in range(6000))
    texts = [None, "", "   ", long, "one two three four five six seven", "one two three four five six seven", "mail me@x.org or +1 (555) 555-0100 now please thanks"]
    rows = [(i % 5 if i % 3 else None, t, None if i % 2 else "en", None if i % 4 == 0 else "src", None, "own", 7, "t", "k") for i, t in enumerate(texts * 2)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, copies string, size int, terms string, text_key string"
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), DATA).count() == 0, name
        if name == corpus_pipeline.STAGES[-1][0]:
            assert stage(spark, docs, DATA).where("start = 0").count() == len(rows)
            break
        kept = stage(spark, docs, DATA)
        assert kept.schema.names == docs.schema.names and {(r["copies"], r["size"], r["terms"], r["text_key"]) for r in kept.collect()} <= {("own", 7, "t", "k")}, name
        if name == "n-gram Jaccard join":
            told = [r.text for r in kept.collect()]
            assert sorted(t for t in told if t and t.strip()) == sorted({t for t in texts if t and t.strip()}) and len([t for t in told if not (t or "").strip()]) == 6
        if name == "personal data":
            assert sorted(r.text or "" for r in kept.collect()) == sorted(["", "", "   ", long, texts[4], texts[5], "mail [EMAIL] or [PHONE] now please thanks"] * 2)
