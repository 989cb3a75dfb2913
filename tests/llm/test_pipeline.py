"""The pipeline's stages against the operators' own results."""

from pyspark.sql import functions as F

import corpus_pipeline
from demandpanel.llm import common, decontaminate, near_dedup

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = common.read(spark, SF, "documents")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = common.cut(stage(spark, docs, SF))
        if name != "packing":
            assert out.columns == columns
            assert out.select("doc_id").subtract(docs.select("doc_id")).count() == 0
        seen[name] = (docs, out)
        docs = out
    before, after = seen["line_dedup"]
    assert before.count() == after.count()
    before, after = seen["near_dedup"]
    classes = near_dedup.near_dedup(before)
    assert {r[0] for r in classes.select("class_id").distinct().collect()} == {r[0] for r in after.select("doc_id").collect()}
    before, after = seen["decontamination"]
    dirty = decontaminate.decontaminate(before, common.read(spark, SF, "benchmark")).filter("n_hit > 0").select("doc_id")
    assert sorted(before.select("doc_id").subtract(dirty).collect()) == sorted(after.select("doc_id").collect())
    before, packed = seen["packing"]
    assert packed.select("doc_id").distinct().count() == before.select("doc_id").distinct().count()
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0


def test_repeated_rows_stay_once(spark):
    rows = [(None, "a text that has no name and several copies", s) for s in "abc"] + [(1, "the first row of a class that is repeated", "a")] * 2
    rows += [(2, "the first row of a class that is repeated", "b"), (3, "words of another document alone in its class", "b")]
    df = spark.createDataFrame([(i, t, "en", s, 1) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.drop_near_copies(spark, df, SF)
    assert got.columns == df.columns
    assert sorted(map(str, (r["doc_id"] for r in got.collect()))) == ["1", "3", "None"]


def test_columns_of_any_name_come_through(spark):
    """Each stage with every name that the operators and MLlib use as an extra column, whose values come back."""
    from test_operators import CLASH

    docs = common.read(spark, SF, "documents").limit(60)
    wide = common.cut(docs.select("*", *(F.concat(F.lit(f"{c} "), "doc_id").alias(c) for c in CLASH)))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, wide, SF)
        assert out.columns == wide.columns, name
        rows = out.collect()
        assert rows and all(r[c] == f"{c} {r['doc_id']}" for r in rows for c in CLASH), name
    assert corpus_pipeline.STAGES[-1][1](spark, wide, SF).count() >= 60


def test_line_dedup_leaves_copies_their_text(spark):
    rows = [(i, "one text that is copied over and over\nby many", "en", "a", 1) for i in range(30)] + [(100 + i, f"own {i}", "en", "a", 1) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert {r["text"] for r in corpus_pipeline.drop_lines(spark, df, SF).filter("doc_id < 100").collect()} == {rows[0][1]}


def test_empty_documents(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        common.read(spark, SF, t).limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
