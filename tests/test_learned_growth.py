"""What the learned forecasts read, score and count, so that their time follows the facts and series."""

from datetime import date, timedelta

from pyspark.sql import functions as F

from demandpanel.config import KEYS
from demandpanel.operators import calendar as C
from demandpanel.operators import forecast as FC
from demandpanel.operators import models as ML
from demandpanel.operators import production as PR
from demandpanel.operators import stats as A
from demandpanel.operators.panel import dense_panel
from demandpanel.plans.queries2 import ml_rows
from demandpanel.sources.testdata import CFG

END = date(2001, 11, 4)


def facts(spark):
    rows = [(s, k, END - timedelta(3 * i * (k == "x") + 17 * i + ord(s) % 5), (7 * i + ord(s)) % 9) for s in "abc" for k in "xy" for i in range(30)]
    return spark.createDataFrame([r for r in rows if r[3] >= 0], "store_id string, sku_id string, date date, sales_clean long")


class Half:
    """A model of a fixed value that remembers the rows it saw."""

    factor, seen = 1.0, None

    def transform(self, df):
        Half.seen = df
        return df.withColumns({"p": F.lit(0.5), "qty": F.col("roll_mean_28")})


def test_a_forecast_scores_a_row_per_series(spark):
    days = facts(spark).withColumn("y", F.col("sales_clean"))
    panel = dense_panel(facts(spark), END).withColumn("y", F.col("sales_filled"))
    seg = days.select(*KEYS).distinct().withColumn("abc", F.when(F.col("sku_id") == "x", "A").otherwise("C"))
    start, closed = END + timedelta(1), C.closure_dim(spark, CFG)
    out = PR.generate_forecast({"A": Half(), "C": Half()}, panel, seg, closed, start, 28)
    assert "date" not in Half.seen.columns and Half.seen.count() == 3
    assert out.count() == 6 * 28
    # Croston from the facts and the features from the last 60 days say the same
    late = dense_panel(facts(spark), END, since=END - timedelta(59)).withColumn("y", F.col("sales_filled"))
    few = PR.generate_forecast({"A": Half(), "C": Half()}, late, seg, closed, start, 28, facts=days, parts=3)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, few.collect()))


def test_croston_needs_no_panel(spark):
    panel = dense_panel(facts(spark), END).withColumn("y", F.col("sales_filled"))
    days = facts(spark).withColumn("y", F.col("sales_clean")).unionByName(spark.createDataFrame([("a", "x", END + timedelta(2), 5, 5)], "store_id string, sku_id string, date date, sales_clean long, y long"))
    assert sorted(map(tuple, FC.croston(panel).collect())) == sorted(map(tuple, FC.croston(days, end=END).collect()))


def test_groups_are_counted_in_one_pass(spark):
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    rows = spark.range(200).select(F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("abc"), (F.col("id") % 5).cast("double").alias("lag_1"), (F.col("id") % 3).alias("y"))
    models = ML.fit_segments(rows.mapInPandas(look, rows.schema), ["lag_1"], trees=1, depth=1)
    assert set(models) == {"A", "B"} and seen.value == 200


def test_keys_are_summed_once_for_their_segments(spark):
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    rows = spark.range(300).select((F.col("id") % 50).cast("string").alias("store_id"), F.lit("k").alias("sku_id"), (F.col("id") % 7).alias("y"))
    out = A.abc(rows.repartition(3, *KEYS).mapInPandas(look, rows.schema)).collect()
    assert len(out) == 50 and seen.value == 300


def test_rows_of_a_fit_are_those_asked_for(spark):
    train, val = ml_rows(spark, "/root/testdata/sf0.001", val=False, group=lambda df: df)
    assert "abc" not in train.columns and val.count() == 0
    every, later = ml_rows(spark, "/root/testdata/sf0.001")
    assert later.count() > 0 and train.exceptAll(every.drop("abc")).count() == 0 and train.count() == every.count()


def test_tiers_score_a_row_per_series(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(PR, "predict_tiers", lambda models, df: seen.append(df) or df.withColumn("yhat", F.lit(2.0)))
    late = dense_panel(facts(spark), END, since=END - timedelta(59)).withColumn("y", F.col("sales_filled"))
    tiers = facts(spark).select(*KEYS).distinct().withColumn("tier_name", F.lit("T1_MATURE"))
    out = PR.tier_horizon({}, late, tiers, C.closure_dim(spark, CFG), END + timedelta(1), 28)
    assert "date" not in seen[0].columns and seen[0].count() == 6
    assert out.count() == out.select(*KEYS, "date").distinct().count() == 6 * 28
