"""What the fourth round found: results that differed from their SQL, work left out, and work by day that facts alone can do."""

from datetime import date, timedelta

from pyspark.sql import functions as F

import __spark_entry__ as entry
from demandpanel.config import KEYS
from demandpanel.operators import metrics as M
from demandpanel.operators import models as ML
from demandpanel.operators import spans as N
from demandpanel.operators import stats as A
from demandpanel.operators import windows as W
from demandpanel.operators.panel import dense_panel
from demandpanel.plans.registry import rounded

SF = "/root/testdata/sf0.001"


def test_split_cuts_at_the_exact_quantile(spark):
    """F8: a sketch of 10,000 cut some days beside the quantile."""
    days = [i * i % 25013 for i in range(50_000)]
    df = spark.createDataFrame([(d,) for d in days], "d int").select(F.date_add(F.lit(date(1960, 1, 1)), F.col("d")).alias("date"))
    at = sorted(days)[40_000 - 1]
    got = {r["split_role"]: r["count"] for r in A.ordered_split(df).groupBy("split_role").count().collect()}
    assert got == {"TRAIN": sum(d <= at for d in days), "VAL": sum(d > at for d in days)}


def odd_facts(spark):
    """Series with a sale on each day, with one in some years, with a return first, and one that begins after the cutoff."""
    end = date(2001, 11, 4)
    rows = [("a", "x", end - timedelta(k), 1 + k * k % 7) for k in range(90)] + [("a", "y", date(1998, 12, 20) + timedelta(9 * k), k % 11) for k in range(115)]
    rows += [("b", "x", date(1997, 3, 1), 0), ("b", "x", date(1998, 12, 31), 4), ("b", "x", date(1999, 1, 1), 9), ("b", "x", date(1999, 1, 8), 30), ("b", "x", end, 2), ("b", "y", date(2001, 6, 1), 3), ("b", "y", end + timedelta(1), 5), ("c", "x", end + timedelta(2), 1)]
    return spark.createDataFrame(rows, "store_id string, sku_id string, date date, y long"), end


def same(a, b) -> None:
    plain = lambda df: sorted(repr([round(v, 9) if isinstance(v, float) else v for v in r]) for r in df.collect())
    assert plain(a) == plain(b) and a.columns == b.columns


def test_spans_have_the_features_of_all_days(spark):
    """F9 F10 F12: frames of spans are those of the panel's rows."""
    facts, end = odd_facts(spark)
    panel = dense_panel(facts.withColumn("sales_clean", F.col("y")), end).withColumn("y", F.col("sales_filled"))
    want = W.rolling(W.rolling(W.lags(panel), (7, 28), ("mean", "sum")), (28,), ("std", "min", "max"))
    want = W.dormancy(W.recency(W.roll_mean_pos(W.nz_rate(want))))
    got = N.frame_features(facts, end)
    same(got, want.select(got.columns))
    late = date(2001, 10, 1)
    same(N.frame_features(facts, end, since=late), got.filter(F.col("date") >= F.lit(late)))
    plan = entry.queries()["w2_w6_rolling"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(_from" in plan and plan.index("sequence(_from") < plan.index("windowspecdefinition")  # windows lie below the days


def test_spikes_of_spans_are_those_of_all_days(spark):
    """F6 F13: spikes, their history, and what is learned by week, from facts."""
    facts, end = odd_facts(spark)
    panel = dense_panel(facts.withColumn("sales_clean", F.col("y")), end).withColumn("y", F.col("sales_filled")).select(*KEYS, "date", "y")
    days = W.spike_flags(facts.filter(F.col("date") <= F.lit(end)), {"mult": "is_spike"}, sparse=True)
    shares = W.store_days_of_facts(facts, end)
    for asof in (date(2001, 5, 14), None):
        got = N.spike_features(days, end, asof, shares)
        assert got.filter("is_spike = 1").count() > 5
        same(got, W.assemble_spikes(W.spike_flag(panel), asof, store_days=shares).select(got.columns))
    plan = entry.queries()["w26_w29_j8_spike_features"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("sequence(_from") < plan.index("windowspecdefinition")


def test_rounding_is_that_of_the_sql(spark):
    values = [0.0, -0.0, 1 / 3, -1 / 3, 1 / 128, -1 / 128, 1e8 + 1 / 7, 123456789012.3456789, -5e15, float("nan"), float("inf"), None, 2.5e-7, 9.99999949e8]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for a, b in df.select(rounded(F.col("x")), F.round("x", 6) + 0.0).collect():
        assert a == b or (a != a and b != b) or abs(a - b) <= 1e-15 * abs(b)


def test_skus_follow_from_facts(spark):
    """no window of a SKU's panel days, and the same features."""
    facts, end = odd_facts(spark)
    panel = dense_panel(facts.withColumn("sales_clean", F.col("y")), end).withColumn("y", F.col("sales_filled"))
    same(A.sku_features_of_facts(facts, end), A.sku_features(panel))
    plan = entry.queries()["a26_sku_features"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in plan


def test_fits_see_rows_of_the_same_buckets_once(spark, monkeypatch):
    """F3 F7: rows that differ in every value are fitted and scored by their buckets, which all feature sets share."""
    df = spark.range(4000).select((F.col("id") * 7919 % 4001 / 4001).alias("a"), (F.col("id") % 3).cast("double").alias("b"), F.when(F.col("id") % 3 > 1, 5).otherwise(0).alias("y"))
    sizes, fit = [], ML.fit_two_stage
    monkeypatch.setattr(ML, "fit_two_stage", lambda *a, **how: sizes.append(how["counted"].count()) or fit(*a, **how))
    got = {r["feature_set"]: r for r in ML.ablate(df, df, {"both": ["a", "b"], "a": ["a"]}, trees=2, depth=2).collect()}
    assert sizes[0] == sizes[1] <= 3 * ML.BUCKETS + 3  # 4,000 before
    model = fit(df, ["a", "b"], trees=2, depth=2)
    scored = model.transform(df).withColumn("yhat", F.col("p") * F.col("qty") * model.factor)
    want = M.metrics(scored, ["yhat"], which=["n", "wmape", "bias_pct"]).first()
    assert all(abs(got["both"][c] - want[c]) < 1e-6 for c in ("n", "wmape", "bias_pct")) and got["both"]["wmape"] < got["a"]["wmape"]
    # the same by conditions on the features themselves
    step = model.transform(df.withColumn("s", model.step({c: F.col(c) for c in ("a", "b")}))).select(F.abs(F.col("p") * F.col("qty") * model.factor - F.col("s")).alias("d"))
    assert step.agg(F.max("d")).first()[0] < 1e-9
