"""Ordered target statistics against plain sums, and weighted fits."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from demandpanel.operators.forecast import smear
from demandpanel.operators.models import fit_two_stage
from demandpanel.operators.targets import target_statistics

DAY = date(2024, 1, 1)
SCHEMA = "store_id string, sku_id string, date date, y long, te_note string"


def test_statistics_see_earlier_days_only(spark):
    data = [(f"s{i % 3}" if i % 17 else None, f"k{i % 5}", DAY + timedelta(i % 12), (i * 7) % 11 if i % 13 else None, "n") for i in range(200)]
    cutoff = DAY + timedelta(8)
    got = target_statistics(spark.createDataFrame(data, SCHEMA), cutoff, prior=5.0)
    assert got.columns == ["store_id", "sku_id", "date", "y", "te_note", "te_store_id", "te_sku_id"]

    def want(i, name, day):
        seen = [r for r in data if r[2] < day and r[2] <= cutoff and r[3] is not None]
        if not seen:
            return 0.0
        own = [r[3] for r in seen if name is not None and r[i] == name]
        return (sum(own) + 5.0 * sum(r[3] for r in seen) / len(seen)) / (len(own) + 5.0)

    rows = got.collect()
    assert len(rows) == len(data)
    for r in rows:
        assert r["te_store_id"] == pytest.approx(want(0, r["store_id"], r["date"])) and r["te_sku_id"] == pytest.approx(want(1, r["sku_id"], r["date"]))
    # a label after the cutoff changes nothing
    other = [(a, b, d, 99 if d > cutoff else y, n) for a, b, d, y, n in data]
    again = target_statistics(spark.createDataFrame(other, SCHEMA), cutoff, prior=5.0)
    assert got.drop("y").exceptAll(again.drop("y")).count() == 0
    assert target_statistics(spark.createDataFrame([], SCHEMA), cutoff).count() == 0


def test_weight_zero_is_absence(spark):
    df = spark.range(400).select(F.pmod(F.xxhash64("id"), F.lit(10)).alias("a"), "id")
    df = df.withColumn("y", F.when(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10)) < F.col("a"), F.col("a") + 1).otherwise(0)).withColumn("w", F.when(F.col("id") % 3 == 0, 0.0).when(F.col("id") % 3 == 1, 2.0).otherwise(1.0))
    how = dict(trees=2, depth=2, bounds=None)
    a, b = fit_two_stage(df, ["a"], weight="w", **how), fit_two_stage(df.filter("w > 0"), ["a"], weight="w", **how)
    assert a.factor == pytest.approx(b.factor) and a.level == pytest.approx(b.level)
    x, z = (sorted((r["id"], r["p"], r["qty"]) for r in m.transform(df).collect()) for m in (a, b))
    assert x == pytest.approx(z) if not isinstance(x[0], tuple) else all(u == pytest.approx(v) for u, v in zip(x, z, strict=True))
    # weights change the fit: rows of sales weighing more raise the mean probability
    heavy = fit_two_stage(df.withColumn("w", F.when(F.col("y") > 0, 5.0).otherwise(1.0)), ["a"], weight="w", **how)
    mean = lambda m: m.transform(df).agg(F.avg("p")).first()[0]
    assert mean(heavy) > mean(fit_two_stage(df, ["a"], **how)) + 0.1


def test_weighted_smearing(spark):
    df = spark.createDataFrame([(0.5, 2.0), (-0.25, 1.0)], "residual double, w double")
    twice = spark.createDataFrame([(0.5,), (0.5,), (-0.25,)], "residual double")
    assert smear(df, weight="w").first()[0] == pytest.approx(smear(twice).first()[0])
