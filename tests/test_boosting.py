"""Boosting of many groups at once: against MLlib's tree, plain quantiles and sums, and for the number of its jobs."""

import math
import uuid

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from demandpanel.operators import boosting as B


@pytest.fixture(scope="module")
def cut(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("cuts")

    def write(df):
        path = f"{folder}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return spark.read.parquet(path)

    return write


@pytest.fixture(scope="module")
def rows(spark, cut):
    """Three groups; group 0 holds most rows."""
    h = lambda k: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1000)).cast("double")
    df = spark.range(3000).select("id", F.when(F.col("id") % 10 < 8, 0).otherwise(F.col("id") % 2 + 1).alias("g"), F.floor(h(1) / 100).alias("a"), F.floor(h(2) / 125).alias("b"), h(3).alias("noise"))
    return cut(df.withColumn("y", F.when(F.col("a") > 4, 20.0).otherwise(3.0) + F.col("b") * (F.col("g") + 1) + F.col("noise") / 500))


def test_one_tree_is_mllibs(rows, cut):
    model = B.fit(rows, ["a", "b"], B.squared(), cut, by=("g",), rounds=1, depth=3, step=1.0, least=1, l2=0.0)
    got = model.predict(rows)
    for g in range(3):
        part = VectorAssembler(inputCols=["a", "b"], outputCol="x").transform(rows.filter(F.col("g") == g))
        want = DecisionTreeRegressor(featuresCol="x", labelCol="y", maxDepth=3, minInfoGain=0.0).fit(part).transform(part)
        both = got.filter(F.col("g") == g).select("id", "yhat").join(want.select("id", "prediction"), "id")
        assert both.count() == part.count()
        assert both.agg(F.max(F.abs(F.col("yhat") - F.col("prediction")))).first()[0] < 1e-9


def test_groups_do_not_add_jobs(spark, rows, cut):
    def jobs(df, tag):
        spark.sparkContext.setJobGroup(tag, tag)
        B.fit(df, ["a", "b"], B.squared(), cut, by=("g",), rounds=2, depth=2)
        ids = spark.sparkContext.statusTracker().getJobIdsForGroup(tag)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(ids)

    many = rows.withColumn("g", F.col("id") % 40)
    few, more = jobs(rows.filter("g < 2"), "few"), jobs(many, "many")
    assert more <= few + 2  # adaptive plans may differ by a job


def test_weight_zero_is_absence(rows, cut):
    half = F.col("id") % 2
    a = B.fit(rows.withColumn("w", half), ["a", "b"], B.squared(), cut, weight="w", rounds=3, depth=2).predict(rows)
    b = B.fit(rows.filter(half == 1), ["a", "b"], B.squared(), cut, rounds=3, depth=2).predict(rows)
    assert a.join(b.select("id", F.col("yhat").alias("z")), "id").agg(F.max(F.abs(F.col("yhat") - F.col("z")))).first()[0] < 1e-9


def test_weights_count_as_repeats(rows, cut):
    twice = rows.withColumn("w", F.when(F.col("a") > 4, 2).otherwise(1))
    a = B.fit(twice, ["b"], B.squared(), cut, weight="w", rounds=1, depth=1, least=1).predict(rows)
    b = B.fit(twice.select("*", F.explode(F.sequence(F.lit(1), "w"))), ["b"], B.squared(), cut, rounds=1, depth=1, least=1).predict(rows)
    assert a.join(b.select("id", F.col("yhat").alias("z")), "id").agg(F.max(F.abs(F.col("yhat") - F.col("z")))).first()[0] < 1e-9


def test_quantiles_cover_and_ascend(spark, rows, cut):
    data = cut(rows.withColumn("y", F.col("a") * 10 + F.col("noise") / 10))
    out = B.fit(data.filter("id % 3 > 0"), ["a", "b"], B.quantile((0.1, 0.5, 0.9)), cut, rounds=8, depth=3, step=0.5).predict(data.filter("id % 3 = 0"))
    assert out.filter("q10 > q50 or q50 > q90 or q10 is null").count() == 0
    said = out.agg(*(F.avg((F.col("y") <= F.col(c)).cast("double")) for c in ("q10", "q50", "q90"))).first()
    assert all(abs(s - q) < 0.05 for s, q in zip(said, (0.1, 0.5, 0.9), strict=True))
    # the level moves with a: a constant would not cover each half
    low = out.filter("a < 3").agg(F.avg((F.col("y") <= F.col("q90")).cast("double"))).first()[0]
    assert 0.8 < low < 0.97


def test_tweedie_first_step_and_deviance(spark, cut):
    data = [(float(x), 0.0 if i % 3 else 2.0 + 6.0 * x) for x in (0, 1) for i in range(60)]
    df = spark.createDataFrame(data, "x double, y double")
    model = B.fit(df, ["x"], B.tweedie(1.3), cut, rounds=12, depth=1, step=0.3, least=1, l2=0.0)
    mean = sum(y for _, y in data) / len(data)
    f = math.log(mean)
    for x in (0.0, 1.0):
        ys = [y for v, y in data if v == x]
        g = sum(y * math.exp(-0.3 * f) - math.exp(0.7 * f) for y in ys)
        h = sum(0.3 * y * math.exp(-0.3 * f) + 0.7 * math.exp(0.7 * f) for y in ys)
        got = model.predict(df.filter(F.col("x") == x), trees=1).first()["yhat"]
        assert got == pytest.approx(math.exp(f + 0.3 * g / h))
    falls = [model.predict(df, trees=k).agg(B.tweedie_deviance("y", "yhat", 1.3)).first()[0] for k in (0, 1, 4, 12)]
    assert falls == sorted(falls, reverse=True) and falls[0] > falls[-1]
    assert model.predict(df.filter("x = 1")).first()["yhat"] == pytest.approx(8 / 3, rel=0.1)


def test_logistic(rows, cut):
    out = B.fit(rows.withColumn("y", (F.col("a") > 4).cast("int")), ["a"], B.logistic(), cut, by=("g",), rounds=6, depth=1, step=0.5).predict(rows)
    assert out.filter("a > 4 and yhat < 0.7 or a <= 4 and yhat > 0.3").count() == 0


def test_edge_cases(spark, rows, cut):
    odd = spark.createDataFrame([(1, None, 2.0, "k"), (1, float("nan"), 4.0, "k"), (1, 1.0, None, "k"), (None, 1.0, 1.0, "k")], "g int, a double, y double, extra string")
    model = B.fit(odd, ["a"], B.squared(), cut, by=("g",), rounds=1, depth=2)
    got = model.predict(odd.unionByName(spark.createDataFrame([(9, 1.0, 1.0, "k")], odd.schema)))
    assert got.columns == ["g", "a", "y", "extra", "yhat"]
    assert sorted((r["g"] or 0, r["yhat"] or -1) for r in got.collect()) == [(0, -1), (1, 3.0), (1, 3.0), (1, 3.0), (9, -1)]
    none = B.fit(rows.limit(0), ["a"], B.squared(), cut, rounds=1, depth=1).predict(rows)
    assert none.count() == rows.count() and none.filter("yhat is not null").count() == 0
    with pytest.raises(ValueError, match="weights"):
        B.fit(rows, ["a"], B.quantile(), cut, weight="noise")
