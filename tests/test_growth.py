"""Steps whose work must grow no faster than the input: results as before, on fewer rows, shuffles and partitions."""

import re
from datetime import date, timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as entry
from demandpanel.config import KEYS
from demandpanel.operators import boosting as B
from demandpanel.operators import models as ML
from demandpanel.operators import windows as W
from demandpanel.operators.panel import audit_lag1, dense_panel, join_days
from demandpanel.sources import testdata as T

SF = "/root/testdata/sf0.001"
END = date(2001, 11, 4)


def test_panel_partitions_follow_the_lines(spark, monkeypatch):
    monkeypatch.setattr(T, "LINES", 500)  # 6,000 lines
    df = W.lags(T.panel(spark, SF), (1,))
    assert df.rdd.getNumPartitions() == 13  # whatever the size of the facts' shuffle


def test_since_keeps_features_of_later_days(spark):
    facts, since = T.facts(spark, SF), date(2001, 1, 1)

    def features(**how):
        df = dense_panel(facts, END, **how).withColumn("y", F.col("sales_filled"))
        df = W.recency(W.roll_mean_pos(W.nz_rate(W.rolling(W.lags(df)))))
        return df.filter(F.col("date") >= F.lit(since + timedelta(56)))

    whole, part = features(), features(since=since)
    assert part.count() == whole.count() > 0
    assert whole.exceptAll(part).count() == 0
    assert dense_panel(facts, END, since=since).count() < dense_panel(facts, END).count() / 2


def test_whole_numbers_roll_by_running_sums(spark):
    days = [("a", "x", date(2024, 1, 1) + timedelta(k), v) for k, v in enumerate([5, 0, None, -2, 3, 0, 0, 9, None, None, None, 1])]
    df = spark.createDataFrame(days, "store_id string, sku_id string, date date, y long")
    got = W.roll_mean_pos(W.nz_rate(W.rolling(df, (3,)), (3,)), (3,))
    frame = Window.partitionBy(*KEYS).orderBy("date").rowsBetween(-3, -1)
    sold = F.when(F.col("y") > 0, F.col("y"))
    want = df.withColumns({"roll_mean_3": F.avg("y").over(frame), "roll_sum_3": F.sum("y").over(frame), "nz_rate_3": F.avg(F.when(F.col("y") > 0, 1.0).otherwise(0.0)).over(frame), "roll_mean_pos_3": F.avg(sold).over(frame)})
    assert got.orderBy("date").collect() == want.select(got.columns).orderBy("date").collect()
    assert "ROWS BETWEEN -3" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_equal_training_rows_are_passed_once(spark):
    rows = [(float(i % 3), float(i % 2)) for i in range(600)]
    counted = ML._counted(spark.createDataFrame(rows, "x double, _sold double"), ["x", "_sold"])
    assert counted.count() == 6 and counted.agg(F.sum("_n")).first()[0] == 600.0


def test_counted_rows_fit_the_same_model(spark):
    rows = [(float(i % 5), float(i % 7), 0 if i % 5 < 3 else i % 7) for i in range(3500)]
    df = spark.createDataFrame(rows, "a double, b double, y long")
    m = ML.fit_two_stage(df, ["a", "b"], trees=3, depth=3)
    got = m.transform(df).agg(F.avg("p"), F.avg(F.when(F.col("y") > 0, F.abs(F.col("qty") - F.col("y"))))).first()
    assert abs(got[0] - sum(r[2] > 0 for r in rows) / len(rows)) < 1e-6 and got[1] < 1e-6


def test_days_join_by_key_alone(spark):
    day = lambda k: date(2024, 1, 1) + timedelta(k)
    rows = spark.createDataFrame([(s, "x", day(k)) for s in ("a", "b", "c", None) for k in range(-1, 9)] + [("a", "y", None)], "store_id string, sku_id string, date date")
    days = spark.createDataFrame([(s, day(k), k, None if k == 2 else float(k)) for s in ("a", "b", None) for k in ((0, 2, 7) if s == "a" else (3,))], "store_id string, date date, n int, v double")
    got = join_days(rows, days, "store_id", ["n", "v"])
    want = rows.join(days, ["store_id", "date"], "left").select(got.columns)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count() == 41


def test_store_days_leave_the_panel_where_it_is(spark):
    # the panel is shuffled once, as facts, on each side of the join, and never by date
    df = W.assemble_spikes(W.spike_flag(T.panel(spark, SF, by=("store_id",)).select(*KEYS, "date", "y")), date(2001, 5, 14))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and not re.search(r"Exchange hashpartitioning\(store_id#\d+, (date|sku_id)#", plan)


def test_counted_rows_have_the_deviance_of_all(spark):
    rows = [(float(i % 3), 1.0 + i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "y double, mu double")
    counted = df.groupBy("y", "mu").agg(F.count("*").alias("n"))
    a, b = df.agg(B.tweedie_deviance("y", "mu")).first()[0], counted.agg(B.tweedie_deviance("y", "mu", weight="n")).first()[0]
    assert abs(a - b) < 1e-12


def test_boosting_counts_rows_of_the_same_bins(spark, tmp_path):
    sizes = []

    def cut(df):
        path = f"{tmp_path}/{len(sizes)}"
        df.write.parquet(path)
        out = spark.read.parquet(path)
        sizes.append((out.columns, out.count()))
        return out

    df = spark.createDataFrame([(float(i % 4), i % 2) for i in range(400)], "x double, y int")
    B.fit(df, ["x"], B.squared(), cut, rounds=1, depth=1)
    assert [n for columns, n in sizes if "_b" in columns] == [4]  # 400 before


def test_lines_are_shuffled_once(spark, monkeypatch):
    monkeypatch.setattr(T, "LINES", 500)
    plan = W.lags(T.panel(spark, SF), (1,)).select(*KEYS, "date", "lag_1")._jdf.queryExecution().executedPlan().toString()
    # daily sums and panel had a shuffle each, and suppliers with their nations one or a broadcast of all lines
    assert len(re.findall(r"Exchange (?:hash|Single)", plan)) == 1 and "BuildLeft" not in plan


def test_audit_looks_up_the_day_before_by_its_date(spark):
    day = lambda k: date(2024, 1, 1) + timedelta(k)
    # a gap, a day that is there twice, nulls
    rows = [("a", "x", day(0), 1, None), ("a", "x", day(1), 2, 1), ("a", "x", day(3), 5, 2), ("a", "x", day(4), None, 9), ("a", "x", day(4), 7, 5), ("a", "x", day(5), 0, None), (None, "x", day(0), 1, 1), (None, "x", day(1), 1, 1), ("a", "x", None, 1, 1)]
    df = spark.createDataFrame(rows, "store_id string, sku_id string, date date, y long, lag_1 long")
    before = df.select(*KEYS, F.date_add("date", 1).alias("date"), F.col("y").alias("_before"))
    want = df.join(before, [*KEYS, "date"]).agg(F.count("*"), F.count_if(~F.col("lag_1").eqNullSafe(F.col("_before")))).first()
    assert tuple(audit_lag1(df).first()) == tuple(want) == (5, 2)
    plan = audit_lag1(W.lags(T.panel(spark, SF), (1,)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("explode") == 1  # of one panel, two before


def test_spikes_of_facts_are_those_of_all_days(spark):
    modes = {m: f"is_{m}" for m in ("mult", "ratio", "hist", "inline")}
    facts = T.facts(spark, SF)
    sparse = W.spike_flags(facts.filter(F.col("date") <= F.lit(END)).withColumn("y", F.col("sales_clean")), modes, sparse=True)
    dense = W.spike_flags(dense_panel(facts, END).withColumn("y", F.col("sales_filled")), modes)
    columns = [*KEYS, "date", *modes.values()]
    a, b = (df.filter(" OR ".join(f"{c} = 1" for c in modes.values())).select(columns) for df in (sparse, dense))
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0 < a.count()


def test_last_sale_is_looked_up_once(spark):
    plan = W.recency(T.panel(spark, SF))._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"max\(_w\d+#\d+\) windowspecdefinition", plan)) == 1  # each use had its own


def test_extracts_share_one_forecast(spark):
    plan = entry.queries()["s11_all_extracts"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("explode") == 0  # seven panels before


def test_shares_of_a_store_day_need_no_second_panel(spark):
    """F8: shares from facts are those of the panel, and the spike features hold one panel."""
    want = W.store_day_spikes(W.spike_flag(T.panel(spark, SF, by=("store_id",)).select(*KEYS, "date", "y")))
    got = W.store_days_of_facts(T.facts(spark, SF).withColumn("y", F.col("sales_clean")), T.CFG.data_end)
    assert got.exceptAll(want).count() == 0 and got.count() > 0
    assert want.join(got, ["store_id", "date"], "left_anti").filter("store_spike_pct > 0").count() == 0
    plan = entry.queries()["w26_w29_j8_spike_features"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"sequence\(_from", plan)) == 1
