"""Sources, sinks and the stream."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from demandpanel.operators.clean import join_sku_attr
from demandpanel.sources import io as S
from demandpanel.streaming.daily import daily_grain_stream


def test_csv_round_trip(spark, tmp_path):
    (tmp_path / "a.csv").write_text('store_id,item_id,date,sales\n201,"x\ny",2024-01-01,5\n')
    assert [tuple(r) for r in S.read_sales_csv(spark, str(tmp_path / "a.csv")).collect()] == [("201", "x\ny", date(2024, 1, 1), 5)]
    df = spark.createDataFrame([("s", "k", date(2024, 1, 1), 1.239, "T1", "VAL", "F1")], "store_id string, sku_id string, date date, yhat double, tier_name string, split_role string, fold_id string")
    S.export_forecast(df, str(tmp_path / "fc"))
    assert [tuple(r) for r in spark.read.csv(str(tmp_path / "fc"), header=True).collect()] == [("k", "s", "2024-01-01", "1.24")]
    S.write_panel(df, str(tmp_path / "panel"))
    assert spark.read.parquet(str(tmp_path / "panel")).select("month").first()[0] in ("2024-01", date(2024, 1, 1))
    for _ in range(2):
        S.append_predictions(df, str(tmp_path / "pred"))
    assert S.read_shards(spark, str(tmp_path / "pred")).count() == 2
    S.write_split(df, str(tmp_path / "split"))
    S.export_by_tier(df, str(tmp_path / "tier"))
    S.write_report(df, str(tmp_path / "report"))
    assert [tuple(r) for r in spark.read.csv(f"{tmp_path}/tier/tier_name=T1", header=True).select("store_id", "sku_id", "date", "yhat").collect()] == [("s", "k", "2024-01-01", "1.239")]
    assert spark.read.parquet(f"{tmp_path}/split/split_role=VAL").count() == spark.read.json(str(tmp_path / "report")).count() == 1


def test_sku_attributes(spark, tmp_path):
    (tmp_path / "attr.csv").write_text('sku_id,local_imported_attribute\n11," li"\n12,I\n13,\n')
    attr = S.read_sku_attr(spark, str(tmp_path / "attr.csv"))
    assert [tuple(r) for r in attr.orderBy("sku_id").collect()] == [(11, " li"), (12, "I"), (13, None)]
    facts = spark.createDataFrame([("11",), ("12",), ("13",), ("14",)], "sku_id string")
    got = {tuple(r) for r in join_sku_attr(facts, attr).select("sku_id", "is_local", "is_imported").collect()}
    assert got == {("11", 1, 1), ("12", 0, 1), ("13", 0, 0), ("14", 0, 0)}


def test_missing_columns(spark):
    with pytest.raises(ValueError, match="sales"):
        S.normalise_schema(spark.createDataFrame([("a",)], " Store_ID string"), ("store_id", "sales"))


def test_daily_stream(spark, tmp_path):
    day = lambda d, h, q: ("s", "k", datetime(2024, 1, d, h), q)
    schema = "store_id string, sku_id string, ts timestamp, sales long"
    for i, part in enumerate(([day(1, 1, 5), day(1, 9, 2), day(2, 3, 4)], [day(9, 0, 1)])):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / f"p{i}"))
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = daily_grain_stream(stream).writeStream.format("memory").queryName("daily").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).start()
    query.processAllAvailable()
    query.stop()
    assert sorted(tuple(r) for r in spark.table("daily").collect()) == [("s", "k", date(2024, 1, 1), 7), ("s", "k", date(2024, 1, 2), 4)]


ROWS = "sku_id string, yhat double, fold_id string"


def test_publishing_twice_is_publishing_once(spark, tmp_path):
    path = str(tmp_path / "pred")
    schema = spark.createDataFrame([], ROWS).schema
    assert S.published(spark, path, schema).count() == 0
    first, second = (spark.createDataFrame(r, ROWS) for r in ([("a", 1.0, "F1"), ("b", 2.0, "F2")], [("a", 3.0, "F1")]))
    for _ in range(2):
        S.publish(first, path, "r1")
    S.publish(second, path, "r2")
    shown = lambda: sorted(tuple(r) for r in S.published(spark, path, schema).select("sku_id", "yhat", "fold_id", "run_id").collect())
    both = [("a", 1.0, "F1", "r1"), ("a", 3.0, "F1", "r2"), ("b", 2.0, "F2", "r1")]
    assert shown() == both
    # a run that fails while it writes shows nothing, and leaves the other run alone; the next one replaces what it left
    bad = first.withColumn("yhat", F.when(F.col("sku_id") == "b", F.raise_error(F.lit("killed"))).otherwise(F.col("yhat")).cast("double"))
    with pytest.raises(Exception, match="killed"):
        S.publish(bad, path, "r1")
    assert shown() == both[1:2]
    S.publish(first, path, "r1")
    assert shown() == both
    # rows without a commit, and a commit that was not finished, are not shown
    first.write.partitionBy("fold_id").parquet(f"{path}/rows/run_id=r3")
    (tmp_path / "pred" / "commits" / "run_id=r3").mkdir()
    assert shown() == both
    with pytest.raises(ValueError, match="run id"):
        S.publish(first, path, "../x")
