"""Sources and sinks."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandpanel.config import KEYS
from demandpanel.functions.columns import key_hash

SALES = T.StructType([T.StructField("store_id", T.StringType()), T.StructField("item_id", T.StringType()), T.StructField("date", T.DateType()), T.StructField("sales", T.LongType())])
SKU_ATTR = T.StructType([T.StructField("sku_id", T.LongType()), T.StructField("local_imported_attribute", T.StringType())])


def read_sales_csv(spark: SparkSession, path: str) -> DataFrame:
    """Sales from a CSV file, or a folder of them, with header and quoted line breaks."""
    return spark.read.csv(path, header=True, multiLine=True, schema=SALES)


def read_sku_attr(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, multiLine=True, schema=SKU_ATTR)


def read_shards(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """All shards of a folder as one table; without a schema CSV columns are strings."""
    reader = spark.read.format(fmt).option("header", True)
    return (reader.schema(schema) if schema else reader).load(path)


def write_split(df: DataFrame, path: str) -> None:
    """One folder for TRAIN and one for VAL."""
    df.write.mode("overwrite").partitionBy("split_role").parquet(path)


def write_panel(df: DataFrame, path: str) -> None:
    """By month, sorted by series within each file, so that readers prune both by date and by series."""
    out = df.withColumn("month", F.date_format("date", "yyyy-MM"))
    # a month is dealt to 16 tasks by series: no task holds a whole month
    out.repartition("month", F.pmod(F.xxhash64(*KEYS), F.lit(16))).sortWithinPartitions("month", *KEYS, "date").write.mode("overwrite").partitionBy("month").parquet(path)


def register_views(views: dict[str, DataFrame]) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def append_predictions(df: DataFrame, path: str) -> None:
    df.write.mode("append").partitionBy("fold_id").parquet(path)


def publish(df: DataFrame, path: str, run_id: str, by: str = "fold_id") -> None:
    """Writes a run's rows so that the job may be repeated: the run's own folder is replaced, and its commit row follows only
    once all rows are there. A job that was killed leaves rows that :func:`published` does not show; its next run replaces them.

    While a run is written again its commit row is away, so readers see the old rows, then none, then the new ones, never a
    part of both. Runs do not touch each other. An empty table is a run of no rows.
    """
    if not re.fullmatch(r"[\w.-]+", run_id):
        raise ValueError("a run id has letters, digits, '.', '_' and '-'")
    spark = df.sparkSession
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/commits/run_id={run_id}")
    mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(mark, True)
    df.drop("run_id").write.mode("overwrite").partitionBy(by).parquet(f"{path}/rows/run_id={run_id}")
    spark.range(1).select(F.current_timestamp().alias("committed_at")).coalesce(1).write.mode("overwrite").parquet(f"{path}/commits/run_id={run_id}")


def published(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of committed runs, with ``run_id``. Spark writes a commit's ``_SUCCESS`` last, so only folders that have it count; the
    runs that are read are named to the scan, which reads no other folder."""
    jvm = spark.sparkContext._jvm
    marks = jvm.org.apache.hadoop.fs.Path(f"{path}/commits/run_id=*/_SUCCESS")
    found = marks.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(marks)
    runs = sorted(s.getPath().getParent().getName() for s in found or [])
    full = T.StructType([*(f for f in schema.fields if f.name != "run_id"), T.StructField("run_id", T.StringType())])
    if not runs:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", f"{path}/rows").parquet(*(f"{path}/rows/{r}" for r in runs))


def forecast_rows(df: DataFrame, yhat: str = "yhat") -> DataFrame:
    """The exported columns: item_id, store_id, ISO date and forecast of two decimals."""
    return df.select(F.col("sku_id").alias("item_id"), "store_id", F.date_format("date", "yyyy-MM-dd").alias("date"), F.round(yhat, 2).alias("predicted_sales"))


def export_forecast(df: DataFrame, path: str, yhat: str = "yhat") -> None:
    forecast_rows(df, yhat).write.mode("overwrite").csv(path, header=True)


def export_by_tier(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").partitionBy("tier_name").csv(path, header=True)


def forecast_extracts(df: DataFrame, yhat: str = "yhat") -> dict[str, DataFrame]:
    """The delivered aggregates of a forecast; ``sample`` is a thousandth of the series."""
    total, week = F.sum(yhat).alias("predicted_sales"), F.trunc("date", "week").alias("week")
    a_items = df.filter("abc = 'A'")
    return {
        "weekly_store": df.groupBy("store_id", week).agg(total),
        "weekly_total": df.groupBy(week).agg(total),
        "daily_store": df.groupBy("store_id", "date").agg(total),
        "weekly_sku": df.groupBy("sku_id", week).agg(total),
        "a_items_daily": a_items.groupBy("date").agg(total),
        "a_items": a_items.select(*KEYS).distinct(),
        "sample": df.filter(F.pmod(key_hash(*KEYS), F.lit(1000)) == 0),
    }


def write_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def normalise_schema(df: DataFrame, required=("store_id", "sku_id", "date", "sales"), rename: dict[str, str] | None = None) -> DataFrame:
    """Lower-cases and trims column names, renames them (item_id to sku_id), and demands the required ones."""
    rename = {"item_id": "sku_id"} | (rename or {})
    names = [c.strip().lower() for c in df.columns]
    out = df.toDF(*(rename.get(c, c) for c in names))
    if missing := sorted(set(required) - set(out.columns)):
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return out
