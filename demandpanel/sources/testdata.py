"""Sales facts from the driver's star schema: returns are negative sales."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandpanel.config import KEYS, Config
from demandpanel.operators.clean import clean, daily_grain
from demandpanel.operators.panel import dense_panel
from demandpanel.operators.stats import year_folds

CFG = Config(data_start=date(1995, 1, 2), data_end=date(2001, 11, 4), disruption=(date(1998, 3, 15), date(1999, 6, 30)), extreme=60, closure_years=(1995, 2002), folds=year_folds(None, date(2001, 11, 4)))

#: The default grain. Both suppliers and lines grow with the tables, so series and panel rows do too.
STORE, SKU = "s_suppkey", "p_type"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sales(spark: SparkSession, sf_dir: str, store: str = STORE, sku: str = SKU) -> DataFrame:
    """``store_id`` (supplier, nation or region), ``sku_id`` (type, brand or part), ``date`` and ``sales``."""
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_quantity", "l_returnflag", "l_shipdate")
    # nations and regions after the suppliers: Spark takes a join to be as large as the product of its sides, so it would shuffle all
    # lines rather than broadcast a table of suppliers with their nations
    rows = lines.join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    rows = rows.join(F.broadcast(table(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey")).join(F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = rows.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    quantity = F.col("l_quantity").cast("long")
    return rows.select(F.col(store).cast("string").alias("store_id"), F.col(sku).cast("string").alias("sku_id"), F.to_date("l_shipdate").alias("date"), F.when(F.col("l_returnflag") == "R", -quantity).otherwise(quantity).alias("sales"))


#: Lines of a partition of the panel. At the default grain a line fills some 25 days, so that is about 250,000 rows to sort: tens of MB for
#: each of the sorts that a task holds at once, which no usual share of an executor's memory makes spill.
LINES = 10_000


#: Lines of a partition of facts that become spans, some three rows of each to sort. Each sort of a task takes a page of memory of up to 64 MB, however few
#: its rows, so smaller partitions cost more.
SPAN_LINES = 50_000


def partitions(spark: SparkSession, sf_dir: str, lines: int | None = None) -> int:
    """Lines are counted from the files' footers."""
    return table(spark, sf_dir, "lineitem").count() // (lines or LINES) + 1


def facts(spark: SparkSession, sf_dir: str, store: str = STORE, sku: str = SKU, exact: bool = True, by=None, lines: int | None = None) -> DataFrame:
    """Quantiles exact, as the queries' SQL has them, unless told; the library's own default is a sketch.

    Suppliers' lines hardly combine to days, so they are dealt by series (or ``by``) before they are summed: that one shuffle serves
    daily sums, quantile and panel, and a task's sums are of some ``LINES`` lines whatever the tables' size. Lines of nations
    and regions do combine, and are summed before they move.
    """
    rows = sales(spark, sf_dir, store, sku)
    if store == STORE:
        rows = rows.repartition(partitions(spark, sf_dir, lines), *(by or KEYS))
    return clean(daily_grain(rows), CFG, exact=exact)


def panel(spark: SparkSession, sf_dir: str, store: str = STORE, sku: str = SKU, since: date | None = None, by=None, until: date | None = None) -> DataFrame:
    """The dense panel up to ``until``, by default all of it, with ``y`` the filled sales; ``since`` and ``by`` as in :func:`dense_panel`."""
    parts = None if store == STORE else partitions(spark, sf_dir)
    return dense_panel(facts(spark, sf_dir, store, sku, by=by), until or CFG.data_end, since=since, parts=parts, by=by).withColumn("y", F.col("sales_filled"))


def days(spark: SparkSession, sf_dir: str, store: str = STORE, sku: str = SKU, by=None) -> DataFrame:
    """The days with a fact, with ``y`` the clean sales, in partitions of ``SPAN_LINES``."""
    out = facts(spark, sf_dir, store, sku, by=by, lines=SPAN_LINES).select(*KEYS, "date", F.col("sales_clean").alias("y"))
    return out if store == STORE else out.repartition(partitions(spark, sf_dir, SPAN_LINES), *(by or KEYS))
