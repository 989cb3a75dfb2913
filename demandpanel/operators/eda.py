"""Exploratory summaries of a panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandpanel.config import KEYS
from demandpanel.functions.columns import flag, ratio
from demandpanel.operators.ranks import exact_quantiles
from demandpanel.operators.stats import abc


def density(facts: DataFrame, y: str = "sales_clean") -> DataFrame:
    """Observed rows over stores x SKUs x days, and the share of zeros among them."""
    cells = F.count_distinct("store_id") * F.count_distinct("sku_id") * (F.datediff(F.max("date"), F.min("date")) + 1)
    return facts.agg(F.count("*").alias("n_rows"), cells.alias("n_cells"), ratio(F.count("*"), cells).alias("density"), F.avg(flag(F.col(y) == 0).cast("double")).alias("zero_rate"))


def sales_percentiles(facts: DataFrame, ps=(0.5, 0.9, 0.95, 0.99), y: str = "sales_clean") -> DataFrame:
    got = exact_quantiles(facts, F.col(y), list(ps)).withColumnRenamed("q", "_q")
    return got.select(F.explode(F.arrays_zip(F.array(*(F.lit(p) for p in ps)).alias("percentile"), F.col("_q").alias("value"))).alias("x")).select("x.percentile", "x.value")


def profile(df: DataFrame, by, y: str = "y") -> DataFrame:
    """Average, total and share of zeros by any time attribute."""
    return df.groupBy(by).agg(F.avg(y).alias("avg_sales"), F.sum(y).alias("total_sales"), F.avg(flag(F.col(y) == 0).cast("double")).alias("zero_rate"))


def time_profiles(df: DataFrame, y: str = "y") -> DataFrame:
    """:func:`profile` by weekday, month, year and week, in one pass: ``attribute``, ``value``."""
    d = F.col("date")
    each = F.explode(F.map_from_arrays(F.array(*(F.lit(x) for x in ("dow", "month", "year", "week"))), F.array(F.dayofweek(d), F.month(d), F.year(d), F.weekofyear(d)))).alias("attribute", "value")
    sums = df.groupBy("date").agg(F.sum(y).alias("_s"), F.count("*").alias("_n"), F.sum(flag(F.col(y) == 0)).alias("_z")).select("_s", "_n", "_z", each)
    return sums.groupBy("attribute", "value").agg(ratio(F.sum("_s"), F.sum("_n")).alias("avg_sales"), F.sum("_s").alias("total_sales"), ratio(F.sum("_z"), F.sum("_n")).alias("zero_rate"))


def seasonal_profile(df: DataFrame, y: str = "y") -> DataFrame:
    """December's mean over the mean of the other months."""
    december = F.month("date") == 12
    return df.agg(F.avg(F.when(december, F.col(y))).alias("december_avg"), F.avg(F.when(~december, F.col(y))).alias("other_avg")).withColumn("december_lift", ratio(F.col("december_avg"), F.col("other_avg")))


def zero_rate_histogram(df: DataFrame, bins: int = 10, y: str = "y") -> DataFrame:
    rates = df.groupBy(*KEYS).agg(F.avg(flag(F.col(y) == 0).cast("double")).alias("r"))
    return rates.groupBy(F.least(F.floor(F.col("r") * bins), F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count("*").alias("n_series"))


def weekly_trend(df: DataFrame, y: str = "y") -> DataFrame:
    return df.groupBy(F.trunc("date", "week").alias("week")).agg(F.sum(y).alias("total_sales"), F.count_distinct(F.when(F.col(y) > 0, F.struct(*KEYS))).alias("active_series"))


def store_profile(df: DataFrame, clusters: int = 4, y: str = "y") -> DataFrame:
    """Totals by store and its cluster, a quarter of the stores by average sales. There is one row per store."""
    out = df.groupBy("store_id").agg(F.sum(y).alias("total_sales"), F.avg(y).alias("avg_sales"), F.avg(flag(F.col(y) == 0).cast("double")).alias("zero_rate"))
    return out.withColumn("cluster", F.ntile(clusters).over(Window.orderBy(F.desc("avg_sales"), "store_id")))


def sku_profile(df: DataFrame, k: int = 20, y: str = "y") -> DataFrame:
    """The k SKUs with most sales, and whether their second half sells more than their first."""
    w = Window.partitionBy("sku_id")
    middle = F.date_add(F.min("date").over(w), F.floor(F.datediff(F.max("date").over(w), F.min("date").over(w)) / 2).cast("int"))
    rows = df.groupBy("sku_id", "date").agg(F.sum(y).alias("s")).withColumn("_late", F.col("date") > middle)
    out = rows.groupBy("sku_id").agg(F.sum("s").alias("total_sales"), F.sum(F.when(F.col("_late"), F.col("s")).otherwise(0)).alias("late"), F.sum(F.when(~F.col("_late"), F.col("s")).otherwise(0)).alias("early"))
    trend = F.when(F.col("late") > 1.1 * F.col("early"), "GROWING").when(F.col("late") < 0.9 * F.col("early"), "DECLINING").otherwise("STABLE")
    return out.withColumn("trend", trend).orderBy(F.desc("total_sales"), "sku_id").limit(k)


def pareto(df: DataFrame, shares=(0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0), y: str = "y") -> DataFrame:
    """How many SKUs, largest first, reach each share of all sales."""
    ranked = abc(df, ("sku_id",), y)
    each = ranked.withColumn("share", F.explode(F.array(*(F.lit(s) for s in shares))))
    short = F.count_if(F.col("cum_share") < F.col("share") - 1e-12)
    return each.groupBy("share").agg(F.least(short + 1, F.count("*")).alias("n_skus"), F.count("*").alias("all_skus"))


def sale_prob_by_dormancy(features: DataFrame, y: str = "y") -> DataFrame:
    return features.groupBy("dormancy_bucket").agg(F.count("*").alias("n_rows"), F.avg(flag(F.col(y) > 0).cast("double")).alias("sale_prob"), F.avg(F.when(F.col(y) > 0, F.col(y))).alias("avg_qty"))


def closure_impact(df: DataFrame, days: int = 3, y: str = "y") -> DataFrame:
    """Average sales before, after and away from closures."""
    to, since = F.col("days_to_next_closure"), F.col("days_from_prev_closure")
    kind = F.when((to == 0) | (since == 0), "closed").when(to <= days, "pre_closure").when(since <= days, "post_closure").otherwise("normal")
    return df.groupBy(kind.alias("period")).agg(F.count("*").alias("n_rows"), F.avg(y).alias("avg_sales"))


def spike_months(df: DataFrame) -> DataFrame:
    return df.groupBy(F.year("date").alias("year"), F.month("date").alias("month")).agg(F.sum("is_spike").alias("n_spikes"), F.avg("is_spike").alias("spike_rate"))


def promo_weeks(df: DataFrame) -> DataFrame:
    """Weeks in which an SKU spikes on a promotion day."""
    hit = (F.col("is_spike") == 1) & (F.col("is_promo_day") == 1)
    return df.groupBy("sku_id").agg(F.count_distinct(F.when(hit, F.trunc("date", "week"))).alias("promo_weeks"))


def store_dow_matrix(df: DataFrame, y: str = "y") -> DataFrame:
    return df.groupBy("store_id").pivot("dow", list(range(1, 8))).agg(F.avg(y)).withColumnsRenamed({str(i): f"dow_{i}" for i in range(1, 8)})


def seasonality_cv(df: DataFrame, y: str = "y") -> DataFrame:
    """Variation of a store's monthly sales."""
    monthly = df.groupBy("store_id", F.year("date").alias("year"), F.month("date").alias("month")).agg(F.sum(y).alias("s"))
    return monthly.groupBy("store_id").agg(ratio(F.stddev_pop("s"), F.avg("s")).alias("seasonality_cv"))


def new_skus(df: DataFrame) -> DataFrame:
    return df.groupBy("sku_id").agg(F.year(F.min("date")).alias("year")).groupBy("year").agg(F.count("*").alias("new_skus"))


def distinct_when(df: DataFrame, columns: list[str], condition, by: list[str]) -> DataFrame:
    """Distinct combinations of columns among the rows that meet a condition."""
    return df.groupBy(*by).agg(F.count_distinct(F.when(condition, F.struct(*columns))).alias("n_distinct"))


def top_k(df: DataFrame, by: str, k: int, ties: list[str]) -> DataFrame:
    return df.orderBy(F.desc(by), *ties).limit(k)


def top_groups(df: DataFrame, key: str, value: str, k: int) -> DataFrame:
    return df.groupBy(key).agg(F.sum(value).alias(value)).orderBy(F.desc(value), key).limit(k)
