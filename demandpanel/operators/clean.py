"""Daily grain, cleaning flags, filters and samples."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandpanel.config import KEYS, Config
from demandpanel.functions.columns import flag, key_hash
from demandpanel.operators.ranks import exact_quantiles


def daily_grain(df: DataFrame, keys=KEYS, date_col: str = "date", qty: str = "sales", to: str = "saleqty") -> DataFrame:
    """One row per series and day, keys as strings, quantities summed. Partial sums are made before the shuffle."""
    return df.groupBy(*(F.col(k).cast("string").alias(k) for k in keys), F.col(date_col).cast("date").alias("date")).agg(F.sum(qty).cast("long").alias(to))


def positive_quantile(df: DataFrame, p: float, qty: str = "saleqty", exact: bool = False) -> DataFrame:
    """One row ``q``: the quantile of the positive quantities, from a sketch or exactly."""
    x = F.when(F.col(qty) > 0, F.col(qty))
    if exact:
        return exact_quantiles(df, x, [p], linear=False).select(F.get("q", F.lit(0)).alias("q"))
    return df.agg(F.percentile_approx(x, p, 10_000).alias("q"))


def clean(df: DataFrame, cfg: Config, qty: str = "saleqty", exact: bool = False) -> DataFrame:
    """Clips returns and flags disruption days, panic spikes (beyond the positive quantile) and extreme values."""
    q, d = F.col(qty), F.col("date")
    in_period = d.between(*cfg.disruption)
    top = positive_quantile(df, cfg.panic_quantile, qty, exact).scalar()
    return df.select(
        *(c for c in df.columns if c != qty),
        q.alias("sales_raw"),
        F.greatest(q, F.lit(0)).cast("long").alias("sales_clean"),
        flag(q < 0).alias("was_negative"),
        flag(in_period).alias("is_covid_period"),
        flag(in_period & (q > top)).alias("is_covid_panic_spike"),
        flag(q > cfg.extreme).alias("is_extreme_spike"),
    )


def iqr_flag(df: DataFrame, k: float = 3.0, keys=KEYS, qty: str = "sales_clean") -> DataFrame:
    """Flags quantities above the series' third quartile plus k quartile ranges (linear quartiles)."""
    bounds = df.groupBy(*keys).agg(F.percentile(qty, F.array(F.lit(0.25), F.lit(0.75))).alias("_q"))
    limit = F.col("_q")[1] + F.lit(k) * (F.col("_q")[1] - F.col("_q")[0])
    return df.join(bounds, list(keys)).withColumn("is_iqr_outlier", flag(F.col(qty) > limit)).drop("_q")


def trim_outliers(df: DataFrame, p: float = 0.995, y: str = "y") -> DataFrame:
    """Rows up to the p-quantile of y (linear)."""
    return df.filter(F.col(y) <= exact_quantiles(df, F.col(y), [p]).select(F.get("q", F.lit(0))).scalar())


def join_sku_attr(df: DataFrame, attr: DataFrame, key: str = "sku_id", column: str = "local_imported_attribute") -> DataFrame:
    """``is_local`` (L, LI) and ``is_imported`` (I, LI) of the SKU, 0 where it has no attribute."""
    kind = F.upper(F.trim(F.col(column)))
    small = attr.groupBy(F.col(key).cast("string").alias("_key")).agg(F.max(flag(kind.isin("L", "LI"))).alias("is_local"), F.max(flag(kind.isin("I", "LI"))).alias("is_imported"))
    return df.join(small, F.col(key) == F.col("_key"), "left").drop("_key").fillna(0, ["is_local", "is_imported"])


def fill_features(df: DataFrame, columns: list[str], sentinels: dict[str, float] | None = None) -> DataFrame:
    """Nulls become 0, or the column's sentinel; columns that are absent are added so."""
    fill = dict.fromkeys(columns, 0) | (sentinels or {})
    there = {c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType)) for c, v in fill.items() if c in df.columns}
    absent = {c: F.lit(float(v)) for c, v in fill.items() if c not in df.columns}
    return df.withColumns(there | absent)


def hash_sample(df: DataFrame, keys=KEYS, n: int = 10, k: int = 1) -> DataFrame:
    """The series whose hash falls into k of n parts: whole series, the same ones each time."""
    return df.filter(F.pmod(key_hash(*keys), F.lit(n)) < k)


def top_skus(df: DataFrame, n: int, key: str = "sku_id") -> DataFrame:
    """Rows of the n SKUs with most rows; ties go to the smaller key."""
    best = df.groupBy(key).count().orderBy(F.desc("count"), key).limit(n).select(key)
    return df.join(F.broadcast(best) if n <= 100_000 else best, key, "left_semi")


def sku_sample(df: DataFrame, fraction: float, seed: int = 42, key: str = "sku_id") -> DataFrame:
    """Rows of a random share of the SKUs."""
    return df.filter(F.pmod(key_hash(F.lit(str(seed)), key), F.lit(1_000_000)) < int(fraction * 1_000_000))


def exclude_t0(df: DataFrame) -> DataFrame:
    """Training leaves out series that never sold or went dormant."""
    return df.filter(F.col("tier_name") != "T0_EXCLUDED")


# Feature sets by tier; a tier without an entry takes the first.
FEATURE_SETS = {
    "T1_MATURE": ["dow", "week_of_year", "month", "is_weekend", "lag_1", "lag_7", "lag_14", "lag_28", "lag_56", "roll_mean_7", "roll_mean_28", "roll_std_28", "nz_rate_7", "nz_rate_28", "days_since_last_sale_asof", "zero_run_length_asof", "last_sale_qty_asof"],
    "T2_GROWING": ["dow", "week_of_year", "month", "is_weekend", "lag_1", "lag_7", "lag_14", "lag_28", "roll_mean_7", "roll_mean_28", "nz_rate_7", "nz_rate_28", "days_since_last_sale_asof", "zero_run_length_asof"],
    "T3_COLD_START": ["dow", "week_of_year", "month", "is_weekend", "lag_1", "lag_7", "roll_mean_7", "nz_rate_7", "days_since_last_sale_asof"],
}


def feature_set(df: DataFrame, tier: str, keep=(*KEYS, "date")) -> DataFrame:
    """Keys and the tier's features, as far as the table has them."""
    names = FEATURE_SETS.get(tier, FEATURE_SETS["T1_MATURE"])
    return df.select(*keep, *(c for c in names if c in df.columns))


def trend_idx(df: DataFrame, origin: date) -> DataFrame:
    return df.withColumn("trend_idx", F.datediff("date", F.lit(origin)))


def sample_weights(df: DataFrame, cfg: Config, decay: float = 0.002, disruption_weight: float = 0.25) -> DataFrame:
    """Recent days weigh more, by exp(-decay * days before the last day); disruption days a quarter."""
    last = df.agg(F.max("date")).scalar()
    weight = F.exp(F.lit(-decay) * F.datediff(last, F.col("date")))
    return df.withColumn("sample_weight", weight * F.when(F.col("date").between(*cfg.disruption), disruption_weight).otherwise(1.0))


def share_by(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Sum of a value by group and its share of the total."""
    sums = df.groupBy(*by).agg(F.sum(value).alias(value))
    return sums.withColumn("share", F.try_divide(F.col(value).cast("double"), F.sum(value).over(Window.partitionBy())))
