"""Forecast errors. One pass sums components by group; every metric follows from the sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandpanel.config import KEYS
from demandpanel.functions.columns import flag, ratio

PCT = 100.0


def unpivot(df: DataFrame, preds: list[str], keep: list[str]) -> DataFrame:
    """A row per forecast column: ``model`` and ``yhat``."""
    return df.unpivot(keep, preds, "model", "yhat")


def aggregates(y: str = "y", yhat: str = "yhat", zero_mode: str = "all") -> dict[str, Column]:
    """Metric columns to aggregate. ``zero_mode``: ZeroAcc as share of all rows, or of the rows with no sale."""
    a, p = F.col(y).cast("double"), F.col(yhat).cast("double")
    e = F.abs(a - p)
    wmape = F.when(F.sum(a) != 0, F.lit(PCT) * F.sum(e) / F.sum(a))
    right = (a == 0) & (p < 0.5)
    hit = F.count_if((a > 0) & (p > 0.5))
    precision, recall = ratio(hit, F.count_if(p > 0.5)), ratio(hit, F.count_if(a > 0))
    total = F.sum(F.pow(a, 2)) - F.pow(F.sum(a), 2) / F.count(a)
    return {
        "n": F.count("*"),
        "mae": F.avg(e),
        "wmape": wmape,
        "wfa": F.lit(PCT) - wmape,
        "rmsle": F.sqrt(F.avg(F.pow(F.log1p(a) - F.log1p(F.greatest(p, F.lit(0.0))), 2))),
        "rmse": F.sqrt(F.avg(F.pow(a - p, 2))),
        "mape_nonzero": F.lit(PCT) * F.avg(F.when(a > 0, e / a)),
        "r2": F.lit(1.0) - F.try_divide(F.sum(F.pow(a - p, 2)), total),
        "bias_pct": F.lit(PCT) * ratio(F.sum(p) - F.sum(a), F.sum(a)),
        "bias_ratio": ratio(F.sum(p), F.sum(a)),
        "zero_acc": F.avg(flag(right).cast("double")) if zero_mode == "all" else F.avg(F.when(a == 0, flag(right).cast("double"))),
        "mae_nonzero": F.avg(F.when(a > 0, e)),
        "bias_nonzero": F.avg(F.when(a > 0, p - a)),
        "sale_accuracy": F.avg(flag((a > 0) == (p > 0.5)).cast("double")),
        "precision": precision,
        "recall": recall,
        "f1": ratio(2 * hit, F.count_if(p > 0.5) + F.count_if(a > 0)),
        "within_50": F.lit(PCT) * F.avg(F.when(a >= 2, flag(e <= 0.5 * a).cast("double"))),
        "within_30": F.lit(PCT) * F.avg(F.when(a >= 2, flag(e <= 0.3 * a).cast("double"))),
    }


def metrics(df: DataFrame, preds: list[str], by: tuple[str, ...] = (), which: list[str] | None = None, y: str = "y", zero_mode: str = "all") -> DataFrame:
    """Metrics of each forecast column by group, from one scan and one aggregation."""
    rows = unpivot(df.select(*by, y, *(F.col(p).cast("double").alias(p) for p in preds)), preds, [*by, y])
    every = aggregates(y, "yhat", zero_mode)
    return rows.groupBy("model", *by).agg(*(every[m].alias(m) for m in which or every))


def error_percentiles(df: DataFrame, yhat: str, y: str = "y", by: tuple[str, ...] = (), ps=(0.5, 0.9, 0.99)) -> DataFrame:
    got = df.groupBy(*by).agg(F.percentile(F.abs(F.col(y) - F.col(yhat)), F.array(*(F.lit(p) for p in ps))).alias("_q"))
    return got.select(*by, *(F.col("_q")[i].alias(f"p{round(100 * p)}_error") for i, p in enumerate(ps)))


def accuracy_levels(df: DataFrame, yhat: str, y: str = "y", iso_year: bool = False) -> DataFrame:
    """Accuracy at six levels: day and week by series, week by A series, by SKU, by store, and in total.

    Weeks are (calendar year, ISO week), or with ``iso_year`` ISO years. Daily rows are read and shuffled once, to weekly
    sums by series, which carry the daily errors too; every other level is a sum of these, all in one more shuffle.
    """
    week = [F.year(F.date_add(F.trunc("date", "week"), 3)) if iso_year else F.year("date"), F.weekofyear("date")]
    error = F.abs(F.col(y).cast("double") - F.col(yhat).cast("double"))
    weekly = df.groupBy(*KEYS, "abc", week[0].alias("year"), week[1].alias("week")).agg(F.sum(y).alias("y"), F.sum(yhat).alias("p"), F.sum(error).alias("e"), F.count("*").alias("n"))
    store, sku = (F.col(k) for k in KEYS)
    none = F.lit(None).cast("string")
    kind = lambda level, a, b: F.struct(F.lit(level).alias("level"), a.alias("store"), b.alias("sku"))
    levels = F.array(kind("weekly_sku_store", store, sku), F.when(F.col("abc") == "A", kind("weekly_sku_store_a", store, sku)), kind("weekly_sku", none, sku), kind("weekly_store", store, none), kind("weekly_total", none, none))
    rows = weekly.select(F.explode(F.filter(levels, lambda x: x.isNotNull())).alias("l"), "year", "week", "y", "p").groupBy("l", "year", "week").agg(F.sum("y").alias("y"), F.sum("p").alias("p"))
    sums = rows.groupBy(F.col("l.level").alias("level")).agg(F.count("*").alias("n"), F.sum(F.abs(F.col("y").cast("double") - F.col("p"))).alias("e"), F.sum("y").alias("y"), F.sum("p").alias("p"))
    daily = weekly.agg(F.lit("daily").alias("level"), F.sum("n").alias("n"), F.sum("e").alias("e"), F.sum("y").alias("y"), F.sum("p").alias("p"))
    total = F.col("y").cast("double")
    wmape = F.lit(PCT) * ratio(F.col("e"), total)
    return daily.unionByName(sums).select("n", wmape.alias("wmape"), (F.lit(PCT) - wmape).alias("wfa"), (F.lit(PCT) * ratio(F.col("p") - total, total)).alias("bias_pct"), "level")


def lift(scores: DataFrame, baseline: str) -> DataFrame:
    """Gain in WMAPE over a baseline model, in points and relative."""
    # a row per model: one window spares a second pass over what was scored
    base = F.max(F.when(F.col("model") == baseline, F.col("wmape"))).over(Window.partitionBy())
    return scores.withColumn("_base", base).select("model", "wmape", (F.col("_base") - F.col("wmape")).alias("lift_pp"), (F.lit(PCT) * F.try_divide(F.col("_base") - F.col("wmape"), F.col("_base"))).alias("lift_pct"))


def error_decomposition(df: DataFrame, yhat: str, y: str = "y") -> DataFrame:
    """Share of error and sales by segment, and in spike rows (y above the series' 99 % quantile)."""
    top = df.groupBy(*KEYS).agg(F.percentile(y, 0.99).alias("_p99"))
    rows = df.join(top, list(KEYS)).withColumns({"is_extreme": flag(F.col(y) > F.col("_p99")), "_e": F.abs(F.col(y) - F.col(yhat))})
    out = rows.groupBy("abc", "is_extreme").agg(F.count("*").alias("n"), F.sum("_e").alias("abs_error"), F.sum(y).alias("sales"))
    every = Window.partitionBy()
    return out.withColumns({"error_share": F.lit(PCT) * ratio(F.col("abs_error"), F.sum("abs_error").over(every)), "sales_share": F.lit(PCT) * ratio(F.col("sales"), F.sum("sales").over(every))})


def zero_error_share(df: DataFrame, yhat: str, y: str = "y") -> DataFrame:
    """Error on days without and with sales."""
    e = F.abs(F.col(y) - F.col(yhat))
    zero = F.sum(F.when(F.col(y) == 0, e).otherwise(0.0))
    return df.agg(zero.alias("zero_error"), (F.sum(e) - zero).alias("nonzero_error"), (F.lit(PCT) * ratio(zero, F.sum(e))).alias("zero_error_pct"))


def series_wmape(df: DataFrame, yhat: str, to: str, y: str = "y") -> DataFrame:
    return df.groupBy(*KEYS).agg(F.sum(y).alias("volume"), (F.lit(PCT) * ratio(F.sum(F.abs(F.col(y) - F.col(yhat))), F.sum(y))).alias(to))


def series_improvement(df: DataFrame, new: str, old: str, y: str = "y") -> DataFrame:
    """Volume-weighted WMAPE of two forecasts over series, the share of series that improve, and the median improvement."""
    rows = df.groupBy(*KEYS).agg(F.sum(y).alias("v"), (F.lit(PCT) * ratio(F.sum(F.abs(F.col(y) - F.col(new))), F.sum(y))).alias("a"), (F.lit(PCT) * ratio(F.sum(F.abs(F.col(y) - F.col(old))), F.sum(y))).alias("b")).filter("v > 0")
    return rows.agg(F.count("*").alias("n_series"), ratio(F.sum(F.col("a") * F.col("v")), F.sum("v")).alias("wmape_new"), ratio(F.sum(F.col("b") * F.col("v")), F.sum("v")).alias("wmape_old"), (F.lit(PCT) * F.avg(flag(F.col("a") < F.col("b")).cast("double"))).alias("pct_improved"), F.percentile(F.col("b") - F.col("a"), 0.5).alias("median_improvement"))


def coverage(df: DataFrame, quantiles: list[str], y: str = "y") -> DataFrame:
    """Share of actuals up to each quantile forecast."""
    return df.agg(*(F.avg(flag(F.col(y) <= F.col(q)).cast("double")).alias(f"coverage_{q}") for q in quantiles))


def compare_models(df: DataFrame, preds: list[str], y: str = "y") -> DataFrame:
    """Weekly WMAPE and bias of forecast columns by series-week."""
    weekly = df.groupBy(*KEYS, F.trunc("date", "week").alias("week")).agg(F.sum(y).alias("y"), *(F.sum(p).alias(p) for p in preds))
    return metrics(weekly, preds, which=["n", "wmape", "bias_pct"])


def best_candidate(scores: DataFrame) -> DataFrame:
    """The model with least WMAPE; of models equal to nine places the first by name."""
    return scores.agg(F.min(F.struct(F.round("wmape", 9).alias("wmape"), "model")).alias("_b")).select(F.col("_b.model").alias("model"), F.col("_b.wmape").alias("wmape"))


def fit_gap(train: DataFrame, val: DataFrame, by: str) -> DataFrame:
    """Validation less training WMAPE of each group."""
    return train.select(by, F.col("wmape").alias("train_wmape")).join(val.select(by, F.col("wmape").alias("val_wmape")), by).withColumn("gap", F.col("val_wmape") - F.col("train_wmape"))


def fit_gap_by_role(scores: DataFrame, by: str) -> DataFrame:
    """The same from one table of scores with ``split_role``, so that the rows are scored in one pass."""
    side = lambda role: F.max(F.when(F.col("split_role") == role, F.col("wmape")))
    both = scores.groupBy(by).agg(side("TRAIN").alias("train_wmape"), side("VAL").alias("val_wmape"), F.count_distinct("split_role").alias("_n")).filter("_n = 2")
    return both.select(by, "train_wmape", "val_wmape", (F.col("val_wmape") - F.col("train_wmape")).alias("gap"))


def validate_folds(scores: DataFrame) -> DataFrame:
    """Mean and spread of a model's WMAPE over folds."""
    return scores.groupBy("model").agg(F.count("*").alias("n_folds"), F.avg("wmape").alias("mean_wmape"), F.stddev_samp("wmape").alias("std_wmape"), (F.max("wmape") - F.min("wmape")).alias("spread_wmape"))
