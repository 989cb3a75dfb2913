"""Forecasts by rule: baselines, Croston, combinations, calibration, intervals and recursion."""

from __future__ import annotations

from datetime import date
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandpanel.config import KEYS
from demandpanel.functions.columns import clip, ratio


def naive_lag(df: DataFrame, k: int = 7) -> DataFrame:
    """The quantity of k days ago, from column ``lag_k``."""
    return df.withColumn(f"pred_lag{k}", F.greatest(F.coalesce(f"lag_{k}", F.lit(0)), F.lit(0)).cast("double"))


def roll_baseline(df: DataFrame, n: int = 28) -> DataFrame:
    return df.withColumn(f"pred_roll{n}", F.greatest(F.coalesce(f"roll_mean_{n}", F.lit(0.0)), F.lit(0.0)))


def smart_baseline(df: DataFrame) -> DataFrame:
    """0 when closed, the 28-day mean within 28 days of a sale, else the lag of 7."""
    out = roll_baseline(naive_lag(df, 7), 28)
    return out.withColumn("pred_smart", F.when(F.col("is_store_closed") == 1, 0.0).when(F.col("days_since_last_sale_asof") <= 28, F.col("pred_roll28")).otherwise(F.col("pred_lag7")))


def croston(panel: DataFrame, alpha: float = 0.1, alpha_interval: float | None = None, keys=KEYS, y: str = "y", end: date | None = None) -> DataFrame:
    """Croston's demand size, interval and rate per series, and the rate with the Syntetos-Boylan correction.

    Smoothing from the first value on is a weighted sum: demand i of n weighs alpha (1 - alpha)^(n - i), the first one
    (1 - alpha)^(n - 1), so ordinary aggregates do. The interval starts at the first gap, whose own update changes
    nothing. Without demand the size is 0 and the interval the series' length; with one, its place in the series.

    With ``end`` the rows are the days with a fact, and the days between them, up to ``end``, have no demand: the same statistics
    without a panel.
    """
    if end:
        panel = panel.filter(F.col("date") <= F.lit(end))
    a, b = alpha, alpha if alpha_interval is None else alpha_interval
    w = Window.partitionBy(*keys).orderBy("date")
    every = Window.partitionBy(*keys)
    sold = F.col(y) > 0
    # only days of demand take part in what needs an order
    ends = panel.groupBy(*keys).agg(F.min("date").alias("_start"), (F.datediff(F.lit(end), F.min("date")) + 1 if end else F.count("*")).cast("long").alias("n_days"))
    rows = panel.filter(sold).select(*keys, "date", F.col(y).cast("double").alias("_q"), F.datediff("date", F.lag("date").over(w)).alias("_g"), F.row_number().over(w).alias("_i"), F.count("*").over(every).alias("_n"))
    i, n = F.col("_i"), F.col("_n")
    size = F.when(i == 1, F.pow(F.lit(1 - a), n - 1)).otherwise(F.lit(a) * F.pow(F.lit(1 - a), n - i))
    gap = F.when(i == 2, F.pow(F.lit(1 - b), n - 2)).when(i > 2, F.lit(b) * F.pow(F.lit(1 - b), n - i))
    out = rows.groupBy(*keys).agg(
        F.count("*").alias("n_demands"), F.sum(F.col("_q") * size).alias("_z"), F.sum(F.col("_g") * gap).alias("_p"), F.min("date").alias("_first"),
        F.var_pop("_q").alias("demand_variance"), F.var_pop("_g").alias("interval_variance"), F.stddev_pop("_q").alias("_sd"), F.avg("_q").alias("_mean"), F.avg("_g").alias("adi"), F.sum("_q").alias("_sum"),
    )
    out = ends.join(out, list(keys), "left").fillna({"n_demands": 0})
    z = F.coalesce("_z", F.lit(0.0))
    p = F.when(F.col("n_demands") == 0, F.col("n_days")).when(F.col("n_demands") == 1, F.datediff("_first", "_start") + 1).otherwise(F.col("_p")).cast("double")
    rate = F.coalesce(ratio(z, p), F.lit(0.0))
    return out.select(*keys, "n_days", "n_demands", z.alias("demand_size"), p.alias("demand_interval"), rate.alias("croston_rate"), (rate * (1 - b / 2)).alias("sba_rate"), "demand_variance", "interval_variance", "adi", ratio(F.col("_sd"), F.col("_mean")).alias("cv"), ratio(F.col("_sum"), F.col("n_days")).alias("moving_average"))


def croston_variant(stats: DataFrame, cv: float = 0.49, adi: float = 1.32) -> DataFrame:
    """Method by demand pattern: too few or smooth: moving average; erratic or intermittent: Croston; lumpy: SBA."""
    few, smooth, steady = F.col("n_demands") < 3, F.col("adi") < adi, F.coalesce("cv", F.lit(0.0)) < cv
    variant = F.when(few, "moving_average").when(smooth & steady, "moving_average").when(smooth | steady, "croston").otherwise("sba")
    rate = F.when(variant == "sba", F.col("sba_rate")).when(variant == "croston", F.col("croston_rate")).otherwise(F.coalesce("moving_average", F.lit(0.0)))
    return stats.withColumns({"variant": variant, "rate": rate})


def z_score(confidence: float) -> float:
    return NormalDist().inv_cdf((1 + confidence) / 2)


def croston_intervals(stats: DataFrame, rate: str = "croston_rate", confidence: float = 0.95) -> DataFrame:
    """Bounds from the variation of sizes and intervals; with three demands at least, else from half the size."""
    cv_d = F.sqrt("demand_variance") / F.greatest("demand_size", F.lit(1e-6))
    cv_i = F.sqrt("interval_variance") / F.greatest("demand_interval", F.lit(1e-6))
    enough = (F.col("demand_interval") > 0) & (F.col("n_demands") > 2)
    error = F.when(enough, F.col(rate) * F.sqrt(cv_d * cv_d + cv_i * cv_i)).otherwise(F.greatest(F.col("demand_size") * 0.5, F.lit(0.5)))
    margin = F.lit(z_score(confidence)) * error
    return stats.withColumns({"lower_bound": F.greatest(F.col(rate) - margin, F.lit(0.0)), "upper_bound": F.col(rate) + margin})


def croston_for_segment(panel: DataFrame, segments: DataFrame, segment: str = "C", min_days: int = 30, min_demands: int = 3, y: str = "y", end: date | None = None) -> DataFrame:
    """Croston forecasts with bounds for the series of one segment that have enough history; ``end`` as in :func:`croston`."""
    rows = panel.join(segments.filter(F.col("abc") == segment).select(*KEYS), list(KEYS), "left_semi")
    stats = croston_variant(croston(rows, y=y, end=end)).filter((F.col("n_days") >= min_days) & (F.col("n_demands") >= min_demands))
    return croston_intervals(stats, "rate")


def smear(df: DataFrame, mode: str = "mean_exp", residual: str = "residual", bounds: tuple[float, float] | None = None, by: tuple = (), weight: str | None = None) -> DataFrame:
    """Retransformation factor of log residuals: mean(exp(r)), or exp(var(r) / 2) with ``mode='normal'``; means may be weighted
    (the variance of weighted residuals is that of the whole, not of a sample)."""
    if weight:
        mean = lambda x: F.try_divide(F.sum(F.col(weight) * x), F.sum(F.col(weight)))
        r = F.col(residual)
        value = mean(F.exp(r)) if mode == "mean_exp" else F.exp((mean(r * r) - mean(r) * mean(r)) * 0.5)
    else:
        value = F.avg(F.exp(residual)) if mode == "mean_exp" else F.exp(F.var_samp(residual) * 0.5)
    out = df.groupBy(*by).agg(value.alias("smear"))
    return out.withColumn("smear", clip(F.col("smear"), *bounds)) if bounds else out


# Thresholds and factors of the fixed combination by segment.
FIXED = {"A": (0.80, 1.04), "B": (0.70, 0.96), "C": (0.65, 0.80)}


def combine(df: DataFrame, mode: str = "threshold", p: str = "p", qty: str = "qty", threshold: float = 0.5, calibration: float = 1.0, smear_factor: float = 1.0, below: float = 0.3, to: str = "yhat", segment: str = "abc") -> DataFrame:
    """Forecast from the probability of a sale and its quantity.

    ``threshold``: quantity times calibration from the threshold on, else 0. ``ev``: p * quantity * smear. ``soft``: p *
    quantity * calibration above the threshold, else ``below`` of it. ``fixed``: thresholds and factors of the segment.
    """
    prob, q = F.col(p), F.col(qty)
    if mode == "threshold":
        out = F.when(prob >= threshold, q * calibration).otherwise(0.0)
    elif mode == "ev":
        out = prob * q * smear_factor
    elif mode == "soft":
        out = prob * q * calibration * F.when(prob > threshold, 1.0).otherwise(below)
    else:
        out = F.lit(0.0)
        for name, (least, k) in FIXED.items():
            out = F.when(F.col(segment) == name, F.when(prob >= least, q * k).otherwise(0.0)).otherwise(out)
    return df.withColumn(to, F.greatest(out, F.lit(0.0)))


def apply_rules(df: DataFrame, yhat: str = "yhat") -> DataFrame:
    """No negative forecast, and 0 where the store is closed."""
    return df.withColumn(yhat, F.when(F.col("is_store_closed") == 1, 0.0).otherwise(F.greatest(F.col(yhat), F.lit(0.0))))


def calibrate(train: DataFrame, bounds=(0.8, 1.3), by: tuple = (), y: str = "y", yhat: str = "yhat") -> DataFrame:
    """Factor sum(y) / sum(yhat) over forecasts above 0.1, held to the bounds; 1 where there are none."""
    use = F.col(yhat) > 0.1
    k = ratio(F.sum(F.when(use, F.col(y))), F.sum(F.when(use, F.col(yhat))))
    return train.groupBy(*by).agg(F.coalesce(clip(k, *bounds), F.lit(1.0)).alias("k"))


def bias_correct(df: DataFrame, mode: str = "multiplicative", y: str = "y", yhat: str = "yhat") -> DataFrame:
    """Moves forecasts towards the mean of the actuals: by their ratio (0.5 to 2), or by half their difference."""
    means = df.agg(F.avg(y).alias("_y"), F.avg(yhat).alias("_p"))
    if mode == "multiplicative":
        factor = means.select(F.when(F.col("_p") > 0, clip(ratio(F.col("_y"), F.col("_p")), 0.5, 2.0)).otherwise(1.0)).scalar()
        return df.withColumn("yhat_corrected", F.col(yhat) * factor)
    return df.withColumn("yhat_corrected", F.greatest(F.col(yhat) + means.select((F.col("_y") - F.col("_p")) * 0.5).scalar(), F.lit(0.0)))


def _tune(df: DataFrame, grid: list[float], of, y: str, by: tuple, group: tuple) -> DataFrame:
    """Error of each grid value in one pass: the grid is exploded on each row and summed before the shuffle."""
    rows = df.withColumn("value", F.explode(F.array(*(F.lit(float(g)) for g in grid))))
    rows = rows.select(*by, *group, "value", F.col(y).cast("double").alias("_y"), of(F.col("value")).alias("_p"))
    if group:
        rows = rows.groupBy(*by, *group, "value").agg(F.sum("_y").alias("_y"), F.sum("_p").alias("_p"))
    return rows.groupBy(*by, "value").agg((F.lit(100.0) * ratio(F.sum(F.abs(F.col("_y") - F.col("_p"))), F.sum("_y"))).alias("wmape"))


def tune_threshold(df: DataFrame, grid: list[float], p: str = "p", qty: str = "qty", y: str = "y", by: tuple = (), group: tuple = ()) -> DataFrame:
    """Weighted error of each threshold; ``group`` sums both sides first, for weekly errors."""
    return _tune(df, grid, lambda t: F.when(F.col(p) >= t, F.col(qty)).otherwise(0.0), y, by, group)


def tune_blend(df: DataFrame, grid: list[float], first: str, second: str, y: str = "y", by: tuple = ()) -> DataFrame:
    return _tune(df, grid, lambda a: a * F.col(first) + (1 - a) * F.col(second), y, by, ())


def tune_scale(df: DataFrame, grid: list[float], yhat: str = "yhat", y: str = "y", by: tuple = ()) -> DataFrame:
    return _tune(df, grid, lambda k: k * F.col(yhat), y, by, ())


def best_value(tuned: DataFrame, by: tuple = ()) -> DataFrame:
    """The grid value with least error, the smaller one of equals."""
    return tuned.groupBy(*by).agg(F.min(F.struct("wmape", "value")).alias("_b")).select(*by, F.col("_b.value").alias("value"), F.col("_b.wmape").alias("wmape"))


def quantile_forecast(train: DataFrame, quantiles=(0.5, 0.75, 0.9, 0.95), days: int = 84, y: str = "y") -> DataFrame:
    """Empirical quantiles (linear) of each series and weekday over its last days: ``q50`` and so on."""
    last = train.agg(F.max("date")).scalar()
    rows = train.filter(F.col("date") > F.date_sub(last, days))
    got = rows.groupBy(*KEYS, F.dayofweek("date").alias("dow")).agg(F.percentile(y, F.array(*(F.lit(q) for q in quantiles))).alias("_q"))
    return got.select(*KEYS, "dow", *(F.col("_q")[i].alias(f"q{round(100 * q)}") for i, q in enumerate(quantiles)))


def quantile_blend(df: DataFrame) -> DataFrame:
    """Higher quantiles where the 90 % quantile is far above the median."""
    wide = F.col("q90") - F.col("q50") > F.col("q50") * 0.5
    return df.withColumn("yhat", F.when(wide, 0.7 * F.col("q75") + 0.3 * F.col("q90")).otherwise(0.8 * F.col("q50") + 0.2 * F.col("q75")))


def dow_weights(train: DataFrame, y: str = "y") -> DataFrame:
    """Share of each weekday in a series' sales, times 7."""
    sums = train.groupBy(*KEYS, F.dayofweek("date").alias("dow")).agg(F.sum(y).alias("_s"))
    total = F.sum("_s").over(Window.partitionBy(*KEYS))
    return sums.select(*KEYS, "dow", (F.col("_s").cast("double") / F.when(total == 0, 1).otherwise(total) * 7).alias("dow_weight"))


def weekly_forecast(train: DataFrame, weeks: int = 4, y: str = "y") -> DataFrame:
    """Mean of a series' weekly sums (ISO weeks) over its last weeks."""
    last = train.agg(F.max("date")).scalar()
    recent = train.filter(F.col("date") > F.date_sub(last, 7 * weeks)).groupBy(*KEYS, F.trunc("date", "week").alias("week")).agg(F.sum(y).alias("_s"))
    return recent.groupBy(*KEYS).agg(F.avg("_s").alias("weekly_forecast"))


def disaggregate(train: DataFrame, future: DataFrame, weeks: int = 4, y: str = "y") -> DataFrame:
    """Daily forecasts: a seventh of the weekly forecast by the weekday's weight; unknown weights 1, unknown series 0."""
    rows = future.withColumn("dow", F.dayofweek("date")).join(weekly_forecast(train, weeks, y), list(KEYS), "left").join(dow_weights(train, y), [*KEYS, "dow"], "left")
    weekly, weight = F.coalesce("weekly_forecast", F.lit(0.0)), F.coalesce("dow_weight", F.lit(1.0))
    return rows.withColumns({"pred_disagg": weekly / 7 * weight, "pred_uniform": weekly / 7})


def ensemble(df: DataFrame, weights: dict[str, float], to: str = "yhat") -> DataFrame:
    """Weighted sum of forecast columns."""
    return df.withColumn(to, sum((F.lit(w) * F.col(c) for c, w in weights.items()), F.lit(0.0)))


# Base uncertainty by segment.
UNCERTAINTY = {"A": 0.20, "B": 0.30, "C": 0.50}


def intervals(df: DataFrame, confidence: float = 0.95, yhat: str = "yhat", p: str = "p", segment: str = "abc", other: float = 0.35) -> DataFrame:
    """Bounds that widen with the segment and with doubt about a sale; the error is 0.5 at least for forecasts above 0."""
    base = F.lit(other)
    for name, m in UNCERTAINTY.items():
        base = F.when(F.col(segment) == name, m).otherwise(base)
    error = F.greatest(F.col(yhat) * base * (1 + (1 - F.col(p)) * 0.5), F.when(F.col(yhat) > 0, 0.5).otherwise(0.0))
    z = F.lit(z_score(confidence))
    return df.withColumns({"lower_bound": F.greatest(F.col(yhat) - z * error, F.lit(0.0)), "upper_bound": F.col(yhat) + z * error})


def beside_croston(df: DataFrame, croston_df: DataFrame) -> DataFrame:
    """What :func:`blend_c_items` takes from Croston, beside each row. Rows by series may have it before they become days."""
    c = croston_df.select(*KEYS, F.col("rate").alias("_r"), F.col("lower_bound").alias("_l"), F.col("upper_bound").alias("_u"))
    return df.join(c, list(KEYS), "left")


def blend_c_items(df: DataFrame, croston_df: DataFrame | None = None, weight: float = 0.7) -> DataFrame:
    """Forecasts of series that Croston covers become a blend with it, with the wider bounds. Without ``croston_df`` the rows
    come from :func:`beside_croston`."""
    out = df if croston_df is None else beside_croston(df, croston_df)
    has = F.col("_r").isNotNull()
    return out.withColumns({
        "yhat": F.when(has, F.col("_r") * weight + F.col("yhat") * (1 - weight)).otherwise(F.col("yhat")),
        "lower_bound": F.when(has, F.least("lower_bound", "_l")).otherwise(F.col("lower_bound")),
        "upper_bound": F.when(has, F.greatest("upper_bound", "_u")).otherwise(F.col("upper_bound")),
    }).drop("_r", "_l", "_u")


def smooth_weeks(df: DataFrame, yhat: str = "yhat", conserve: bool = False, iso_year: bool = False) -> DataFrame:
    """Spreads a day that holds over half of its week's forecast: it falls to 70 %, and the others share what it had beyond a
    half. ``conserve`` gives the others what it lost instead, so that the week's total stays. Weeks are named by calendar
    year and ISO week, which puts 31 December into one week with the first days of its own year; with ``iso_year`` they
    are the seven days from Monday on."""
    week = Window.partitionBy(*KEYS, *([F.trunc("date", "week")] if iso_year else [F.year("date"), F.weekofyear("date")]))
    v = F.col(yhat)
    rows = df.withColumns({"_t": F.sum(yhat).over(week), "_m": F.max(yhat).over(week), "_n": F.count("*").over(week), "_r": F.row_number().over(week.orderBy(F.desc(yhat), "date"))})
    high = (F.col("_m") > 0.5 * F.col("_t")) & (F.col("_n") > 1) & (F.col("_t") != 0)
    moved = F.col("_m") * 0.3 if conserve else F.col("_m") - 0.5 * F.col("_t")
    return rows.withColumn(yhat, F.when(high & (F.col("_r") == 1), v * 0.7).when(high, v + moved / (F.col("_n") - 1)).otherwise(v)).drop("_t", "_m", "_n", "_r")


def series_state(panel: DataFrame, cutoff: date, days: int = 56, keys=KEYS, y: str = "y") -> DataFrame:
    """One row per series: its last ``days`` quantities in order (``hist``, zeros before its start), and days since a sale."""
    rows = panel.filter((F.col("date") <= F.lit(cutoff)) & (F.col("date") > F.date_sub(F.lit(cutoff), days)))
    got = F.map_from_entries(F.collect_list(F.struct(F.datediff(F.lit(cutoff), "date").alias("k"), F.col(y).cast("double").alias("v"))))
    out = rows.groupBy(*keys).agg(got.alias("_m"))
    hist = F.transform(F.sequence(F.lit(days - 1), F.lit(0)), lambda k: F.coalesce(F.try_element_at("_m", k), F.lit(0.0)))
    return out.select(*keys, hist.alias("hist"))


def recursive_features(hist: Column, median_gap: Column | None = None) -> dict[str, Column]:
    """Lags, means and recency from an array of quantities that ends yesterday; with the series' median gap between sales the
    velocity too: days since a sale against it, whether that is overdue, and the pressure."""
    n = F.size(hist)
    last = lambda k: F.slice(hist, F.greatest(n - k + 1, F.lit(1)), F.lit(k))
    mean = lambda k: F.aggregate(last(k), F.lit(0.0), lambda a, x: a + x) / k
    place = F.array_position(F.transform(F.reverse(hist), lambda x: x > 0), F.lit(True))
    since = F.when(place > 0, place).otherwise(n).cast("int")
    out = {"lag_1": F.element_at(hist, -1), "lag_7": F.element_at(hist, -7), "lag_28": F.element_at(hist, -28), "roll_mean_7": mean(7), "roll_mean_28": mean(28), "nz_rate_28": F.size(F.filter(last(28), lambda x: x > 0)) / 28.0, "days_since": since}
    if median_gap is not None:
        r = F.coalesce(F.try_divide(since.cast("double"), median_gap), F.lit(0.0))
        out |= {"gap_vs_median": r, "is_overdue": F.when(r > 1.5, 1).otherwise(0), "gap_pressure": 1 - F.exp(F.lit(-0.5) * r)}
    return out


def recursive_forecast(state: DataFrame, start: date, horizon: int, step=None, keys=KEYS, median_gap: str | None = None) -> DataFrame:
    """Forecasts day by day, each from the days before it, forecasts included. One fold over the days in each row; no job
    per day and no state outside the row.

    ``step`` makes a forecast from :func:`recursive_features`, which with the column ``median_gap`` have the velocity too; by default the mean of the 7 and 28 day means, 0 after 56
    days without a sale.
    """

    def rule(f: dict[str, Column]) -> Column:
        return F.when(f["days_since"] > 55, 0.0).otherwise(0.5 * f["roll_mean_7"] + 0.5 * f["roll_mean_28"])

    keep = 56
    grown = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), F.col("hist"), lambda h, _: F.concat(h, F.array(F.greatest((step or rule)(recursive_features(F.slice(h, F.size(h) - keep + 1, F.lit(keep)), F.col(median_gap) if median_gap else None)), F.lit(0.0)))))
    days = state.select(*keys, F.posexplode(F.slice(grown, F.size("hist") + 1, F.lit(horizon))).alias("_k", "yhat"))
    return days.select(*keys, F.date_add(F.lit(start), F.col("_k")).alias("date"), "yhat")


def forecast_output(df: DataFrame, yhat: str = "yhat") -> DataFrame:
    """The delivered columns of a forecast."""
    return df.select(*KEYS, "date", F.col(yhat).alias("predicted_sales"), "lower_bound", "upper_bound", F.col("abc").alias("abc_segment"))
