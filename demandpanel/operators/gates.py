"""Data-quality gates. Each gives rows (gate, value, status) from one aggregation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandpanel.config import KEYS, Config


def _gate(df: DataFrame, checks: dict, info: dict | None = None) -> DataFrame:
    """``checks`` must be 0; ``info`` is reported as it is."""
    every = {**checks, **(info or {})}
    one = df.agg(*(F.coalesce(c, F.lit(0)).cast("double").alias(k) for k, c in every.items()))
    rows = one.unpivot([], list(every), "gate", "value")
    if not info:
        return rows.withColumn("status", F.when(F.col("value") == 0, "PASS").otherwise("FAIL"))
    status = F.when(F.col("gate").isin(list(info)), "INFO").when(F.col("value") == 0, "PASS").otherwise("FAIL")
    return rows.withColumn("status", status)


def _all(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def gate_nulls(df: DataFrame, keys=(*KEYS, "date")) -> DataFrame:
    return _gate(df, {f"null_{k}": F.count_if(F.col(k).isNull()) for k in keys}, {"rows": F.count("*")})


def gate_unique(df: DataFrame, keys=(*KEYS, "date")) -> DataFrame:
    """Keys that occur more than once."""
    return _gate(df.groupBy(*keys).agg(F.count("*").alias("n")), {"duplicate_keys": F.count_if(F.col("n") > 1)})


def gate_clean(df: DataFrame) -> DataFrame:
    flags = ("was_negative", "is_covid_period", "is_covid_panic_spike", "is_extreme_spike")
    return _gate(df, {"negative_clean": F.count_if(F.col("sales_clean") < 0), "clean_above_raw": F.count_if(F.col("sales_clean") > F.greatest(F.col("sales_raw"), F.lit(0)))}, {f: F.sum(f) for f in flags})


def gate_spine(panel: DataFrame, pairs: DataFrame, end) -> DataFrame:
    """Rows of the panel against the days of each pair; pairs whose days have gaps."""
    expected = pairs.withColumn("_n", F.datediff(F.lit(end), "first_date") + 1).select(*KEYS, "_n")
    got = panel.groupBy(*KEYS).agg(F.count("*").alias("_rows"), (F.datediff(F.max("date"), F.min("date")) + 1).alias("_days"))
    both = expected.join(got, list(KEYS), "full").fillna(0, ["_n", "_rows", "_days"])
    return _gate(both, {"row_count_difference": F.sum(F.col("_rows") - F.col("_n")), "pairs_with_gaps": F.count_if(F.col("_rows") != F.col("_days"))}, {"panel_rows": F.sum("_rows")})


def gate_panel(panel: DataFrame, facts: DataFrame) -> DataFrame:
    """Observed days carry the facts' values; filled values are neither null nor negative; unobserved days hold the contract."""
    seen = F.col("is_observed") == 1
    inner = panel.filter(seen).select(*KEYS, "date", F.col("sales_clean").alias("_p")).join(facts.select(*KEYS, "date", F.col("sales_clean").alias("_f")), [*KEYS, "date"], "full")
    a = _gate(inner, {"observed_value_differs": F.count_if(~F.col("_p").eqNullSafe(F.col("_f")))})
    b = _gate(panel, {"filled_null_or_negative": F.count_if(F.col("sales_filled").isNull() | (F.col("sales_filled") < 0)), "unobserved_contract": F.count_if(~seen & (F.col("sales_raw").isNotNull() | (F.col("sales_filled") != 0) | (F.col("was_negative") != 0)))}, {"observed_rows": F.sum("is_observed"), "filled_rows": F.count_if(~seen)})
    return _all(a, b)


def gate_calendar(dim: DataFrame, closures: DataFrame, enriched: DataFrame) -> DataFrame:
    days = _gate(dim, {"duplicate_days": F.count("*") - F.count_distinct("date"), "missing_days": F.datediff(F.max("date"), F.min("date")) + 1 - F.count("*")}, {"calendar_days": F.count("*")})
    return _all(days, _gate(closures, {"duplicate_closures": F.count("*") - F.count_distinct("closure_date")}, {"closures": F.count("*")}), _gate(enriched, {"rows_without_calendar": F.count_if(F.col("dow").isNull())}, {"closed_rows": F.sum("is_store_closed")}))


def gate_tiers(tiers: DataFrame, cfg: Config, expected: int | None = None) -> DataFrame:
    t0, d = F.col("tier_name") == "T0_EXCLUDED", F.col("days_since_last_sale")
    h = F.col("history_days")
    wrong = (~t0 & (h >= cfg.mature_days) & (F.col("tier_name") != "T1_MATURE")) | (~t0 & h.between(cfg.growing_days, cfg.mature_days - 1) & (F.col("tier_name") != "T2_GROWING")) | (~t0 & (h < cfg.growing_days) & (F.col("tier_name") != "T3_COLD_START"))
    checks = {"t0_without_reason": F.count_if(t0 & F.col("t0_reason").isNull()), "reason_without_t0": F.count_if(~t0 & F.col("t0_reason").isNotNull()), "t0_logic": F.count_if(t0 != ((F.col("n_pos") == 0) | F.coalesce(d > cfg.dormant_days, F.lit(False)))), "threshold_logic": F.count_if(wrong)}
    if expected is not None:
        checks["series_count_difference"] = F.count("*") - expected
    return _gate(tiers, checks, {"series": F.count("*")})


def gate_lags(features: DataFrame, audit: DataFrame) -> DataFrame:
    """Share of rows with lags, and lags that differ from the day before."""
    a = _gate(features, {}, {"rows_without_lag_1": F.count_if(F.col("lag_1").isNull()), "rows_without_lag_28": F.count_if(F.col("lag_28").isNull()), "pct_with_lag_7": 100.0 * F.avg(F.when(F.col("lag_7").isNotNull(), 1.0).otherwise(0.0))})
    return _all(a, _gate(audit, {"lag_1_violations": F.sum("violations")}, {"lag_1_checked": F.sum("checked")}))


def gate_features(df: DataFrame) -> DataFrame:
    circle = lambda a, b: F.count_if(F.abs(F.pow(a, 2) + F.pow(b, 2) - 1) > 1e-9)
    return _gate(df, {"sin_cos_doy": circle("sin_doy", "cos_doy"), "sin_cos_dow": circle("sin_dow", "cos_dow"), "closure_range": F.count_if(~F.col("days_to_next_closure").between(0, 60) | ~F.col("days_from_prev_closure").between(0, 60))}, {"closure_week_rows": F.sum("is_closure_week"), **{b: F.count_if(F.col("dormancy_bucket") == b) for b in ("D0_7", "D8_28", "D29_56", "D57_182", "D183_PLUS")}})


def gate_spikes(df: DataFrame) -> DataFrame:
    return _gate(df, {"lift_range": F.count_if(~F.col("seasonal_lift").between(0.5, 3.0)), "prob_range": F.count_if(~F.col("spike_prob").between(0.0, 1.0))}, {"spike_rows": F.sum("is_spike"), "promo_store_days": F.count_distinct(F.when(F.col("is_promo_day") == 1, F.struct("store_id", "date")))})


def gate_folds(folds: DataFrame, horizon: int = 168, embargo: int = 7) -> DataFrame:
    gap, days = F.datediff("val_start", "train_end"), F.datediff("val_end", "val_start") + 1
    return _gate(folds, {"short_embargo": F.count_if(gap < embargo), "wrong_horizon": F.count_if(days != horizon)}, {"folds": F.count("*")})


def gate_closure(df: DataFrame, yhat: str = "yhat", y: str = "y") -> DataFrame:
    closed = F.col("is_store_closed") == 1
    return _gate(df, {"forecast_when_closed": F.count_if(closed & (F.col(yhat) > 0))}, {"sales_when_closed": F.count_if(closed & (F.col(y) > 0)), "closed_rows": F.count_if(closed)})


def gate_velocity(df: DataFrame) -> DataFrame:
    return _gate(df, {}, {"series": F.count("*"), "with_median_gap": F.count("median_gap"), **{s: F.count_if(F.col("velocity_segment") == s) for s in ("FAST", "MEDIUM", "SLOW", "VERY_SLOW")}})


def gate_forecast(fc: DataFrame, n_series: int, horizon: int, start) -> DataFrame:
    v = F.col("predicted_sales")
    return _gate(fc, {"row_count_difference": F.count("*") - n_series * horizon, "null_or_nan": F.count_if(v.isNull() | F.isnan(v)), "negative": F.count_if(v < 0), "first_day_difference": F.datediff(F.min("date"), F.lit(start)), "last_day_difference": F.datediff(F.max("date"), F.lit(start)) - (horizon - 1)}, {"series": F.count_distinct(*KEYS)})


def gate_predictions(train: DataFrame, val: DataFrame, yhat: str = "yhat") -> DataFrame:
    """Forecasts above 0 on closed days, negative ones, and series in only one of training and validation."""
    a = _gate(val, {"forecast_when_closed": F.count_if((F.col("is_store_closed") == 1) & (F.col(yhat) > 0)), "negative": F.count_if(F.col(yhat) < 0)})
    both = train.select(*KEYS).distinct().withColumn("_t", F.lit(1)).join(val.select(*KEYS).distinct().withColumn("_v", F.lit(1)), list(KEYS), "full")
    return _all(a, _gate(both, {}, {"series_only_in_train": F.count_if(F.col("_v").isNull()), "series_only_in_val": F.count_if(F.col("_t").isNull())}))
