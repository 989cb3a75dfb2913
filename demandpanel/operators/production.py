"""Whole forecasts: models and rules put together for a horizon."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandpanel.config import KEYS
from demandpanel.operators import forecast as FC
from demandpanel.operators.models import TwoStage, predict_segments, predict_tiers
from demandpanel.operators.panel import attach_segment
from demandpanel.operators.windows import snapshot_features


def horizon_rows(known: DataFrame, closed: DataFrame, start: date, horizon: int) -> DataFrame:
    """A row per series (``known``) becomes the days to forecast, with closures. No join of days with series, no shuffle."""
    shut = closed.select(F.col("closure_date").alias("date"), "is_store_closed")
    days = known.withColumn("date", F.explode(F.sequence(F.lit(start), F.lit(start + timedelta(horizon - 1)))))
    return days.join(F.broadcast(shut), "date", "left").fillna(0, ["is_store_closed"])


def tier_horizon(models, panel: DataFrame, tiers: DataFrame, closed: DataFrame, start: date, horizon: int, cut=lambda df: df) -> DataFrame:
    """The production forecast by tier: each series' last-known features over the horizon, forecast by its tier's model and put
    together; T0 series and closed days at 0. ``cut`` as in :func:`generate_forecast`."""
    known = cut(snapshot_features(panel, start - timedelta(1)).join(tiers.select(*KEYS, "tier_name"), list(KEYS)))
    return FC.apply_rules(horizon_rows(predict_tiers(models, known), closed, start, horizon))


def generate_forecast(models: dict[str, TwoStage], panel: DataFrame, segments: DataFrame, closed: DataFrame, start: date, horizon: int, weight: float = 0.7, facts: DataFrame | None = None, parts: int | None = None, cut=lambda df: df) -> DataFrame:
    """The delivered forecast: two-stage models by segment, intervals, Croston for C items, weekly smoothing, closures at 0.

    The last-known features stand for the whole horizon, so models score a row per series, which then becomes days; only the rules, bounds
    and smoothing are made by day. ``facts``, the days with a fact (``date``, ``y``), serve Croston in place of the
    panel, which may then begin 60 days before ``start``. ``parts`` deals the series to so many partitions before they become
    days. ``cut`` writes the series' features as a table, else each segment's model makes them anew.
    """
    known = cut(attach_segment(snapshot_features(panel, start - timedelta(1)), segments))
    items = FC.croston_for_segment(panel, segments) if facts is None else FC.croston_for_segment(facts, segments, end=start - timedelta(1))
    scored = predict_segments(models, known).select(*KEYS, "abc", "p", "yhat")
    scored = FC.beside_croston(scored.repartition(parts, *KEYS) if parts else scored, items)
    rows = FC.apply_rules(horizon_rows(scored, closed, start, horizon))
    rows = FC.smooth_weeks(FC.blend_c_items(FC.intervals(rows), weight=weight))
    shut = F.col("is_store_closed") == 1
    rows = rows.withColumns({c: F.when(shut, 0.0).otherwise(F.col(c)) for c in ("yhat", "lower_bound", "upper_bound")})
    return FC.forecast_output(rows)


def compare_scoring(teacher: DataFrame, recursive: DataFrame, y: str = "y") -> DataFrame:
    """Error with true lags against error when forecasts feed the next days, over the days both have."""
    both = teacher.select(*KEYS, "date", y, F.col("yhat").alias("_t")).join(recursive.select(*KEYS, "date", F.col("yhat").alias("_r")), [*KEYS, "date"])
    wmape = lambda p: F.lit(100.0) * F.try_divide(F.sum(F.abs(F.col(y) - F.col(p))), F.sum(F.col(y).cast("double")))
    return both.agg(F.count("*").alias("n"), wmape("_t").alias("teacher_wmape"), wmape("_r").alias("recursive_wmape"))

