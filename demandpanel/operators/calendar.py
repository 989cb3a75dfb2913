"""Calendar dimension, closures and event flags. All tables here have one row per day: they fit one broadcast."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandpanel.config import Config, closures
from demandpanel.functions.columns import cyclical, flag, week_of_year


def dates(spark: SparkSession, start: date, end: date) -> DataFrame:
    """All days from start to end."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("date"))


def date_dim(spark: SparkSession, start: date, end: date, convention: str = "sunday") -> DataFrame:
    """Calendar attributes of each day. ``sunday``: weekdays 1 (Sunday) to 7, weeks 0 to 53 from Sunday; ``iso``: weekdays 0
    (Monday) to 6, ISO weeks."""
    d = F.col("date")
    iso = convention == "iso"
    dow = F.weekday(d) if iso else F.dayofweek(d)
    month_start, quarter_start, year_start = (F.trunc(d, x) for x in ("month", "quarter", "year"))
    leap = (F.year(d) % 4 == 0) & ((F.year(d) % 100 != 0) | (F.year(d) % 400 == 0))
    return dates(spark, start, end).select(
        "date",
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_id"),
        dow.alias("dow"),
        (F.weekofyear(d) if iso else week_of_year(d)).alias("week_of_year"),
        F.month(d).alias("month"),
        F.year(d).alias("year"),
        (F.dayofweek(d).isin(1, 7)).alias("is_weekend"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        F.quarter(d).alias("quarter"),
        F.trunc(d, "week").alias("week_start_date"),
        F.date_add(F.trunc(d, "week"), 6).alias("week_end_date"),
        F.ceil(F.dayofmonth(d) / 7).cast("int").alias("week_of_month"),
        (d == month_start).alias("is_month_start"),
        (d == F.last_day(d)).alias("is_month_end"),
        (d == quarter_start).alias("is_quarter_start"),
        (d == F.date_sub(F.add_months(quarter_start, 3), 1)).alias("is_quarter_end"),
        (d == year_start).alias("is_year_start"),
        ((F.month(d) == 12) & (F.dayofmonth(d) == 31)).alias("is_year_end"),
        leap.alias("is_leap_year"),
        ((F.month(d) == 2) & (F.dayofmonth(d) == 29)).alias("is_feb29"),
    )


def closure_dim(spark: SparkSession, cfg: Config) -> DataFrame:
    """Days on which stores are closed: ``closure_date``, ``closure_name``, ``is_store_closed``."""
    return spark.createDataFrame([(d, name, 1) for d, name in closures(*cfg.closure_years)], "closure_date date, closure_name string, is_store_closed int")


def days_to_event(dim: DataFrame, events: DataFrame, event_date: str = "closure_date", cap: int | None = 60, strict: bool = False, default: int | None = None, to: str = "days_to_next", since: str = "days_from_prev") -> DataFrame:
    """Days of each date to the next and from the previous event, held at ``cap``; ``default`` (the cap) where there is none.

    The event itself counts as distance 0, unless ``strict``. Two windows over the days and events together find both;
    the table has one row per day.
    """
    default = cap if default is None else default
    marks = events.select(F.col(event_date).alias("date")).distinct().withColumn("_event", F.lit(1))
    both = dim.select("date").distinct().join(marks, "date", "full")
    at = F.when(F.col("_event") == 1, F.col("date"))
    w = Window.orderBy("date")
    before, after = (-1, 1) if strict else (0, 0)
    near = both.select("date", F.min(at).over(w.rowsBetween(after, Window.unboundedFollowing)).alias("_next"), F.max(at).over(w.rowsBetween(Window.unboundedPreceding, before)).alias("_prev"))
    held = lambda c: F.coalesce(F.least(c, F.lit(cap)) if cap is not None else c, F.lit(default)).cast("int")
    near = near.select("date", F.when(F.col("_next").isNull(), default).otherwise(held(F.datediff("_next", "date"))).alias(to), F.when(F.col("_prev").isNull(), default).otherwise(held(F.datediff("date", "_prev"))).alias(since))
    return dim.join(F.broadcast(near), "date")


def closure_proximity(dim: DataFrame, closed: DataFrame, cap: int | None = 60, strict: bool = False, week: int = 3, default: int | None = None) -> DataFrame:
    """Distances to the next and from the last closure, and ``is_closure_week`` within ``week`` days of one."""
    out = days_to_event(dim, closed, "closure_date", cap, strict, default, "days_to_next_closure", "days_from_prev_closure")
    return out.withColumn("is_closure_week", flag((F.col("days_to_next_closure") <= week) | (F.col("days_from_prev_closure") <= week)))


def enrich(panel: DataFrame, dim: DataFrame, closed: DataFrame) -> DataFrame:
    """Panel rows with calendar attributes and ``is_store_closed``; both sides that join have one row per day."""
    days = dim.join(F.broadcast(closed.select(F.col("closure_date").alias("date"), "closure_name", "is_store_closed")), "date", "left").fillna(0, ["is_store_closed"])
    return panel.join(F.broadcast(days), "date")


def holiday_flag(df: DataFrame, days: list[date], to: str = "is_local_holiday") -> DataFrame:
    return df.withColumn(to, flag(F.col("date").isin(days)))


def event_month_flags(df: DataFrame, months: list[int]) -> DataFrame:
    """``is_december``, ``is_week_49_52`` and ``is_event_month`` for months given as year * 100 + month."""
    d = F.col("date")
    return df.withColumns({"is_december": flag(F.month(d) == 12), "is_week_49_52": flag(F.weekofyear(d).between(49, 52)), "is_event_month": flag((F.year(d) * 100 + F.month(d)).isin(months))})


def event_week_flags(df: DataFrame, months: list[int]) -> DataFrame:
    """``is_pre_christmas_week``, the seven days before 25 December, and ``is_ramadan_approx`` for the given months."""
    d = F.col("date")
    return df.withColumns({"is_pre_christmas_week": flag((F.month(d) == 12) & F.dayofmonth(d).between(18, 24)), "is_ramadan_approx": flag((F.year(d) * 100 + F.month(d)).isin(months))})


def dom_flags(df: DataFrame, first: int = 7, last: int = 24) -> DataFrame:
    """``is_month_begin`` up to day ``first`` and ``is_month_close`` from day ``last``."""
    day = F.dayofmonth("date")
    return df.withColumns({"is_month_begin": flag(day <= first), "is_month_close": flag(day >= last)})


def cyclical_features(df: DataFrame, year_period: float = 365.25) -> DataFrame:
    """Sine and cosine of the day of the year and of the weekday."""
    (sy, cy), (sw, cw) = cyclical(F.dayofyear("date"), year_period), cyclical(F.dayofweek("date"), 7)
    return df.withColumns({"sin_doy": sy, "cos_doy": cy, "sin_dow": sw, "cos_dow": cw})
