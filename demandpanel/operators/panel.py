"""The dense daily panel, and joins of panels with tiers, folds and predictions."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandpanel.config import KEYS, Config

MEASURES = {"sales_raw": None, "sales_clean": None, "was_negative": 0, "is_covid_period": 0, "is_covid_panic_spike": 0, "is_extreme_spike": 0}


def active_pairs(df: DataFrame, keys=KEYS) -> DataFrame:
    """First and last day of each series, and the days between them, both counted."""
    return df.groupBy(*keys).agg(F.min("date").alias("first_date"), F.max("date").alias("last_date")).withColumn("history_days", F.datediff("last_date", "first_date") + 1)


def spine(pairs: DataFrame, end: date, mode: str = "own", start: date | None = None, keys=KEYS) -> DataFrame:
    """Every day of each pair to ``end``: from its own first day, or with ``mode='rectangle'`` all from ``start``. No join."""
    first = F.lit(start) if mode == "rectangle" else F.col("first_date")
    return pairs.filter(first <= F.lit(end)).select(*keys, F.explode(F.sequence(first, F.lit(end))).alias("date"))


def _filled(df: DataFrame, observed) -> dict:
    out = {c: F.when(observed, F.col(c)) if v is None else F.coalesce(F.when(observed, F.col(c)), F.lit(v)) for c, v in MEASURES.items() if c in df.columns}
    return out | {"sales_filled": F.coalesce(F.when(observed, F.col("sales_clean")), F.lit(0)).cast("long"), "is_observed": F.when(observed, 1).otherwise(0)}


def gap_fill(days: DataFrame, facts: DataFrame, keys=KEYS) -> DataFrame:
    """Left join of the spine with the facts. :func:`dense_panel` gives the same rows without a join."""
    out = days.join(facts.withColumn("_seen", F.lit(1)), [*keys, "date"], "left")
    return out.select(*keys, "date", *(v.alias(k) for k, v in _filled(out, F.col("_seen").isNotNull()).items()))


def dense_panel(facts: DataFrame, end: date, keys=KEYS, since: date | None = None, parts: int | None = None, by=None) -> DataFrame:
    """One row per series and day from its first fact to ``end``.

    Unobserved days have null ``sales_raw`` and ``sales_clean``, ``sales_filled`` 0, flags 0 and ``is_observed`` 0. Each
    fact fills the days up to the next one by itself, so there is one shuffle by series and no join, and what comes
    after, windows and statistics by series, needs no further shuffle.

    With ``since`` the days before it are there only if they have a fact. That leaves recency exact, and lags and frames of n days
    exact from ``since`` + n days on, for a fraction of the rows.

    ``parts`` shuffles into so many partitions, by ``by`` if told, else by series. The facts are a small part of the panel, and
    partitions that suit their size hold far too many of its days. By ``store_id`` alone the stores' statistics need no shuffle either.
    """
    w = Window.partitionBy(*keys).orderBy("date")
    until = F.least(F.coalesce(F.date_sub(F.lead("date").over(w), 1), F.lit(end)), F.lit(end))
    rows = facts.repartition(parts, *(by or keys)) if parts else facts
    # days after the end go behind the window: a filter before it would move into the facts, and what else reads these, such as
    # their quantile, could not share their shuffle
    runs = rows.withColumn("_until", until).filter(F.col("date") <= F.lit(end)).withColumnRenamed("date", "_from")
    days = F.sequence("_from", "_until")
    if since:
        at = F.lit(since)
        days = F.when(F.col("_from") >= at, days).when(F.col("_until") < at, F.array("_from")).otherwise(F.concat(F.array("_from"), F.sequence(at, "_until")))
    out = runs.withColumn("date", F.explode(days))
    return out.select(*keys, "date", *(v.alias(k) for k, v in _filled(out, F.col("date") == F.col("_from")).items()))


def with_tiers(df: DataFrame, tiers: DataFrame, keys=KEYS) -> DataFrame:
    """Rows of series that have a tier."""
    return df.join(tiers.select(*keys, "tier_name"), list(keys))


def fold_dim(spark: SparkSession, cfg: Config) -> DataFrame:
    """One row per fold, with its train and validation days and the embargo between them."""
    rows = [(f.fold_id, cfg.data_start, f.train_end, f.val_start, f.val_end, f.val_days, f.embargo_days) for f in cfg.folds]
    return spark.createDataFrame(rows, "fold_id string, train_start date, train_end date, val_start date, val_end date, val_days int, embargo_days int")


def label_folds(df: DataFrame, folds: DataFrame, keep_excluded: bool = False) -> DataFrame:
    """A row per fold that a day belongs to, with ``split_role`` TRAIN or VAL; EXCLUDE days of the embargo go unless kept.

    The folds, a handful of rows of the configuration, are broadcast.
    """
    d = F.col("date")
    role = F.when(d.between(F.col("train_start"), F.col("train_end")), "TRAIN").when(d.between(F.col("val_start"), F.col("val_end")), "VAL").otherwise("EXCLUDE")
    small = F.broadcast(folds.select("fold_id", "train_start", "train_end", "val_start", "val_end"))
    out = df.join(small, (d >= F.col("train_start")) & (d <= F.col("val_end"))).withColumn("split_role", role).drop("train_start", "train_end", "val_start", "val_end")
    return out if keep_excluded else out.filter("split_role <> 'EXCLUDE'")


def audit_lag1(features: DataFrame, y: str = "y", keys=KEYS) -> DataFrame:
    """One row: how many days have a day before in the panel, and how many of these have a lag_1 that differs from it.

    The day before is looked up by its date, in a frame of one day of the calendar, not by place as lags are: what a join of the
    panel with itself shifted gives, without a second panel and its shuffle. Keys or dates that are null have none.
    """
    there = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*keys, "date")])
    day = Window.partitionBy(*keys).orderBy(F.unix_date("date").cast("long")).rangeBetween(-1, -1)
    both = features.filter(there).select("lag_1", F.collect_list(F.struct(F.col(y).alias("v"))).over(day).alias("_before"))
    differ = F.filter("_before", lambda b: ~F.col("lag_1").eqNullSafe(b["v"]))
    return both.agg(F.coalesce(F.sum(F.size("_before")), F.lit(0)).cast("long").alias("checked"), F.coalesce(F.sum(F.size(differ)), F.lit(0)).cast("long").alias("violations"))


def future_panel(series: DataFrame, start: date, horizon: int, keys=KEYS) -> DataFrame:
    """The days to forecast for each series."""
    last = F.date_add(F.lit(start), horizon - 1)
    return series.select(*keys).distinct().withColumn("date", F.explode(F.sequence(F.lit(start), last)))


def calendars(days: DataFrame, key: str, values: list[str]) -> DataFrame:
    """A row per ``key`` (``_key``) with its first day, and for each of the ``values`` an array ``_of_<value>`` with a place for each day from then to
    its last, null where ``days`` (one row per ``key`` and date) has none."""
    gap = F.coalesce(F.datediff("date", F.lag("date").over(Window.partitionBy(key).orderBy("date"))) - 1, F.lit(0))
    rows = days.filter(F.col(key).isNotNull() & F.col("date").isNotNull()).select(F.col(key).alias("_key"), "date", gap.alias("_gap"), *values)
    lists = rows.groupBy("_key").agg(F.min("date").alias("_first"), F.sort_array(F.collect_list(F.struct("date", "_gap", *values))).alias("_list"))

    def places(v: str):
        none = F.lit(None).cast(days.schema[v].dataType)
        return F.flatten(F.transform("_list", lambda x: F.concat(F.array_repeat(none, x["_gap"]), F.array(x[v]))))

    return lists.select("_key", "_first", *(places(v).alias(f"_of_{v}") for v in values))


def join_days(rows: DataFrame, days: DataFrame, key: str, values: list[str]) -> DataFrame:
    """``rows`` left-joined to ``days`` (one row per ``key`` and date) by key and date.

    A key's days become one row, an array with a place for each day of its calendar, and the join is by ``key`` alone: rows that
    are partitioned by it stay where they are, which a join by key and date would not let them.
    """
    out = rows.join(calendars(days, key, values), F.col(key) == F.col("_key"), "left")
    return out.select(*rows.columns, *(F.get(f"_of_{v}", F.datediff("date", "_first")).alias(v) for v in values))


def attach_segment(df: DataFrame, segments: DataFrame, keys=KEYS, column: str = "abc", default: str = "C") -> DataFrame:
    return df.join(segments.select(*keys, column), list(keys), "left").fillna(default, [column])


def join_pred(actual: DataFrame, predicted: DataFrame, keys=(*KEYS, "date")) -> DataFrame:
    return actual.join(predicted, list(keys))


def tier_migration(a: DataFrame, b: DataFrame, keys=KEYS) -> DataFrame:
    """Series by their tier in two as-of tables."""
    left, right = a.select(*keys, F.col("tier_name").alias("tier_from")), b.select(*keys, F.col("tier_name").alias("tier_to"))
    return left.join(right, list(keys)).groupBy("tier_from", "tier_to").agg(F.count("*").alias("n_series"))
