"""Ids as model inputs: ordered target statistics, each row's from earlier days alone."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandpanel.config import KEYS
from demandpanel.operators.panel import join_days


def _days(df: DataFrame, by: list[str], known: Column, y: str) -> DataFrame:
    """Sum ``_s`` and number ``_n`` of the known labels of each day of a group."""
    return df.groupBy(*by, "date").agg(F.sum(F.when(known, F.col(y))).alias("_s"), F.count(F.when(known, F.col(y))).alias("_n"))


def _earlier(days: DataFrame, by: list[str]) -> DataFrame:
    """The same of all days before. Rows have combined to days, so a window holds one row per day of the calendar."""
    before = Window.partitionBy(*by).orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    return days.select(*by, "date", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("_s", "_n")))


def target_statistics(df: DataFrame, cutoff: date, ids: tuple[str, ...] = KEYS, y: str = "y", prior: float = 20.0, rows: DataFrame | None = None, by: tuple[str, ...] = (), cut=None) -> DataFrame:
    """Adds ``te_<id>``: the mean of ``y`` over all rows of the id on earlier days, shrunk to the mean of all rows on earlier days as
    by ``prior`` rows of it. Days after the cutoff see what was known at the cutoff; their own labels count nowhere.

    An id without an earlier day, or null, has the parent's mean; the first day of all, which has no earlier one, has 0.
    Null labels do not count. Rows without a date have 0.

    ``rows`` are those that get the columns, all of ``df`` unless told. Ids that ``df`` is partitioned ``by`` take no shuffle of its rows.
    ``cut`` writes the days of the other ids as tables: the planner then knows which are small and broadcasts them.
    """
    known = F.col("date") <= F.lit(cutoff)
    mean = F.try_divide("_s", "_n").cast("double")
    out = df if rows is None else rows
    own = out.columns
    days = {i: cut(_days(df, [i], known, y)) for i in ids if cut and i not in by}
    # days of an id, null among them, hold all rows' sums
    every = next(iter(days.values())).groupBy("date").agg(F.sum("_s").alias("_s"), F.sum("_n").alias("_n")) if days else _days(df, [], known, y)
    out = out.join(F.broadcast(_earlier(every, []).select("date", mean.alias("_parent"))), "date", "left")  # one row a day
    for i in sorted(ids, key=lambda i: i not in by):
        there = days[i].filter(F.col(i).isNotNull()) if i in days else _days(df.filter(F.col(i).isNotNull()), [i], known, y)
        stats = _earlier(there, [i]).select(i, "date", F.col("_s").alias("_ids"), F.col("_n").alias("_idn"))
        if i in days:
            stats = cut(stats)
        value = (F.coalesce("_ids", F.lit(0)) + F.lit(prior) * F.col("_parent")) / (F.coalesce("_idn", F.lit(0)) + F.lit(prior))
        out = join_days(out, stats, i, ["_ids", "_idn"]) if i in by else out.join(stats, [i, "date"], "left")
        out = out.withColumn(f"te_{i}", F.coalesce(value.cast("double"), F.lit(0.0))).drop("_ids", "_idn")
    return out.select(*own, *(f"te_{i}" for i in ids))
