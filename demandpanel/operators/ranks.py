"""Exact quantiles by selection: no task sorts or holds all distinct values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges that the distinct values are counted in; one of them is sorted for each wanted rank.
RANGES = 1024


def exact_quantiles(df: DataFrame, value: Column, ps: list[float], linear: bool = True, ranges: int = RANGES) -> DataFrame:
    """One row ``q``: the quantiles of a number at ``ps``, in that order, nulls left out; null without any value.

    ``linear`` interpolates between neighbours (``percentile``); otherwise a quantile is the first value that this share of
    the rows does not exceed (``percentile_disc``).

    Equal values combine to one row with a count before they shuffle. A sketch cuts the distinct values into ranges; the
    ranges' counts, ``ranges`` rows, tell which range a rank lies in and how many rows come before; the values of that range
    alone are sorted. The sketch decides how large a range is, not what comes out.
    """
    counts = df.select(value.alias("x")).filter("x IS NOT NULL").groupBy("x").agg(F.count("*").alias("n"))
    # all uses of the counts read both columns, so that one shuffle serves them
    cuts = counts.agg(F.percentile_approx(F.when(F.col("n") > 0, F.col("x")), [i / ranges for i in range(1, ranges)], 10 * ranges).alias("cuts"))
    # one row of numbers; a value's range is found by bisection
    placed = counts.crossJoin(F.broadcast(cuts)).select("x", "n", _place(F.col("cuts"), F.col("x"), ranges).alias("range"))
    per_range = placed.groupBy("range").agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.sum("n").alias("here"))
    # ``ranges`` rows at most
    upto, everything = Window.orderBy("lo").rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy()
    per_range = per_range.select("lo", "hi", "here", F.sum("here").over(upto).alias("upto"), F.sum("here").over(everything).alias("all"))
    ranks = F.array_distinct(F.flatten(F.array(*(F.array(*_ranks(p, F.col("all"), linear)[:2]) for p in ps))))
    wanted = per_range.select("lo", "hi", (F.col("upto") - F.col("here")).alias("before"), "all", F.explode(F.filter(ranks, lambda r: (r > F.col("upto") - F.col("here")) & (r <= F.col("upto")))).alias("rank"))
    # a row per rank
    near = counts.join(F.broadcast(wanted), F.col("x").between(F.col("lo"), F.col("hi")))
    inside = Window.partitionBy("rank").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    found = near.withColumn("at", F.col("before") + F.sum("n").over(inside)).filter(F.col("at") >= F.col("rank")).groupBy("rank").agg(F.min("x").alias("x"), F.max("all").alias("all"))
    found = found.agg(F.map_from_entries(F.collect_list(F.struct("rank", "x"))).alias("at"), F.max("all").alias("all"))

    def quantile(p: float) -> Column:
        low, high, part = _ranks(p, F.col("all"), linear)
        low, high = F.try_element_at("at", low), F.try_element_at("at", high)
        return low if not linear else (F.lit(1.0) - part) * low + part * high

    return found.select(F.when(F.col("all").isNotNull(), F.array(*map(quantile, ps))).alias("q"))


def _ranks(p: float, n: Column, linear: bool) -> tuple[Column, Column, Column]:
    """The ranks from 1 that a quantile lies between, and its distance from the first."""
    if not linear:
        rank = F.greatest(F.ceil(F.lit(p) * n), F.lit(1)).cast("long")
        return rank, rank, F.lit(0.0)
    at = F.lit(p) * (n - 1)
    return F.floor(at).cast("long") + 1, F.ceil(at).cast("long") + 1, at - F.floor(at)


def _place(cuts: Column, x: Column, ranges: int) -> Column:
    """How many of the ascending ``cuts`` lie below x."""
    steps = F.array(*(F.lit(2**i) for i in reversed(range((ranges - 1).bit_length()))))
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.coalesce(F.get(cuts, at + step - 1) < x, F.lit(False)), at + step).otherwise(at))
