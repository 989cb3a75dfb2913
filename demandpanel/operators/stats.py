"""Statistics by series, tiers, segments and folds."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandpanel.config import KEYS, Config, Fold
from demandpanel.functions.columns import flag, ratio
from demandpanel.operators.ranks import exact_quantiles


def _quantile(p: float, exact: bool):
    return F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY _pos)") if exact else F.percentile_approx("_pos", p, 1000)


def series_stats(facts: DataFrame, asof: date, cfg: Config | None = None, keys=KEYS, qty: str = "sales_clean", exact: bool = False) -> DataFrame:
    """Life cycle, positive-day, intermittency and zero-run statistics of each series as of a day.

    Works on observed days only: unobserved days of the dense panel are zeros, so counts follow from dates and zero
    runs are the gaps between sales days. Gives what the dense panel would, from the facts' rows alone and with one
    shuffle by series.
    """
    cfg = cfg or Config()
    w = Window.partitionBy(*keys).orderBy("date")
    pos = F.when(F.col(qty) > 0, F.col(qty))
    day = F.when(F.col(qty) > 0, F.col("date"))
    rows = facts.filter(F.col("date") <= F.lit(asof)).select(*keys, "date", pos.alias("_pos"), day.alias("_day"))
    rows = rows.withColumn("_gap", F.datediff("_day", F.coalesce(F.max("_day").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.date_sub(F.min("date").over(w.rowsBetween(Window.unboundedPreceding, -1)), 1))) - 1)
    out = rows.groupBy(*keys).agg(
        F.min("date").alias("spine_start"),
        F.min("_day").alias("first_sale_date"),
        F.max("_day").alias("last_sale_date"),
        F.count("_pos").alias("n_pos"),
        F.coalesce(F.sum("_pos"), F.lit(0)).alias("sum_sales"),
        F.max(F.coalesce("_pos", F.lit(0))).alias("max_sales"),
        F.avg("_pos").alias("avg_pos"),
        F.stddev_pop("_pos").alias("std_pos"),
        _quantile(0.5, exact).alias("p50_pos"),
        _quantile(0.9, exact).alias("p90_pos"),
        F.max("_gap").alias("_inner_run"),
    )
    end = F.lit(asof)
    days = F.datediff(end, "spine_start") + 1
    trailing = F.datediff(end, "last_sale_date")
    out = out.withColumn("spine_end", end).withColumn("history_days", days)
    adi = ratio(F.col("history_days"), F.col("n_pos"))
    return out.select(
        *keys,
        "spine_start",
        "spine_end",
        "first_sale_date",
        "last_sale_date",
        "history_days",
        "n_pos",
        "sum_sales",
        "max_sales",
        ratio(F.col("sum_sales"), F.col("history_days")).alias("avg_daily"),
        "avg_pos",
        "std_pos",
        "p50_pos",
        "p90_pos",
        ratio(F.col("n_pos"), F.col("history_days")).alias("nz_rate"),
        adi.alias("adi"),
        F.pow(ratio(F.col("std_pos"), F.col("avg_pos")), 2).alias("cv2"),
        flag(adi >= cfg.intermittent_adi).alias("intermittent_flag"),
        F.greatest(F.coalesce("_inner_run", F.lit(0)), F.coalesce(trailing, F.col("history_days"))).alias("max_zero_run"),
        F.coalesce(trailing, F.lit(0)).alias("last_zero_run"),
        trailing.alias("days_since_last_sale"),
    )


def assign_tier(stats: DataFrame, cfg: Config | None = None) -> DataFrame:
    """``tier_name`` by dormancy and history length, in strict order, and ``t0_reason``."""
    cfg = cfg or Config()
    never, dormant = F.col("n_pos") == 0, F.col("days_since_last_sale") > cfg.dormant_days
    tier = F.when(never | dormant, "T0_EXCLUDED").when(F.col("history_days") >= cfg.mature_days, "T1_MATURE").when(F.col("history_days") >= cfg.growing_days, "T2_GROWING").otherwise("T3_COLD_START")
    return stats.withColumns({"tier_name": tier, "t0_reason": F.when(never, "NEVER_SOLD").when(dormant, f"DORMANT_{cfg.dormant_days}D")})


def tiers_asof(facts: DataFrame, cutoff: date, cfg: Config | None = None, exact: bool = False) -> DataFrame:
    """Tiers from data up to the cutoff only."""
    return assign_tier(series_stats(facts, cutoff, cfg, exact=exact), cfg)


def share_of_count(df: DataFrame, by: list[str], count: str = "n_series") -> DataFrame:
    """Rows by group and their percentage of all."""
    n = df.groupBy(*by).agg(F.count("*").alias(count))
    return n.withColumn("pct_of_total", F.lit(100.0) * ratio(F.col(count), F.sum(count).over(Window.partitionBy())))


def tier_summary(tiers: DataFrame) -> DataFrame:
    return share_of_count(tiers, ["tier_name"])


def tier_intermittent(tiers: DataFrame) -> DataFrame:
    return share_of_count(tiers, ["tier_name", "intermittent_flag"])


def tier_sales(tiers: DataFrame) -> DataFrame:
    """Series, sales and share of sales by tier."""
    out = tiers.groupBy("tier_name").agg(F.count("*").alias("n_series"), F.sum("sum_sales").alias("total_sales"))
    return out.withColumn("pct_of_sales", F.lit(100.0) * ratio(F.col("total_sales"), F.sum("total_sales").over(Window.partitionBy())))


def inactivity_buckets(tiers: DataFrame) -> DataFrame:
    d = F.col("days_since_last_sale")
    bucket = F.when(F.col("n_pos") == 0, "1_never_sold").when(d <= 28, "2_0-28_days").when(d <= 56, "3_29-56_days").when(d <= 182, "4_57-182_days").otherwise("5_>182_days")
    return share_of_count(tiers.withColumn("inactivity", bucket), ["inactivity"])


def tiers_by_cutoff(facts: DataFrame, cutoffs: list[date], cfg: Config | None = None, keys=KEYS, qty: str = "sales_clean") -> DataFrame:
    """Tiers of each series as of each ``cutoff``, from one pass over the facts and one shuffle, however many cutoffs.

    The facts between consecutive cutoffs combine to a small state per series (first day, first and last sale, number and sum
    of sales); states add up, so each cutoff's is the merge of those before it. A series has rows from the first cutoff on
    that does not lie before its first day. Equal to :func:`tiers_asof` at each cutoff, in what tiers need.
    """
    days = sorted(set(cutoffs))
    if not days:
        raise ValueError("no cutoffs")
    sold = F.col(qty) > 0
    # nulls where an interval has no row: minimum and maximum of arrays leave them out
    span = lambda i: (F.col("date") <= F.lit(days[i])) & ((F.col("date") > F.lit(days[i - 1])) if i else F.lit(True))
    each = lambda f: F.array(*(f(span(i)) for i in range(len(days))))
    states = facts.filter(F.col("date") <= F.lit(days[-1])).groupBy(*keys).agg(
        each(lambda c: F.min(F.when(c, F.col("date")))).alias("_from"),
        each(lambda c: F.min(F.when(c & sold, F.col("date")))).alias("_first"),
        each(lambda c: F.max(F.when(c & sold, F.col("date")))).alias("_last"),
        each(lambda c: F.count_if(c & sold)).alias("_n"),
        each(lambda c: F.coalesce(F.sum(F.when(c & sold, F.col(qty))), F.lit(0))).alias("_sum"),
    )
    upto = lambda c: F.slice(c, 1, F.col("_i") + 1)
    total = lambda c: F.aggregate(upto(c), F.lit(0).cast("long"), lambda x, y: x + y.cast("long"))
    rows = states.select("*", F.posexplode(F.array(*(F.lit(d) for d in days))).alias("_i", "cutoff"))
    rows = rows.select(*keys, "cutoff", F.array_min(upto("_from")).alias("spine_start"), F.array_min(upto("_first")).alias("first_sale_date"), F.array_max(upto("_last")).alias("last_sale_date"), total("_n").alias("n_pos"), total("_sum").alias("sum_sales"))
    rows = rows.filter("spine_start IS NOT NULL").withColumn("history_days", F.datediff("cutoff", "spine_start") + 1)
    return assign_tier(rows.withColumn("days_since_last_sale", F.datediff("cutoff", "last_sale_date")), cfg)


def tier_counts_by_fold(facts: DataFrame, cfg: Config) -> DataFrame:
    """Series by fold and tier as of each fold's last training day, all folds in one pass."""
    tiers = tiers_by_cutoff(facts, [f.train_end for f in cfg.folds], cfg).groupBy("cutoff", "tier_name").agg(F.count("*").alias("n_series"))
    folds = F.array(*(F.struct(F.lit(f.fold_id).alias("fold_id"), F.lit(f.train_end).alias("cutoff")) for f in cfg.folds))
    names = F.transform(F.filter(folds, lambda f: f["cutoff"] == F.col("cutoff")), lambda f: f["fold_id"])
    return tiers.select("tier_name", "n_series", F.explode(names).alias("fold_id"))


def fold_counts(labelled: DataFrame, by=("fold_id", "split_role")) -> DataFrame:
    """Rows, series and day range by fold and role."""
    return labelled.groupBy(*by).agg(F.count("*").alias("n_rows"), F.count_distinct(*KEYS).alias("n_series"), F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def fold_eligibility(labelled: DataFrame, y: str = "y", min_days: int = 7, min_positive: int = 1) -> DataFrame:
    """Series by fold with enough training days and sales."""
    train = labelled.filter("split_role = 'TRAIN'").groupBy("fold_id", *KEYS).agg(F.count("*").alias("train_days"), F.count_if(F.col(y) > 0).alias("train_pos"))
    return train.filter((F.col("train_days") >= min_days) & (F.col("train_pos") >= min_positive))


def anchored_split(df: DataFrame, n: int = 28, keys=KEYS) -> DataFrame:
    """The last n days of each series are VAL."""
    last = F.max("date").over(Window.partitionBy(*keys))
    return df.withColumn("split_role", F.when(F.col("date") > F.date_sub(last, n), "VAL").otherwise("TRAIN"))


def make_folds(cutoffs: list[date], weeks: int = 12, embargo_days: int = 0) -> tuple[Fold, ...]:
    """Folds that validate for some weeks after each cutoff."""
    return tuple(Fold(f"C{i + 1}", c, embargo_days + 1, 7 * weeks) for i, c in enumerate(cutoffs))


def ordered_split(df: DataFrame, fraction: float = 0.8) -> DataFrame:
    """The earlier share of the rows is TRAIN: cut at the exact quantile of their dates, not at a global row number."""
    number = F.datediff("date", F.lit(date(1970, 1, 1)))
    # a row per day of the calendar is what the selection sees
    at = exact_quantiles(df, number, [fraction], linear=False).select(F.get("q", F.lit(0))).scalar()
    return df.withColumn("split_role", F.when(number <= at, "TRAIN").otherwise("VAL"))


def abc(df: DataFrame, keys=KEYS, value: str = "y", a: float = 0.80, b: float = 0.95) -> DataFrame:
    """Segment of each key by its place in the cumulative share of the total: up to ``a`` A, up to ``b`` B, else C.

    Totals are sorted downwards, ties by key. The running sum has two levels, so that no task sorts all keys: keys fall
    into buckets of like totals (a sketch's quantiles), each bucket starts at the sum of those before it, and a window
    within the bucket does the rest.
    """
    # dealt once more, one row a key: cuts, starts and result then share this shuffle, else each of them makes the totals anew
    totals = df.groupBy(*keys).agg(F.sum(value).alias("total")).repartition(*keys)
    # one row of 63 numbers
    cuts = totals.agg(F.percentile_approx("total", F.array(*(F.lit(i / 64) for i in range(1, 64))), 10_000).alias("_cuts"))
    totals = totals.crossJoin(F.broadcast(cuts)).withColumn("_b", F.size(F.filter("_cuts", lambda x: x >= F.col("total")))).drop("_cuts")
    sums = totals.groupBy("_b").agg(F.sum("total").alias("_s"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    # at most 64 rows
    starts = sums.select("_b", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_start"), F.sum("_s").over(Window.partitionBy()).alias("_all"))
    inside = Window.partitionBy("_b").orderBy(F.desc("total"), *keys).rowsBetween(Window.unboundedPreceding, 0)
    out = totals.join(F.broadcast(starts), "_b").withColumn("cum_share", ratio(F.col("_start") + F.sum("total").over(inside), F.col("_all")))
    return out.select(*keys, "total", "cum_share", F.when(F.col("cum_share") <= a, "A").when(F.col("cum_share") <= b, "B").otherwise("C").alias("abc"))


def velocity(panel: DataFrame, keys=KEYS, y: str = "y") -> DataFrame:
    """Median days between sales and sales per day of each series with two sales at least, and its velocity segment.

    A sale counts from the second on, over the days from the second sale to the last.
    """
    w = Window.partitionBy(*keys).orderBy("date")
    gaps = panel.filter(F.col(y) > 0).select(*keys, "date", F.datediff("date", F.lag("date").over(w)).alias("_gap")).filter("_gap IS NOT NULL")
    out = gaps.groupBy(*keys).agg(F.count("*").alias("n_sales"), F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY _gap)").alias("median_gap"), ratio(F.count("*"), F.datediff(F.max("date"), F.min("date")) + 1).alias("sale_frequency"))
    f = F.col("sale_frequency")
    return out.withColumn("velocity_segment", F.when(f >= 0.30, "FAST").when(f >= 0.10, "MEDIUM").when(f >= 0.03, "SLOW").otherwise("VERY_SLOW"))


def series_state_stats(panel: DataFrame, cutoff: date, keys=KEYS, y: str = "y", default_gap: float = 7.0) -> DataFrame:
    """Days since the last sale, median gap (exact, 7 without one) and sale frequency up to a day."""
    w = Window.partitionBy(*keys).orderBy("date")
    rows = panel.filter(F.col("date") <= F.lit(cutoff)).withColumn("_d", F.when(F.col(y) > 0, F.col("date")))
    rows = rows.withColumn("_gap", F.datediff("_d", F.max("_d").over(w.rowsBetween(Window.unboundedPreceding, -1))))
    out = rows.groupBy(*keys).agg(F.datediff(F.lit(cutoff), F.max("_d")).alias("days_since_last_sale"), F.coalesce(F.percentile("_gap", 0.5), F.lit(default_gap)).alias("median_gap"), F.count("_d").alias("_n"), F.count("*").alias("_days"))
    return out.withColumn("sale_frequency", ratio(F.col("_n"), F.col("_days"))).drop("_n", "_days")


def store_features(train: DataFrame, y: str = "y") -> DataFrame:
    """Average, share of zeros and weekend to weekday ratio by store."""
    weekend = F.dayofweek("date").isin(1, 7)
    out = train.groupBy("store_id").agg(F.avg(y).alias("store_avg"), F.avg(flag(F.col(y) == 0)).alias("store_zero_rate"), F.avg(F.when(weekend, F.col(y))).alias("_e"), F.avg(F.when(~weekend, F.col(y))).alias("_w"))
    return out.withColumn("store_weekend_ratio", ratio(F.col("_e"), F.col("_w"))).drop("_e", "_w")


def sku_features(train: DataFrame, y: str = "y") -> DataFrame:
    """Average, share of sales days, and average after against before the middle of the SKU's dates."""
    w = Window.partitionBy("sku_id")
    middle = F.date_add(F.min("date").over(w), F.floor(F.datediff(F.max("date").over(w), F.min("date").over(w)) / 2).cast("int"))
    rows = train.withColumn("_late", F.col("date") > middle)
    out = rows.groupBy("sku_id").agg(F.avg(y).alias("sku_avg"), F.avg(flag(F.col(y) > 0)).alias("sku_nz_rate"), F.avg(F.when(F.col("_late"), F.col(y))).alias("_b"), F.avg(F.when(~F.col("_late"), F.col(y))).alias("_a"))
    return out.withColumn("sku_trend", ratio(F.col("_b"), F.col("_a"))).drop("_a", "_b")


def sku_features_of_facts(facts: DataFrame, end: date, y: str = "y", keys=KEYS) -> DataFrame:
    """:func:`sku_features` of the panel that ends at ``end``, from its days with a fact alone.

    A series has a row on each day from its first fact on, so the days of a SKU follow from when its series begin. Facts combine to a row per
    SKU and day of the calendar before they move; the panel would bring all days of a SKU into one task.
    """
    w = Window.partitionBy(*keys).orderBy("date")
    rows = facts.filter(F.col("date") <= F.lit(end)).select(*keys, "date", y, flag(F.row_number().over(w) == 1).alias("_first"))
    days = rows.groupBy("sku_id", "date").agg(F.sum(y).alias("_s"), F.count_if(F.col(y) > 0).alias("_sold"), F.sum("_first").alias("_begun"))
    start = F.min("date").over(Window.partitionBy("sku_id"))
    days = days.withColumn("_middle", F.date_add(start, F.floor(F.datediff(F.lit(end), start) / 2).cast("int")))
    early, upto = F.col("date") <= F.col("_middle"), lambda day: F.greatest(F.datediff(day, "date") + 1, F.lit(0))
    out = days.groupBy("sku_id").agg(F.sum("_s").alias("_s"), F.sum("_sold").alias("_sold"), F.sum(F.col("_begun") * upto(F.lit(end))).alias("_n"), F.sum(F.when(early, F.col("_s")).otherwise(0)).alias("_as"), F.sum(F.col("_begun") * upto("_middle")).alias("_an"))
    before, after = ratio("_as", "_an"), ratio(F.col("_s") - F.col("_as"), F.col("_n") - F.col("_an"))
    return out.select("sku_id", ratio("_s", "_n").alias("sku_avg"), ratio("_sold", "_n").alias("sku_nz_rate"), ratio(after, before).alias("sku_trend"))


def store_sku_features(train: DataFrame, y: str = "y") -> DataFrame:
    return train.groupBy(*KEYS).agg(F.avg(y).alias("store_sku_avg"), F.avg(flag(F.col(y) > 0)).alias("store_sku_nz_rate"))


def hierarchy_features(train: DataFrame, y: str = "y") -> dict[str, DataFrame]:
    """Means above the series, fitted on training rows: by store-week, SKU-day, SKU-week, and effects of weekday and month as
    ratio to the store's or SKU's mean."""
    week = F.trunc("date", "week").alias("week")
    per_day = train.groupBy("sku_id", "date").agg(F.avg(y).alias("sku_avg_across_stores"))
    dow = train.groupBy("store_id", F.dayofweek("date").alias("dow")).agg(F.avg(y).alias("_x"), F.count("*").alias("_n"), F.sum(y).alias("_s"))
    month = train.groupBy("sku_id", F.month("date").alias("month")).agg(F.avg(y).alias("_x"), F.count("*").alias("_n"), F.sum(y).alias("_s"))
    effect = lambda df, k, to: df.withColumn(to, ratio(F.col("_x"), ratio(F.sum("_s").over(Window.partitionBy(k)), F.sum("_n").over(Window.partitionBy(k))))).drop("_x", "_n", "_s")
    return {
        "store_total_weekly": train.groupBy("store_id", week).agg(F.sum(y).alias("store_total_weekly")),
        "sku_avg_across_stores": per_day,
        "sku_total_weekly": train.groupBy("sku_id", week).agg(F.sum(y).alias("sku_total_weekly")),
        "dow_store_effect": effect(dow, "store_id", "dow_store_effect"),
        "month_sku_effect": effect(month, "sku_id", "month_sku_effect"),
    }


def cleaning_report(clean: DataFrame) -> DataFrame:
    """Sales inside and outside the disruption, returns included and clipped."""
    return clean.groupBy("is_covid_period").agg(
        F.count("*").alias("n_rows"), F.avg("sales_raw").alias("avg_raw"), F.stddev_samp("sales_raw").alias("std_raw"), F.sum("sales_raw").alias("sum_raw"), F.sum("sales_clean").alias("sum_clean"),
        F.min("sales_raw").alias("min_raw"), F.max("sales_raw").alias("max_raw"), F.sum("was_negative").alias("n_negative"),
    )


def revival_rates(facts: DataFrame, asof: date, gap: int = 182, horizons=(30, 90, 180), keys=KEYS, qty: str = "sales_clean") -> DataFrame:
    """Of the times that a series had no sale for ``gap`` days, the share that sold again within each horizon after that.

    One row per horizon; events whose horizon is not over by ``asof`` don't count.
    """
    w = Window.partitionBy(*keys).orderBy("date")
    sold = facts.filter((F.col(qty) > 0) & (F.col("date") <= F.lit(asof))).select(*keys, "date", F.lead("date").over(w).alias("_next"))
    dormant = sold.withColumn("_at", F.date_add("date", gap)).filter((F.col("_at") <= F.lit(asof)) & (F.col("_next").isNull() | (F.col("_next") > F.col("_at"))))
    each = dormant.withColumn("horizon", F.explode(F.array(*(F.lit(h) for h in horizons)))).filter(F.date_add("_at", F.col("horizon")) <= F.lit(asof))
    back = F.coalesce(F.col("_next") <= F.date_add("_at", F.col("horizon")), F.lit(False))
    return each.groupBy("horizon").agg(F.count("*").alias("n_events"), F.count_if(back).alias("n_revived"), F.avg(flag(back)).alias("revival_rate"))


def year_folds(spark: SparkSession, last: date, n: int = 3, step: int = 175) -> tuple[Fold, ...]:
    """Folds whose validations end at ``last`` and before it, ``step`` days apart."""
    return tuple(Fold(f"F{i + 1}", last - timedelta(174 + i * step)) for i in range(n))
