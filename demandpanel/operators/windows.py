"""Features by series. Every frame ends the day before, so no feature sees its own day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from demandpanel.config import KEYS
from demandpanel.functions.columns import clip, flag, ratio
from demandpanel.operators.panel import join_days

NEVER = 999_999


def _w(keys=KEYS):
    return Window.partitionBy(*keys).orderBy("date")


def _past(n: int | None = None, keys=KEYS):
    return _w(keys).rowsBetween(Window.unboundedPreceding if n is None else -n, -1)


def _total(x, n: int, keys=KEYS):
    """Sum of whole numbers over the ``n`` rows before, as the difference of two running sums: a sliding frame adds up all its rows
    again for each row. Exact for whole numbers only. Null counts as 0, as does no row."""
    upto = lambda k: F.coalesce(F.sum(x).over(_w(keys).rowsBetween(Window.unboundedPreceding, -k)), F.lit(0))
    return upto(1) - upto(n + 1)


def _count(x, n: int, keys=KEYS):
    """How many of the ``n`` rows before have a value."""
    return _total(F.when(x.isNotNull(), 1).otherwise(0), n, keys)


def _whole(df: DataFrame, y: str) -> bool:
    return isinstance(df.schema[y].dataType, IntegralType)


def _mean(df: DataFrame, y: str, n: int, keys=KEYS):
    """Mean of the ``n`` rows before, null where there is none."""
    if not _whole(df, y):
        return F.avg(y).over(_past(n, keys))
    return ratio(_total(F.col(y), n, keys), _count(F.col(y), n, keys))


def lags(df: DataFrame, ks=(1, 7, 14, 28, 56), y: str = "y", keys=KEYS) -> DataFrame:
    return df.withColumns({f"lag_{k}": F.lag(y, k).over(_w(keys)) for k in ks})


def rolling(df: DataFrame, wins=(7, 28), aggs=("mean", "sum"), y: str = "y", ddof: int = 0, min_periods: int = 1, otherwise: float | None = None, keys=KEYS) -> DataFrame:
    """Rolling mean, sum, std, min and max of the days before; fewer than ``min_periods`` of them give ``otherwise``."""
    of = {"mean": F.avg, "sum": F.sum, "std": F.stddev_pop if ddof == 0 else F.stddev_samp, "min": F.min, "max": F.max}
    out = {}
    for a in aggs:
        for n in wins:
            value = of[a](y).over(_past(n, keys))
            if a == "mean":
                value = _mean(df, y, n, keys)
            elif a == "sum" and _whole(df, y):
                value = F.when(_count(F.col(y), n, keys) > 0, _total(F.col(y), n, keys))
            if min_periods > 1:
                value = F.when(F.count(y).over(_past(n, keys)) >= min_periods, value).otherwise(F.lit(otherwise))
            out[f"roll_{a}_{n}"] = value
    return df.withColumns(out)


def nz_rate(df: DataFrame, wins=(7, 28), y: str = "y", keys=KEYS) -> DataFrame:
    return df.withColumns({f"nz_rate_{n}": ratio(_total(flag(F.col(y) > 0), n, keys), _total(F.lit(1), n, keys)) for n in wins})


def roll_mean_pos(df: DataFrame, wins=(7, 28), y: str = "y", keys=KEYS) -> DataFrame:
    sold = F.when(F.col(y) > 0, F.col(y))
    mean = lambda n: ratio(_total(sold, n, keys), _count(sold, n, keys)) if _whole(df, y) else F.avg(sold).over(_past(n, keys))
    return df.withColumns({f"roll_mean_pos_{n}": mean(n) for n in wins})


def recency(df: DataFrame, y: str = "y", caps: tuple[int, int, int] | None = None, keys=KEYS) -> DataFrame:
    """Last sale as of yesterday: its date and quantity, the days since (NEVER without one) and the zero run before today.

    ``caps`` holds days since, zero run and quantity at most there.
    """
    day = F.when(F.col(y) > 0, F.col("date"))
    # each window is a column of its own before it is used: Spark computes one anew for every use within an expression
    df = df.withColumns({"last_sale_date_asof": F.max(day).over(_past(None, keys)), "last_sale_qty_asof": F.last(F.when(F.col(y) > 0, F.col(y)), ignorenulls=True).over(_past(None, keys)), "_start": F.min("date").over(Window.partitionBy(*keys))})
    last, qty = F.col("last_sale_date_asof"), F.col("last_sale_qty_asof")
    since = F.when(last.isNull(), NEVER).otherwise(F.datediff("date", last))
    run = F.when(last.isNull(), F.datediff("date", "_start")).otherwise(F.datediff("date", last) - 1)
    if caps:
        since, run, qty = F.least(since, F.lit(caps[0])), F.least(run, F.lit(caps[1])), F.least(qty, F.lit(caps[2]))
    return df.withColumns({"last_sale_qty_asof": qty, "days_since_last_sale_asof": since, "zero_run_length_asof": F.greatest(run, F.lit(0))}).drop("_start")


def dormancy(df: DataFrame, cap: int = 365) -> DataFrame:
    d = F.col("days_since_last_sale_asof")
    bucket = F.when(d <= 7, "D0_7").when(d <= 28, "D8_28").when(d <= 56, "D29_56").when(d <= 182, "D57_182").otherwise("D183_PLUS")
    return df.withColumns({"dormancy_bucket": bucket, "dormancy_capped": F.least(d, F.lit(cap))})


def dormancy_extra(df: DataFrame, stats: DataFrame, keys=KEYS) -> DataFrame:
    """``long_dormancy`` beyond 56 days, last quantity against the positive mean, and days left of the median gap."""
    out = df.join(stats.select(*keys, "median_gap"), list(keys), "left")
    d = F.col("days_since_last_sale_asof")
    return out.withColumns({"long_dormancy": flag(d > 56), "dormancy_burst_factor": ratio(F.col("last_sale_qty_asof"), F.col("roll_mean_pos_28")), "days_to_reactivation_estimate": F.greatest(F.col("median_gap") - d, F.lit(0))}).drop("median_gap")


def log1p_features(df: DataFrame, columns=("y", "lag_7", "roll_mean_7", "roll_mean_28")) -> DataFrame:
    return df.withColumns({f"log1p_{c}": F.log1p(F.greatest(F.coalesce(F.col(c), F.lit(0)), F.lit(0)).cast("double")) for c in columns})


def interactions(df: DataFrame) -> DataFrame:
    """Ratios and differences of lags and rolling means."""
    c = F.col
    return df.withColumns({
        "lag7_over_mean7": ratio(c("lag_7"), c("roll_mean_7") + F.lit(0.1)),
        "lag1_minus_lag7": c("lag_1") - c("lag_7"),
        "trend_7_28": ratio(c("roll_mean_7"), c("roll_mean_28") + F.lit(0.1)),
        "nz_trend": c("nz_rate_7") - c("nz_rate_28"),
        "log_mean_7": F.log1p(F.coalesce("roll_mean_7", F.lit(0.0))),
        "log_mean_28": F.log1p(F.coalesce("roll_mean_28", F.lit(0.0))),
    })


def spike_flag(df: DataFrame, mode: str = "mult", mult: float = 2.0, y: str = "y", keys=KEYS) -> DataFrame:
    """``is_spike`` against the past: ``mult`` y > mult * mean of 28 days (mean over 0.1, y over 1); ``ratio`` the same with 0.1
    added to the mean, and ``spike_ratio``; ``hist`` y > 3 * the positive mean so far and over 5; ``inline`` y > mult * mean."""
    return spike_flags(df, {mode: "is_spike"}, mult, y, keys)


def spike_flags(df: DataFrame, modes: dict[str, str], mult: float = 2.0, y: str = "y", keys=KEYS, sparse: bool = False) -> DataFrame:
    """:func:`spike_flag` for several modes, each with the name of its flag, from one mean.

    ``sparse``: the rows are the days with a fact, ``y`` whole numbers of 0 or more; days between them count as 0 and none of them
    spikes. The 28 days before are then found by date, and their number from the series' first day.
    """
    q, mean, ever, r = F.col(y), F.col("_mean"), F.col("_ever"), F.col("_ratio")
    past = {}
    if set(modes) - {"hist"}:
        by_day = Window.partitionBy(*keys).orderBy(F.unix_date("date").cast("long"))  # one order, one sort
        before = F.sum(y).over(by_day.rangeBetween(-28, -1)), F.least(F.datediff("date", F.min("date").over(by_day)), F.lit(28))
        past["_mean"] = F.coalesce(ratio(F.coalesce(before[0], F.lit(0)), before[1]) if sparse else _mean(df, y, 28, keys), F.lit(0.0))
    if "hist" in modes:
        past["_ever"] = F.avg(F.when(q > 0, q)).over(_past(None, keys))
    of = {"mult": (q > mult * mean) & (mean > 0.1) & (q > 1), "ratio": (r > mult) & (q > 1), "hist": (q > 3 * ever) & (q > 5), "inline": q > mult * mean}
    # the windows are columns before they are used: Spark computes one anew for every use within an expression
    out = df.withColumns(past)
    if "ratio" in modes:
        out = out.withColumn("_ratio", q / (mean + 0.1))
    out = out.withColumns({name: flag(of[mode]) for mode, name in modes.items()})
    return out.select(*(c for c in df.columns if c not in modes.values()), *([r.alias("spike_ratio")] if "ratio" in modes else []), *modes.values())


def store_day_spikes(df: DataFrame, promo: float = 0.15) -> DataFrame:
    """Share of a store's SKUs that spike on a day, and whether that makes a promotion day."""
    out = df.groupBy("store_id", "date").agg(ratio(F.sum("is_spike"), F.count_distinct("sku_id")).alias("store_spike_pct"))
    return out.withColumn("is_promo_day", flag(F.col("store_spike_pct") > promo))


def store_days_of_facts(facts: DataFrame, end: date, promo: float = 0.15, y: str = "y", keys=KEYS) -> DataFrame:
    """:func:`store_day_spikes` of the panel that ends at ``end``, from its days with a fact alone; on the others nothing spikes.

    A series has a panel row on every day from its first fact on, so a store's SKUs of a day are the series begun by then.
    """
    days = spike_flags(facts.filter(F.col("date") <= F.lit(end)).select(*keys, "date", y), {"mult": "is_spike"}, y=y, keys=keys, sparse=True)
    first = F.when(F.row_number().over(_w(keys)) == 1, F.col("sku_id"))
    rows = days.withColumn("_first", first).groupBy("store_id", "date").agg(F.sum("is_spike").alias("_spikes"), F.count("_first").alias("_begun"))
    begun = F.sum("_begun").over(Window.partitionBy("store_id").orderBy("date"))
    out = rows.withColumn("_n", begun).select("store_id", "date", ratio(F.col("_spikes"), F.col("_n")).alias("store_spike_pct"))
    return out.withColumn("is_promo_day", flag(F.col("store_spike_pct") > promo))


def seasonal_lift(df: DataFrame, keys=KEYS, y: str = "y", asof: date | None = None, **also) -> DataFrame:
    """Mean of a week of the year over the key's mean, held to 0.5 to 3, 1 where it has none; from days up to ``asof``. ``also`` names
    other aggregates of the week, made in the same pass."""
    rows = df if asof is None else df.filter(F.col("date") <= F.lit(asof))
    week = rows.groupBy(*keys, F.weekofyear("date").alias("week")).agg(F.avg(y).alias("_week"), F.sum(y).alias("_s"), F.count(y).alias("_n"), *(v.alias(k) for k, v in also.items()))
    w = Window.partitionBy(*keys)
    lift = ratio(F.col("_week"), ratio(F.sum("_s").over(w), F.sum("_n").over(w)))
    return week.withColumn("seasonal_lift", F.coalesce(clip(lift, 0.5, 3.0), F.lit(1.0))).drop("_week", "_s", "_n")


def spike_prob(df: DataFrame, keys=KEYS, asof: date | None = None, weekly: bool = True) -> DataFrame:
    """Share of days with a spike by key and week of the year (or by key), from days up to ``asof``."""
    rows = df if asof is None else df.filter(F.col("date") <= F.lit(asof))
    by = [*keys, F.weekofyear("date").alias("week")] if weekly else list(keys)
    return rows.groupBy(*by).agg(F.avg("is_spike").alias("spike_prob"))


def spike_history(df: DataFrame, keys=KEYS) -> DataFrame:
    """From earlier days: the share with a spike so far, whether one fell into the last 7 or 14, and the flag of 7 days ago."""
    return df.withColumns({
        "spike_prob_expanding": F.avg("is_spike").over(_past(None, keys)),
        "had_recent_spike": flag(_total(F.col("is_spike"), 7, keys) > 0),
        "had_recent_spike_14": flag(_total(F.col("is_spike"), 14, keys) > 0),
        "post_spike": F.coalesce(F.lag("is_spike", 7).over(_w(keys)), F.lit(0)),
    })


def assemble_spikes(df: DataFrame, asof: date | None, keys=KEYS, store_days: DataFrame | None = None) -> DataFrame:
    """Spike features together: store-day share, lift and probability of the series-week, and the series' recent spikes.

    Lift and probability are learned from days up to ``asof``; None, for reports on the past, lets them see the whole range.
    Days partitioned by ``store_id`` alone take no further shuffle. ``store_days``, from :func:`store_days_of_facts`, spares a
    second panel for the stores' shares.
    """
    out = spike_history(df, keys).withColumn("week", F.weekofyear("date"))
    # what a join of seasonal_lift and spike_prob would bring, within the series
    learned = lambda c: F.col(c) if asof is None else F.when(F.col("date") <= F.lit(asof), F.col(c))
    ever, week = Window.partitionBy(*keys), Window.partitionBy(*keys, "week")
    out = out.withColumn("_ever", F.avg(learned("y")).over(ever))
    lift = clip(ratio(F.avg(learned("y")).over(week), F.col("_ever")), 0.5, 3.0)
    out = out.withColumns({"seasonal_lift": lift, "spike_prob": F.avg(learned("is_spike")).over(week)}).drop("_ever")
    out = join_days(out, store_day_spikes(df) if store_days is None else store_days, "store_id", ["store_spike_pct", "is_promo_day"])
    out = out.fillna({"seasonal_lift": 1.0, "spike_prob": 0.0, "store_spike_pct": 0.0, "is_promo_day": 0})
    return out.withColumn("is_seasonal_period", flag(F.col("seasonal_lift") > 1.3))


def classify_spikes(df: DataFrame) -> DataFrame:
    """Why a day spikes: the store's promotion, the season, the weekend, or for itself."""
    kind = F.when(F.col("is_spike") == 0, "NONE").when(F.col("is_promo_day") == 1, "STORE_PROMO").when(F.col("is_seasonal_period") == 1, "SEASONAL").when(F.dayofweek("date").isin(1, 7), "DOW_PATTERN").otherwise("ISOLATED")
    return df.withColumn("spike_class", kind)


def panic_events(df: DataFrame, mult: float = 5.0, y: str = "y", share: float = 0.05, keys=KEYS) -> DataFrame:
    """Panic spikes (over five times the mean, and 3) by store and day; a panic day has over 5 % of the SKUs in one."""
    mean = F.coalesce(_mean(df, y, 28, keys), F.lit(0.0))
    rows = df.withColumn("_panic", flag((F.col(y) / (mean + 0.1) > mult) & (F.col(y) > 3)))
    out = rows.groupBy("store_id", "date").agg(F.sum("_panic").alias("n_panic"), ratio(F.sum("_panic"), F.count_distinct("sku_id")).alias("panic_pct"))
    return out.withColumn("is_store_panic", flag(F.col("panic_pct") > share))


def spike_fit_apply(train: DataFrame, other: DataFrame, keys=KEYS) -> DataFrame:
    """Lift and spike probability learned on training rows, joined to other rows; 1 and 0 where unknown."""
    out = other.withColumn("week", F.weekofyear("date")).join(seasonal_lift(train, keys, spike_prob=F.avg("is_spike")), [*keys, "week"], "left")
    return out.fillna({"seasonal_lift": 1.0, "spike_prob": 0.0})


def gap_features(df: DataFrame, stats: DataFrame, keys=KEYS) -> DataFrame:
    """Days since the last sale against the median gap: ratio, overdue beyond 1.5, and pressure 1 - exp(-ratio / 2)."""
    return with_gaps(df.join(stats.select(*keys, "median_gap"), list(keys), "left"))


def with_gaps(df: DataFrame) -> DataFrame:
    """:func:`gap_features` of rows that have the median gap beside them."""
    r = ratio(F.col("days_since_last_sale_asof"), F.col("median_gap"))
    return df.withColumns({"gap_vs_median": r, "is_overdue": flag(r > 1.5), "gap_pressure": 1 - F.exp(F.lit(-0.5) * r)})


def spike_report(df: DataFrame, y: str = "y") -> DataFrame:
    """Spikes by class: count, share of all days, mean quantity, and how many events (runs of spike days) they form."""
    w = _w()
    rows = df.withColumn("_start", flag((F.col("is_spike") == 1) & (F.coalesce(F.lag("is_spike").over(w), F.lit(0)) == 0)))
    out = rows.groupBy("spike_class").agg(F.count("*").alias("n_days"), F.avg(y).alias("avg_qty"), F.sum("_start").alias("n_events"))
    return out.withColumn("pct_days", F.lit(100.0) * ratio(F.col("n_days"), F.sum("n_days").over(Window.partitionBy())))


def snapshot_features(panel: DataFrame, cutoff: date, days: int = 60, keys=KEYS, y: str = "y") -> DataFrame:
    """What is known of each series at the cutoff, from its last ``days`` days: lags stand at the 28-day mean, sums at 7 and 28
    times it, deviations at 0."""
    rows = panel.filter((F.col("date") <= F.lit(cutoff)) & (F.col("date") > F.date_sub(F.lit(cutoff), days)))
    recent = lambda n: F.avg(F.when(F.col("date") > F.date_sub(F.lit(cutoff), n), F.col(y)))
    out = rows.groupBy(*keys).agg(recent(7).alias("roll_mean_7"), recent(28).alias("roll_mean_28"), F.max_by(y, "date").alias("last_y"), F.avg(y).alias("mean_y"), F.datediff(F.lit(cutoff), F.max(F.when(F.col(y) > 0, F.col("date")))).alias("days_since"), F.avg(F.when(F.col("date") > F.date_sub(F.lit(cutoff), 28), flag(F.col(y) > 0))).alias("nz_rate_28"))
    mean = F.col("roll_mean_28")
    return out.withColumns({**{f"lag_{k}": mean for k in (1, 7, 14, 28)}, "roll_sum_7": mean * 7, "roll_sum_28": mean * 28, "roll_std_28": F.lit(0.0), "days_since": F.coalesce("days_since", F.lit(days))})


def exp3_features(df: DataFrame, asof: date, y: str = "y", keys=KEYS) -> DataFrame:
    """Mean, maximum and sales share of the last seven days; where there are none, the series' mean over days up to ``asof``."""
    ever = F.avg(F.when(F.col("date") <= F.lit(asof), F.col(y))).over(Window.partitionBy(*keys))
    past = _past(7, keys)
    return df.withColumns({"mean_7": F.coalesce(F.avg(y).over(past), ever), "max_7": F.coalesce(F.max(y).over(past).cast("double"), ever), "nz_7": F.coalesce(F.avg(F.when(F.col(y) > 0, 1.0).otherwise(0.0)).over(past), F.lit(0.0))})
