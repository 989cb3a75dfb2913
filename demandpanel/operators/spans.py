"""Features of every day of the dense panel from its days with a fact, a small part of it.

Between facts little changes: what the last n days hold changes on the day after a sale and n days later. So each fact gives the first days
of a few spans over which all frames hold the same facts. Windows see these rows alone, and only then does each span become its days, with
what the day itself adds (its number, its week). :mod:`~demandpanel.operators.windows` has the same features over the rows of a panel;
tests hold both equal. Quantities are whole numbers of 0 or more, days are numbers from 1970 on.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandpanel.config import KEYS
from demandpanel.functions.columns import clip, flag, ratio
from demandpanel.operators.panel import calendars
from demandpanel.operators.windows import NEVER

#: Lengths of the frames, and the longest lag.
WINS, LONGEST = (7, 28), 56


def _day(d) -> Column:
    return F.unix_date(F.lit(d) if isinstance(d, date) else F.col(d))


def _over(low, high, keys):
    return Window.partitionBy(*keys).orderBy("_from").rangeBetween(low, high)


def spans(facts: DataFrame, end: date, y: str = "y", keys=KEYS, spikes: bool = False, beside: tuple[str, ...] = (), wins: tuple[int, ...] = WINS) -> DataFrame:
    """Rows of ``_from`` to ``_until`` that cover each series from its first fact to ``end``, with what their frames hold. Rows of equal ``_from``
    are alike but that only the last is not empty.

    ``spikes``: the facts have ``is_spike``, whose history is added. ``beside`` columns stay at the fact's own row. Without ``wins`` there is no
    other history, and each fact is one span.
    """
    after = [0, 1, *(n + 1 for n in wins)] if wins else [0]
    ends = F.when(F.col(y) > 0, F.array(*map(F.lit, after))).otherwise(F.array(F.lit(0)))
    # the days that a later day of the span may look up, its own first day among them: listed once a fact, and handed on to the spans after it
    recent = lambda low: Window.partitionBy(*keys).orderBy(_day("date").cast("long")).rangeBetween(low, 0)
    lists = {}
    if wins:
        lists |= {"_sales": F.collect_list(F.when(F.col(y) > 0, _day("date"))).over(recent(-LONGEST)), "_qtys": F.collect_list(F.when(F.col(y) > 0, F.col(y))).over(recent(-LONGEST))}
    if spikes:
        lists["_spike_days"] = F.collect_list(F.when(F.col("is_spike") == 1, _day("date"))).over(recent(-7))
    rows = facts.filter(F.col("date") <= F.lit(end)).withColumns(lists)
    at = rows.select(*keys, _day("date").alias("_at"), F.col(y).alias("_y"), *(["is_spike"] if spikes else []), *beside, *lists, F.explode(ends).alias("_k"))
    own = lambda c: F.when(F.col("_k") == 0, F.col(c))
    rows = at.select(*keys, (F.col("_at") + F.col("_k")).alias("_from"), own("_y").alias("_y"), *([own("is_spike").alias("_spike")] if spikes else []), *(own(c).alias(c) for c in (*beside, *lists))).filter(F.col("_from") <= _day(end))
    always, sold = Window.unboundedPreceding, F.when(F.col("_y") > 0, F.col("_y"))
    sale = F.when(F.col("_y") > 0, F.col("_from"))
    out = {"_until": F.coalesce(F.lead("_from").over(Window.partitionBy(*keys).orderBy("_from")) - 1, _day(end)), "_first": F.min("_from").over(_over(always, 0, keys)), "_now": F.max("_y").over(_over(0, 0, keys))}
    if wins:
        for n in wins:
            out |= {f"_sum{n}": F.sum("_y").over(_over(-n, -1, keys)), f"_sold{n}": F.count(sold).over(_over(-n, -1, keys))}
        month = _over(-28, -1, keys)
        out |= {"_squares": F.sum(F.col("_y") * F.col("_y")).over(month), "_least": F.min(sold).over(month), "_most": F.max("_y").over(month)}
        out |= {"_last": F.max(sale).over(_over(always, -1, keys)), "_qty": F.last(sold, ignorenulls=True).over(_over(always, -1, keys))}
    if spikes:
        count = lambda low, high: F.coalesce(F.sum("_spike").over(_over(low, high, keys)), F.lit(0))
        spiked = F.when(F.col("_spike") == 1, F.col("_from"))
        out |= {"_spiked": count(always, -1), "_spikes": count(0, 0), "_spike_last": F.max(spiked).over(_over(always, -1, keys))}
    return rows.withColumns(out | {c: F.last(c, ignorenulls=True).over(_over(always, 0, keys)) for c in lists})


def each_day(rows: DataFrame, since: date | None = None) -> DataFrame:
    """The days of spans as rows with ``date`` and ``_day``; ``since`` leaves out those before it."""
    rows = rows.withColumn("_start", F.col("_from"))
    if since:
        rows = rows.withColumn("_from", F.greatest("_from", _day(since)))
    rows = rows.filter("_until >= _from").withColumn("_day", F.explode(F.sequence("_from", "_until")))
    return rows.withColumn("date", F.date_from_unix_date("_day"))


def frames() -> dict[str, Column]:
    """What :mod:`~demandpanel.operators.windows` makes by ``lags``, ``rolling``, ``nz_rate``, ``roll_mean_pos``, ``recency`` and ``dormancy``, as columns of
    the rows of :func:`each_day`."""
    c = F.col
    day, age = c("_day"), c("_day") - c("_first")
    opening = c("_day") == c("_start")
    out = {"y": F.when(opening, F.coalesce("_now", F.lit(0))).otherwise(0).cast("long")}
    for k in (1, 7, 14, 28, 56):
        found = F.get("_qtys", F.array_position("_sales", day - k).cast("int") - 1)
        out[f"lag_{k}"] = F.when(age >= k, F.coalesce(found, F.lit(0).cast("long")))
    total = {n: F.coalesce(f"_sum{n}", F.lit(0)) for n in WINS}
    rows = {n: F.least(age, F.lit(n)).cast("long") for n in WINS}
    for n in WINS:
        out |= {f"roll_mean_{n}": ratio(total[n], rows[n]), f"roll_sum_{n}": F.when(age > 0, total[n]), f"nz_rate_{n}": ratio(c(f"_sold{n}"), rows[n]), f"roll_mean_pos_{n}": ratio(c(f"_sum{n}"), c(f"_sold{n}"))}
    n, s = rows[28], total[28]
    out["roll_std_28"] = ratio(F.sqrt((n * F.coalesce("_squares", F.lit(0)) - s * s).cast("double")), n)
    out["roll_min_28"] = F.when(age > 0, F.when(c("_sold28") < n, 0).otherwise(c("_least")))
    out["roll_max_28"] = F.when(age > 0, F.coalesce("_most", F.lit(0)))
    since = F.coalesce(day - c("_last"), F.lit(NEVER))
    bucket = F.when(since <= 7, "D0_7").when(since <= 28, "D8_28").when(since <= 56, "D29_56").when(since <= 182, "D57_182").otherwise("D183_PLUS")
    out |= {"last_sale_date_asof": F.date_from_unix_date("_last"), "last_sale_qty_asof": c("_qty"), "days_since_last_sale_asof": since}
    return out | {"zero_run_length_asof": F.coalesce(day - c("_last") - 1, age), "dormancy_bucket": bucket, "dormancy_capped": F.least(since, F.lit(365))}


def frame_features(facts: DataFrame, end: date, since: date | None = None, y: str = "y", keys=KEYS, beside=None) -> DataFrame:
    """Keys, ``date`` and :func:`frames` of every day from ``since`` on. ``beside`` puts columns of the series next to the spans, before they become days."""
    rows = spans(facts, end, y, keys)
    if since:
        rows = rows.filter(F.col("_until") >= _day(since))
    if beside:
        rows = beside(rows)
    return each_day(rows, since).select(*(c for c in rows.columns if not c.startswith("_")), "date", *(v.alias(k) for k, v in frames().items()))


# spikes


def _iso(day: Column) -> Column:
    """ISO year and week of a day's number, and which day of the week it is, from 1."""
    monday = day - F.pmod(day + 3, F.lit(7))
    return F.struct(F.year(F.date_from_unix_date(monday + 3)).alias("year"), F.weekofyear(F.date_from_unix_date(day)).alias("week"), (day - monday + 1).alias("nth"))


def _long_years(first: Column, last: Column) -> Column:
    """How many of the ISO years from ``first`` to before ``last`` have a 53rd week: those whose 28th of December lies in one."""
    years = F.when(last > first, F.sequence(first, F.greatest(last - 1, first))).otherwise(F.array().cast("array<int>"))
    return F.size(F.filter(years, lambda y: F.weekofyear(F.make_date(y, F.lit(12), F.lit(28))) == 53))


def _week_days(before: Column, last: Column, long_years: Column, week: Column) -> Column:
    """How many days after ``before`` up to ``last`` (as :func:`_iso` has them) lie in an ISO week of this number: the week's days of the years
    between, and of the last years what is over by then."""
    over = lambda d: F.when(week < d["week"], 7).when(week == d["week"], d["nth"]).otherwise(0)
    whole = F.when(week < 53, last["year"] - before["year"]).otherwise(long_years)
    return 7 * whole + over(last) - over(before)


def series_spikes(facts: DataFrame, end: date, asof: date | None = None, keys=KEYS, y: str = "y", wins: tuple[int, ...] = WINS, since: date | None = None) -> DataFrame:
    """A row per series with its spans (``_spans``) and, by week of the year, the lift of its sales (``_lift``) and share of days with a
    spike (``_prob``), both learned from days up to ``asof``. Facts have ``is_spike``. ``since`` leaves out spans that end before it."""
    upto = asof or end
    known = F.col("date") <= F.lit(min(upto, end))
    week = Window.partitionBy(*keys, "_week")
    rows = facts.filter(F.col("date") <= F.lit(end)).withColumn("_week", F.weekofyear("date"))
    sums = F.struct(F.sum(F.when(known, F.col(y))).over(week).alias("s"), F.sum(F.when(known, F.col("is_spike"))).over(week).alias("k"))
    rows = rows.select(*keys, "date", y, "is_spike", F.struct("_week", sums.alias("of")).alias("_by"), F.when(known, F.col(y)).alias("_known"))
    rows = spans(rows, end, y, keys, spikes=True, beside=("_by", "_known"), wins=wins)
    one = F.struct(*(c for c in rows.columns if c not in (*keys, "_first", "_y", "_spike", "_by", "_known")))
    wanted = F.col("_until") >= (F.greatest(F.col("_from"), _day(since)) if since else F.col("_from"))
    out = rows.groupBy(*keys).agg(F.min("_from").alias("_first"), F.collect_list(F.when(wanted, one)).alias("_spans"), F.map_from_entries(F.collect_set("_by")).alias("_weeks"), F.sum("_known").alias("_total"))
    last = _day(min(upto, end))
    ever = ratio(F.coalesce("_total", F.lit(0)), last - F.col("_first") + 1)
    c = F.col
    out = out.withColumns({"_ever": ever, "_before": _iso(c("_first") - 1), "_upto": _iso(last)})
    out = out.withColumn("_long", _long_years(c("_before.year"), c("_upto.year")))
    out = out.withColumn("_week_days", F.transform(F.sequence(F.lit(1), F.lit(53)), lambda w: _week_days(c("_before"), c("_upto"), c("_long"), w)))
    of = lambda i, name: F.coalesce(F.try_element_at("_weeks", i + 1)[name], F.lit(0))
    lift = F.transform("_week_days", lambda n, i: clip(ratio(ratio(of(i, "s"), n), c("_ever")), 0.5, 3.0))
    prob = F.transform("_week_days", lambda n, i: ratio(of(i, "k"), n))
    begun = c("_first") <= last
    return out.select(*keys, "_first", "_spans", F.when(begun, lift).alias("_lift"), F.when(begun, prob).alias("_prob"))


def spike_columns() -> dict[str, Column]:
    """Spike features that :func:`~demandpanel.operators.windows.assemble_spikes` learns within a series, as columns of :func:`each_day`'s rows."""
    c = F.col
    week, opening = F.weekofyear("date") - 1, c("_day") == c("_start")
    lift = F.coalesce(F.get("_lift", week), F.lit(1.0))
    last = c("_day") - F.when(opening | (c("_spikes") == 0), c("_spike_last")).otherwise(c("_start"))
    return {
        "is_spike": F.when(opening, c("_spikes")).otherwise(0), "seasonal_lift": lift, "spike_prob": F.coalesce(F.get("_prob", week), F.lit(0.0)),
        "spike_prob_expanding": ratio(c("_spiked") + F.when(opening, 0).otherwise(c("_spikes")), c("_day") - c("_first")), "had_recent_spike": flag(last <= 7), "had_recent_spike_14": flag(last <= 14),
        "post_spike": flag(F.array_contains("_spike_days", c("_day") - 7)), "is_seasonal_period": flag(lift > 1.3),
    }


def span_days(series: DataFrame, since: date | None = None) -> DataFrame:
    """The days of the rows of :func:`series_spikes`, whatever columns were joined to these."""
    rows = series.withColumn("_span", F.explode("_spans"))
    fields = series.schema["_spans"].dataType.elementType.names
    return each_day(rows.select(*(c for c in series.columns if c != "_spans"), *(F.col(f"_span.{f}").alias(f) for f in fields)), since)


def spike_features(facts: DataFrame, end: date, asof: date | None, store_days: DataFrame, keys=KEYS, y: str = "y") -> DataFrame:
    """:func:`~demandpanel.operators.windows.assemble_spikes` of every day, from facts with ``is_spike``. Series meet their store's days (``store_days``) as one
    row each, before they become days: facts partitioned by ``store_id`` alone take no shuffle."""
    values = ["store_spike_pct", "is_promo_day"]
    rows = series_spikes(facts, end, asof, keys, y, wins=()).join(calendars(store_days, "store_id", values).withColumnsRenamed({"_first": "_opened"}), F.col("store_id") == F.col("_key"), "left")
    more = {v: F.coalesce(F.get(f"_of_{v}", F.col("_day") - F.unix_date("_opened")), F.lit(0)) for v in values}
    return span_days(rows).select(*keys, "date", frames()["y"].alias("y"), *(v.alias(k) for k, v in (spike_columns() | more).items()))
