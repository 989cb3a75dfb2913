"""Queries of forecasts, metrics, gates and summaries, with their SQL."""

from __future__ import annotations

from datetime import date, timedelta
from statistics import NormalDist

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandpanel.config import KEYS
from demandpanel.operators import calendar as C
from demandpanel.operators import eda as E
from demandpanel.operators import forecast as FC
from demandpanel.operators import gates as Q
from demandpanel.operators import metrics as M
from demandpanel.operators import models as ML
from demandpanel.operators import panel as J
from demandpanel.operators import spans as N
from demandpanel.operators import stats as A
from demandpanel.operators import windows as W
from demandpanel.plans.ctes import CALENDAR, CUT, END, FEATURES, FINE, FOLDS, PANEL, SERIES, stats
from demandpanel.plans.queries import ABC_CTE, CUTOFF, KD, SALES, SPIKE, VELOCITY, K, dim, features, fine_tiers, predictions, segments, spikes, spiking, val_predictions, with_closures, written
from demandpanel.plans.registry import query
from demandpanel.sources import testdata as T
from demandpanel.sources.testdata import CFG

Z95 = NormalDist().inv_cdf(0.975)
AFTER, BEFORE = f"date > DATE '{CUTOFF}'", f"date <= DATE '{CUTOFF}'"
ABC_ONLY = ABC_CTE[len(SALES) :]  # follows any list that begins with the sales tables

# forecasts


def demands(spark, sf) -> DataFrame:
    """The days with a fact, which is all that Croston needs of the panel."""
    return T.facts(spark, sf).withColumn("y", F.col("sales_clean"))


@query(KD + "pred_lag7:d pred_roll28:d pred_smart:d", "SELECT * FROM pred", FEATURES)
def f1_f3_baselines(spark, sf):
    return predictions(spark, sf)


CROSTON = PANEL + f""",
dem AS (SELECT *, row_number() OVER ({SERIES} ORDER BY date) AS i, count(*) OVER ({SERIES}) AS n, date_diff('day', lag(date) OVER ({SERIES} ORDER BY date), date) AS g FROM panel WHERE y > 0),
cro AS (SELECT store_id, sku_id, count(*) AS n_demands, sum(y * CASE WHEN i = 1 THEN pow(0.9, n - 1) ELSE 0.1 * pow(0.9, n - i) END) AS z,
  sum(g * CASE WHEN i = 2 THEN pow(0.9, n - 2) WHEN i > 2 THEN 0.1 * pow(0.9, n - i) END) AS p, min(date) AS first_sale, var_pop(y) AS vy, var_pop(g) AS vg, stddev_pop(y) / avg(y) AS cv, avg(g) AS adi, sum(y) AS s FROM dem GROUP BY ALL),
lens AS (SELECT store_id, sku_id, min(date) AS start, count(*) AS n_days FROM panel GROUP BY ALL),
cr AS (SELECT *, coalesce(demand_size / nullif(demand_interval, 0), 0) AS croston_rate, coalesce(demand_size / nullif(demand_interval, 0), 0) * 0.95 AS sba_rate,
  CASE WHEN n_demands < 3 THEN 'moving_average' WHEN adi < 1.32 AND coalesce(cv, 0) < 0.49 THEN 'moving_average' WHEN adi < 1.32 OR coalesce(cv, 0) < 0.49 THEN 'croston' ELSE 'sba' END AS variant
  FROM (SELECT l.store_id, l.sku_id, n_days, coalesce(n_demands, 0) AS n_demands, coalesce(z, 0) AS demand_size, CASE WHEN n_demands IS NULL THEN n_days WHEN n_demands = 1 THEN date_diff('day', start, first_sale) + 1 ELSE p END AS demand_interval, vy, vg, cv, adi, coalesce(s, 0) / n_days AS ma
  FROM lens l LEFT JOIN cro c ON l.store_id = c.store_id AND l.sku_id = c.sku_id)),
cri AS (SELECT *, CASE variant WHEN 'sba' THEN sba_rate WHEN 'croston' THEN croston_rate ELSE ma END AS rate FROM cr),
crb AS (SELECT *, {Z95} * CASE WHEN demand_interval > 0 AND n_demands > 2 THEN rate * sqrt(pow(sqrt(vy) / greatest(demand_size, 1e-6), 2) + pow(sqrt(vg) / greatest(demand_interval, 1e-6), 2)) ELSE greatest(demand_size * 0.5, 0.5) END AS margin FROM cri)"""


@query(K + "n_demands:i demand_size:d demand_interval:d croston_rate:d sba_rate:d variant:s rate:d", "SELECT * FROM cri", CROSTON)
def f4_f6_croston(spark, sf):
    return FC.croston_variant(FC.croston(demands(spark, sf), end=CFG.data_end))


@query(K + "rate:d lower_bound:d upper_bound:d", "SELECT *, greatest(rate - margin, 0) AS lower_bound, rate + margin AS upper_bound FROM crb", CROSTON)
def f7_croston_intervals(spark, sf):
    return FC.croston_intervals(FC.croston_variant(FC.croston(demands(spark, sf), end=CFG.data_end)), "rate")


@query(K + "rate:d lower_bound:d upper_bound:d", "SELECT crb.*, greatest(rate - margin, 0) AS lower_bound, rate + margin AS upper_bound FROM crb JOIN abc USING (store_id, sku_id) WHERE abc = 'C' AND n_days >= 30 AND n_demands >= 3", CROSTON + ABC_ONLY)
def f8_croston_for_segment(spark, sf):
    return FC.croston_for_segment(demands(spark, sf), segments(spark, sf), end=CFG.data_end)


PQ = FEATURES + ABC_ONLY + f""",
pq AS (SELECT f.*, coalesce(abc.abc, 'C') AS abc, coalesce(nz_rate_28, 0) AS p, coalesce(roll_mean_pos_28, 0) AS qty FROM pred f LEFT JOIN abc ON f.store_id = abc.store_id AND f.sku_id = abc.sku_id WHERE date > {CUT}),
pv AS (SELECT *, greatest(p * qty * 1.05, 0) AS yhat FROM pq)"""


def pq(spark, sf) -> DataFrame:
    df = J.attach_segment(val_predictions(spark, sf), segments(spark, sf))
    return df.withColumns({"p": F.coalesce("nz_rate_28", F.lit(0.0)), "qty": F.coalesce("roll_mean_pos_28", F.lit(0.0))})


def pv(spark, sf) -> DataFrame:
    return FC.combine(pq(spark, sf), "ev", smear_factor=1.05)


@query("store_id:s mean_exp:d normal:d clipped:d", "SELECT store_id, avg(exp(r)) AS mean_exp, exp(var_samp(r) * 0.5) AS normal, least(greatest(avg(exp(r)), 0.8), 1.5) AS clipped FROM (SELECT store_id, ln(1 + y) - ln(1 + qty) AS r FROM pq WHERE y > 0) GROUP BY ALL", PQ)
def f10_smearing(spark, sf):
    df = pq(spark, sf).filter("y > 0").withColumn("residual", F.log1p(F.col("y").cast("double")) - F.log1p("qty"))
    a, b, c = FC.smear(df, by=("store_id",)), FC.smear(df, "normal", by=("store_id",)), FC.smear(df, bounds=(0.8, 1.5), by=("store_id",))
    return a.withColumnRenamed("smear", "mean_exp").join(b.withColumnRenamed("smear", "normal"), "store_id").join(c.withColumnRenamed("smear", "clipped"), "store_id")


@query(KD + "threshold:d ev:d soft:d fixed:d", "SELECT *, CASE WHEN p >= 0.2 THEN qty * 1.1 ELSE 0 END AS threshold, p * qty * 1.05 AS ev, p * qty * 1.15 * CASE WHEN p > 0.2 THEN 1.0 ELSE 0.3 END AS soft, CASE abc WHEN 'A' THEN CASE WHEN p >= 0.8 THEN qty * 1.04 ELSE 0 END WHEN 'B' THEN CASE WHEN p >= 0.7 THEN qty * 0.96 ELSE 0 END ELSE CASE WHEN p >= 0.65 THEN qty * 0.8 ELSE 0 END END AS fixed FROM pq", PQ)
def f11_f15b_combinations(spark, sf):
    df = FC.combine(FC.combine(pq(spark, sf), "threshold", threshold=0.2, calibration=1.1, to="threshold"), "ev", smear_factor=1.05, to="ev")
    return FC.combine(FC.combine(df, "soft", threshold=0.2, calibration=1.15, to="soft"), "fixed", to="fixed")


@query(KD + "yhat:d", "SELECT *  EXCLUDE (yhat), CASE WHEN is_store_closed = 1 THEN 0.0 ELSE yhat END AS yhat FROM pv", PQ)
def f14_rules(spark, sf):
    return FC.apply_rules(pv(spark, sf))


@query("abc:s k:d", "SELECT abc, coalesce(least(greatest(sum(y) FILTER (yhat > 0.1) / sum(yhat) FILTER (yhat > 0.1), 0.8), 1.3), 1.0) AS k FROM pv GROUP BY ALL", PQ)
def f15_calibration(spark, sf):
    return FC.calibrate(pv(spark, sf), by=("abc",))


@query("mult:d add:d", "SELECT sum(yhat * least(greatest(my / mp, 0.5), 2.0)) AS mult, sum(greatest(yhat + (my - mp) * 0.5, 0)) AS add FROM pv, (SELECT avg(y) AS my, avg(yhat) AS mp FROM pv)", PQ)
def f16_bias_correction(spark, sf):
    df = pv(spark, sf)
    a, b = FC.bias_correct(df), FC.bias_correct(df, "additive")
    return a.agg(F.sum("yhat_corrected").alias("mult")).crossJoin(b.agg(F.sum("yhat_corrected").alias("add")))


GRID = [0.05, 0.1, 0.2, 0.4, 0.6]
GRID_SQL = ", ".join(f"({g})" for g in GRID)


@query("value:d wmape:d", f"SELECT g AS value, 100.0 * sum(abs(y - CASE WHEN p >= g THEN qty ELSE 0 END)) / sum(y) AS wmape FROM pq, (VALUES {GRID_SQL}) v(g) GROUP BY ALL", PQ)
def f17_tune_threshold(spark, sf):
    return FC.tune_threshold(pq(spark, sf), GRID)


@query("value:d wmape:d", f"SELECT g AS value, 100.0 * sum(abs(y - q)) / sum(y) AS wmape FROM (SELECT store_id, sku_id, date_trunc('week', date) AS w, g, sum(y) AS y, sum(CASE WHEN p >= g THEN qty ELSE 0 END) AS q FROM pq, (VALUES {GRID_SQL}) v(g) GROUP BY ALL) GROUP BY ALL", PQ)
def f17_tune_threshold_weekly(spark, sf):
    return FC.tune_threshold(pq(spark, sf).withColumn("w", F.trunc("date", "week")), GRID, group=(*KEYS, "w"))


@query("value:d wmape:d", f"SELECT g AS value, 100.0 * sum(abs(y - (g * yhat + (1 - g) * pred_roll28))) / sum(y) AS wmape FROM pv, (VALUES {GRID_SQL}) v(g) GROUP BY ALL", PQ)
def f18_tune_blend(spark, sf):
    return FC.tune_blend(pv(spark, sf), GRID, "yhat", "pred_roll28")


@query("abc:s value:d wmape:d", f"SELECT abc, arg_min(g, (wmape, g)) AS value, min(wmape) AS wmape FROM (SELECT abc, g, 100.0 * sum(abs(y - g * yhat)) / sum(y) AS wmape FROM pv, (VALUES {GRID_SQL}) v(g) GROUP BY ALL) GROUP BY ALL", PQ)
def f19_tune_scale(spark, sf):
    return FC.best_value(FC.tune_scale(pv(spark, sf), GRID, by=("abc",)), ("abc",))


@query(K + "dow:i q50:d q75:d q90:d q95:d", f"SELECT store_id, sku_id, dayofweek(date) + 1 AS dow, quantile_cont(y, 0.5) AS q50, quantile_cont(y, 0.75) AS q75, quantile_cont(y, 0.9) AS q90, quantile_cont(y, 0.95) AS q95 FROM panel WHERE date > {END} - 84 GROUP BY ALL", PANEL)
def f23_quantile_forecast(spark, sf):
    return FC.quantile_forecast(T.panel(spark, sf))


@query(K + "dow:i yhat:d", f"SELECT *, CASE WHEN q90 - q50 > q50 * 0.5 THEN 0.7 * q75 + 0.3 * q90 ELSE 0.8 * q50 + 0.2 * q75 END AS yhat FROM (SELECT store_id, sku_id, dayofweek(date) + 1 AS dow, quantile_cont(y, 0.5) AS q50, quantile_cont(y, 0.75) AS q75, quantile_cont(y, 0.9) AS q90 FROM panel WHERE date > {END} - 84 GROUP BY ALL)", PANEL)
def f24_quantile_blend(spark, sf):
    return FC.quantile_blend(FC.quantile_forecast(T.panel(spark, sf)))


@query(KD + "pred_disagg:d pred_uniform:d", f"SELECT v.store_id, v.sku_id, v.date, coalesce(wf, 0) / 7 * coalesce(w, 1) AS pred_disagg, coalesce(wf, 0) / 7 AS pred_uniform FROM (SELECT * FROM panel WHERE date > {CUT}) v LEFT JOIN (SELECT store_id, sku_id, avg(s) AS wf FROM (SELECT store_id, sku_id, date_trunc('week', date) AS wk, sum(y) AS s FROM panel WHERE date <= {CUT} AND date > {CUT} - 28 GROUP BY ALL) GROUP BY ALL) a ON v.store_id = a.store_id AND v.sku_id = a.sku_id LEFT JOIN (SELECT store_id, sku_id, dayofweek(date) AS d, sum(y) / any_value(t) * 7 AS w FROM panel JOIN (SELECT store_id, sku_id, sum(y) AS t FROM panel WHERE date <= {CUT} GROUP BY ALL) USING (store_id, sku_id) WHERE date <= {CUT} GROUP BY ALL) b ON v.store_id = b.store_id AND v.sku_id = b.sku_id AND dayofweek(v.date) = b.d", PANEL)
def f26_disaggregation(spark, sf):
    df = T.panel(spark, sf)
    return FC.disaggregate(df.filter(BEFORE), df.filter(AFTER).select(*KEYS, "date"))


@query(KD + "yhat:d", "SELECT * EXCLUDE (yhat), 0.6 * pred_roll28 + 0.4 * pred_lag7 AS yhat FROM pv", PQ)
def f28_ensemble(spark, sf):
    return FC.ensemble(pv(spark, sf), {"pred_roll28": 0.6, "pred_lag7": 0.4})


@query(KD + "lower_bound:d upper_bound:d", f"SELECT *, greatest(yhat - {Z95} * e, 0) AS lower_bound, yhat + {Z95} * e AS upper_bound FROM (SELECT *, greatest(yhat * CASE abc WHEN 'A' THEN 0.2 WHEN 'B' THEN 0.3 ELSE 0.5 END * (1 + (1 - p) * 0.5), CASE WHEN yhat > 0 THEN 0.5 ELSE 0 END) AS e FROM pv)", PQ)
def f33_intervals(spark, sf):
    return FC.intervals(pv(spark, sf))


@query(K + "yhat:d lower_bound:d upper_bound:d", f"SELECT v.store_id, v.sku_id, sum(CASE WHEN c.rate IS NULL THEN v.yhat ELSE 0.7 * c.rate + 0.3 * v.yhat END) AS yhat, sum(CASE WHEN c.rate IS NULL THEN v.l ELSE least(v.l, greatest(c.rate - c.margin, 0)) END) AS lower_bound, sum(CASE WHEN c.rate IS NULL THEN v.u ELSE greatest(v.u, c.rate + c.margin) END) AS upper_bound FROM (SELECT *, greatest(yhat - {Z95} * e, 0) AS l, yhat + {Z95} * e AS u FROM (SELECT *, greatest(yhat * CASE abc WHEN 'A' THEN 0.2 WHEN 'B' THEN 0.3 ELSE 0.5 END * (1 + (1 - p) * 0.5), CASE WHEN yhat > 0 THEN 0.5 ELSE 0 END) AS e FROM pv)) v LEFT JOIN (SELECT crb.* FROM crb JOIN abc USING (store_id, sku_id) WHERE abc = 'C' AND n_days >= 30 AND n_demands >= 3) c ON v.store_id = c.store_id AND v.sku_id = c.sku_id GROUP BY ALL", PQ + CROSTON[len(PANEL) :])
def f34_blend_c_items(spark, sf):
    df = FC.blend_c_items(FC.intervals(pv(spark, sf)), FC.croston_for_segment(demands(spark, sf), segments(spark, sf), end=CFG.data_end))
    return df.groupBy(*KEYS).agg(*(F.sum(c).alias(c) for c in ("yhat", "lower_bound", "upper_bound")))


SMOOTH = "SELECT store_id, sku_id, date, CASE WHEN m > 0.5 * t AND n > 1 AND t <> 0 THEN CASE WHEN r = 1 THEN v * 0.7 ELSE v + (m - 0.5 * t) / (n - 1) END ELSE v END AS pred_lag7 FROM (SELECT store_id, sku_id, date, pred_lag7 AS v, sum(pred_lag7) OVER w AS t, max(pred_lag7) OVER w AS m, count(*) OVER w AS n, row_number() OVER (PARTITION BY store_id, sku_id, {week} ORDER BY pred_lag7 DESC, date) AS r FROM pred WHERE date > " + CUT + " WINDOW w AS (PARTITION BY store_id, sku_id, {week}))"


@query(KD + "pred_lag7:d", SMOOTH.replace("{week}", "year(date), weekofyear(date)"), FEATURES)
def f35_smooth_weeks(spark, sf):
    return FC.smooth_weeks(val_predictions(spark, sf), "pred_lag7")


@query(KD + "pred_lag7:d", SMOOTH.replace("{week}", "date_trunc('week', date)"), FEATURES)
def f35_smooth_iso_weeks(spark, sf):
    return FC.smooth_weeks(val_predictions(spark, sf), "pred_lag7", iso_year=True)


def rolled(cut: str) -> str:
    """The rule-based rollout as a recursive table: the last 56 quantities of each series, one day more at each step."""
    return PANEL + f""",
days AS (SELECT store_id, sku_id, k, coalesce(CAST(y AS DOUBLE), 0.0) AS y FROM (SELECT DISTINCT store_id, sku_id FROM panel WHERE date <= {cut} AND date > {cut} - 56) CROSS JOIN range(56) r(k) LEFT JOIN (SELECT store_id, sku_id, y, date_diff('day', date, {cut}) AS k FROM panel) USING (store_id, sku_id, k)),
state AS (SELECT store_id, sku_id, list(y ORDER BY k DESC) AS h FROM days GROUP BY ALL),
roll AS (WITH RECURSIVE r AS (SELECT store_id, sku_id, h, -1 AS k, CAST(NULL AS DOUBLE) AS yhat FROM state
  UNION ALL SELECT store_id, sku_id, list_append(h[2:], v), k + 1, v FROM (SELECT *, CASE WHEN len(list_filter(h[2:], lambda x: x > 0)) = 0 THEN 0.0 ELSE 0.5 * list_avg(h[50:]) + 0.5 * list_avg(h[29:]) END AS v FROM r WHERE k < {CFG.horizon - 1}))
  SELECT store_id, sku_id, {cut} + 1 + CAST(k AS INT) AS date, yhat FROM r WHERE k >= 0)"""


@query(K + "n:i total:d peak:d", "SELECT store_id, sku_id, count(*) AS n, sum(yhat) AS total, max(yhat) AS peak FROM roll GROUP BY ALL", rolled(CUT))
def f29_f30_recursive_forecast(spark, sf):
    state = FC.series_state(T.panel(spark, sf), CUTOFF)
    return FC.recursive_forecast(state, CUTOFF + timedelta(1), CFG.horizon).groupBy(*KEYS).agg(F.count("*").alias("n"), F.sum("yhat").alias("total"), F.max("yhat").alias("peak"))


LAGS = ["lag_7", "lag_28", "roll_mean_7", "roll_mean_28", "nz_rate_28"]
ML_FEATURES = [*LAGS, "days_since_last_sale_asof"]
SPIKES = ["had_recent_spike", "spike_prob_expanding", "seasonal_lift", "spike_prob"]
GAPS = ["gap_vs_median", "is_overdue", "gap_pressure"]
#: Days before the cutoff that models are fitted on: a bound on the rows of a fit.
FIT_DAYS = 364


def spike_rows(spark, sf, since: date, until: date, beside) -> DataFrame:
    """Features of the days from ``since`` on, with those of spikes and velocity, learned from all days up to the cutoff. Series are rows until they
    have all that is known of them."""
    known = A.velocity(T.days(spark, sf).filter(F.col("date") <= F.lit(CUTOFF)))
    series = N.series_spikes(spiking(spark, sf), until, CUTOFF, since=since).join(known.select(*KEYS, "median_gap"), list(KEYS), "left")
    rows = beside(series)
    days = N.span_days(rows, since)
    days = days.select(*(c for c in rows.columns if not c.startswith("_")), "date", *(v.alias(k) for k, v in (N.frames() | N.spike_columns()).items()))
    return with_closures(spark, W.with_gaps(days))


def ml_rows(spark, sf, more: bool = False, fit_days: int = FIT_DAYS, val: bool = True, group=None) -> tuple[DataFrame, DataFrame]:
    """The last ``fit_days`` training days and the validation days (none unless ``val``), with ``more`` spike and velocity features too,
    all of them learned from training days. ``group`` puts another group beside the rows than the segment ``abc``."""
    # days of validation are not learned from: without them the panel ends at the cutoff
    until, since = None if val else CUTOFF, CUTOFF - timedelta(fit_days - 1)
    beside = group or (lambda df: J.attach_segment(df, segments(spark, sf)))
    names = [*ML_FEATURES, *SPIKES, *GAPS] if more else ML_FEATURES
    df = spike_rows(spark, sf, since, until or CFG.data_end, beside) if more else features(spark, sf, since=since, until=until, beside=beside)
    kept = {*KEYS, "date", "y", "is_store_closed", *names, "abc", "tier_name"}
    df = df.select(*(c for c in df.columns if c in kept))
    df = written(spark, df.filter(F.col("date") > F.date_sub(F.lit(CUTOFF), fit_days)))
    return df.filter(F.col("date") <= F.lit(CUTOFF)), df.filter(AFTER)


@query("abc:s n:i total:d")
def f9_f12_two_stage_by_segment(spark, sf):
    train, val = ml_rows(spark, sf)
    models = ML.fit_segments(train, ML_FEATURES, trees=5, depth=4)
    out = FC.apply_rules(ML.predict_segments(models, val))
    return out.groupBy("abc").agg(F.count("*").alias("n"), F.sum("yhat").alias("total"))


@query("n:i wmape:d bias_pct:d")
def f20_direct_model(spark, sf):
    train, val = ml_rows(spark, sf, group=lambda df: df)
    return M.metrics(ML.predict_direct(ML.fit_direct(train, ML_FEATURES, trees=5, depth=4), val, ML_FEATURES), ["yhat"], which=["n", "wmape", "bias_pct"])


@query("n:i wmape:d bias_pct:d")
def f22_tweedie(spark, sf):
    train, val = ml_rows(spark, sf, group=lambda df: df)
    return M.metrics(ML.predict_direct(ML.fit_tweedie(train, ML_FEATURES), val, ML_FEATURES, log=False), ["yhat"], which=["n", "wmape", "bias_pct"])


@query("n:i wmape:d bias_pct:d")
def f25_forest_two_stage(spark, sf):
    train, val = ml_rows(spark, sf, group=lambda df: df)
    m = ML.fit_two_stage(train, ML_FEATURES, kind="forest", trees=5, depth=5)
    return M.metrics(FC.combine(m.transform(val), "threshold", threshold=0.5), ["yhat"], which=["n", "wmape", "bias_pct"])


@query("feature_set:s n:i wmape:d bias_pct:d")
def f40_f41_ablation(spark, sf):
    """The same rows with and without spike features, velocity features, both, and these alone."""
    train, val = ml_rows(spark, sf, more=True)
    sets = {"baseline": ML_FEATURES, "spike": [*ML_FEATURES, *SPIKES], "velocity": [*ML_FEATURES, *GAPS], "both": [*ML_FEATURES, *SPIKES, *GAPS], "alone": [*SPIKES, *GAPS]}
    return ML.ablate(train, val, sets, trees=3, depth=3)


# metrics

METRICS_SQL = """count(*) AS n, avg(e) AS mae, CASE WHEN sum(y) <> 0 THEN 100.0 * sum(e) / sum(y) END AS wmape, CASE WHEN sum(y) <> 0 THEN 100.0 - 100.0 * sum(e) / sum(y) END AS wfa,
sqrt(avg(pow(ln(1 + y) - ln(1 + greatest(p, 0)), 2))) AS rmsle, sqrt(avg(pow(y - p, 2))) AS rmse, 100.0 * avg(CASE WHEN y > 0 THEN e / y END) AS mape_nonzero,
1 - sum(pow(y - p, 2)) / nullif(sum(pow(y, 2)) - pow(sum(y), 2) / count(*), 0) AS r2, 100.0 * (sum(p) - sum(y)) / nullif(sum(y), 0) AS bias_pct, sum(p) / nullif(sum(y), 0) AS bias_ratio,
avg(CAST(y = 0 AND p < 0.5 AS INT)) AS zero_acc, avg(CASE WHEN y > 0 THEN e END) AS mae_nonzero, avg(CASE WHEN y > 0 THEN p - y END) AS bias_nonzero, avg(CAST((y > 0) = (p > 0.5) AS INT)) AS sale_accuracy,
count(*) FILTER (y > 0 AND p > 0.5) / nullif(count(*) FILTER (p > 0.5), 0) AS precision, count(*) FILTER (y > 0 AND p > 0.5) / nullif(count(*) FILTER (y > 0), 0) AS recall,
2.0 * count(*) FILTER (y > 0 AND p > 0.5) / nullif(count(*) FILTER (p > 0.5) + count(*) FILTER (y > 0), 0) AS f1, 100.0 * avg(CASE WHEN y >= 2 THEN CAST(e <= 0.5 * y AS INT) END) AS within_50, 100.0 * avg(CASE WHEN y >= 2 THEN CAST(e <= 0.3 * y AS INT) END) AS within_30"""
MODELS = ["pred_lag7", "pred_roll28", "pred_smart"]
LONG = FEATURES + ",\nlongp AS (SELECT *, abs(y - p) AS e FROM (" + " UNION ALL ".join(f"SELECT store_id, sku_id, date, dormancy_bucket, y, '{m}' AS model, {m} AS p FROM pred WHERE date > {CUT}" for m in MODELS) + "))"
METRIC_COLUMNS = "n:i mae:d wmape:d wfa:d rmsle:d rmse:d mape_nonzero:d r2:d bias_pct:d bias_ratio:d zero_acc:d mae_nonzero:d bias_nonzero:d sale_accuracy:d precision:d recall:d f1:d within_50:d within_30:d"


@query("model:s " + METRIC_COLUMNS, f"SELECT model, {METRICS_SQL} FROM longp GROUP BY ALL", LONG)
def m1_m10_metrics(spark, sf):
    return M.metrics(val_predictions(spark, sf), MODELS)


@query("model:s dormancy_bucket:s " + METRIC_COLUMNS, f"SELECT model, dormancy_bucket, {METRICS_SQL} FROM longp GROUP BY ALL", LONG)
def m2_metrics_by_dormancy(spark, sf):
    return M.metrics(val_predictions(spark, sf), MODELS, ("dormancy_bucket",))


TIERED = LONG + ",\n" + stats("panel", CUT, "known")


@query("model:s tier_name:s n:i wmape:d bias_pct:d", "SELECT model, tier_name, count(*) AS n, CASE WHEN sum(y) <> 0 THEN 100.0 * sum(e) / sum(y) END AS wmape, 100.0 * (sum(p) - sum(y)) / nullif(sum(y), 0) AS bias_pct FROM longp JOIN known USING (store_id, sku_id) GROUP BY ALL", TIERED)
def m2_metrics_by_tier(spark, sf):
    tiers = A.tiers_asof(T.facts(spark, sf), CUTOFF, CFG)
    return M.metrics(J.with_tiers(val_predictions(spark, sf), tiers), MODELS, ("tier_name",), ["n", "wmape", "bias_pct"])


@query("model:s n:i zero_acc:d bias_nonzero:d", "SELECT model, count(*) AS n, avg(CASE WHEN y = 0 THEN CAST(p < 0.5 AS INT) END) AS zero_acc, avg(CASE WHEN y > 0 THEN p - y END) AS bias_nonzero FROM longp GROUP BY ALL", LONG)
def m4_zero_rows_only(spark, sf):
    return M.metrics(val_predictions(spark, sf), MODELS, which=["n", "zero_acc", "bias_nonzero"], zero_mode="zero")


@query("store_id:s p50_error:d p90_error:d p99_error:d", "SELECT store_id, quantile_cont(e, 0.5) AS p50_error, quantile_cont(e, 0.9) AS p90_error, quantile_cont(e, 0.99) AS p99_error FROM longp WHERE model = 'pred_smart' GROUP BY ALL", LONG)
def m8_error_percentiles(spark, sf):
    return M.error_percentiles(val_predictions(spark, sf), "pred_smart", by=("store_id",))


LEVELS = PQ + ",\nwk AS (SELECT store_id, sku_id, abc, year(date) AS yr, weekofyear(date) AS w, sum(y) AS y, sum(pred_smart) AS p FROM pq GROUP BY ALL)"
LEVEL_SQL = "count(*) AS n, 100.0 * sum(abs(y - p)) / sum(y) AS wmape, 100.0 - 100.0 * sum(abs(y - p)) / sum(y) AS wfa, 100.0 * (sum(p) - sum(y)) / sum(y) AS bias_pct"


@query("level:s n:i wmape:d wfa:d bias_pct:d", "SELECT 'daily' AS level, " + LEVEL_SQL + " FROM (SELECT y, pred_smart AS p FROM pq)" + "".join(f" UNION ALL SELECT '{name}' AS level, {LEVEL_SQL} FROM (SELECT sum(y) AS y, sum(p) AS p FROM wk {where} GROUP BY {by})" for name, where, by in (("weekly_sku_store", "", "store_id, sku_id, yr, w"), ("weekly_sku_store_a", "WHERE abc = 'A'", "store_id, sku_id, yr, w"), ("weekly_sku", "", "sku_id, yr, w"), ("weekly_store", "", "store_id, yr, w"), ("weekly_total", "", "yr, w"))), LEVELS)
def m9_accuracy_levels(spark, sf):
    return M.accuracy_levels(pq(spark, sf), "pred_smart")


@query("model:s abc:s mae:d wmape:d wfa:d", "SELECT 'pred_smart' AS model, abc, avg(abs(y - pred_smart)) AS mae, 100.0 * sum(abs(y - pred_smart)) / sum(y) AS wmape, 100.0 - 100.0 * sum(abs(y - pred_smart)) / sum(y) AS wfa FROM pq GROUP BY ALL", PQ)
def m11_metrics_by_abc(spark, sf):
    return M.metrics(pq(spark, sf), ["pred_smart"], ("abc",), ["mae", "wmape", "wfa"])


@query("model:s wmape:d lift_pp:d lift_pct:d", "SELECT model, w AS wmape, b - w AS lift_pp, 100.0 * (b - w) / b AS lift_pct FROM (SELECT model, 100.0 * sum(e) / sum(y) AS w FROM longp GROUP BY ALL), (SELECT 100.0 * sum(e) / sum(y) AS b FROM longp WHERE model = 'pred_lag7')", LONG)
def m12_lift(spark, sf):
    return M.lift(M.metrics(val_predictions(spark, sf), MODELS, which=["wmape"]), "pred_lag7")


@query("abc:s is_extreme:i n:i abs_error:d sales:i error_share:d sales_share:d", "SELECT abc, x AS is_extreme, count(*) AS n, sum(e) AS abs_error, sum(y) AS sales, 100.0 * sum(e) / sum(sum(e)) OVER () AS error_share, 100.0 * sum(y) / sum(sum(y)) OVER () AS sales_share FROM (SELECT abc, y, abs(y - pred_smart) AS e, CAST(y > t AS INT) AS x FROM pq JOIN (SELECT store_id, sku_id, quantile_cont(y, 0.99) AS t FROM pq GROUP BY ALL) USING (store_id, sku_id)) GROUP BY ALL", PQ)
def m13_error_decomposition(spark, sf):
    return M.error_decomposition(pq(spark, sf), "pred_smart")


@query("zero_error:d nonzero_error:d zero_error_pct:d", "SELECT sum(e) FILTER (y = 0) AS zero_error, sum(e) FILTER (y <> 0) AS nonzero_error, 100.0 * sum(e) FILTER (y = 0) / sum(e) AS zero_error_pct FROM longp WHERE model = 'pred_smart'", LONG)
def m14_zero_error_share(spark, sf):
    return M.zero_error_share(val_predictions(spark, sf), "pred_smart")


@query("n_series:i wmape_new:d wmape_old:d pct_improved:d median_improvement:d", f"SELECT count(*) AS n_series, sum(a * v) / sum(v) AS wmape_new, sum(b * v) / sum(v) AS wmape_old, 100.0 * avg(CAST(a < b AS INT)) AS pct_improved, quantile_cont(b - a, 0.5) AS median_improvement FROM (SELECT store_id, sku_id, sum(y) AS v, 100.0 * sum(abs(y - pred_smart)) / sum(y) AS a, 100.0 * sum(abs(y - pred_lag7)) / sum(y) AS b FROM pred WHERE date > {CUT} GROUP BY ALL HAVING sum(y) > 0)", FEATURES)
def m15_series_improvement(spark, sf):
    return M.series_improvement(val_predictions(spark, sf), "pred_smart", "pred_lag7")


@query("coverage_pred_lag7:d coverage_pred_roll28:d", f"SELECT avg(CAST(y <= pred_lag7 AS INT)) AS coverage_pred_lag7, avg(CAST(y <= pred_roll28 AS INT)) AS coverage_pred_roll28 FROM pred WHERE date > {CUT}", FEATURES)
def m16_coverage(spark, sf):
    return M.coverage(val_predictions(spark, sf), ["pred_lag7", "pred_roll28"])


@query("model:s n:i wmape:d bias_pct:d", "SELECT model, count(*) AS n, 100.0 * sum(abs(y - p)) / sum(y) AS wmape, 100.0 * (sum(p) - sum(y)) / sum(y) AS bias_pct FROM (SELECT model, store_id, sku_id, date_trunc('week', date) AS w, sum(y) AS y, sum(p) AS p FROM longp GROUP BY ALL) GROUP BY ALL", LONG)
def m17_compare_weekly(spark, sf):
    return M.compare_models(val_predictions(spark, sf), MODELS)


FOLD_METRICS = "SELECT fold_id, model, 100.0 * sum(e) / sum(y) AS wmape FROM (" + " UNION ALL ".join(f"SELECT '{f.fold_id}' AS fold_id, '{m}' AS model, y, abs(y - {m}) AS e FROM pred WHERE date BETWEEN DATE '{f.val_start}' AND DATE '{f.val_end}'" for f in CFG.folds for m in MODELS) + ") GROUP BY ALL"


@query("model:s n_folds:i mean_wmape:d std_wmape:d spread_wmape:d", f"SELECT model, count(*) AS n_folds, avg(wmape) AS mean_wmape, stddev_samp(wmape) AS std_wmape, max(wmape) - min(wmape) AS spread_wmape FROM ({FOLD_METRICS}) GROUP BY ALL", FEATURES)
def m18_validate_folds(spark, sf):
    rows = J.label_folds(predictions(spark, sf, min(f.val_start for f in CFG.folds)), J.fold_dim(spark, CFG)).filter("split_role = 'VAL'")
    return M.validate_folds(M.metrics(rows, MODELS, ("fold_id",), ["wmape"]))


@query("model:s wmape:d", "SELECT arg_min(model, (round(w, 9), model)) AS model, min(w) AS wmape FROM (SELECT model, 100.0 * sum(e) / sum(y) AS w FROM longp GROUP BY ALL)", LONG)
def m19_best_candidate(spark, sf):
    return M.best_candidate(M.metrics(val_predictions(spark, sf), MODELS, which=["wmape"]))


@query("dormancy_bucket:s train_wmape:d val_wmape:d gap:d", f"SELECT dormancy_bucket, t AS train_wmape, v AS val_wmape, v - t AS gap FROM (SELECT dormancy_bucket, 100.0 * sum(abs(y - pred_smart)) FILTER (date <= {CUT}) / nullif(sum(y) FILTER (date <= {CUT}), 0) AS t, 100.0 * sum(abs(y - pred_smart)) FILTER (date > {CUT}) / nullif(sum(y) FILTER (date > {CUT}), 0) AS v, count(*) FILTER (date > {CUT}) AS n FROM pred GROUP BY ALL) WHERE n > 0", FEATURES)
def m20_fit_gap(spark, sf):
    df = predictions(spark, sf).withColumn("split_role", F.when(F.expr(BEFORE), "TRAIN").otherwise("VAL"))
    return M.fit_gap_by_role(M.metrics(df, ["pred_smart"], ("dormancy_bucket", "split_role"), ["wmape"]), "dormancy_bucket")


# gates

GATE = "gate:s value:d status:s"


def check(gate: str, value: str, table: str) -> str:
    return f"SELECT '{gate}' AS gate, CAST(coalesce({value}, 0) AS DOUBLE) AS value, CASE WHEN coalesce({value}, 0) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM {table}"


def info(gate: str, value: str, table: str) -> str:
    return f"SELECT '{gate}' AS gate, CAST(coalesce({value}, 0) AS DOUBLE) AS value, 'INFO' AS status FROM {table}"


def both(*rows: str) -> str:
    return " UNION ALL ".join(rows)


BUCKETS = ("D0_7", "D8_28", "D29_56", "D57_182", "D183_PLUS")


@query(GATE, both(*(check(f"null_{k}", f"count(*) FILTER ({k} IS NULL)", "sales") for k in (*KEYS, "date")), info("rows", "count(*)", "sales")), SALES)
def q1_gate_nulls(spark, sf):
    return Q.gate_nulls(T.sales(spark, sf))


@query(GATE, check("duplicate_keys", "count(*)", "(SELECT 1 FROM sales GROUP BY store_id, sku_id, date HAVING count(*) > 1)"), SALES)
def q2_gate_unique(spark, sf):
    return Q.gate_unique(T.sales(spark, sf))


@query(GATE, both(check("negative_clean", "count(*) FILTER (sales_clean < 0)", "clean"), check("clean_above_raw", "count(*) FILTER (sales_clean > greatest(sales_raw, 0))", "clean"), *(info(f, f"sum({f})", "clean") for f in ("was_negative", "is_covid_period", "is_covid_panic_spike", "is_extreme_spike"))), SALES)
def q3_gate_clean(spark, sf):
    return Q.gate_clean(T.facts(spark, sf))


@query(GATE, both(
    check("row_count_difference", "n - d", f"(SELECT count(*) AS n FROM panel), (SELECT sum(date_diff('day', first_date, {END}) + 1) AS d FROM pairs)"),
    check("pairs_with_gaps", "count(*) FILTER (n <> date_diff('day', a, z) + 1)", "(SELECT count(*) AS n, min(date) AS a, max(date) AS z FROM panel GROUP BY store_id, sku_id)"),
    info("panel_rows", "count(*)", "panel"),
), PANEL)
def q4_gate_spine(spark, sf):
    return Q.gate_spine(T.panel(spark, sf), J.active_pairs(T.facts(spark, sf)), CFG.data_end)


@query(GATE, both(
    check("observed_value_differs", "count(*) FILTER (a IS DISTINCT FROM b)", "(SELECT p.sales_clean AS a, c.sales_clean AS b FROM (SELECT * FROM panel WHERE is_observed = 1) p FULL JOIN clean c ON p.store_id = c.store_id AND p.sku_id = c.sku_id AND p.date = c.date)"),
    check("filled_null_or_negative", "count(*) FILTER (sales_filled IS NULL OR sales_filled < 0)", "panel"),
    check("unobserved_contract", "count(*) FILTER (is_observed = 0 AND (sales_raw IS NOT NULL OR sales_filled <> 0 OR was_negative <> 0))", "panel"),
    info("observed_rows", "sum(is_observed)", "panel"),
    info("filled_rows", "count(*) FILTER (is_observed = 0)", "panel"),
), PANEL)
def q5_gate_panel(spark, sf):
    return Q.gate_panel(T.panel(spark, sf), T.facts(spark, sf))


@query(GATE, both(
    check("duplicate_days", "count(*) - count(DISTINCT date)", "dim"),
    check("missing_days", "date_diff('day', min(date), max(date)) + 1 - count(*)", "dim"),
    info("calendar_days", "count(*)", "dim"),
    check("duplicate_closures", "count(*) - count(DISTINCT closure_date)", "closed"),
    info("closures", "count(*)", "closed"),
    check("rows_without_calendar", "count(*) FILTER (dow IS NULL)", "panel LEFT JOIN dim USING (date)"),
    info("closed_rows", "count(*)", "panel JOIN closed ON date = closure_date"),
), PANEL + ",\n" + CALENDAR)
def q6_gate_calendar(spark, sf):
    d, c = dim(spark), C.closure_dim(spark, CFG)
    return Q.gate_calendar(d, c, C.enrich(T.panel(spark, sf), d, c))


@query(GATE, both(
    check("t0_without_reason", "count(*) FILTER (tier_name = 'T0_EXCLUDED' AND t0_reason IS NULL)", "stats"),
    check("reason_without_t0", "count(*) FILTER (tier_name <> 'T0_EXCLUDED' AND t0_reason IS NOT NULL)", "stats"),
    check("t0_logic", f"count(*) FILTER ((tier_name = 'T0_EXCLUDED') <> (n_pos = 0 OR coalesce(days_since_last_sale > {CFG.dormant_days}, false)))", "stats"),
    check("threshold_logic", f"count(*) FILTER (tier_name <> 'T0_EXCLUDED' AND tier_name <> CASE WHEN history_days >= {CFG.mature_days} THEN 'T1_MATURE' WHEN history_days >= {CFG.growing_days} THEN 'T2_GROWING' ELSE 'T3_COLD_START' END)", "stats"),
    info("series", "count(*)", "stats"),
), FINE)
def q7_gate_tiers(spark, sf):
    return Q.gate_tiers(fine_tiers(spark, sf), CFG)


@query(GATE, both(
    *(info(f"rows_without_lag_{k}", f"count(*) FILTER (lag_{k} IS NULL)", "feat") for k in (1, 28)),
    info("pct_with_lag_7", "100.0 * count(lag_7) / count(*)", "feat"),
    check("lag_1_violations", "count(*) FILTER (f.lag_1 IS DISTINCT FROM g.y)", "feat f JOIN panel g ON f.store_id = g.store_id AND f.sku_id = g.sku_id AND f.date = g.date + 1"),
    info("lag_1_checked", "count(*)", "feat f JOIN panel g ON f.store_id = g.store_id AND f.sku_id = g.sku_id AND f.date = g.date + 1"),
), FEATURES)
def q8_gate_lags(spark, sf):
    df = W.lags(T.panel(spark, sf))
    return Q.gate_lags(df, J.audit_lag1(df))


@query(GATE, both(
    check("sin_cos_doy", "count(*) FILTER (abs(pow(sin(a), 2) + pow(cos(a), 2) - 1) > 1e-9)", "(SELECT 2 * pi() * dayofyear(date) / 365.25 AS a FROM panel)"),
    check("sin_cos_dow", "count(*) FILTER (abs(pow(sin(a), 2) + pow(cos(a), 2) - 1) > 1e-9)", "(SELECT 2 * pi() * (dayofweek(date) + 1) / 7 AS a FROM panel)"),
    check("closure_range", "count(*) FILTER (NOT (days_to_next_closure BETWEEN 0 AND 60) OR NOT (days_from_prev_closure BETWEEN 0 AND 60))", "panel JOIN near USING (date)"),
    info("closure_week_rows", "sum(is_closure_week)", "panel JOIN near USING (date)"),
    *(info(b, f"count(*) FILTER (dormancy_bucket = '{b}')", "pred") for b in BUCKETS),
), FEATURES)
def q9_gate_features(spark, sf):
    near = C.closure_proximity(dim(spark), C.closure_dim(spark, CFG)).select("date", "days_to_next_closure", "days_from_prev_closure", "is_closure_week")
    return Q.gate_features(C.cyclical_features(W.dormancy(W.recency(T.panel(spark, sf)))).join(F.broadcast(near), "date"))


@query(GATE, both(
    check("lift_range", "count(*) FILTER (NOT (seasonal_lift BETWEEN 0.5 AND 3.0))", "sall"),
    check("prob_range", "count(*) FILTER (NOT (spike_prob BETWEEN 0.0 AND 1.0))", "sall"),
    info("spike_rows", "sum(is_spike)", "sall"),
    info("promo_store_days", "count(DISTINCT CASE WHEN is_promo_day = 1 THEN (store_id, date) END)", "sall"),
), SPIKE)
def q10_gate_spikes(spark, sf):
    return Q.gate_spikes(spikes(spark, sf))


@query("fold_id:s n:i short_embargo:i wrong_horizon:i", "SELECT fold_id, n, short_embargo, wrong_horizon FROM (SELECT fold_id, count(*) AS n FROM clean JOIN folds ON date BETWEEN val_start AND val_end GROUP BY ALL), (SELECT count(*) FILTER (date_diff('day', train_end, val_start) < 7) AS short_embargo, count(*) FILTER (date_diff('day', val_start, val_end) + 1 <> 168) AS wrong_horizon FROM folds)", SALES + f",\nfolds AS (SELECT * FROM (VALUES {FOLDS}) AS v(fold_id, train_start, train_end, val_start, val_end, val_days, embargo_days))")
def q11_gate_folds(spark, sf):
    folds = J.fold_dim(spark, CFG)
    bad = Q.gate_folds(folds).filter("status <> 'INFO'").groupBy().pivot("gate", ["short_embargo", "wrong_horizon"]).agg(F.sum("value"))
    rows = J.label_folds(T.facts(spark, sf), folds).filter("split_role = 'VAL'").groupBy("fold_id").agg(F.count("*").alias("n"))
    return rows.crossJoin(F.broadcast(bad))


@query(GATE, both(
    check("forecast_when_closed", "count(*) FILTER (is_store_closed = 1 AND pred_smart > 0)", f"pred WHERE {AFTER}"),
    info("sales_when_closed", "count(*) FILTER (is_store_closed = 1 AND y > 0)", f"pred WHERE {AFTER}"),
    info("closed_rows", "count(*) FILTER (is_store_closed = 1)", f"pred WHERE {AFTER}"),
), FEATURES)
def q12_gate_closure(spark, sf):
    return Q.gate_closure(val_predictions(spark, sf), "pred_smart")


@query(GATE, "SELECT 'series' AS gate, CAST(count(*) AS DOUBLE) AS value, 'INFO' AS status FROM vel UNION ALL SELECT 'with_median_gap', count(median_gap), 'INFO' FROM vel UNION ALL SELECT s, count(velocity_segment), 'INFO' FROM (SELECT unnest(['FAST', 'MEDIUM', 'SLOW', 'VERY_SLOW']) AS s) LEFT JOIN vel ON s = velocity_segment GROUP BY ALL", VELOCITY)
def q13_gate_velocity(spark, sf):
    return Q.gate_velocity(A.velocity(T.facts(spark, sf), y="sales_clean"))


@query(GATE, both(
    check("row_count_difference", f"count(*) - {CFG.horizon} * (SELECT count(*) FROM state)", "roll"),
    check("null_or_nan", "count(*) FILTER (yhat IS NULL OR isnan(yhat))", "roll"),
    check("negative", "count(*) FILTER (yhat < 0)", "roll"),
    check("first_day_difference", f"date_diff('day', {END} + 1, min(date))", "roll"),
    check("last_day_difference", f"date_diff('day', {END} + 1, max(date)) - {CFG.horizon - 1}", "roll"),
    info("series", "count(DISTINCT (store_id, sku_id))", "roll"),
), rolled(END))
def q14_gate_forecast(spark, sf):
    state = FC.series_state(T.panel(spark, sf), CFG.data_end)
    fc = FC.recursive_forecast(state, date(2001, 11, 5), CFG.horizon).withColumnRenamed("yhat", "predicted_sales")
    return Q.gate_forecast(fc, state.count(), CFG.horizon, date(2001, 11, 5))


@query(GATE, both(
    check("forecast_when_closed", "count(*) FILTER (is_store_closed = 1 AND pred_smart > 0)", f"pred WHERE {AFTER}"),
    check("negative", "count(*) FILTER (pred_smart < 0)", f"pred WHERE {AFTER}"),
    info("series_only_in_train", "count(*) FILTER (t AND NOT v)", f"(SELECT bool_or({BEFORE}) AS t, bool_or({AFTER}) AS v FROM pred GROUP BY store_id, sku_id)"),
    info("series_only_in_val", "count(*) FILTER (v AND NOT t)", f"(SELECT bool_or({BEFORE}) AS t, bool_or({AFTER}) AS v FROM pred GROUP BY store_id, sku_id)"),
), FEATURES)
def q15_gate_predictions(spark, sf):
    # a series has panel days up to the cutoff if it has a fact there
    return Q.gate_predictions(T.facts(spark, sf).filter(BEFORE), val_predictions(spark, sf), "pred_smart")


# summaries


@query("n_rows:i n_cells:i density:d zero_rate:d", "SELECT count(*) AS n_rows, count(DISTINCT store_id) * count(DISTINCT sku_id) * (date_diff('day', min(date), max(date)) + 1) AS n_cells, count(*) / (count(DISTINCT store_id) * count(DISTINCT sku_id) * (date_diff('day', min(date), max(date)) + 1)) AS density, avg(CAST(sales_clean = 0 AS INT)) AS zero_rate FROM clean", SALES)
def e1_density(spark, sf):
    return E.density(T.facts(spark, sf))


@query("percentile:d value:d", "SELECT unnest([0.5, 0.9, 0.95, 0.99]) AS percentile, unnest(q) AS value FROM (SELECT quantile_cont(sales_clean, [0.5, 0.9, 0.95, 0.99]) AS q FROM clean)", SALES)
def e2_sales_percentiles(spark, sf):
    return E.sales_percentiles(T.facts(spark, sf))


@query("december_avg:d other_avg:d december_lift:d", "SELECT a AS december_avg, b AS other_avg, a / b AS december_lift FROM (SELECT avg(y) FILTER (month(date) = 12) AS a, avg(y) FILTER (month(date) <> 12) AS b FROM panel)", PANEL)
def e3_seasonal_profile(spark, sf):
    return E.seasonal_profile(T.panel(spark, sf))


@query("week:t total_sales:i active_series:i", "SELECT date_trunc('week', date) AS week, sum(y) AS total_sales, count(DISTINCT CASE WHEN y > 0 THEN (store_id, sku_id) END) AS active_series FROM panel GROUP BY ALL", PANEL)
def e4_weekly_trend(spark, sf):
    return E.weekly_trend(T.panel(spark, sf))


@query("store_id:s total_sales:i avg_sales:d zero_rate:d cluster:i", "SELECT *, ntile(4) OVER (ORDER BY avg_sales DESC, store_id) AS cluster FROM (SELECT store_id, sum(y) AS total_sales, avg(y) AS avg_sales, avg(CAST(y = 0 AS INT)) AS zero_rate FROM panel GROUP BY ALL)", PANEL)
def e5_store_profile(spark, sf):
    return E.store_profile(T.panel(spark, sf))


@query("sku_id:s total_sales:i early:i late:i trend:s", "SELECT *, CASE WHEN late > 1.1 * early THEN 'GROWING' WHEN late < 0.9 * early THEN 'DECLINING' ELSE 'STABLE' END AS trend FROM (SELECT sku_id, sum(y) AS total_sales, coalesce(sum(y) FILTER (date > mid), 0) AS late, coalesce(sum(y) FILTER (date <= mid), 0) AS early FROM (SELECT *, min(date) OVER (PARTITION BY sku_id) + CAST(floor(date_diff('day', min(date) OVER (PARTITION BY sku_id), max(date) OVER (PARTITION BY sku_id)) / 2) AS INT) AS mid FROM panel) GROUP BY ALL) ORDER BY total_sales DESC, sku_id LIMIT 20", PANEL)
def e6_sku_profile(spark, sf):
    return E.sku_profile(T.panel(spark, sf))


@query("share:d n_skus:i all_skus:i", "SELECT s AS share, least(count(*) FILTER (c < s - 1e-12) + 1, count(*)) AS n_skus, count(*) AS all_skus FROM (SELECT sum(t) OVER (ORDER BY t DESC, sku_id ROWS UNBOUNDED PRECEDING) / sum(t) OVER () AS c FROM (SELECT sku_id, sum(y) AS t FROM panel GROUP BY ALL)), (SELECT unnest([0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) AS s) GROUP BY ALL", PANEL)
def e7_pareto(spark, sf):
    return E.pareto(T.panel(spark, sf))


@query("attribute:s value:i avg_sales:d total_sales:i zero_rate:d", " UNION ALL ".join(f"SELECT '{a}' AS attribute, {x} AS value, avg(y) AS avg_sales, sum(y) AS total_sales, avg(CAST(y = 0 AS INT)) AS zero_rate FROM panel GROUP BY ALL" for a, x in (("dow", "dayofweek(date) + 1"), ("month", "month(date)"), ("year", "year(date)"), ("week", "weekofyear(date)"))), PANEL)
def e8_time_profiles(spark, sf):
    return E.time_profiles(T.panel(spark, sf))


@query("bin:i n_series:i", "SELECT least(floor(r * 10), 9) AS bin, count(*) AS n_series FROM (SELECT avg(CAST(y = 0 AS INT)) AS r FROM panel GROUP BY store_id, sku_id) GROUP BY ALL", PANEL)
def e8_zero_rate_histogram(spark, sf):
    return E.zero_rate_histogram(T.panel(spark, sf))


@query("dormancy_bucket:s n_rows:i sale_prob:d avg_qty:d", "SELECT dormancy_bucket, count(*) AS n_rows, avg(CAST(y > 0 AS INT)) AS sale_prob, avg(y) FILTER (y > 0) AS avg_qty FROM pred GROUP BY ALL", FEATURES)
def e9_sale_prob_by_dormancy(spark, sf):
    return E.sale_prob_by_dormancy(W.dormancy(W.recency(T.panel(spark, sf))))


@query("period:s n_rows:i avg_sales:d", "SELECT CASE WHEN days_to_next_closure = 0 OR days_from_prev_closure = 0 THEN 'closed' WHEN days_to_next_closure <= 3 THEN 'pre_closure' WHEN days_from_prev_closure <= 3 THEN 'post_closure' ELSE 'normal' END AS period, count(*) AS n_rows, avg(y) AS avg_sales FROM panel JOIN near USING (date) GROUP BY ALL", PANEL + ",\n" + CALENDAR)
def e10_closure_impact(spark, sf):
    near = C.closure_proximity(dim(spark), C.closure_dim(spark, CFG))
    return E.closure_impact(T.panel(spark, sf).join(F.broadcast(near), "date"))


@query("year:i month:i n_spikes:i spike_rate:d", "SELECT year(date) AS year, month(date) AS month, sum(is_spike) AS n_spikes, avg(is_spike) AS spike_rate FROM spk GROUP BY ALL", SPIKE)
def e11_spike_months(spark, sf):
    return E.spike_months(W.spike_flag(T.panel(spark, sf)))


@query("sku_id:s promo_weeks:i", "SELECT sku_id, count(DISTINCT CASE WHEN is_spike = 1 AND is_promo_day = 1 THEN date_trunc('week', date) END) AS promo_weeks FROM sall GROUP BY ALL", SPIKE)
def e11_promo_weeks(spark, sf):
    return E.promo_weeks(spikes(spark, sf))


@query("store_id:s " + " ".join(f"dow_{i}:d" for i in range(1, 8)), "SELECT store_id, " + ", ".join(f"avg(y) FILTER (dayofweek(date) = {i - 1}) AS dow_{i}" for i in range(1, 8)) + " FROM panel GROUP BY ALL", PANEL)
def e12_store_dow_matrix(spark, sf):
    return E.store_dow_matrix(T.panel(spark, sf).withColumn("dow", F.dayofweek("date")))


@query("store_id:s seasonality_cv:d", "SELECT store_id, stddev_pop(s) / avg(s) AS seasonality_cv FROM (SELECT store_id, year(date) AS a, month(date) AS b, sum(y) AS s FROM panel GROUP BY ALL) GROUP BY ALL", PANEL)
def e12_seasonality_cv(spark, sf):
    return E.seasonality_cv(T.panel(spark, sf))


@query("year:i new_skus:i", "SELECT yr AS year, count(*) AS new_skus FROM (SELECT sku_id, year(min(date)) AS yr FROM clean GROUP BY ALL) GROUP BY ALL", SALES)
def e13_new_skus(spark, sf):
    return E.new_skus(T.facts(spark, sf))
