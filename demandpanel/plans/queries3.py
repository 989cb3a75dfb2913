"""Queries of learned forecasts. Trees depend on how rows are split, so only their rows are checked, not their values."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandpanel.config import KEYS
from demandpanel.operators import calendar as C
from demandpanel.operators import forecast as FC
from demandpanel.operators import metrics as M
from demandpanel.operators import models as ML
from demandpanel.operators import panel as J
from demandpanel.operators import production as PR
from demandpanel.operators import stats as A
from demandpanel.operators import windows as W
from demandpanel.plans.ctes import CUT, END, PANEL, stats
from demandpanel.plans.queries import CUTOFF, K, features, segments
from demandpanel.plans.queries2 import FIT_DAYS, GAPS, LAGS, ML_FEATURES, SPIKES, demands, ml_rows, written
from demandpanel.plans.registry import query
from demandpanel.sources import testdata as T
from demandpanel.sources.testdata import CFG

SCORES = "n:i wmape:d bias_pct:d"


def _score(df: DataFrame) -> DataFrame:
    return M.metrics(df, ["yhat"], which=["n", "wmape", "bias_pct"])


def tiered(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Rows of :func:`ml_rows` with the tier that each series had at the cutoff and their split role, and the tiers."""
    tiers = A.tiers_asof(T.facts(spark, sf), CUTOFF, CFG)
    train, val = ml_rows(spark, sf, group=lambda df: J.with_tiers(df, tiers))
    return train.withColumn("split_role", F.lit("TRAIN")).unionByName(val.withColumn("split_role", F.lit("VAL"))), tiers


#: The features of each tier's model; T0 series are not forecast.
TIER_SETS = {"T1_MATURE": ML_FEATURES, "T2_GROWING": LAGS, "T3_COLD_START": ["lag_7", "roll_mean_7"]}


@query("tier_name:s n:i wmape:d bias_pct:d")
def f21_tier_model(spark, sf):
    rows, _ = tiered(spark, sf)
    models = ML.fit_tiers(rows, TIER_SETS, trees=5, depth=4)
    val = rows.filter("split_role = 'VAL'")
    return M.metrics(ML.predict_tiers(models, val), ["yhat"], ("tier_name",), ["n", "wmape", "bias_pct"])


#: What SQL can say of a forecast whose values hang on trees: rows, dates and bounds.
SHAPE = "n:i first:t last:t bad:i"


def shape(df: DataFrame, *by: str) -> DataFrame:
    """Rows, first and last day, and how many values are null, negative or above 0 on a closed day."""
    bad = F.col("yhat").isNull() | (F.col("yhat") < 0)
    if "is_store_closed" in df.columns:
        bad = bad | ((F.col("is_store_closed") == 1) & (F.col("yhat") > 0))
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.min("date").alias("first"), F.max("date").alias("last"), F.count_if(bad).alias("bad"))


@query("tier_name:s " + SHAPE, f"SELECT tier_name, {CFG.horizon} * count(*) AS n, {END} + 1 AS first, {END} + {CFG.horizon} AS last, 0 AS bad FROM stats JOIN (SELECT store_id, sku_id FROM panel WHERE date > {END} - 60 GROUP BY ALL) USING (store_id, sku_id) GROUP BY ALL", PANEL + ",\n" + stats("panel"))
def f32_forecast_by_tier(spark, sf):
    rows, _ = tiered(spark, sf)
    models = ML.fit_tiers(rows, {t: [f for f in fs if f in LAGS] for t, fs in TIER_SETS.items()}, trees=3, depth=4)
    now = A.tiers_asof(T.facts(spark, sf), CFG.data_end, CFG)
    panel = T.panel(spark, sf, since=CFG.data_end - timedelta(59))
    return shape(PR.tier_horizon(models, panel, now, C.closure_dim(spark, CFG), CFG.data_end + timedelta(1), CFG.horizon, cut=lambda df: written(spark, df)), "tier_name")


@query("store_id:s n:i total:d")
def f27_models_by_store(spark, sf):
    """Stores are regions here: each model is a fit of its own, and suppliers grow with the tables."""
    df = features(spark, sf, "r_name", "p_brand", since=CUTOFF - timedelta(FIT_DAYS - 1)).select(*KEYS, "date", "y", *ML_FEATURES)
    df = written(spark, df.filter(F.col("date") > F.date_sub(F.lit(CUTOFF), FIT_DAYS)).withColumn("split_role", F.when(F.col("date") <= F.lit(CUTOFF), "TRAIN").otherwise("VAL")))
    models = ML.fit_per_group(df, ML_FEATURES, trees=2, depth=3)
    return ML.predict_segments(models, df.filter("split_role = 'VAL'"), "store_id").groupBy("store_id").agg(F.count("*").alias("n"), F.sum("yhat").alias("total"))


@query(K + "n:i total:d upper:d")
def f31_f36_delivered_forecast(spark, sf):
    seg = written(spark, segments(spark, sf))
    train, _ = ml_rows(spark, sf, val=False, group=lambda df: J.attach_segment(df, seg))
    models = ML.fit_segments(train, LAGS, trees=3, depth=4)
    # snapshots see 60 days, and Croston needs days with a fact alone
    panel, days = T.panel(spark, sf, since=CFG.data_end - timedelta(59)), demands(spark, sf)
    out = PR.generate_forecast(models, panel, seg, C.closure_dim(spark, CFG), CFG.data_end + timedelta(1), CFG.horizon, facts=days, parts=T.partitions(spark, sf), cut=lambda df: written(spark, df))
    return out.groupBy(*KEYS).agg(F.count("*").alias("n"), F.sum("predicted_sales").alias("total"), F.max("upper_bound").alias("upper"))


@query("abc:s feature:s importance:d")
def f37_importance(spark, sf):
    train, _ = ml_rows(spark, sf)
    models = ML.fit_segments(train, ML_FEATURES, trees=3, depth=3)
    return spark.createDataFrame(ML.importance(models) + ML.mean_importance(models), "abc string, feature string, importance double")


@query("feature_set:s n:i wmape:d bias_pct:d")
def f38_refit_on_best(spark, sf):
    """All features against the four of most importance over the segments, both fitted anew."""
    train, val = ml_rows(spark, sf, more=True)
    every = [*ML_FEATURES, *SPIKES, *GAPS]
    best = ML.select_features(ML.fit_segments(train, every, together=False, trees=3, depth=3), 4)
    return ML.ablate(train, val, {"all": every, "best": best}, trees=3, depth=3)


@query("depth:i step:d mae:d chosen:i wmape:d")
def f39_parameter_search(spark, sf):
    """Each candidate's error on the last training days, and the chosen one's on the validation days."""
    train, val = ml_rows(spark, sf, group=lambda df: df)
    best, tried = ML.tune_params(train, ML_FEATURES, depths=(2, 4), steps=(0.1, 0.3), trees=3)
    wmape = M.metrics(ML.predict_direct(best, val, ML_FEATURES), ["yhat"], which=["wmape"]).select("wmape")
    first = F.row_number().over(W.Window.orderBy("mae", "depth", "step")) == 1  # four rows
    return tried.withColumn("chosen", F.when(first, 1).otherwise(0)).crossJoin(F.broadcast(wmape))


def rollout(spark, sf) -> tuple[DataFrame, DataFrame]:
    """A two-stage model on lags and velocity, rolled out over the whole horizon, and its scores with true lags."""
    names = [*LAGS, *GAPS]
    train, val = ml_rows(spark, sf, more=True)
    model = ML.fit_two_stage(train, names, trees=3, depth=4)
    known = A.velocity(T.facts(spark, sf).filter(F.col("date") <= F.lit(CUTOFF)), y="sales_clean").select(*KEYS, F.col("median_gap").cast("double").alias("median_gap"))
    state = FC.series_state(T.panel(spark, sf), CUTOFF).join(known, list(KEYS), "left")
    first = CUTOFF + timedelta(1)
    rolled = FC.recursive_forecast(state, first, CFG.horizon, model.step, median_gap="median_gap")
    teacher = model.transform(val.filter(F.col("date") < F.lit(first + timedelta(CFG.horizon)))).withColumn("yhat", F.col("p") * F.col("qty") * model.factor)
    return rolled, teacher


@query(K + SHAPE, f"SELECT store_id, sku_id, {CFG.horizon} AS n, {CUT} + 1 AS first, {CUT} + {CFG.horizon} AS last, 0 AS bad FROM panel WHERE date <= {CUT} AND date > {CUT} - 56 GROUP BY ALL", PANEL)
def f29_f30_learned_rollout(spark, sf):
    return shape(rollout(spark, sf)[0], *KEYS)


@query("n:i teacher_wmape:d recursive_wmape:d")
def f42_teacher_forcing_against_recursion(spark, sf):
    rolled, teacher = rollout(spark, sf)
    return PR.compare_scoring(teacher, rolled)
