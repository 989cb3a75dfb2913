"""Queries of boosting by any loss, of ids and weights in models, and of repeatable publishing."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandpanel.config import KEYS
from demandpanel.operators import boosting as B
from demandpanel.operators import clean as P
from demandpanel.operators import metrics as M
from demandpanel.operators import models as ML
from demandpanel.operators.targets import target_statistics
from demandpanel.plans.ctes import CUT, PANEL
from demandpanel.plans.queries import CUTOFF, KD
from demandpanel.plans.queries2 import FIT_DAYS, ML_FEATURES, ml_rows, written
from demandpanel.plans.registry import query
from demandpanel.sources import testdata as T
from demandpanel.sources.testdata import CFG

QUANTILES = (0.5, 0.75, 0.9, 0.95)
NAMES = [f"q{100 * q:g}" for q in QUANTILES]
VAL_SOLD = f"FROM panel WHERE date > {CUT} AND y > 0"

# ids


def _past(by: str) -> str:
    """Sums over the earlier days of an id, or of all rows."""
    cols, part = (f"{by}, ", f"PARTITION BY {by} ") if by else ("", "")
    over = f"OVER ({part}ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return f"(SELECT {cols}date, coalesce(sum(s) {over}, 0) AS s, coalesce(sum(n) {over}, 0) AS n FROM (SELECT {cols}date, coalesce(sum(y) FILTER (date <= {CUT}), 0) AS s, count(*) FILTER (date <= {CUT}) AS n FROM panel GROUP BY ALL))"


@query(
    KD + "te_store_id:d te_sku_id:d",
    f"SELECT p.store_id, p.sku_id, p.date, coalesce((a.s + 20.0 * (c.s / nullif(c.n, 0))) / (a.n + 20.0), 0) AS te_store_id, coalesce((b.s + 20.0 * (c.s / nullif(c.n, 0))) / (b.n + 20.0), 0) AS te_sku_id FROM panel p "
    f"JOIN {_past('store_id')} a ON p.store_id = a.store_id AND p.date = a.date JOIN {_past('sku_id')} b ON p.sku_id = b.sku_id AND p.date = b.date JOIN {_past('')} c ON p.date = c.date",
    PANEL,
)
def f9_target_statistics(spark, sf):
    panel = T.panel(spark, sf, by=("store_id",)).select(*KEYS, "date", "y")
    return target_statistics(panel, CUTOFF, by=("store_id",), cut=partial(written, spark)).select(*KEYS, "date", "te_store_id", "te_sku_id")


@query("feature_set:s n:i wmape:d bias_pct:d")
def f9_f20_ids_ablation(spark, sf):
    """The two-stage model without ids, with ids as ordered target statistics, and with these alone."""
    train, val = ml_rows(spark, sf)
    panel = T.panel(spark, sf, by=("store_id",)).select(*KEYS, "date", "y")
    rows = written(spark, target_statistics(panel, CUTOFF, rows=train.unionByName(val), by=("store_id",), cut=partial(written, spark)))
    ids = ["te_store_id", "te_sku_id"]
    both = rows.filter(F.col("date") <= F.lit(CUTOFF)), rows.filter(F.col("date") > F.lit(CUTOFF))
    return ML.ablate(*both, {"without": ML_FEATURES, "with": [*ML_FEATURES, *ids], "alone": ids}, trees=5, depth=4)


# weights

#: Days that the weighted fits see: the disruption, which they weigh down, must be among them.
WEIGHT_DAYS = (CUTOFF - CFG.disruption[0]).days + 28


@query("weighting:s n:i wmape:d bias_pct:d")
def p18_f9_weightings(spark, sf):
    """The two-stage model with the four weightings: none, recent days, disruption days, both."""
    train, val = ml_rows(spark, sf, fit_days=WEIGHT_DAYS)
    out = []
    for name, decay, disruption in (("none", 0.0, 1.0), ("recency", 0.001, 1.0), ("disruption", 0.0, 0.25), ("both", 0.001, 0.25)):
        model = ML.fit_two_stage(P.sample_weights(train, CFG, decay, disruption), ML_FEATURES, trees=3, depth=4, weight="sample_weight")
        scored = model.transform(val).withColumn("yhat", F.col("p") * F.col("qty") * model.factor)
        out.append(M.metrics(scored, ["yhat"], which=["n", "wmape", "bias_pct"]).drop("model").withColumn("weighting", F.lit(name)))
    return reduce(DataFrame.unionByName, out)


# quantiles and Tweedie


def _sold_quantiles(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Quantities of the validation days with a sale, with boosted quantiles, and the training days' rows."""
    train, val = ml_rows(spark, sf)
    sold = [df.filter("y > 0") for df in (train, val)]
    model = B.fit(sold[0], ML_FEATURES, B.quantile(QUANTILES), partial(written, spark), rounds=6, depth=3, step=0.3)
    return model.predict(sold[1]), sold[0]


@query("n:i bad:i", f"SELECT count(*) AS n, 0 AS bad {VAL_SOLD}", PANEL)
def f23_quantile_boosting(spark, sf):
    """``bad``: rows whose quantiles are null or out of order."""
    out, _ = _sold_quantiles(spark, sf)
    wrong = reduce(lambda a, b: a | b, [F.col(a) > F.col(b) for a, b in zip(NAMES, NAMES[1:])])
    return out.agg(F.count("*").alias("n"), F.count_if(F.coalesce(wrong, F.lit(True))).alias("bad"))


@query("quantile:d n:i coverage:d empirical_coverage:d pinball:d empirical_pinball:d")
def f23_quantile_coverage(spark, sf):
    """Held-out coverage and pinball loss of the boosted quantiles, against the empirical ones of each segment."""
    out, train = _sold_quantiles(spark, sf)
    plain = train.groupBy("abc").agg(F.percentile_approx("y", list(QUANTILES), 10_000).alias("_e"))
    long = out.join(F.broadcast(plain), "abc", "left").select("y", F.explode(F.array(*(F.struct(F.lit(q).alias("q"), F.col(c).alias("a"), F.col("_e")[i].cast("double").alias("b")) for i, (q, c) in enumerate(zip(QUANTILES, NAMES, strict=True))))).alias("x"))
    loss = lambda c: F.avg(F.when(F.col("y") > F.col(c), F.col("x.q") * (F.col("y") - F.col(c))).otherwise((1 - F.col("x.q")) * (F.col(c) - F.col("y"))))
    covered = lambda c: F.avg((F.col("y") <= F.col(c)).cast("double"))
    return long.groupBy(F.col("x.q").alias("quantile")).agg(F.count("*").alias("n"), covered("x.a").alias("coverage"), covered("x.b").alias("empirical_coverage"), loss("x.a").alias("pinball"), loss("x.b").alias("empirical_pinball"))


@query("n:i bad:i", f"SELECT count(*) AS n, 0 AS bad {VAL_SOLD}", PANEL)
def f24_boosted_blend(spark, sf):
    """The blend by the uncertainty of boosted quantiles; ``bad``: rows where it leaves the range of the median and the 90 % quantile."""
    from demandpanel.operators.forecast import quantile_blend

    out = quantile_blend(_sold_quantiles(spark, sf)[0])
    return out.agg(F.count("*").alias("n"), F.count_if(F.coalesce((F.col("yhat") < F.col("q50") - 1e-9) | (F.col("yhat") > F.col("q90") + 1e-9), F.lit(True))).alias("bad"))


POWER = 1.2


@query("model:s trees:i deviance:d val_deviance:d wmape:d bias_pct:d")
def f22_tweedie_boosting(spark, sf):
    """Deviance on training and validation days after each few trees, and of the linear model."""
    train, val = ml_rows(spark, sf)
    model = B.fit(train, ML_FEATURES, B.tweedie(POWER), partial(written, spark), rounds=8, depth=3, step=0.3)
    linear = ML.fit_tweedie(train, ML_FEATURES, POWER)
    # days that agree in features and label are scored once
    some = [written(spark, df.groupBy(*ML_FEATURES, "y").agg(F.count("*").alias("_n"))) for df in (train, val)]

    def row(name: str, trees: int, predict) -> DataFrame:
        a, b = (predict(df) for df in some)
        deviance = B.tweedie_deviance("y", "yhat", POWER, "_n")
        y, p, n = F.col("y").cast("double"), F.col("yhat"), F.col("_n")
        of = lambda x: F.lit(100.0) * F.try_divide(F.sum(n * x), F.sum(n * y))
        scores = b.agg(deviance.alias("val_deviance"), of(F.abs(y - p)).alias("wmape"), of(p - y).alias("bias_pct"))
        return scores.crossJoin(F.broadcast(a.agg(deviance.alias("deviance")))).select(F.lit(name).alias("model"), F.lit(trees).alias("trees"), "deviance", "val_deviance", "wmape", "bias_pct")  # one row each

    rows = [row("boosted", k, lambda df, k=k: model.predict(df, trees=k)) for k in (0, 2, 4, 8)]
    return reduce(DataFrame.unionByName, [*rows, row("linear", 0, lambda df: ML.predict_direct(linear, df, ML_FEATURES, log=False))])


# models of every store

STORES = f"""{PANEL},
enough AS (SELECT store_id FROM panel WHERE date > {CUT} - {FIT_DAYS} GROUP BY ALL HAVING count(*) FILTER (date <= {CUT}) >= 100 AND count(*) FILTER (date > {CUT}) >= 10)"""


@query("store_id:s n:i bad:i", f"SELECT store_id, count(*) AS n, 0 AS bad FROM panel WHERE date > {CUT} AND store_id IN (SELECT store_id FROM enough) GROUP BY ALL", STORES)
def f27_models_of_all_stores(spark, sf):
    """A two-stage model for each supplier with enough rows, all grown together. ``bad``: forecasts that are null or negative."""
    train, val = ml_rows(spark, sf)
    cut = partial(written, spark)
    count = lambda df, c: df.groupBy("store_id").agg(F.count("*").alias(c))
    enough = cut(count(train, "t").join(count(val, "v"), "store_id").filter("t >= 100 AND v >= 10").select("store_id"))
    train, val = (df.join(enough, "store_id", "left_semi") for df in (train, val))
    how = dict(cut=cut, by=("store_id",), rounds=3, depth=3, step=0.3)
    sold = B.fit(train.withColumn("sold", (F.col("y") > 0).cast("int")), ML_FEATURES, B.logistic(), y="sold", **how)
    size = B.fit(train.filter("y > 0").withColumn("size", F.log1p("y")), ML_FEATURES, B.squared(), y="size", **how)
    out = size.predict(sold.predict(val, "p"), "size")
    # a store without a sale in training has no model of sizes: it sells nothing
    out = out.withColumn("yhat", F.col("p") * F.coalesce(F.greatest(F.expm1("size"), F.lit(0.0)), F.lit(0.0)))
    return out.groupBy("store_id").agg(F.count("*").alias("n"), F.count_if(F.col("yhat").isNull() | (F.col("yhat") < 0)).alias("bad"))
