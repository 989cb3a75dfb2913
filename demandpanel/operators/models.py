"""Learned forecasts on MLlib: two-stage trees by segment, direct and Tweedie models, searches and ablations."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandpanel.config import KEYS
from demandpanel.operators.forecast import smear
from demandpanel.operators.metrics import aggregates, metrics


def _ready(df: DataFrame, features: list[str], y: str = "y") -> DataFrame:
    """Features as doubles, and the labels; rows that are to be forecast may lack ``y``."""
    if y not in df.columns:
        return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features})
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features} | {"_sold": F.when(F.col(y) > 0, 1.0).otherwise(0.0), "_log": F.log1p(F.greatest(F.col(y), F.lit(0)).cast("double")), "_y": F.col(y).cast("double")})


def _counted(rows: DataFrame, by: list[str], weight: str | None = None) -> DataFrame:
    """Rows that agree in ``by`` (features and label, and what else tells them apart) as one, with their number or weight as ``_n``.

    A weighted row is to the loss what its copies are, and few days differ where most sell nothing: each round of trees then passes
    over these instead of all rows. As many partitions as cores: each round is a few short jobs.
    """
    out = rows.groupBy(*dict.fromkeys(by)).agg((F.sum(weight) if weight else F.count("*")).cast("double").alias("_n"))
    return out.coalesce(rows.sparkSession.sparkContext.defaultParallelism)


def _apart(rows: DataFrame, features: list[str], kind: str) -> list[str]:
    """What tells the rows of a classifier apart. Forests draw rows: equal ones stay apart by day, so that no draw leaves many of them out."""
    return [*features, "_sold", *(["date"] if kind != "gbt" and "date" in rows.columns else [])]


#: Buckets of a feature, as many as MLlib's trees tell apart: half of them by quantiles of all values, half by those of values that are not 0.
BUCKETS = 32


def buckets(rows: DataFrame, features: list[str]) -> Bucketizer:
    """Cuts each feature (:func:`_ready` rows) at quantiles, so that rows which a tree could not tell apart count as one. The cuts come from all rows, in
    one pass; MLlib takes its thresholds from a draw of them."""
    at = [i / (BUCKETS // 2) for i in range(BUCKETS // 2)]
    cuts = lambda x: F.coalesce(F.percentile_approx(x, at, 1000), F.array().cast("array<double>"))
    got = rows.agg(*(F.sort_array(F.array_distinct(F.concat(cuts(F.col(c)), cuts(F.when(F.col(c) != 0, F.col(c)))))).alias(c) for c in features)).first()
    return _buckets_at({c: list(got[c]) or [0.0] for c in features}, features)


def _buckets_at(cuts: dict[str, list[float]], features: list[str]) -> Bucketizer:
    return Bucketizer(splitsArray=[[float("-inf"), *cuts[c], float("inf")] for c in features], inputCols=features, outputCols=[f"_b_{c}" for c in features], handleInvalid="keep")


def _cut(cuts: Bucketizer, rows: DataFrame) -> DataFrame:
    """Rows with their buckets as plain numbers: trees would take what a bucketizer gives for categories without an order."""
    names = cuts.getOutputCols()
    return cuts.transform(rows).select(*rows.columns, *(F.col(c).alias(c, metadata={}) for c in names))


def _some(of: Bucketizer, features: list[str]) -> Bucketizer:
    """The buckets of some of the features."""
    return _buckets_at({c: splits[1:-1] for c, splits in zip(of.getInputCols(), of.getSplitsArray(), strict=True)}, features)


def trees_column(model, x: list[Column], cuts: list[list[float]] | None = None) -> Column:
    """Weighted sum of a boosted model's trees as nested conditions on the features, all of them continuous. With ``cuts`` the model's thresholds are numbers of
    buckets between these: bucket b and below is what lies under cut b."""

    def left(n) -> Column:
        i, t = n.split().featureIndex(), float(n.split().threshold())
        if cuts is None:
            return x[i] <= t
        return x[i] < cuts[i][int(t)] if int(t) < len(cuts[i]) else F.lit(True)

    def node(n) -> Column:
        if n.subtreeDepth() == 0:
            return F.lit(float(n.prediction()))
        return F.when(left(n), node(n.leftChild())).otherwise(node(n.rightChild()))

    roots = [t._call_java("rootNode") for t in model.trees]
    return reduce(lambda a, b: a + b, [F.lit(float(w)) * node(r) for w, r in zip(model.treeWeights, roots, strict=True)])


class TwoStage:
    """P(sale) by a classifier, quantity by a regressor of log quantities of sales days, and the smearing factor.

    ``level`` brings the mean probability of the training rows to their share of sales: few boosting steps leave the
    probabilities of rare sales far too high.
    """

    def __init__(self, classify: PipelineModel, regress: PipelineModel, factor: float, features: list[str], level: float = 1.0):
        self.classify, self.regress, self.factor, self.features, self.level = classify, regress, factor, features, level

    def transform(self, df: DataFrame, y: str = "y") -> DataFrame:
        """Adds ``p`` and ``qty``; quantities are transformed back, not smeared."""
        rows = _ready(df.withColumn(y, F.col(y)) if y in df.columns else df.withColumn(y, F.lit(0)), self.features, y)
        return self._scored(rows, self.classify, self.regress).select(*df.columns, "p", "qty")

    def of_buckets(self, rows: DataFrame) -> DataFrame:
        """:meth:`transform` of rows whose features are in buckets already."""
        return self._scored(rows, *(PipelineModel([t for t in m.stages if not isinstance(t, Bucketizer)]) for m in (self.classify, self.regress))).select(*rows.columns, "p", "qty")

    def _scored(self, rows: DataFrame, classify: PipelineModel, regress: PipelineModel) -> DataFrame:
        rows = classify.transform(rows)
        rows = rows.withColumn("p", F.least(vector_to_array("probability")[1] * self.level, F.lit(1.0)))
        rows = rows.drop("x", "rawPrediction", "probability", "prediction", *(f"_b_{c}" for c in self.features if isinstance(classify.stages[0], Bucketizer)))
        return regress.transform(rows).withColumn("qty", F.greatest(F.expm1("prediction"), F.lit(0.0)))

    def step(self, features: dict[str, Column]) -> Column:
        """The expected value as a column of the features, for boosted trees: what :meth:`transform` computes, without a job."""
        x = F.struct(*(F.coalesce(features[c].cast("double"), F.lit(0.0)).alias(c) for c in self.features))
        classify, regress = self.classify.stages[-1], self.regress.stages[-1]
        first = self.classify.stages[0]
        cuts = [list(splits)[1:-1] for splits in first.getSplitsArray()] if isinstance(first, Bucketizer) else None

        def value(row: Column) -> Column:
            p = F.least(self.level / (1 + F.exp(-2 * trees_column(classify, [row[c] for c in self.features], cuts))), F.lit(1.0))
            return p * F.greatest(F.expm1(trees_column(regress, [row[c] for c in self.features], cuts)), F.lit(0.0)) * self.factor

        # the features are computed once, however many splits read them
        return F.get(F.transform(F.array(x), value), F.lit(0))

    def save(self, path: str) -> None:
        self.classify.write().overwrite().save(f"{path}/classify")
        self.regress.write().overwrite().save(f"{path}/regress")

    @classmethod
    def load(cls, path: str, factor: float, features: list[str], level: float = 1.0) -> TwoStage:
        return cls(PipelineModel.load(f"{path}/classify"), PipelineModel.load(f"{path}/regress"), factor, features, level)


def fit_two_stage(train: DataFrame, features: list[str], y: str = "y", kind: str = "gbt", trees: int = 20, depth: int = 5, smear_mode: str = "mean_exp", bounds: tuple[float, float] | None = (0.8, 1.5), weight: str | None = None, counted: DataFrame | None = None, cuts: Bucketizer | None = None) -> TwoStage:
    """``kind``: boosted trees (``gbt``) or random forests (``forest``). ``weight``: both stages, the smearing factor and the
    level of the probabilities count rows by this column; rows of weight 0, less or null are left out. ``counted``: these rows as :func:`_counted` has them.
    Boosted trees see features in buckets; ``cuts`` are those of ``counted``."""
    rows = _ready(train, features, y)
    if weight:
        rows = rows.withColumn(weight, F.col(weight).cast("double")).filter(F.col(weight) > 0)
    if kind == "gbt" and cuts is None:
        cuts = buckets(rows if counted is None else counted, features)
        rows, counted = (_cut(cuts, rows), None) if counted is None else (rows, _cut(cuts, counted))
    names = [f"_b_{c}" for c in features] if cuts else features
    stage = VectorAssembler(inputCols=names, outputCol="x")
    apart = _apart(rows, names, kind)
    few, of = (rows, weight) if counted is None else (counted, "_n")
    every = _counted(few, apart, of).persist()
    sold = _counted(few.filter("_sold = 1"), [*apart, "_log"], of).persist()
    if kind == "gbt":
        c, r = GBTClassifier(featuresCol="x", labelCol="_sold", maxIter=trees, maxDepth=depth, seed=7), GBTRegressor(featuresCol="x", labelCol="_log", maxIter=trees, maxDepth=depth, seed=7)
    else:
        c, r = RandomForestClassifier(featuresCol="x", labelCol="_sold", numTrees=trees, maxDepth=depth, seed=7), RandomForestRegressor(featuresCol="x", labelCol="_log", numTrees=trees, maxDepth=depth, seed=7)
    c, r = c.setWeightCol("_n"), r.setWeightCol("_n")
    mean = lambda x: F.try_divide(F.sum(F.col("_n") * x), F.sum("_n"))
    classify, regress = Pipeline(stages=[stage, c]).fit(every), Pipeline(stages=[stage, r]).fit(sold)
    share = classify.transform(every).agg(mean(F.col("_sold")).alias("is"), mean(vector_to_array("probability")[1]).alias("said")).first()
    level = share["is"] / share["said"] if share["said"] else 1.0
    residual = regress.transform(sold).withColumn("residual", F.col("_log") - F.col("prediction"))
    factor = smear(residual, smear_mode, bounds=bounds, weight="_n").first()["smear"] or 1.0
    if not weight and smear_mode != "mean_exp":  # of rows that each count once the variance is that of a sample
        plain = regress.transform((_cut(cuts, rows) if cuts and counted is not None else rows).filter("_sold = 1")).withColumn("residual", F.col("_log") - F.col("prediction"))
        factor = smear(plain, smear_mode, bounds=bounds).first()["smear"] or 1.0
    every.unpersist(), sold.unpersist()
    if cuts:
        classify, regress = (PipelineModel([_some(cuts, features), *m.stages]) for m in (classify, regress))
    return TwoStage(classify, regress, factor, features, level)


def fit_segments(train: DataFrame, features: list[str], by: str = "abc", together: bool = True, **how) -> dict[str, TwoStage]:
    """A two-stage model per segment (or per tier, or store). The groups are few; each fit is a distributed job.

    ``together`` counts the rows of all groups in one pass over ``train``, and each fit takes its own from these. Where features make nearly
    all rows differ, that keeps them twice; without it each group counts its own.
    """
    if not together:
        groups = sorted(r[0] for r in train.select(by).distinct().collect())
        return {g: fit_two_stage(train.filter(F.col(by) == g), features, **how) for g in groups}
    rows = _ready(train, features, how.get("y", "y"))
    weight = how.get("weight")
    if weight:
        rows = rows.withColumn(weight, F.col(weight).cast("double")).filter(F.col(weight) > 0)
    counted = _counted(rows, [by, *_apart(rows, features, how.get("kind", "gbt")), "_log"], weight).persist()
    groups = sorted(r[0] for r in train.select(by).distinct().collect()) if weight else sorted(r[0] for r in counted.select(by).distinct().collect())
    models = {g: fit_two_stage(train.filter(F.col(by) == g), features, counted=counted.filter(F.col(by) == g), **how) for g in groups}
    counted.unpersist()
    return models


def predict_segments(models: dict[str, TwoStage], df: DataFrame, by: str = "abc") -> DataFrame:
    """``p``, ``qty`` and the expected value ``yhat`` of every row whose segment has a model."""
    parts = [m.transform(df.filter(F.col(by) == g)).withColumn("yhat", F.col("p") * F.col("qty") * m.factor) for g, m in models.items()]
    return reduce(DataFrame.unionByName, parts)


def fit_per_group(df: DataFrame, features: list[str], by: str = "store_id", min_train: int = 100, min_val: int = 10, **how) -> dict[str, TwoStage]:
    """Models of the groups with enough training and validation rows."""
    n = df.groupBy(by).agg(F.count_if(F.col("split_role") == "TRAIN").alias("t"), F.count_if(F.col("split_role") == "VAL").alias("v")).filter((F.col("t") >= min_train) & (F.col("v") >= min_val))
    enough = df.filter("split_role = 'TRAIN'").join(F.broadcast(n.select(by)), by, "left_semi")
    return fit_segments(enough, features, by, **how)


def fit_direct(train: DataFrame, features: list[str], log: bool = True, y: str = "y", trees: int = 20, depth: int = 5) -> PipelineModel:
    """One regressor of all days, of log quantities or of quantities."""
    label = "_log" if log else "_y"
    model = GBTRegressor(featuresCol="x", labelCol=label, weightCol="_n", maxIter=trees, maxDepth=depth, seed=7)
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="x"), model]).fit(_counted(_ready(train, features, y), [*features, label]))


def predict_direct(model: PipelineModel, df: DataFrame, features: list[str], log: bool = True, y: str = "y") -> DataFrame:
    out = model.transform(_ready(df, features, y))
    value = F.expm1("prediction") if log else F.col("prediction")
    return out.select(*df.columns, F.greatest(value, F.lit(0.0)).alias("yhat"))


def fit_tier_model(df: DataFrame, features: list[str], y: str = "y", trees: int = 50, depth: int = 6, step: float = 0.1, subsample: float = 0.8) -> PipelineModel:
    """Boosted trees that stop early on the rows of ``split_role`` VAL."""
    rows = _ready(df, features, y).withColumn("_val", F.col("split_role") == "VAL")
    # each tree draws rows: equal ones stay apart by day, so that no draw leaves many of them out
    rows = _counted(rows, [*features, "_y", "_val", *(["date"] if "date" in rows.columns else [])])
    model = GBTRegressor(featuresCol="x", labelCol="_y", weightCol="_n", maxIter=trees, maxDepth=depth, stepSize=step, subsamplingRate=subsample, validationIndicatorCol="_val", validationTol=0.01, seed=7)
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="x"), model]).fit(rows)


def fit_tiers(df: DataFrame, sets: dict[str, list[str]], y: str = "y", by: str = "tier_name", **how) -> dict[str, tuple[PipelineModel, list[str]]]:
    """A model of its own for each tier that has training and validation rows, on the tier's feature set. T0 has none."""
    there = df.groupBy(by).agg(F.count_if(F.col("split_role") == "TRAIN").alias("t"), F.count_if(F.col("split_role") == "VAL").alias("v")).collect()
    tiers = sorted(r[by] for r in there if r[by] in sets and r["t"] and r["v"])
    return {t: (fit_tier_model(df.filter(F.col(by) == t), sets[t], y, **how), sets[t]) for t in tiers}


def predict_tiers(models: dict[str, tuple[PipelineModel, list[str]]], df: DataFrame, y: str = "y", by: str = "tier_name") -> DataFrame:
    """``yhat`` of every row by its tier's model; rows of a tier without one, T0 among them, get 0."""
    rest = df.filter(~F.coalesce(F.col(by).isin(list(models)), F.lit(False))).withColumn("yhat", F.lit(0.0))
    return reduce(DataFrame.unionByName, [predict_direct(m, df.filter(F.col(by) == t), features, False, y) for t, (m, features) in models.items()], rest)


def fit_tweedie(train: DataFrame, features: list[str], power: float = 1.3, y: str = "y") -> PipelineModel:
    """A generalized linear model with Tweedie variance and log link: linear, not boosted."""
    model = GeneralizedLinearRegression(featuresCol="x", labelCol="_y", weightCol="_n", family="tweedie", variancePower=power, linkPower=0.0, maxIter=25, regParam=0.1)
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="x"), model]).fit(_counted(_ready(train, features, y), [*features, "_y"]))


def importance(models: dict[str, TwoStage]) -> list[tuple[str, str, float]]:
    """(segment, feature, per cent) of the classifiers' importances; see :func:`mean_importance` for all segments."""
    out = []
    for segment, m in sorted(models.items()):
        values = m.classify.stages[-1].featureImportances.toArray()
        out += [(segment, f, 100.0 * float(v) / (float(values.sum()) or 1.0)) for f, v in zip(m.features, values, strict=True)]
    return out


def mean_importance(models: dict[str, TwoStage]) -> list[tuple[str, str, float]]:
    """The mean over the segments, as rows of the segment ``mean``."""
    each: dict[str, list[float]] = {}
    for _, f, v in importance(models):
        each.setdefault(f, []).append(v)
    return [("mean", f, sum(v) / len(v)) for f, v in each.items()]


def select_features(models: dict[str, TwoStage], n: int) -> list[str]:
    """The n features of most mean importance."""
    mean: dict[str, float] = {}
    for _, f, v in importance(models):
        mean[f] = mean.get(f, 0.0) + v
    return sorted(mean, key=lambda f: (-mean[f], f))[:n]


def tune_params(train: DataFrame, features: list[str], depths=(3, 5), steps=(0.05, 0.1), days: int = 28, y: str = "y", trees: int = 10) -> tuple[PipelineModel, DataFrame]:
    """Best boosted regressor of a small grid, and a row of each candidate (``depth``, ``step``, ``mae``).

    Each candidate is fitted on the days before the last ``days`` and judged on these, so that no later day tells about an
    earlier one; the best is fitted on all days. Of equal ones the first of the grid wins.
    """
    last = train.agg(F.max("date")).first()[0]
    late = F.col("_late")
    rows = _ready(train, features, y).withColumn("_late", F.col("date") > F.date_sub(F.lit(last), days))
    rows = _counted(rows, [*features, "_log", "_late"]).persist()
    stage = VectorAssembler(inputCols=features, outputCol="x")
    model = lambda depth, step: Pipeline(stages=[stage, GBTRegressor(featuresCol="x", labelCol="_log", weightCol="_n", maxIter=trees, maxDepth=depth, stepSize=step, seed=7)])
    tried = []
    for depth in depths:
        for step in steps:
            out = model(depth, step).fit(rows.filter(~late)).transform(rows.filter(late))
            error = F.try_divide(F.sum(F.col("_n") * F.abs(F.col("prediction") - F.col("_log"))), F.sum("_n"))
            tried.append((depth, step, float(out.agg(error).first()[0] or 0.0)))
    best = min(tried, key=lambda r: r[2])
    chosen = model(best[0], best[1]).fit(rows)
    rows.unpersist()
    return chosen, train.sparkSession.createDataFrame(tried, "depth int, step double, mae double")


def ablate(train: DataFrame, val: DataFrame, sets: dict[str, list[str]], **how) -> DataFrame:
    """WMAPE and bias on validation rows of a two-stage model for each feature set. Rows are cut into buckets and counted once, for all sets; rows that
    agree in all buckets and in the quantity are fitted and scored as one, with their number."""
    every = list(dict.fromkeys(f for features in sets.values() for f in features))
    ready = _ready(train, every)
    cuts = buckets(ready, every)
    names = cuts.getOutputCols()
    counted = _counted(_cut(cuts, ready), [*names, "_sold", "_log"]).persist()
    unseen = _counted(_cut(cuts, _ready(val, every)), [*names, "_y"]).persist()
    out = []
    for name, features in sets.items():
        m = fit_two_stage(train, features, counted=counted, cuts=_some(cuts, features), **how)
        y, n, p = F.col("_y"), F.col("_n"), F.col("p") * F.col("qty") * m.factor
        scored = m.of_buckets(unseen)
        total = F.sum(n * y)
        error, bias = F.lit(100.0) * F.sum(n * F.abs(y - p)), F.lit(100.0) * (F.sum(n * p) - total)
        row = scored.agg(F.sum("_n").cast("long").alias("n"), F.when(total != 0, F.try_divide(error, total)).alias("wmape"), F.try_divide(bias, total).alias("bias_pct")).first()
        out.append((name, *row))
    counted.unpersist(), unseen.unpersist()
    return train.sparkSession.createDataFrame(out, "feature_set string, n long, wmape double, bias_pct double")


def score_roles(df: DataFrame, yhat: str = "yhat", y: str = "y") -> DataFrame:
    every = aggregates(y, yhat)
    return df.groupBy("split_role").agg(*(every[m].alias(m) for m in ("n", "wmape", "bias_pct")))


def recursive_ml(model: TwoStage, state: DataFrame, start: date, horizon: int, cut, every: int = 14, keys=KEYS) -> DataFrame:
    """Day-by-day forecasts by a model whose features come from :func:`recursive_features`, and from the velocity statistics that
    ``state`` holds besides its history. For models that are no column expression; boosted trees take one fold in
    :func:`~demandpanel.operators.forecast.recursive_forecast` by their :meth:`TwoStage.step`. ``cut`` writes the state as a table every few days, so that plans stay short and
    lost executors cost little."""
    from demandpanel.operators.forecast import recursive_features

    done, now = [], state
    extra = [c for c in state.columns if c not in (*keys, "hist")]
    for k in range(horizon):
        median = F.col("median_gap") if "median_gap" in extra else None
        rows = now.withColumns({c: v.cast("double") for c, v in recursive_features(F.col("hist"), median).items()})
        rows = model.transform(rows).withColumn("yhat", F.col("p") * F.col("qty") * model.factor)
        now = rows.select(*keys, F.concat(F.slice("hist", 2, 55), F.array("yhat")).alias("hist"), *extra, *(c for c in now.columns if c.startswith("d_")), F.col("yhat").alias(f"d_{k}"))
        if (k + 1) % every == 0 or k == horizon - 1:
            now = cut(now)
            names = [c for c in now.columns if c.startswith("d_")]
            days = F.explode(F.arrays_zip(F.array(*(F.lit(int(c[2:])) for c in names)).alias("k"), F.array(*names).alias("v"))).alias("x")
            done.append(now.select(*keys, days).select(*keys, F.date_add(F.lit(start), F.col("x.k")).alias("date"), F.col("x.v").alias("yhat")))
            now = now.select(*keys, "hist", *extra)
    return reduce(DataFrame.unionByName, done)
