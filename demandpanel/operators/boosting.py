"""Boosted trees of many groups at once, by histograms: squared, logistic, Tweedie and quantile losses, with weights.

Each level of all groups' trees takes one aggregation over (group, node, feature, bin), so the number of jobs hangs on rounds and depth,
not on groups. Quantiles are groups too. A model is a table of one row per group: Spark saves, joins and broadcasts it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Cut = Callable[[DataFrame], DataFrame]
SPLITS = "array<struct<feature:int,bin:int>>"
TREES = f"array<struct<splits:{SPLITS},leaves:array<double>>>"


@dataclass(frozen=True)
class Loss:
    """``start`` aggregates (y, weight) to the first score, ``slope`` is the negative gradient and ``curve`` the second derivative
    at (y, score), ``value`` turns a score into a prediction. With ``quantiles`` there is a model for each of them."""

    start: Callable[[Column, Column], Column]
    slope: Callable[[Column, Column], Column]
    curve: Callable[[Column, Column], Column]
    value: Callable[[Column], Column]
    quantiles: tuple[float, ...] = ()


def _mean(y: Column, w: Column) -> Column:
    return F.try_divide(F.sum(y * w), F.sum(w))


def squared() -> Loss:
    return Loss(_mean, lambda y, f: y - f, lambda y, f: F.lit(1.0), lambda f: f)


def logistic() -> Loss:
    """Labels 0 and 1; predictions are probabilities."""

    def start(y: Column, w: Column) -> Column:
        p = F.greatest(F.least(_mean(y, w), F.lit(1 - 1e-6)), F.lit(1e-6))
        return F.log(p / (1 - p))

    share = lambda f: 1 / (1 + F.exp(-f))
    return Loss(start, lambda y, f: y - share(f), lambda y, f: share(f) * (1 - share(f)), share)


def tweedie(power: float = 1.2) -> Loss:
    """Deviance of variance mean^power (1 < power < 2) with a log link: a leaf's Newton step needs two sums."""
    if not 1 < power < 2:
        raise ValueError("power lies between 1 and 2")
    a, b = 1 - power, 2 - power
    return Loss(
        lambda y, w: F.log(F.greatest(_mean(y, w), F.lit(1e-6))),
        lambda y, f: y * F.exp(a * f) - F.exp(b * f),
        lambda y, f: b * F.exp(b * f) - a * y * F.exp(a * f),
        F.exp,
    )


def quantile(quantiles: tuple[float, ...] = (0.5, 0.75, 0.9, 0.95), accuracy: int = 10_000) -> Loss:
    """Pinball loss. Leaves take the residuals' quantile from a mergeable sketch; weights are not supported."""
    if list(quantiles) != sorted(set(quantiles)) or not all(0 < q < 1 for q in quantiles):
        raise ValueError("quantiles ascend between 0 and 1")
    q = F.get(F.array(*(F.lit(v) for v in quantiles)), F.col("_q"))
    pick = lambda x: F.get(F.percentile_approx(x, list(quantiles), accuracy), F.min("_q"))
    return Loss(lambda y, w: pick(y), lambda y, f: F.when(y > f, q).otherwise(q - 1), lambda y, f: F.lit(1.0), lambda f: f, tuple(quantiles))


def tweedie_deviance(y: str, mu: str, power: float = 1.2, weight: str | None = None) -> Column:
    """The mean unit deviance, as an aggregate, of rows that count by ``weight`` if told."""
    a, b = F.lit(1 - power), F.lit(2 - power)
    m, v = F.greatest(F.col(mu), F.lit(1e-9)), F.col(y).cast("double")
    each = 2 * (F.pow(v, b) / ((1 - power) * (2 - power)) - v * F.pow(m, a) / (1 - power) + F.pow(m, b) / (2 - power))
    return F.try_divide(F.sum(each * F.col(weight)), F.sum(weight)) if weight else F.avg(each)


def _point(features: list[str]) -> Column:
    """The features as doubles; null and NaN count as 0, as in the other models."""
    return F.array(*(F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) for c in features))


def _walk(splits: Column, point: Column, limit: str, levels: int) -> Column:
    """The node after some levels; node n has the children 2n + 1 and 2n + 2, and what is not split goes left."""
    if levels == 0:
        return F.lit(0)

    def down(node: Column, _: Column) -> Column:
        split = F.get(splits, node)
        left = F.coalesce(F.get(point, split["feature"]) <= split[limit], F.lit(True))
        return node * 2 + F.when(left, 1).otherwise(2)

    return F.aggregate(F.sequence(F.lit(1), F.lit(levels)), F.lit(0), down)


def _score(trees: Column, point: Column, first: Column, limit: str, depth: int, step: float) -> Column:
    leaf = lambda t: F.get(t["leaves"], _walk(t["splits"], point, limit, depth) - (2**depth - 1))
    return F.aggregate(trees, first, lambda f, t: f + step * F.coalesce(leaf(t), F.lit(0.0)))


def _edges(features: int, bins: int) -> Column:
    """Candidate thresholds of a group: quantiles of each feature's values, and of those that are not 0 (most are, in sparse sales)."""
    at = [i / (bins // 2) for i in range(bins // 2)]

    def one(i: int) -> Column:
        x = F.col("_x")[i]
        others = F.coalesce(F.percentile_approx(F.when(x != 0, x), at, 1000), F.array().cast("array<double>"))
        return F.sort_array(F.array_distinct(F.concat(F.percentile_approx(x, at, 1000), others)))

    return F.array(*(one(i) for i in range(features)))


def _bin(i: int) -> Column:
    """How many edges lie below the value: it is at most edge ``bin``, or above all."""
    x = F.col("_x")[i]
    return F.size(F.filter(F.col("_edges")[i], lambda e: e < x))


def _best_splits(cells: DataFrame, keys: list[str], least: int, l2: float) -> DataFrame:
    """The split of most gain of each node, ties to the first feature and bin."""
    # cells are few per group, whatever its rows: the windows and groupings below share this partitioning
    cells = cells.repartition(*keys)
    part = Window.partitionBy(*keys, "_node", "_feature")
    upto = part.orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = cells.select("*", *(F.sum(c).over(upto).alias(f"{c}_l") for c in ("_g", "_h", "_n")), *(F.sum(c).over(part).alias(f"{c}_t") for c in ("_g", "_h", "_n")))
    power = lambda g, h: F.try_divide(g * g, h + l2)
    g, h, n = F.col("_g_t") - F.col("_g_l"), F.col("_h_t") - F.col("_h_l"), F.col("_n_t") - F.col("_n_l")
    gain = power(F.col("_g_l"), F.col("_h_l")) + power(g, h) - power(F.col("_g_t"), F.col("_h_t"))
    # gains are compared as floats, so that the order of sums decides nothing
    good = sums.withColumn("_gain", gain.cast("float")).filter((F.col("_n_l") >= least) & (n >= least) & (F.col("_gain") > 1e-7))
    best = good.groupBy(*keys, "_node").agg(F.max(F.struct("_gain", (-F.col("_feature")).alias("f"), (-F.col("_bin")).alias("b"))).alias("_m"))
    split = F.struct((-F.col("_m.f")).cast("int").alias("feature"), (-F.col("_m.b")).cast("int").alias("bin"))
    return best.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_node", split))).alias("_new"))


@dataclass(frozen=True)
class Boosted:
    """``table``: the ``by`` columns, ``_q`` (number of the quantile, else 0), ``_start``, and ``trees`` of thresholds and leaves."""

    table: DataFrame
    features: list[str]
    loss: Loss
    by: tuple[str, ...]
    depth: int
    step: float

    def predict(self, df: DataFrame, to: str = "yhat", trees: int | None = None) -> DataFrame:
        """Adds the prediction, of the first ``trees`` trees if told; null for groups without a model. Quantile models add
        ``q50`` and so on instead, put in order (rearranged) where the models cross."""
        out, names = df, []
        for i in range(len(self.loss.quantiles) or 1):
            names.append(f"_f{i}")
            all_trees = F.col("trees") if trees is None else F.slice("trees", 1, trees) if trees else F.slice("trees", 1, 0)
            model = self.table.filter(F.col("_q") == i).select(*self.by, F.col("_start").alias("_s"), all_trees.alias("_t"))
            joined = out.join(model, list(self.by), "left") if self.by else out.join(F.broadcast(model), F.lit(True), "left")  # one row
            score = F.when(F.col("_s").isNotNull(), _score(F.col("_t"), F.col("_p"), F.col("_s"), "threshold", self.depth, self.step))
            out = joined.withColumn("_p", _point(self.features)).withColumn(names[i], self.loss.value(score)).select(*df.columns, *names)
        if not self.loss.quantiles:
            return out.select(*(c for c in df.columns if c != to), F.col("_f0").alias(to))
        ordered = F.sort_array(F.array(*names))
        return out.select(*df.columns, *(ordered[i].alias(f"q{100 * q:g}") for i, q in enumerate(self.loss.quantiles)))


def fit(train: DataFrame, features: list[str], loss: Loss, cut: Cut, by: tuple[str, ...] = (), y: str = "y", weight: str | None = None, rounds: int = 20, depth: int = 4, step: float = 0.1, bins: int = 32, least: int = 20, l2: float = 1.0, every: int = 5) -> Boosted:
    """Boosted trees of each group of ``by``, all groups in the same jobs.

    ``cut`` writes a table to the shared folder and reads it again: the trees at each level, the rows' scores once in ``every``
    rounds. ``least`` is the least number of rows in a node, ``l2`` the shrinkage of leaves. Rows without a label, of weight 0
    or less, or of a null group are left out: weight 0 and absence are the same. No rows give a model that predicts null.
    A group's rows are never brought together: histograms and sketches combine before they shuffle.
    """
    if weight and loss.quantiles:
        raise ValueError("quantile leaves come from sketches without weights")
    if {"_q", "_x", "_y", "_w", "_b", "_f", "_c"} & set(by):
        raise ValueError("these group columns are taken")
    keys, n = [*by, "_q"], len(features)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = train.select(*by, _point(features).alias("_x"), F.col(y).cast("double").alias("_y"), w.alias("_w")).filter(F.col("_y").isNotNull() & (F.col("_w") > 0))
    for c in by:
        rows = rows.filter(F.col(c).isNotNull())
    edges = cut(rows.groupBy(*by).agg(_edges(n, bins).alias("_edges"))) if by else cut(rows.agg(_edges(n, bins).alias("_edges")).filter("_edges[0] is not null"))
    met = lambda df: df.join(edges, list(by)) if by else df.crossJoin(F.broadcast(edges))  # noqa: E731  (one row where there are no groups)
    number = F.explode(F.array(*(F.lit(i) for i in range(len(loss.quantiles) or 1)))).alias("_q")
    many = rows.select("*", number)
    first = cut(many.groupBy(*keys).agg(loss.start(F.col("_y"), F.col("_w")).alias("_start")))
    binned = met(many).join(first, keys).select(*keys, F.array(*(_bin(i) for i in range(n))).alias("_b"), "_y", "_w", F.col("_start").alias("_f"))
    # rows in the same bins with the same label are one, with their weight and number; a quantile's sketch takes each
    binned = binned.withColumn("_c", F.lit(1)) if loss.quantiles else binned.groupBy(*keys, "_b", "_y", "_f").agg(F.sum("_w").alias("_w"), F.count("*").alias("_c"))
    state, model = cut(binned), first.select(*keys, F.array().cast(TREES).alias("trees"))
    fresh = 0  # trees that the written scores lack
    for r in range(rounds):
        grown = model.withColumn("splits", F.array().cast(SPLITS))
        score = _score(F.slice("trees", -fresh, fresh), F.col("_b"), F.col("_f"), "bin", depth, step) if fresh else F.col("_f")
        for level in range(depth):
            at = state.join(grown, keys).select(*keys, _walk(F.col("splits"), F.col("_b"), "bin", level).alias("_node"), "_b", "_y", "_w", "_c", score.alias("_f"))
            g, h = F.col("_w") * loss.slope(F.col("_y"), F.col("_f")), F.col("_w") * loss.curve(F.col("_y"), F.col("_f"))
            cells = at.select(*keys, "_node", "_c", g.alias("_g"), h.alias("_h"), F.posexplode("_b").alias("_feature", "_bin"))
            cells = cells.groupBy(*keys, "_node", "_feature", "_bin").agg(F.sum("_g").alias("_g"), F.sum("_h").alias("_h"), F.sum("_c").alias("_n"))
            known = F.transform(F.sequence(F.lit(0), F.lit(2 ** (level + 1) - 2)), lambda i: F.coalesce(F.get("splits", i), F.try_element_at("_new", i)))
            grown = cut(grown.join(_best_splits(cells, keys, least, l2), keys, "left").select(*keys, "trees", known.cast(SPLITS).alias("splits")))
        at = state.join(grown, keys).select(*keys, (_walk(F.col("splits"), F.col("_b"), "bin", depth) - (2**depth - 1)).alias("_leaf"), "_y", "_w", score.alias("_f"))
        if loss.quantiles:
            value = loss.start(F.col("_y") - F.col("_f"), F.col("_w"))
        else:
            value = F.try_divide(F.sum(F.col("_w") * loss.slope(F.col("_y"), F.col("_f"))), F.sum(F.col("_w") * loss.curve(F.col("_y"), F.col("_f"))) + l2)
        leaves = at.groupBy(*keys, "_leaf").agg(value.alias("_v")).groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_leaf", "_v"))).alias("_leaves"))
        each = F.transform(F.sequence(F.lit(0), F.lit(2**depth - 1)), lambda i: F.coalesce(F.try_element_at("_leaves", i), F.lit(0.0)))
        tree = F.struct(F.col("splits"), each.alias("leaves"))
        model, fresh = cut(grown.join(leaves, keys).select(*keys, F.concat("trees", F.array(tree)).cast(TREES).alias("trees"))), fresh + 1
        if fresh == every and r + 1 < rounds:
            now = _score(F.slice("trees", -fresh, fresh), F.col("_b"), F.col("_f"), "bin", depth, step)
            state, fresh = cut(state.join(model, keys).select(*keys, "_b", "_y", "_w", "_c", now.alias("_f"))), 0
    limits = F.transform("trees", lambda t: F.struct(F.transform(t["splits"], lambda s: F.struct(s["feature"].alias("feature"), F.get(F.get("_edges", s["feature"]), s["bin"]).alias("threshold"))).alias("splits"), t["leaves"].alias("leaves")))
    table = met(model).join(first, keys).select(*keys, "_start", limits.alias("trees"))
    return Boosted(cut(table), features, loss, tuple(by), depth, step)
