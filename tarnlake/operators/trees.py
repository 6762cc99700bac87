"""A forest of decision trees grown level by level with aggregates.

Features are cut into bins at exact quantiles. Every tree sees each row as often as a draw from its key says, and
a node looks at some of the features, also drawn. For a level, class weights are summed per node, feature and bin; these sums are
partial before they move and their number depends on trees, depth and bins, not on rows. Running sums over the bins give
the Gini gain of each split; the best one per node is stored, and rows move to the children. Nothing but cuts and a fixed
number of splits is ever small enough to be gathered, and only cuts are. All draws are hashes of keys, so a model depends on
the data alone.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.operators.quantiles import exact_cuts
from tarnlake.session import checkpointed

WHOLE = 1 << 32


@dataclass(frozen=True)
class Settings:
    trees: int = 10
    depth: int = 4
    bins: int = 16
    columns: int = 3
    least_gain: float = 1e-6
    seed: str = "42"

    @property
    def poisson(self) -> list[int]:
        """Draws from which on a row counts once, twice, ... in a tree: steps of the Poisson distribution of mean 1."""
        steps = [sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) for k in range(6)]
        return [math.floor(s * WHOLE) for s in steps]


def draw(*parts: Column | str) -> Column:
    """A number below 2^32 drawn from the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, 8), 16, 10).cast("long")


def split_by_key(df: DataFrame, key: str, share: float = 0.8, seed: str = "42") -> tuple[DataFrame, DataFrame]:
    """Train and test rows; which is which depends on the key alone."""
    train = draw(F.lit(seed), F.lit("split"), F.col(key).cast("string")) < F.lit(math.floor(share * WHOLE))
    return df.filter(train), df.filter(~train)


@dataclass
class Forest:
    """Splits (tree, node, feature, bin, bound, gain, weight) and leaves (tree, node, c0, c1, ...) of a fitted forest.

    Node 1 is a tree's root, 2n and 2n + 1 are the children of n: up to and above the bound."""

    features: list[str]
    cuts: dict[str, list[float]]
    classes: int
    settings: Settings
    splits: DataFrame
    leaves: DataFrame

    def binned(self, df: DataFrame) -> Column:
        """The bin of every feature: how many cuts lie below the value."""
        return F.array(*[
            reduce(lambda a, b: a + b, [(F.col(f).cast("double") > c).cast("int") for c in self.cuts[f]], F.lit(0)) for f in self.features])


def _classes(prefix: str, classes: int) -> list[str]:
    return [f"{prefix}{k}" for k in range(classes)]


def _squares(names: Sequence[str]) -> Column:
    """Sum of squared class weights over their total: what purity a part holds."""
    total = reduce(lambda a, b: a + b, [F.col(n) for n in names])
    return reduce(lambda a, b: a + b, [F.col(n).cast("double") * F.col(n).cast("double") for n in names]) / total.cast("double")


def _looks(nodes: DataFrame, forest: Forest) -> DataFrame:
    """The features that each of the nodes (tree, node) looks at, drawn once for a node: those of the lowest hashes."""
    s = forest.settings
    drawn = [F.struct(F.md5(F.concat_ws(":", F.lit(s.seed), "tree", "node", F.lit(str(g))).cast("binary")).alias("h"), F.lit(g).alias("g"))
             for g in range(len(forest.features))]
    return nodes.select("tree", "node", F.explode(F.slice(F.array_sort(F.array(*drawn)), 1, s.columns)["g"]).alias("feature"))


def _best_splits(placed: DataFrame, nodes: DataFrame, forest: Forest, level: int) -> DataFrame:
    """``nodes``: those that rows of this level may be in."""
    s, k = forest.settings, forest.classes
    here = placed.filter(F.col("node") >= 1 << level)
    # No more rows than trees times nodes of a level times features of a node; rows are repeated for those features only.
    bins = here.join(F.broadcast(_looks(nodes, forest)), ["tree", "node"]).select(
        "tree", "node", "label", "weight", "feature", F.element_at("bins", F.col("feature") + 1).alias("bin"))
    counts = bins.groupBy("tree", "node", "feature", "bin").agg(
        *[F.sum(F.when(F.col("label") == c, F.col("weight")).otherwise(0)).alias(n) for c, n in enumerate(_classes("c", k))])
    whole = Window.partitionBy("tree", "node", "feature")
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = counts.withColumns({
        **{n: F.sum(c).over(upto) for c, n in zip(_classes("c", k), _classes("l", k))},
        **{n: F.sum(c).over(whole) for c, n in zip(_classes("c", k), _classes("t", k))}})
    cum = cum.withColumns({n: F.col(t) - F.col(left) for n, t, left in zip(_classes("r", k), _classes("t", k), _classes("l", k))})
    right = reduce(lambda a, b: a + b, [F.col(n) for n in _classes("r", k)])
    # A bound needs rows on both sides.
    gains = cum.filter(right > 0).withColumn("gain", _squares(_classes("l", k)) + _squares(_classes("r", k)) - _squares(_classes("t", k)))
    weight = reduce(lambda a, b: a + b, [F.col(n) for n in _classes("t", k)])
    best = gains.withColumn("weight", weight).groupBy("tree", "node").agg(
        F.max_by(F.struct("feature", "bin", "gain", "weight"), F.struct("gain", -F.col("feature"), -F.col("bin"))).alias("b"))
    return best.select("tree", "node", "b.*").filter(F.col("gain") > s.least_gain)


def fit(train: DataFrame, key: str, label: str, features: Sequence[str], classes: int, settings: Settings = Settings()) -> Forest:
    """Grow a forest; labels are 0 .. classes - 1. Values at or below a cut go to the lower child, nulls too."""
    forest = Forest(list(features), exact_cuts(train, features, settings.bins), classes, settings, None, None)
    drawn = draw(F.lit(settings.seed), F.lit("row"), F.col("tree").cast("string"), F.col("_key"))
    weight = reduce(lambda a, b: a + b, [(drawn >= F.lit(step)).cast("int") for step in settings.poisson])
    # Bins are worked out before rows are repeated for the trees.
    rows = train.select(F.col(key).cast("string").alias("_key"), F.col(label).cast("int").alias("label"), forest.binned(train).alias("bins"))
    placed = rows.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(settings.trees - 1))))
    placed = checkpointed(placed.withColumn("weight", weight).filter("weight > 0").withColumn("node", F.lit(1)).drop("_key"))
    found, nodes = [], train.sparkSession.range(settings.trees).select(F.col("id").cast("int").alias("tree"), F.lit(1).alias("node"))
    for level in range(settings.depth):
        best = checkpointed(_best_splits(placed, nodes, forest, level))
        nodes = best.select("tree", F.explode(F.array(F.col("node") * 2, F.col("node") * 2 + 1)).alias("node"))
        found.append(best)
        # No more rows than trees times nodes of a level.
        moves = F.broadcast(best.select("tree", "node", F.col("feature").alias("_f"), F.col("bin").alias("_b")))
        goes = (F.element_at("bins", F.col("_f") + 1) > F.col("_b")).cast("int")
        placed = placed.join(moves, ["tree", "node"], "left").withColumn(
            "node", F.when(F.col("_f").isNull(), F.col("node")).otherwise(F.col("node") * 2 + goes)).drop("_f", "_b")
        placed = checkpointed(placed)
    bounds = train.sparkSession.createDataFrame(
        [(i, b, float(v)) for i, f in enumerate(forest.features) for b, v in enumerate(forest.cuts[f])], "feature int, bin int, bound double")
    forest.splits = checkpointed(reduce(DataFrame.unionByName, found).join(F.broadcast(bounds), ["feature", "bin"]))
    forest.leaves = checkpointed(placed.groupBy("tree", "node").agg(
        *[F.sum(F.when(F.col("label") == c, F.col("weight")).otherwise(0)).alias(n) for c, n in enumerate(_classes("c", classes))]))
    return forest


def predict(df: DataFrame, forest: Forest) -> DataFrame:
    """Add prediction and confidence: the class of the highest mean share over the trees, the lowest of equal ones."""
    s, names = forest.settings, _classes("c", forest.classes)
    rows = checkpointed(df.withColumn("_row", F.monotonically_increasing_id()))
    placed = rows.select("_row", forest.binned(rows).alias("bins"), F.lit(1).alias("node")).withColumn(
        "tree", F.explode(F.sequence(F.lit(0), F.lit(s.trees - 1))))
    moves = F.broadcast(forest.splits.select("tree", F.col("node").alias("_n"), F.col("feature").alias("_f"), F.col("bin").alias("_b")))
    for _ in range(s.depth):
        step = moves.withColumnRenamed("tree", "_t")
        goes = (F.element_at("bins", F.col("_f") + 1) > F.col("_b")).cast("int")
        placed = placed.join(step, (F.col("tree") == F.col("_t")) & (F.col("node") == F.col("_n")), "left").withColumn(
            "node", F.when(F.col("_f").isNull(), F.col("node")).otherwise(F.col("node") * 2 + goes)).drop("_t", "_n", "_f", "_b")
    total = reduce(lambda a, b: a + b, [F.col(n) for n in names]).cast("double")
    told = placed.join(F.broadcast(forest.leaves), ["tree", "node"]).groupBy("_row").agg(
        *[F.round(F.sum(F.col(n).cast("double") / total) / s.trees, 9).alias(n) for n in names])
    best = F.array_max(F.array(*[F.struct(F.col(n).alias("p"), F.lit(-k).alias("k")) for k, n in enumerate(names)]))
    return rows.join(told, "_row").withColumns({"prediction": (-best["k"]).cast("double"), "confidence": best["p"]}).drop("_row", *names)


def importances(forest: Forest) -> DataFrame:
    """feature and importance: each tree's gains by feature as shares, their mean over the trees that split."""
    per_tree = forest.splits.groupBy("tree", "feature").agg(F.sum("gain").alias("gain")).withColumn(
        "share", F.col("gain") / F.sum("gain").over(Window.partitionBy("tree")))
    trees = F.broadcast(forest.splits.agg(F.count_distinct("tree").cast("double").alias("trees")))
    named = F.element_at(F.array(*[F.lit(f) for f in forest.features]), F.col("feature") + 1)
    found = per_tree.groupBy(named.alias("feature")).agg(F.sum("share").alias("total")).crossJoin(trees).select(
        "feature", (F.col("total") / F.col("trees")).alias("importance"))
    every = forest.splits.sparkSession.createDataFrame([(f,) for f in forest.features], "feature string")
    return every.join(found, "feature", "left").select("feature", F.coalesce("importance", F.lit(0.0)).alias("importance"))
