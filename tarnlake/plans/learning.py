"""Customer tier model, forecast and error measure on DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.operators.timeseries import series_window
from tarnlake.session import checkpointed

TIER_FEATURES = (
    "TotalOrdersFirst90Days", "SpendFirst90Days", "AvgTicketFirst90Days", "ProductDiversity",
    "CategoryDiversity", "DaysToRepurchase",
)
SEED = 42


def feature_pipeline(label: str = "ClientRank", features: Sequence[str] = TIER_FEATURES) -> Pipeline:
    return Pipeline(
        stages=[
            StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc"),
            VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error"),
        ]
    )


def prepare(df: DataFrame, label: str = "ClientRank", features: Sequence[str] = TIER_FEATURES) -> DataFrame:
    """Label index and feature vector; decimals become doubles for the assembler."""
    typed = df.withColumns({c: F.col(c).cast("double") for c in features})
    return feature_pipeline(label, features).fit(typed).transform(typed)


def split(df: DataFrame, key: str, train: float = 0.8, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Random split that depends on the key alone, so it survives re-partitioning and
    recomputed tasks."""
    share = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1_000_000)) / F.lit(1_000_000.0)
    return df.filter(share < train), df.filter(share >= train)


def fit_forest(train: DataFrame, trees: int = 100, seed: int = SEED):
    return RandomForestClassifier(
        labelCol="label", featuresCol="features", numTrees=trees, seed=seed
    ).fit(train)


def scores(predictions: DataFrame) -> DataFrame:
    """Accuracy, weighted precision and recall, F1 as one row per metric."""
    names = {
        "accuracy": "accuracy", "precision": "weightedPrecision", "recall": "weightedRecall", "f1": "f1",
    }
    # Stored, for each metric reads them.
    predictions = checkpointed(predictions.select("label", "prediction"))
    rows = [
        (name, float(MulticlassClassificationEvaluator(
            labelCol="label", predictionCol="prediction", metricName=metric).evaluate(predictions)))
        for name, metric in names.items()
    ]
    return predictions.sparkSession.createDataFrame(rows, "metric string, value double")


def confusion(predictions: DataFrame) -> DataFrame:
    """Counts of predicted class (columns) per true class (rows), for every class that is met."""
    predictions = checkpointed(predictions.select("label", "prediction"))
    classes = int(predictions.agg(F.max(F.greatest("label", "prediction"))).first()[0] or 0) + 1
    wide = predictions.groupBy(F.col("label").cast("int").alias("label")).pivot(
        "prediction", [float(i) for i in range(classes)]
    ).count()
    return wide.na.fill(0).toDF("label", *[f"predicted_{i}" for i in range(classes)])


def importances(model, spark, features: Sequence[str] = TIER_FEATURES) -> DataFrame:
    rows = [(f, float(w)) for f, w in zip(features, model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def with_probability(predictions: DataFrame) -> DataFrame:
    return predictions.withColumn("confidence", F.array_max(vector_to_array("probability")))


def time_split(df: DataFrame, date: str, cut: Column, leave_out: Column | None = None) -> DataFrame:
    """Mark rows train or test by date; ``leave_out`` drops months seen as unusable."""
    kept = df if leave_out is None else df.filter(~leave_out)
    return kept.withColumn("part", F.when(F.col(date) < cut, "train").otherwise("test"))


def smape(df: DataFrame, actual: str, predicted: str, *by: str) -> DataFrame:
    """Symmetric mean absolute percentage error."""
    a, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    term = 2 * F.abs(p - a) / (F.abs(a) + F.abs(p) + F.lit(1e-8))
    return df.groupBy(*by).agg((F.lit(100.0) * F.avg(term)).alias("smape"))


def seasonal_forecast(
    series: DataFrame, entity: Sequence[str], month: str, value: str, start: str, end: str,
    season: int = 12,
) -> DataFrame:
    """Monthly forecast of many dense series at once.

    Per series a line is fitted from the value one season back to the current one,
    then applied as often as seasons separate the wanted month from the data. A series
    without enough history repeats its last season. Fit and forecast are aggregates
    and joins on the entity; no series is gathered in Python.
    """
    w = series_window(entity, month)
    y, x = F.col(value).cast("double"), F.lag(F.col(value).cast("double"), season).over(w)
    pairs = series.select(*entity, F.col(month).alias("_m"), y.alias("_y"), x.alias("_x"))
    fits = pairs.groupBy(*entity).agg(
        F.max("_m").alias("_last"),
        F.regr_slope("_y", "_x").alias("_b"),
        F.regr_intercept("_y", "_x").alias("_a"),
        F.avg("_y").alias("_mean"),
    )
    step = F.expr("interval 1 month")
    wanted = fits.select(
        "*",
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), step)).alias("date"),
    ).filter(F.col("date") > F.col("_last"))
    seasons = F.ceil(F.months_between("date", "_last") / season).cast("int")
    wanted = wanted.withColumn("_k", seasons).withColumn(
        "_m", F.add_months("date", F.col("_k") * F.lit(-season))
    )
    base = pairs.select(*entity, "_m", F.col("_y").alias("_base"))
    known = wanted.join(base, [*entity, "_m"], "left")
    a, b = F.coalesce("_a", F.lit(0.0)), F.when(F.col("_a").isNull(), F.lit(1.0)).otherwise(F.col("_b"))
    forecast = F.aggregate(
        F.sequence(F.lit(1), F.col("_k")), F.coalesce("_base", "_mean"), lambda acc, _: a + b * acc
    )
    return known.select(*entity, "date", F.round(forecast, 2).alias("prediction"))


# How fast level, trend and season follow the data; the best is chosen for each series.
GRID = [(a, b, c) for a in (0.1, 0.3, 0.5) for b in (0.0, 0.1) for c in (0.1, 0.3)]


def smoothed_forecast(
    series: DataFrame, entity: Sequence[str], month: str, value: str, start: str, end: str, season: int = 12, grid: Sequence = GRID,
) -> DataFrame:
    """Monthly forecast of many dense series at once, with a level, a trend and a season that are carried along.

    Level and season start from the first season and the trend from the first two; from then on each month moves them by its
    one-step error. For each series the factors of the least total error are taken (the first in the grid of equal ones). A series of
    less than two seasons goes on at its mean. A series has a row for each month, so its array is bounded by the calendar."""
    zeros = F.array_repeat(F.lit(0.0), season)
    own = series.groupBy(*entity).agg(
        F.transform(F.sort_array(F.collect_list(F.struct(F.col(month).alias("m"), F.col(value).cast("double").alias("v")))), lambda x: x["v"]).alias("y"),
        F.max(month).alias("_last"))

    def mean(values: Column, n: Column | int) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.lit(n)

    first, second = mean(F.slice("y", 1, season), season), mean(F.slice("y", season + 1, season), season)
    long = F.size("y") >= 2 * season
    begun = own.withColumns({
        "_n": F.size("y"), "_level": F.when(long, first).otherwise(F.aggregate("y", F.lit(0.0), lambda a, x: a + x) / F.size("y")),
        "_trend": F.when(long, (second - first) / F.lit(season)).otherwise(F.lit(0.0)),
        "_seasons": F.when(long, F.transform(F.slice("y", 1, season), lambda x: x - first)).otherwise(zeros)})
    tried = begun.withColumn("f", F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(c).alias("c")) for k, (a, b, c) in enumerate(grid)])))

    def move(state: Column, t: Column) -> Column:
        place = (t % season).cast("int")
        was, y = F.get(state["seasons"], place), F.get(F.col("y"), t)
        told = state["level"] + state["trend"]
        level = F.col("f.a") * (y - was) + (1 - F.col("f.a")) * told
        trend = F.col("f.b") * (level - state["level"]) + (1 - F.col("f.b")) * state["trend"]
        now = F.col("f.c") * (y - level) + (1 - F.col("f.c")) * was
        return F.struct(
            level.alias("level"), trend.alias("trend"), F.transform(state["seasons"], lambda x, i: F.when(i == place, now).otherwise(x)).alias("seasons"),
            (state["error"] + F.abs(y - told - was)).alias("error"))

    state = F.struct(F.col("_level").alias("level"), F.col("_trend").alias("trend"), F.col("_seasons").alias("seasons"), F.lit(0.0).alias("error"))
    steps = F.when(F.col("_n") >= 2 * season, F.sequence(F.lit(season), F.col("_n") - 1)).otherwise(F.array().cast("array<int>"))
    ended = tried.withColumn("s", F.aggregate(steps, state, move))
    best = ended.groupBy(*entity).agg(F.min_by(F.struct("s", "_last", "_n"), F.struct("s.error", "f.k")).alias("b"))
    wanted = best.select(*entity, "b.*", F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 month"))).alias("date"))
    ahead = F.months_between("date", "_last").cast("int")
    place = ((F.col("_n") + ahead - 1) % season).cast("int")
    return wanted.filter(F.col("date") > F.col("_last")).select(
        *entity, "date", (F.col("s.level") + ahead * F.col("s.trend") + F.get("s.seasons", place)).alias("prediction"))


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)
