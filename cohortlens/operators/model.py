"""Classification and evaluation.

Spark ML estimators replace the RDD-based MLlib calls: training is
distributed (binned features, per-node statistics aggregated on executors)
and predictions stay in the row next to the label, so no positional zip is
needed. Folds come from a hash of the sample id, so membership does not
depend on partition layout and every engine reproduces it.
"""

from __future__ import annotations

import math
import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions import hash_bucket
from cohortlens.functions.columns import hash_number
from cohortlens.operators.features import feature_columns
from cohortlens.operators.ordered import DIGITS, order_statistics
from cohortlens.operators.rank import TOP_K
from cohortlens.session import durable, run_folder

# Fold boundaries on a 200-bucket hash (weights .335/.335/.33),
# hold-out split 0.7/0.3, and the model settings of the classifiers.
FOLD_BUCKETS = 200
FOLD_EDGES = (67, 134)
N_FOLDS = len(FOLD_EDGES) + 1
FOLD_WEIGHTS = (0.335, 0.335, 0.33)
HOLDOUT_EDGE = 140
MAX_DEPTH = 5
FOREST_SEED = 123
RANDOM_SPLIT_SEED = 1234
DEFAULT_TREES = 10
MODELS = ("tree_gini", "tree_entropy", "forest_entropy")


def fold_of(sample_id) -> F.Column:
    """M1/M2: fold 0, 1 or 2 from the hash bucket of the sample id."""
    b = hash_bucket(sample_id, FOLD_BUCKETS)
    return (F.when(b < FOLD_EDGES[0], F.lit(0))
            .when(b < FOLD_EDGES[1], F.lit(1))
            .otherwise(F.lit(2)))


def holdout_of(sample_id) -> F.Column:
    """M3: 'train' for 70 % of the hash buckets, 'test' for the rest."""
    return F.when(hash_bucket(sample_id, FOLD_BUCKETS) < HOLDOUT_EDGE,
                  F.lit("train")).otherwise(F.lit("test"))


def holdout_split(df: DataFrame, id_col: str = "sample_id") -> tuple[DataFrame, DataFrame]:
    """M3: (train, test) by the 70/30 hash hold-out of the sample id."""
    part = holdout_of(F.col(id_col))
    return df.filter(part == F.lit("train")), df.filter(part == F.lit("test"))


def with_folds(df: DataFrame, id_col: str = "sample_id", method: str = "hash",
               seed: int = RANDOM_SPLIT_SEED) -> DataFrame:
    """Add ``fold`` (0, 1, 2) with weights .335/.335/.33.

    ``method='hash'`` (default) buckets the md5 of the id: the same in every
    run, layout and engine. ``method='random'`` draws a seeded uniform
    number per row, like a seeded random split; the draw depends on the
    partition layout, as the original split did.
    """
    if method == "hash":
        return df.withColumn("fold", fold_of(F.col(id_col)))
    if method == "random":
        # draw once per row: each evaluation of rand() advances the generator
        r = F.col("_fold_draw")
        edges = [e / FOLD_BUCKETS for e in FOLD_EDGES]
        return (df.withColumn("_fold_draw", F.rand(seed))
                .withColumn("fold", F.when(r < edges[0], F.lit(0))
                            .when(r < edges[1], F.lit(1)).otherwise(F.lit(2)))
                .drop("_fold_draw"))
    raise ValueError(f"method must be 'hash' or 'random', got {method!r}")


def exact_folds(df: DataFrame, id_col: str = "sample_id",
                weights: tuple[float, ...] = FOLD_WEIGHTS, seed: int = RANDOM_SPLIT_SEED
                ) -> DataFrame:
    """M1: ``fold`` by a seeded hash, with fold sizes exact to a row.

    Fold i ends at the ⌊n · (w₀ + … + wᵢ)⌋-th id in order of hash and id text. The ids at
    these places are found by counting (:func:`ordered.order_statistics`), so nothing is
    sorted and the same ids give the same folds in any layout. Rows with equal ids share a
    fold (then sizes are exact up to the rows of one id); null ids are in the last one.
    """
    ids = df.filter(F.col(id_col).isNotNull()).select(id_col)
    n = ids.count()
    shares = [sum(weights[:i + 1]) for i in range(len(weights) - 1)]
    cuts = order_statistics(ids, [math.floor(n * s + 1e-9) for s in shares], seed, id_col)
    text = F.col(id_col).cast("string")
    place = F.struct(hash_number(text, seed, DIGITS), text)
    fold = F.lit(len(weights) - 1)
    for i in range(len(cuts) - 1, -1, -1):
        if cuts[i] is not None:
            upto = place <= F.struct(F.lit(cuts[i][0]).cast("bigint"), F.lit(cuts[i][1]))
            fold = F.when(text.isNotNull() & upto, F.lit(i)).otherwise(fold)
    return df.withColumn("fold", fold)


def training_split(df: DataFrame, fold: int) -> tuple[DataFrame, DataFrame]:
    """train = union of the other folds (one filter), test = this fold."""
    return df.filter(F.col("fold") != fold), df.filter(F.col("fold") == fold)


def labeled_points(features: DataFrame, feature_set: str = "genes",
                   k: int = TOP_K, fold_method: str = "hash") -> DataFrame:
    """M4 + R7 + P13: ``(sample_id, label, fold, features)``.

    A sample without a score in a top-k cluster has zero of that cluster
    (matching the mean's treatment of absent samples). ``life_stats``
    prepends age; samples without background age are left out (and counted by
    :func:`age_quality`). Folds as in :func:`with_folds`.
    """
    cols = feature_columns(feature_set, k)
    score_cols = [c for c in cols if c != "age"]
    df = features.fillna(0.0, subset=score_cols)
    if "age" in cols:
        df = df.filter(F.col("age").isNotNull()).withColumn("age", F.col("age").cast("double"))
    assembled = VectorAssembler(inputCols=cols, outputCol="features").transform(df)
    return with_folds(assembled.select("sample_id", "label", "features"), method=fold_method)


def estimator(model: str, num_trees: int = DEFAULT_TREES):
    """M5 / M6: the classifier behind a model name."""
    if model == "tree_gini":
        return DecisionTreeClassifier(impurity="gini", maxDepth=MAX_DEPTH)
    if model == "tree_entropy":
        return DecisionTreeClassifier(impurity="entropy", maxDepth=MAX_DEPTH)
    if model == "forest_entropy":
        return RandomForestClassifier(numTrees=int(num_trees), impurity="entropy",
                                      maxDepth=MAX_DEPTH, featureSubsetStrategy="auto",
                                      seed=FOREST_SEED)
    raise ValueError(f"model must be one of {MODELS}, got {model!r}")


def confusion(pairs: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """A11 + A12 + P7 + P8: counts, fractions and error (per ``by`` group).

    ``pairs`` has ``label`` and ``prediction`` (0/1). One aggregate replaces
    a count per cell; an empty input gives NULL error, not a failure.
    """
    lab, pred = F.col("label"), F.col("prediction")

    def cnt(cond):
        return F.count(F.when(cond, F.lit(1)))

    counts = pairs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        cnt((lab == 0) & (pred == 0)).alias("tn"),
        cnt((lab == 1) & (pred == 1)).alias("tp"),
        cnt((lab == 0) & (pred == 1)).alias("fp"),
        cnt((lab == 1) & (pred == 0)).alias("fn"),
        cnt(lab != pred).alias("errors"),
    )
    n = F.col("n")
    return counts.select(
        *by, "n", "tn", "tp", "fp", "fn", "errors",
        F.try_divide(F.col("tn"), n).alias("tn_frac"),
        F.try_divide(F.col("tp"), n).alias("tp_frac"),
        F.try_divide(F.col("fp"), n).alias("fp_frac"),
        F.try_divide(F.col("fn"), n).alias("fn_frac"),
        F.try_divide(F.col("errors"), n).alias("error"),
    )


def evaluate(model: Model, test: DataFrame) -> DataFrame:
    """M7 + M8: predict the test rows and summarise the confusion matrix."""
    return confusion(model.transform(test).select("label", "prediction"))


@dataclass
class FoldResult:
    model: str
    fold: int
    fitted: Model


def by_fold(points: DataFrame) -> DataFrame:
    """``points`` written once to the shared folder, one sub-folder per fold.

    Training and test scans then read the folders of their folds only.
    """
    path = f"{run_folder(points.sparkSession, 'points')}/points"
    points.write.partitionBy("fold").parquet(path)
    return points.sparkSession.read.schema(points.schema).parquet(path)

def predictions(fitted: dict[str, Model], test: DataFrame) -> DataFrame:
    """M7: ``model, label, prediction`` of several models from one scan of ``test``."""
    for i, model in enumerate(fitted.values()):
        test = model.copy().setPredictionCol(f"_p{i}").setRawPredictionCol(
            f"_r{i}").setProbabilityCol(f"_q{i}").transform(test)
    each = F.array(*[F.struct(F.lit(name).alias("model"), F.col(f"_p{i}").alias("prediction"))
                     for i, name in enumerate(fitted)])
    return test.select("label", F.explode(each).alias("m")).select("m.model", "label",
                                                                   "m.prediction")


def cross_validate(points: DataFrame, models=MODELS, num_trees: int = DEFAULT_TREES,
                   parallelism: int = 4, landed: bool = False
                   ) -> tuple[DataFrame, list[FoldResult]]:
    """Every model × fold (the ``N_FOLDS`` folds of :func:`with_folds`);
    returns per-fold metrics and fitted models.

    The labelled points are written once by fold (:func:`by_fold`, unless ``landed``
    says that they come from there). Fits are
    independent Spark jobs, so up to ``parallelism`` of them are submitted
    at once (as Spark ML's own tuning estimators do); each fit is itself
    distributed over the cluster. Each fold is then evaluated in one scan, all
    its models side by side.
    """
    if not landed:
        points = by_fold(points)
    tasks = [(name, fold) for name in models for fold in range(N_FOLDS)]

    def fit(task):
        name, fold = task
        train, _ = training_split(points, fold)
        return FoldResult(name, fold, estimator(name, num_trees).fit(train))

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        results = list(pool.map(fit, tasks))
    table = None
    for fold in range(N_FOLDS):
        _, test = training_split(points, fold)
        # fold and model names come from the left side, so a fold without test rows keeps its row
        names = test.sparkSession.createDataFrame([(m, fold) for m in models],
                                                  "model string, fold int")
        counted = confusion(predictions({r.model: r.fitted for r in results if r.fold == fold},
                                        test), by=("model",))
        rows = names.join(counted, "model", "left").fillna(
            0, ["n", "tn", "tp", "fp", "fn", "errors"])
        table = rows if table is None else table.unionByName(rows)
    return table, results


def tree_texts(spark: SparkSession, results: list[FoldResult]) -> DataFrame:
    """M9: ``model, fold, line_no, line`` of the learned trees."""
    rows = [(r.model, r.fold, i, line) for r in results
            for i, line in enumerate(describe(r.fitted).rstrip("\n").split("\n"))]
    return spark.createDataFrame(rows, "model string, fold int, line_no int, line string")


def holdout_error(points: DataFrame, model: str = "tree_gini") -> DataFrame:
    """M3 + M8: the confusion matrix and error of a model fitted on the 70 % hold-out."""
    train, test = holdout_split(durable(points))
    return evaluate(estimator(model).fit(train), test)


def age_quality(features: DataFrame) -> DataFrame:
    """``n_samples, n_without_age`` of a feature table: what ``life_stats`` leaves out."""
    return features.agg(F.count(F.lit(1)).alias("n_samples"),
                        F.count(F.when(F.col("age").isNull(), 1)).alias("n_without_age"))


def mean_error(per_fold: DataFrame) -> DataFrame:
    """Mean fold error per model (folds with NULL error are skipped)."""
    return per_fold.groupBy("model").agg(
        F.count("error").alias("n_folds"),
        F.avg("error").alias("mean_error"),
    )


def comparison(per_fold: DataFrame) -> DataFrame:
    """M10 + A13: ``model, error_0, …, n_folds, mean_error``: fold errors and mean side by side."""
    each = [F.max(F.when(F.col("fold") == i, F.col("error"))).alias(f"error_{i}")
            for i in range(N_FOLDS)]
    return per_fold.groupBy("model").agg(*each, F.count("error").alias("n_folds"),
                                         F.avg("error").alias("mean_error"))


def describe(model: Model) -> str:
    """M9: the learned trees as text (without the random uid)."""
    return re.sub(r"uid=[^,]*, ", "", model.toDebugString)


def save(model: Model, path: str) -> None:
    """Persist a fitted model (overwrites)."""
    model.write().overwrite().save(path)


def load(path: str) -> Model:
    """Reload a model saved by :func:`save`, of whatever kind its metadata names."""
    return DefaultParamsReader.loadParamsInstance(path, SparkSession.getActiveSession())
