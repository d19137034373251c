"""Registered queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Each query reads whole parquet tables through a binding in
``cohortlens.sources.tables``. Statistics are rounded to 6 decimals at the
output so results compare across engines (float sums depend on order).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions import cell, round6
from cohortlens.functions.columns import CASE_CODES, CONTROL_CODES
from cohortlens.operators import features as feat
from cohortlens.operators import model as ml
from cohortlens.operators import reshape, stats, textcount
from cohortlens.plans.cohort import (
    CohortAnalysis,
    from_landed,
    from_long,
    from_wide,
    land_wide,
)
from cohortlens.session import durable, run_folder
from cohortlens.sources import tables, text

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the registered queries.
LOOKUP_CLUSTER = "Brand#12"
WORD_THRESHOLD = 3
LINE_THRESHOLD = 2
ML_TREES = 10
THRESHOLD_LINE = 4

STAT_COLS = ("t", "mean", "sd", "mean_case", "sd_case", "mean_control", "sd_control",
             "score")


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    """Project ``cols`` (default: all), rounding the statistic columns."""
    return df.select(*[round6(c).alias(c) if c in STAT_COLS else F.col(c)
                       for c in (cols or df.columns)])


def long_analysis(spark: SparkSession, sf_dir: str) -> CohortAnalysis:
    """Binding L: orders as samples, line items as cells, parts as features."""
    return from_long(tables.long_samples(spark, sf_dir), tables.long_obs(spark, sf_dir),
                     tables.long_membership(spark, sf_dir), unique_samples=True,
                     **tables.long_partitions(spark, sf_dir))


def landed_analysis(spark: SparkSession, sf_dir: str) -> CohortAnalysis:
    """Binding W through files: matrix and annotation text, read back and landed."""
    folder = run_folder(spark, "wide")
    matrix = text.write_lines(tables.wide_lines(spark, sf_dir), f"{folder}/matrix")
    annotation = text.write_lines(tables.annotation_lines(spark, sf_dir), f"{folder}/annotation")
    return from_landed(spark, land_wide(spark, matrix, f"{folder}/landed"), annotation)


def cohort_background(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.long_background(spark, sf_dir, [*CONTROL_CODES, *CASE_CODES])


def wide_analysis(spark: SparkSession, sf_dir: str) -> CohortAnalysis:
    """Binding W: embeddings rendered as the wide text matrix + annotation."""
    return from_wide(spark, tables.wide_lines(spark, sf_dir),
                     tables.annotation_lines(spark, sf_dir))


T_COLS = ("cluster", "t", "mean_case", "sd_case", "mean_control", "sd_control",
          "n_case", "n_control")
RANK_COLS = ("rank", "cluster", "t", "mean_case", "sd_case", "mean_control", "sd_control")


# ---- long binding -------------------------------------------------------------

def q_cohort_sizes(spark, sf_dir):
    return long_analysis(spark, sf_dir).sizes


def q_cluster_scores(spark, sf_dir):
    return _rounded(long_analysis(spark, sf_dir).scores)


def q_cohort_stats(spark, sf_dir):
    st = long_analysis(spark, sf_dir).stats
    return _rounded(st, "grp", "cluster", "n", "n_scored", "mean", "sd")


def q_t_scores_all(spark, sf_dir):
    return _rounded(long_analysis(spark, sf_dir).t_scores, *T_COLS)


def q_top_k_clusters(spark, sf_dir):
    return _rounded(long_analysis(spark, sf_dir).ranked, *RANK_COLS)


def q_cluster_lookup(spark, sf_dir):
    a = long_analysis(spark, sf_dir)
    return _rounded(a.lookup(LOOKUP_CLUSTER), *T_COLS)


def q_sample_features(spark, sf_dir):
    a = long_analysis(spark, sf_dir)
    df = a.sample_features(cohort_background(spark, sf_dir))
    cols = ["grp", "sample_id", "label", "age", "sex", "education", *feat.feature_names(a.k)]
    return df.select(*cols)


def q_tagged_union(spark, sf_dir):
    return stats.tag_cohorts(long_analysis(spark, sf_dir).cohort)


def q_tagged_part(spark, sf_dir):
    return stats.select_part(q_tagged_union(spark, sf_dir), 1)


# ---- wide binding (delimited text) --------------------------------------------

def _wide_rows(spark, sf_dir):
    return text.wide_rows(spark, tables.wide_lines(spark, sf_dir))


def q_delimited_parse(spark, sf_dir):
    cells = F.col("cells")
    numeric = F.transform(cells, lambda x, i: F.when(i >= 2, x.try_cast("bigint")))
    value_sum = F.aggregate(numeric, F.lit(0).cast("bigint"),
                            lambda acc, x: acc + F.coalesce(x, F.lit(0).cast("bigint")))
    return _wide_rows(spark, sf_dir).select(
        cell(cells, 0).alias("sample_id"), cell(cells, 1).alias("code"),
        F.size(cells).cast("bigint").alias("n_cells"), value_sum.alias("value_sum"))


def q_annotation_explode(spark, sf_dir):
    ann = text.annotation(spark, tables.annotation_lines(spark, sf_dir))
    return reshape.membership(ann)


def q_header_positions(spark, sf_dir):
    return reshape.header_positions(_wide_rows(spark, sf_dir))


def q_position_cluster_map(spark, sf_dir):
    return wide_analysis(spark, sf_dir).feature_clusters


def q_unpivot_long(spark, sf_dir):
    return wide_analysis(spark, sf_dir).cells


def q_cohort_sizes_wide(spark, sf_dir):
    return wide_analysis(spark, sf_dir).sizes


def q_top_k_clusters_wide(spark, sf_dir):
    return _rounded(wide_analysis(spark, sf_dir).ranked, *RANK_COLS)


def q_top_k_clusters_landed(spark, sf_dir):
    return _rounded(landed_analysis(spark, sf_dir).ranked, *RANK_COLS)


def q_cohort_stats_wide(spark, sf_dir):
    st = wide_analysis(spark, sf_dir).stats
    return _rounded(st, "grp", "cluster", "n", "n_scored", "mean", "sd")


def q_sample_features_wide(spark, sf_dir):
    a = wide_analysis(spark, sf_dir)
    return a.sample_features().select("grp", "sample_id", "label", *feat.feature_names(a.k))


def q_fold_assignment(spark, sf_dir):
    emb = tables.table(spark, sf_dir, "embeddings")
    return emb.select(F.col("vec_id").alias("sample_id"),
                      ml.fold_of(F.col("vec_id")).alias("fold"),
                      ml.holdout_of(F.col("vec_id")).alias("holdout"))


# ---- background and fixed-width text ------------------------------------------

def q_background_parse(spark, sf_dir):
    return text.background(spark, tables.background_lines(spark, sf_dir))


def q_background_csv_parse(spark, sf_dir):
    """S1 + S6 through files: the rendered background is written as text to a
    new folder of this call, then read back and parsed by Spark's CSV parser."""
    path = text.write_lines(tables.background_lines(spark, sf_dir),
                            f"{run_folder(spark, 'background')}/lines")
    return text.background_csv(spark, path)


def q_background_quality(spark, sf_dir):
    """Lines of the background that are used and set aside, and samples without an age."""
    parsed = text.background(spark, tables.background_lines(spark, sf_dir))
    features = long_analysis(spark, sf_dir).sample_features(
        cohort_background(spark, sf_dir).filter("age >= 0"))
    counts = text.background_quality(parsed).selectExpr(
        "stack(3, 'lines', n_lines, 'lines used', n_used, 'lines set aside', n_set_aside)"
        " AS (what, n)")
    return counts.unionAll(ml.age_quality(features).selectExpr(
        "stack(2, 'samples', n_samples, 'samples without age', n_without_age) AS (what, n)"))


def q_fixed_width_groups(spark, sf_dir):
    return textcount.key_groups(tables.fixed_width_lines(spark, sf_dir),
                                start=tables.ID_WIDTH + 1)


# ---- evaluation pairs -----------------------------------------------------------

def q_confusion_matrix(spark, sf_dir):
    return _rounded_fracs(ml.confusion(tables.evaluation_pairs(spark, sf_dir)))


def q_fold_error_mean(spark, sf_dir):
    pairs = ml.with_folds(tables.evaluation_pairs(spark, sf_dir), "doc_id")
    per_fold = ml.confusion(pairs, by=("fold",))
    return per_fold.agg(F.count("error").alias("n_folds"),
                        round6(F.avg("error")).alias("mean_error"))


def _rounded_fracs(df):
    fracs = {"tn_frac", "tp_frac", "fp_frac", "fn_frac", "error"}
    return df.select(*[round6(c).alias(c) if c in fracs else F.col(c) for c in df.columns])


def _rounded_errors(df):
    return df.select(*[round6(c).alias(c) if "error" in c else F.col(c) for c in df.columns])


# ---- text counts ----------------------------------------------------------------

def _word_counts(spark, sf_dir):
    toks = textcount.tokens(tables.document_lines(spark, sf_dir), textcount.WHITESPACE,
                            drop_empty=True)
    return textcount.token_counts(toks, WORD_THRESHOLD)


def q_word_count_threshold(spark, sf_dir):
    return _word_counts(spark, sf_dir)


def q_char_count(spark, sf_dir):
    return textcount.char_counts(_word_counts(spark, sf_dir))


def q_line_count_threshold(spark, sf_dir):
    toks = textcount.tokens(tables.document_lines(spark, sf_dir))
    return textcount.token_counts(toks, LINE_THRESHOLD)


# ---- classification ------------------------------------------------------------

def labeled(spark: SparkSession, sf_dir: str, feature_set: str = "genes") -> DataFrame:
    """Binding L + B: labelled points from the per-sample top-k features."""
    a = long_analysis(spark, sf_dir)
    background = cohort_background(spark, sf_dir) if feature_set == "life_stats" else None
    return ml.labeled_points(a.sample_features(background), feature_set, a.k)


def labeled_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binding W: labelled points from the text matrix's top-k features."""
    a = wide_analysis(spark, sf_dir)
    return ml.labeled_points(a.sample_features(), "genes", a.k)


def _cv_query(models: tuple[str, ...], feature_set: str = "genes", wide: bool = False) -> Query:
    def run(spark, sf_dir):
        points = labeled_wide(spark, sf_dir) if wide else labeled(spark, sf_dir, feature_set)
        per_fold, _ = ml.cross_validate(points, models, num_trees=ML_TREES)
        return _rounded_fracs(per_fold)
    return run


def q_model_comparison(spark, sf_dir):
    per_fold, _ = ml.cross_validate(labeled(spark, sf_dir), ml.MODELS, num_trees=ML_TREES)
    return ml.mean_error(per_fold).select("model", "n_folds",
                                          round6("mean_error").alias("mean_error"))


def _labeled_columns(points: DataFrame, names: list[str]) -> DataFrame:
    values = vector_to_array("features")
    return points.select("sample_id", "label", "fold", *[
        round6(values[i]).alias(name) for i, name in enumerate(names)])


def q_labeled_points(spark, sf_dir):
    return _labeled_columns(labeled(spark, sf_dir), feat.feature_columns("genes"))


def q_labeled_points_life_stats(spark, sf_dir):
    return _labeled_columns(labeled(spark, sf_dir, "life_stats"),
                            feat.feature_columns("life_stats"))


def q_fold_split_sizes(spark, sf_dir):
    """Rows and positive labels of the training and test part of each fold."""
    points = labeled(spark, sf_dir).select("label", "fold")
    out = None
    for fold in range(ml.N_FOLDS):
        for name, part in zip(("train", "test"), ml.training_split(points, fold), strict=True):
            row = part.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("n_case")).select(
                F.lit(fold).alias("fold"), F.lit(name).alias("part"), "n", "n_case")
            out = row if out is None else out.unionAll(row)
    return out


def threshold_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items labelled by a threshold of their first feature (few values, so the
    split is a candidate and a tree finds it exactly); two features without bearing."""
    items = tables.table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 16 + F.col("l_linenumber")).alias("sample_id"),
        F.when(F.col("l_linenumber") >= THRESHOLD_LINE, 1.0).otherwise(0.0).alias("label"),
        F.col("l_linenumber").cast("double").alias("f01"),
        F.col("l_quantity").cast("double").alias("f02"),
        F.col("l_discount").cast("double").alias("f03"))
    return ml.labeled_points(items, "genes", 3)


def q_threshold_trees(spark, sf_dir):
    """Confusion counts of both trees on every fold."""
    per_fold, _ = ml.cross_validate(threshold_points(spark, sf_dir), ("tree_gini", "tree_entropy"))
    return per_fold.select("model", "fold", "n", "tn", "tp", "fp", "fn", "errors")


def q_threshold_holdout(spark, sf_dir):
    """M3: test counts and error of a tree fitted on the 70 % hold-out."""
    return _rounded_fracs(ml.holdout_error(threshold_points(spark, sf_dir))).select(
        "n", "tn", "tp", "fp", "fn", "errors", "error")


def q_tree_text(spark, sf_dir):
    """M9: the learned trees of one fold per model, as rows."""
    _, results = ml.cross_validate(threshold_points(spark, sf_dir), ("tree_gini",))
    return ml.tree_texts(spark, results)


def q_model_roundtrip(spark, sf_dir):
    """M3 + S10 + M7: fit on the 70/30 hold-out, save, reload; held-out rows
    and how many of them both models predict alike, per label."""
    points = durable(labeled(spark, sf_dir))
    train, test = ml.holdout_split(points)
    fitted = ml.estimator("tree_gini").fit(train)
    path = f"{run_folder(spark, 'model')}/tree_gini"
    ml.save(fitted, path)
    reloaded = ml.load(path)
    reloaded.setPredictionCol("prediction_reloaded").setRawPredictionCol("raw_reloaded") \
        .setProbabilityCol("probability_reloaded")
    both = reloaded.transform(fitted.transform(test))
    alike = F.col("prediction") == F.col("prediction_reloaded")
    return both.groupBy("label").agg(F.count(F.lit(1)).alias("n_test"),
                                     F.count(F.when(alike, 1)).alias("n_alike"))


QUERIES: dict[str, Query] = {
    "cohort_sizes": q_cohort_sizes,
    "cluster_scores": q_cluster_scores,
    "cohort_stats": q_cohort_stats,
    "t_scores_all": q_t_scores_all,
    "top_k_clusters": q_top_k_clusters,
    "cluster_lookup": q_cluster_lookup,
    "sample_features": q_sample_features,
    "tagged_union": q_tagged_union,
    "tagged_part": q_tagged_part,
    "delimited_parse": q_delimited_parse,
    "annotation_explode": q_annotation_explode,
    "header_positions": q_header_positions,
    "position_cluster_map": q_position_cluster_map,
    "unpivot_long": q_unpivot_long,
    "cohort_stats_wide": q_cohort_stats_wide,
    "cohort_sizes_wide": q_cohort_sizes_wide,
    "top_k_clusters_wide": q_top_k_clusters_wide,
    "top_k_clusters_landed": q_top_k_clusters_landed,
    "sample_features_wide": q_sample_features_wide,
    "fold_assignment": q_fold_assignment,
    "background_parse": q_background_parse,
    "background_csv_parse": q_background_csv_parse,
    "background_quality": q_background_quality,
    "fixed_width_groups": q_fixed_width_groups,
    "confusion_matrix": q_confusion_matrix,
    "fold_error_mean": q_fold_error_mean,
    "word_count_threshold": q_word_count_threshold,
    "char_count": q_char_count,
    "line_count_threshold": q_line_count_threshold,
    "tree_gini_cv": _cv_query(("tree_gini",)),
    "tree_entropy_cv": _cv_query(("tree_entropy",)),
    "forest_cv": _cv_query(("forest_entropy",)),
    "forest_cv_life_stats": _cv_query(("forest_entropy",), "life_stats"),
    "tree_gini_cv_wide": _cv_query(("tree_gini",), wide=True),
    "model_comparison": q_model_comparison,
    "labeled_points": q_labeled_points,
    "labeled_points_life_stats": q_labeled_points_life_stats,
    "fold_split_sizes": q_fold_split_sizes,
    "threshold_trees": q_threshold_trees,
    "threshold_holdout": q_threshold_holdout,
    "tree_text": q_tree_text,
    "model_roundtrip": q_model_roundtrip,
}
