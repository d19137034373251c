"""Registered queries over stored state and sorted runs, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.operators import features as feat
from cohortlens.operators import rank, reshape, stats, textcount
from cohortlens.plans import oracle as sql
from cohortlens.plans import registry as base
from cohortlens.plans import storage
from cohortlens.plans.cohort import from_long
from cohortlens.session import run_folder
from cohortlens.sources import tables, text

# Fixed parameters of the registered queries.
HALF_LINE = 3
FIRST_SAMPLES = 2


def q_cluster_scores_wide(spark, sf_dir):
    """J2 + A2 inside the row of the wide matrix."""
    a = base.wide_analysis(spark, sf_dir)
    rows = reshape.cohort_rows(text.wide_rows(spark, tables.wide_lines(spark, sf_dir)))
    scores = stats.cluster_scores_wide(reshape.row_values(rows), a.cells, a.feature_clusters,
                                       a.salts)
    return base._rounded(scores)


def q_cohort_sizes_landed(spark, sf_dir):
    """A1: cohort sizes observed while the matrix text was landed."""
    return base.landed_analysis(spark, sf_dir).sizes


def half_analyses(spark, sf_dir):
    """Binding L in two snapshots: cells by line number, sample rows by order key.

    Orders of more than ``HALF_LINE`` lines have cells in both.
    """
    samples, obs = tables.long_samples(spark, sf_dir), tables.table(spark, sf_dir, "lineitem")
    cohort = stats.assign_cohorts(samples).select("sample_id", "grp")
    partitions = tables.long_partitions(spark, sf_dir)
    for half in (0, 1):
        early = F.col("l_linenumber") <= HALF_LINE
        cells = obs.filter(early if half == 0 else ~early).select(
            F.col("l_orderkey").alias("sample_id"), F.col("l_partkey").alias("feature_id"),
            F.col("l_quantity").cast("double").alias("value"))
        a = from_long(samples, cells, tables.long_membership(spark, sf_dir), unique_samples=True,
                      **partitions)
        a.cohort_sizes = stats.cohort_sizes(cohort.filter(F.pmod("sample_id", F.lit(2)) == half))
        yield a


def q_cohort_stats_incremental(spark, sf_dir):
    """A3, A5: statistics of two landed snapshots merged from their states."""
    folder = run_folder(spark, "snapshots")
    states = [storage.land_state(a, f"{folder}/{i}")
              for i, a in enumerate(half_analyses(spark, sf_dir))]
    merged = storage.merged_statistics(spark, *states)
    return base._rounded(merged, "grp", "cluster", "n", "n_scored", "mean", "sd")


def q_t_scores_incremental(spark, sf_dir):
    """A7 on merged snapshot states."""
    folder = run_folder(spark, "snapshots")
    states = [storage.land_state(a, f"{folder}/{i}")
              for i, a in enumerate(half_analyses(spark, sf_dir))]
    return base._rounded(stats.t_scores(storage.merged_statistics(spark, *states)), *base.T_COLS)


def q_sample_features_bucketed(spark, sf_dir):
    """J2, J6, M11 on sample tables bucketed by sample id."""
    folder = run_folder(spark, "bucketed")
    a = storage.from_bucketed(tables.long_samples(spark, sf_dir), tables.long_obs(spark, sf_dir),
                              tables.long_membership(spark, sf_dir), folder)
    background = storage.land_bucketed(base.cohort_background(spark, sf_dir),
                                       f"{folder}/background")
    df = a.sample_features(background)
    return df.select("grp", "sample_id", "label", "age", "sex", "education",
                     *feat.feature_names(a.k))


def q_cluster_lookup_landed(spark, sf_dir):
    """L1 on landed t scores: sorted by cluster, with a bloom filter."""
    path = rank.land_t_scores(base.long_analysis(spark, sf_dir).t_scores,
                              f"{run_folder(spark, 'ranking')}/t")
    return base._rounded(rank.lookup_landed(spark, path, base.LOOKUP_CLUSTER), *base.T_COLS)


def _group_rows(spark, sf_dir):
    return textcount.group_rows(tables.fixed_width_lines(spark, sf_dir),
                                start=tables.ID_WIDTH + 1)


def q_group_rows(spark, sf_dir):
    """A10: the lines of each group with their places."""
    return _group_rows(spark, sf_dir).drop("chunk")


def q_group_boundaries(spark, sf_dir):
    """A10: where each group begins and ends."""
    return textcount.group_boundaries(_group_rows(spark, sf_dir))


def q_first_case_samples(spark, sf_dir):
    """The feature rows of the first case samples."""
    df = base.q_sample_features(spark, sf_dir).filter("grp = 'case'")
    return rank.take_n(df, FIRST_SAMPLES, "sample_id")


QUERIES = {
    "cluster_scores_wide": q_cluster_scores_wide,
    "cohort_sizes_landed": q_cohort_sizes_landed,
    "cohort_stats_incremental": q_cohort_stats_incremental,
    "t_scores_incremental": q_t_scores_incremental,
    "sample_features_bucketed": q_sample_features_bucketed,
    "cluster_lookup_landed": q_cluster_lookup_landed,
    "group_rows": q_group_rows,
    "group_boundaries": q_group_boundaries,
    "first_case_samples": q_first_case_samples,
}

_GROUPS = """
WITH lines AS (
  SELECT 'PATIENT_ID,DIAGNOSIS,STATUS' AS line
  UNION ALL
  SELECT concat_ws(',', lpad(CAST(o_orderkey AS VARCHAR), 12, '0'),
                   substr(o_orderpriority, 1, 1), o_orderstatus)
  FROM orders),
counted AS (SELECT substr(line, 14, 1) AS key, line, count(*) AS copies FROM lines
            WHERE TRY_CAST(substr(line, 14, 1) AS INTEGER) IS NOT NULL GROUP BY ALL),
rows AS (SELECT key, line, copies,
                CAST(sum(copies) OVER (PARTITION BY key ORDER BY line) AS BIGINT) AS last_row
         FROM counted)"""

ORACLE = {
    "cluster_scores_wide": sql._with(sql._WIDE) + """
SELECT grp, cluster, sample_id, (round(score, 6) + 0.0) AS score FROM scores""",
    "cohort_sizes_landed": sql.COHORT_SIZES_WIDE,
    "cohort_stats_incremental": sql.COHORT_STATS,
    "t_scores_incremental": sql.T_SCORES_ALL,
    "sample_features_bucketed": sql.SAMPLE_FEATURES,
    "cluster_lookup_landed": sql.CLUSTER_LOOKUP,
    "group_rows": _GROUPS + """
SELECT key, line, copies, last_row - copies + 1 AS first_row, last_row FROM rows""",
    "group_boundaries": _GROUPS + """
SELECT key, max(last_row) AS n_lines, count(*) AS n_different, min(line) AS first_line,
       max(line) AS last_line
FROM rows GROUP BY key""",
    "first_case_samples": f"SELECT * FROM ({sql.SAMPLE_FEATURES}) WHERE grp = 'case'"
                          " ORDER BY sample_id LIMIT 2",
}
