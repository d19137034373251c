"""Reshape operators: explode, posexplode, unpivot and the position map.

R1 ``membership``        annotation members → ``(cluster, feature_id)`` bag
R2 ``header_positions``  header cells → ``(feature_id, position)``
J1 ``position_clusters`` membership ⋈ positions → ``(position, cluster)``
R3 ``unpivot``           wide rows → long ``(sample_id, grp, position, value)``
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions import CASE, CONTROL, cell, cohort_label, to_double
from cohortlens.functions.columns import CASE_CODES, CONTROL_CODES
from cohortlens.sources.text import HEADER_MARKER


def membership(annotation: DataFrame) -> DataFrame:
    """One row per listed member; a member listed twice stays twice."""
    return annotation.select(
        "cluster",
        F.explode(F.split(F.col("members"), ";", -1)).alias("feature_id"),
    )


def summary_columns(control=CONTROL_CODES, case=CASE_CODES) -> list[Column]:
    """Aggregates over wide rows: cohort row counts, greatest and least header row."""
    cells = F.col("cells")
    grp = cohort_label(cell(cells, 1), control, case)
    header = F.when(cell(cells, 0) == F.lit(HEADER_MARKER), cells)
    return [F.count(F.when(grp == F.lit(CONTROL), F.lit(1))).alias("n_control"),
            F.count(F.when(grp == F.lit(CASE), F.lit(1))).alias("n_case"),
            F.max(header).alias("_header_max"), F.min(header).alias("_header_min")]


def matrix_summary(rows: DataFrame, control=CONTROL_CODES, case=CASE_CODES) -> DataFrame:
    """One pass over the wide rows: cohort row counts (A1) and the header.

    A single global aggregate: ``n_control``, ``n_case`` and ``header`` —
    the cells of the row whose cell 0 is ``PATIENT_ID``. Identical header
    rows (concatenated files) collapse into one; two different header rows
    fail the job (they would map a position to two features). The header is
    one row of the input, so the aggregate state is bounded by the column
    count, not by the data.
    """
    agg = rows.agg(*summary_columns(control, case))
    checked = F.when(F.col("_header_max") != F.col("_header_min"),
                     F.raise_error(F.lit("conflicting header rows in the matrix"))
                     ).otherwise(F.col("_header_max"))
    return agg.select("n_control", "n_case", checked.alias("header"))


def summary_sizes(summary: DataFrame) -> DataFrame:
    """``(grp, n)`` from :func:`matrix_summary`; cohorts without rows are absent."""
    pairs = F.array(
        F.struct(F.lit(CONTROL).alias("grp"), F.col("n_control").alias("n")),
        F.struct(F.lit(CASE).alias("grp"), F.col("n_case").alias("n")),
    )
    return summary.select(F.inline(pairs)).filter(F.col("n") > 0)


def summary_positions(summary: DataFrame, first_position: int = 0) -> DataFrame:
    """R2: ``(feature_id, position)`` of the header from :func:`matrix_summary`."""
    return (summary.select(F.posexplode("header").alias("position", "feature_id"))
            .filter(F.col("position") >= first_position)
            .select("feature_id", "position"))


def header_positions(rows: DataFrame, first_position: int = 0) -> DataFrame:
    """R2 (+P3): header cells with their 0-based positions."""
    return summary_positions(matrix_summary(rows), first_position)


def position_clusters(members: DataFrame, positions: DataFrame) -> DataFrame:
    """Feature id join (inner, many-to-many) → ``(position, cluster)``."""
    return members.join(positions, "feature_id").select("position", "cluster")


def cohort_rows(rows: DataFrame, control=CONTROL_CODES, case=CASE_CODES) -> DataFrame:
    """P2 on wide rows: keep rows whose cell 1 is a cohort code; tag ``grp``."""
    return (rows.select(cell("cells", 0).alias("sample_id"),
                        cohort_label(cell("cells", 1), control, case).alias("grp"),
                        "cells")
            .filter(F.col("grp").isNotNull()))


def row_values(cohort: DataFrame) -> DataFrame:
    """``sample_id, grp, values``: the cells of cohort rows as numbers, by position."""
    return cohort.select("sample_id", "grp", F.transform("cells", lambda c, i: F.when(
        i >= 2, to_double(c))).alias("values"))


def unpivot(cohort: DataFrame, first_position: int = 2) -> DataFrame:
    """Wide cohort rows → long cells for positions ≥ ``first_position``.

    A generator on one array column (not ``stack`` over thousands of
    columns). Non-numeric or empty cells carry no value and are dropped
    here, before any shuffle.
    """
    return (cohort.select("sample_id", "grp",
                          F.posexplode("cells").alias("position", "raw"))
            .filter(F.col("position") >= first_position)
            .select("sample_id", "grp", "position", to_double("raw").alias("value"))
            .filter(F.col("value").isNotNull()))
