"""Analyses over stored state: snapshots with mergeable statistics, bucketed sample tables.

``land_state`` / ``merged_statistics``  moments of a snapshot's scores; statistics over
                                        several snapshots without reading them again
``land_bucketed`` / ``from_bucketed``   sample tables bucketed by sample id, whose joins
                                        on it need no shuffle
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from cohortlens.operators import moments, stats
from cohortlens.plans.cohort import CohortAnalysis
from cohortlens.session import run_folder

# ---- snapshots ------------------------------------------------------------------


def land_state(analysis: CohortAnalysis, path: str) -> str:
    """Write a snapshot's state: ``scores/`` by sample, their ``moments/``, cohort ``sizes/``."""
    spark = analysis.cohort.sparkSession
    analysis.scores.write.parquet(f"{path}/scores")
    moments.moments(spark.read.parquet(f"{path}/scores")).write.parquet(f"{path}/moments")
    analysis.sizes.write.parquet(f"{path}/sizes")
    return path


def merge_states(spark: SparkSession, a: str, b: str, path: str) -> str:
    """The state of two snapshots together, as a state itself.

    Moments are merged (:func:`moments.merge_snapshots`); scores of samples that are in both
    are added up.
    """
    def part(folder: str, name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}")

    moments.merge_snapshots(part(a, "moments"), part(a, "scores"), part(b, "moments"),
                            part(b, "scores")).write.parquet(f"{path}/moments")
    moments.merge_sizes(part(a, "sizes"), part(b, "sizes")).write.parquet(f"{path}/sizes")
    (part(a, "scores").unionByName(part(b, "scores")).groupBy("grp", "cluster", "sample_id")
     .agg({"score": "sum"}).withColumnRenamed("sum(score)", "score")
     .write.parquet(f"{path}/scores"))
    return path


def merged_statistics(spark: SparkSession, *paths: str) -> DataFrame:
    """Cohort statistics over landed states, as :func:`stats.cohort_stats` over all their cells.

    Two states are merged without a new state being written; more are folded in turn.
    """
    *first, last = paths
    if not first:
        state, sizes = (spark.read.parquet(f"{last}/{name}") for name in ("moments", "sizes"))
        return moments.stats_of(state, sizes)
    folder = run_folder(spark, "states")
    a = reduce(lambda x, y: merge_states(spark, x, y, f"{folder}/{uuid.uuid4().hex}"), first)
    read = spark.read.parquet
    state = moments.merge_snapshots(read(f"{a}/moments"), read(f"{a}/scores"),
                                    read(f"{last}/moments"), read(f"{last}/scores"))
    return moments.stats_of(state, moments.merge_sizes(read(f"{a}/sizes"), read(f"{last}/sizes")))


# ---- bucketed tables --------------------------------------------------------------


def land_bucketed(df: DataFrame, path: str, key: str = "sample_id") -> DataFrame:
    """``df`` as a table of files under ``path``, bucketed and sorted by ``key``.

    The number of buckets is the session's shuffle partitions, so tables landed under one
    setting meet without a shuffle. The table's name is its own and in the session's catalog.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"bucketed_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
     .format("parquet").option("path", path).saveAsTable(name))
    return spark.table(name)


def from_bucketed(samples: DataFrame, cells: DataFrame, feature_clusters: DataFrame, path: str,
                  key: str = "feature_id", **options) -> CohortAnalysis:
    """Binding of long tables after landing them bucketed by sample under ``path``.

    ``samples`` (sample_id, code) is a table by ``sample_id``. Cohorts are attached to cells
    without moving these, and sums per sample find a sample's cells in one place.
    """
    cohort = land_bucketed(stats.assign_cohorts(samples).select("sample_id", "grp"),
                           f"{path}/samples")
    placed = land_bucketed(cells, f"{path}/cells")
    return CohortAnalysis(
        cohort=cohort, cells=stats.attach_cohort(placed, cohort.hint("merge")),
        feature_clusters=feature_clusters, key=key, **options)
