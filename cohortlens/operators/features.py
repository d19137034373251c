"""Per-sample top-k feature assembly."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions import CASE
from cohortlens.operators.rank import TOP_K
from cohortlens.operators.stats import join_map

FEATURE_SETS = ("genes", "life_stats")


def feature_names(k: int = TOP_K) -> list[str]:
    width = max(2, len(str(k)))
    return [f"f{i:0{width}d}" for i in range(1, k + 1)]


def sample_features(cells: DataFrame, feature_clusters: DataFrame, key: str,
                    ranked: DataFrame, k: int = TOP_K,
                    background: DataFrame | None = None, salts: int = 1,
                    partitions: int | None = None,
                    map_partitions: int | None = None) -> DataFrame:
    """One row per (cohort, sample) with the top-k scores in rank order.

    J5: the feature→cluster map is first cut down to the top-k clusters
    (the ranked side has at most k rows by construction, so it is
    broadcast), then joined to the cells once. R6: ``f01`` is the rank-1
    cluster's score — the sum of the sample's values whose feature is in
    that cluster — ``f02`` rank 2, …, computed directly by one aggregate per
    sample, so the full (cluster × sample) score table is never rebuilt or
    shuffled. A sample without values in a cluster gets NULL there; samples
    with none in any top-k cluster do not appear. J6: left join to the
    background on ``sample_id`` (unmatched → NULL fields). ``label`` is 1.0
    for case samples and 0.0 for control samples. ``salts`` and ``map_partitions``
    as in :func:`cohortlens.operators.stats.join_map`, ``partitions`` as in
    :func:`cohortlens.operators.stats.cluster_scores`.
    """
    names = feature_names(k)
    top_map = feature_clusters.select(key, "cluster").join(
        F.broadcast(ranked.select("cluster", "rank")), "cluster").select(key, "rank")
    picked = join_map(cells, top_map, key, salts, map_partitions)
    if partitions is not None:
        picked = picked.select("grp", "sample_id", "rank", "value").repartition(
            partitions, "sample_id")
    wide = picked.groupBy("grp", "sample_id").agg(*[
        F.sum(F.when(F.col("rank") == i, F.col("value"))).alias(name)
        for i, name in enumerate(names, start=1)
    ])
    wide = wide.withColumn("label", F.when(F.col("grp") == CASE, 1.0).otherwise(0.0))
    if background is not None:
        wide = wide.join(background, "sample_id", "left")
    return wide


def feature_columns(feature_set: str, k: int = TOP_K) -> list[str]:
    """P13 + R7: the assembler inputs for a feature-set name."""
    if feature_set not in FEATURE_SETS:
        raise ValueError(f"feature_set must be one of {FEATURE_SETS}, got {feature_set!r}")
    names = feature_names(k)
    return ["age", *names] if feature_set == "life_stats" else names
