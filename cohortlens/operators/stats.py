"""Cohort statistics (A1–A7, J2–J4) as one lazy DataFrame plan.

The two cohorts are a ``grp`` column, so every aggregate runs once over
both instead of once per cohort.

Denominators follow the source semantics exactly:

* mean  = Σ score / n          where n = number of cohort *rows* (A1, A3)
* sd    = √( Σ (score − mean)² / m )   where m = number of scores present (A5)
* t     = (μ_case − μ_control) / √(sd_case²/n_case + sd_control²/n_control)

They differ when a sample has no value for a cluster, so neither ``avg``
nor ``stddev_pop`` is used directly. The deviation is computed in one
aggregate pass without a second join: with m present scores summing to S,
their mean m̄ = S/m and the cohort mean μ = S/n,

    Σ (s − μ)² = Σ (s − m̄)² + m (m̄ − μ)²  =  m · var_pop(s) + m (m̄ − μ)²

``var_pop`` is Spark's numerically stable central-moment aggregate, so the
identity is exact and needs no Σs² cancellation. Every aggregate here is
algebraic (partial/final), so a cluster or sample holding a large share of
all rows is combined map-side and never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions import CASE, CONTROL, cohort_label, welch_t
from cohortlens.functions.columns import CASE_CODES, CONTROL_CODES


def assign_cohorts(samples: DataFrame, code: str = "code",
                   control: Iterable[str] = CONTROL_CODES,
                   case: Iterable[str] = CASE_CODES) -> DataFrame:
    """Keep samples whose code is a cohort code; add ``grp``."""
    return (samples.withColumn("grp", cohort_label(code, control, case))
            .filter(F.col("grp").isNotNull())
            .drop(code))


def cohort_sizes(cohort: DataFrame) -> DataFrame:
    """A1: ``(grp, n)`` — matrix rows per cohort (duplicate ids count twice)."""
    return cohort.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))


def merge_join(left: DataFrame, right: DataFrame, keys: list[str],
               partitions: int | None = None) -> DataFrame:
    """``left ⋈ right`` on ``keys``; with ``partitions`` a shuffled hash join in so many tasks.

    A task keeps its share of ``right`` (whose keys are few rows each) and streams its rows
    of ``left``, so a key that holds a large share of ``left`` takes no memory, as it would
    in a sort. With the session's shuffle partitions these shares grow with the tables.
    """
    if partitions is None:
        return left.join(right, keys)
    return left.repartition(partitions, *keys).join(
        right.repartition(partitions, *keys).hint("shuffle_hash"), keys)


def attach_cohort(obs: DataFrame, cohort: DataFrame, partitions: int | None = None) -> DataFrame:
    """Observed cells of cohort samples: ``obs ⋈ cohort`` on ``sample_id``.

    Used by the long binding, where cells and sample codes live in separate
    tables; the inner join also applies the cohort filter. ``cohort`` must have
    a sample once per ``grp``. ``partitions`` as in :func:`merge_join`.
    """
    return merge_join(obs, cohort.select("sample_id", "grp"), ["sample_id"], partitions)


def join_map(cells: DataFrame, feature_map: DataFrame, key: str, salts: int = 1,
             partitions: int | None = None) -> DataFrame:
    """``cells ⋈ feature_map`` on ``key``, each key spread over ``salts`` join keys.

    Column positions of a wide matrix are few and each holds a cell of every
    sample, so a shuffle on the position alone would make few, huge tasks. A
    salt from the sample id multiplies the keys; the map's rows are repeated
    for each salt. Whether the map is broadcast is left to Spark's byte threshold,
    except with ``partitions`` (:func:`merge_join`), for a map that grows with the cells.
    """
    if salts == 1:
        return merge_join(cells, feature_map, [key], partitions)
    salted = cells.withColumn("_salt", F.pmod(F.xxhash64("sample_id"), F.lit(salts)))
    repeated = feature_map.withColumn("_salt", F.explode(
        F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return merge_join(salted, repeated, [key, "_salt"], partitions).drop("_salt")


def cluster_scores(cells: DataFrame, feature_clusters: DataFrame, key: str,
                   salts: int = 1, partitions: int | None = None,
                   map_partitions: int | None = None) -> DataFrame:
    """J2 + A2: ``(grp, cluster, sample_id, score)``, score = Σ member values.

    ``cells`` has ``(sample_id, grp, <key>, value)``; ``feature_clusters``
    maps ``<key>`` to clusters (a bag: a feature listed twice counts twice).
    Spark broadcasts the map when its measured size is under the broadcast
    threshold and otherwise shuffles both sides on ``key`` (AQE splits skewed
    keys; ``salts`` and ``map_partitions`` as in :func:`join_map`). There are nearly as many scores as
    cells, so a task's sums take memory by its share of the cells: with
    ``partitions`` (a number that grows with the cells) they are summed in so
    many tasks, however few the session's shuffles have. Without it the sum is
    partially aggregated before the shuffle.
    """
    picked = join_map(cells, feature_clusters.select(key, "cluster"), key, salts, map_partitions)
    if partitions is not None:
        picked = picked.select("grp", "cluster", "sample_id", "value").repartition(
            partitions, "sample_id", "cluster")
    return (picked.groupBy("grp", "cluster", "sample_id")
            .agg(F.sum("value").alias("score")))


#: Entries of a position map (position, cluster) that may go into every task's plan.
IN_ROW_ENTRIES = 100_000


def in_row_scores(rows: DataFrame, position_clusters: DataFrame) -> DataFrame:
    """J2 + A2 inside the row: cluster sums straight from the array column.

    ``rows``: ``sample_id, grp, values`` (numbers by position, NULL where not numeric). The
    position map becomes one array of (cluster, positions), a scalar subquery, and each
    row's sums are computed before any shuffle; only (cluster, score) pairs leave the row.
    The map must be small (:func:`cluster_scores_wide` checks).
    """
    lists = position_clusters.groupBy("cluster").agg(F.collect_list("position").alias("positions"))
    every = lists.agg(F.collect_list(F.struct("cluster", "positions"))).scalar()

    def add(total, position):
        value = F.get("values", position)
        return F.coalesce(total + value, total, value)

    sums = F.transform("clusters", lambda c: F.struct(
        c.cluster.alias("cluster"),
        F.aggregate(c.positions, F.lit(None).cast("double"), add).alias("score")))
    scored = (rows.withColumn("clusters", every)
              .select("grp", "sample_id", F.inline(sums)).filter("score is not null"))
    # a sample that has several matrix rows counts by their sum
    return scored.groupBy("grp", "cluster", "sample_id").agg(F.sum("score").alias("score"))


def cluster_scores_wide(rows: DataFrame, cells: DataFrame, position_clusters: DataFrame,
                        salts: int = 1, most: int = IN_ROW_ENTRIES) -> DataFrame:
    """``(grp, cluster, sample_id, score)`` of wide rows, whichever way the map allows.

    With at most ``most`` map entries (counted) sums are taken in the row, else cells are
    unpivoted and joined with the map (:func:`cluster_scores`). Both give the same scores.
    """
    if position_clusters.limit(most + 1).count() <= most:
        return in_row_scores(rows, position_clusters)
    return cluster_scores(cells, position_clusters, "position", salts)


def cohort_stats(scores: DataFrame, sizes: DataFrame) -> DataFrame:
    """A3 + A5 (+J3): ``(grp, cluster, n, n_scored, score_sum, mean, sd)``.

    ``sizes`` has one row per cohort — two rows — so it is always broadcast:
    a shuffle join on a two-valued key would put every cluster's statistics
    into two tasks.
    """
    per_cluster = scores.groupBy("grp", "cluster").agg(
        F.count("score").alias("n_scored"),
        F.sum("score").alias("score_sum"),
        F.var_pop("score").alias("var_scored"),
    )
    mean = F.col("score_sum") / F.col("n")
    scored_mean = F.try_divide(F.col("score_sum"), F.col("n_scored"))
    shift = scored_mean - mean
    return (per_cluster.join(F.broadcast(sizes), "grp")
            .select("grp", "cluster", "n", "n_scored", "score_sum",
                    mean.alias("mean"),
                    F.sqrt(F.col("var_scored") + shift * shift).alias("sd")))


def t_scores(stats: DataFrame, case: str = CASE, control: str = CONTROL) -> DataFrame:
    """J4 + A7: Welch t per cluster present in both cohorts.

    One aggregate over the (small) stats table pivots the two cohorts into
    columns; clusters missing from either cohort are dropped (inner
    semantics). Zero deviation in both cohorts gives a NULL t.
    """
    def pick(name: str, grp: str):
        return F.max(F.when(F.col("grp") == grp, F.col(name)))

    wide = stats.groupBy("cluster").agg(
        pick("mean", case).alias("mean_case"), pick("sd", case).alias("sd_case"),
        pick("n", case).alias("n_case"), pick("n_scored", case).alias("n_scored_case"),
        pick("mean", control).alias("mean_control"), pick("sd", control).alias("sd_control"),
        pick("n", control).alias("n_control"),
        pick("n_scored", control).alias("n_scored_control"),
    ).filter(F.col("mean_case").isNotNull() & F.col("mean_control").isNotNull())
    t = welch_t(F.col("mean_case"), F.col("sd_case"), F.col("n_case"),
                F.col("mean_control"), F.col("sd_control"), F.col("n_control"))
    return wide.select("cluster", t.alias("t"), "mean_case", "sd_case", "n_case",
                       "n_scored_case", "mean_control", "sd_control", "n_control",
                       "n_scored_control")


def tagged_union(parts: dict[int, DataFrame]) -> DataFrame:
    """U1 + U3: bag union of separate datasets, each row tagged with its part's number."""
    tagged = [df.withColumn("tag", F.lit(tag)) for tag, df in sorted(parts.items())]
    out = tagged[0]
    for df in tagged[1:]:
        out = out.unionByName(df)
    return out


def tag_cohorts(cohort: DataFrame) -> DataFrame:
    """U3 for cohorts of one table: tag 0 for control and 1 for case rows, in one scan."""
    return cohort.withColumn("tag", F.when(F.col("grp") == CONTROL, 0).otherwise(1))


def select_part(tagged: DataFrame, tag: int) -> DataFrame:
    """The rows of one part again."""
    return tagged.filter(F.col("tag") == tag).drop("tag")
