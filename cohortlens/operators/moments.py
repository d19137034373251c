"""Mergeable cohort statistics (A3, A5, A7): moments of cluster scores, snapshot by snapshot.

The state of a snapshot is one row per (cohort, cluster): ``m`` scores, their sum ``s``
and the sum ``m2`` of squared deviations from their own mean. Two states are merged, and
a part is taken out of one, in closed form; no score is read again for that. Only
samples whose cells lie in both snapshots need more: their scores in each are taken
out and the sums of both put in, so the work beyond the states grows with the samples
that span snapshots, not with the snapshots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS = ["grp", "cluster"]


def moments(scores: DataFrame) -> DataFrame:
    """``grp, cluster, m, s, m2`` of scores, in one aggregate (map-side combined)."""
    return scores.groupBy(*KEYS).agg(
        F.count("score").alias("m"), F.coalesce(F.sum("score"), F.lit(0.0)).alias("s"),
        F.coalesce(F.var_pop("score") * F.count("score"), F.lit(0.0)).alias("m2"))


def _between(m_a: Column, s_a: Column, m_b: Column, s_b: Column) -> Column:
    """What m2 of two sets together has beyond the sum of theirs."""
    d = s_b / m_b - s_a / m_a
    return F.when((m_a > 0) & (m_b > 0), d * d * m_a * m_b / (m_a + m_b)).otherwise(0.0)


def merge(a: DataFrame, b: DataFrame) -> DataFrame:
    """The moments of two disjoint sets of scores together."""
    both = _joined(a, b)

    def of(side: str, name: str) -> Column:
        return F.coalesce(F.col(f"{side}.{name}"), F.lit(0))

    return both.select(
        *[F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in KEYS],
        (of("a", "m") + of("b", "m")).alias("m"), (of("a", "s") + of("b", "s")).alias("s"),
        (of("a", "m2") + of("b", "m2")
         + _between(of("a", "m"), of("a", "s"), of("b", "m"), of("b", "s"))).alias("m2"))


def without(whole: DataFrame, part: DataFrame) -> DataFrame:
    """The moments of a set of scores without some of them."""
    both = _joined(whole, part, "left")
    m = F.col("a.m") - F.coalesce("b.m", F.lit(0))
    s = F.col("a.s") - F.coalesce("b.s", F.lit(0.0))
    rest = F.col("a.m2") - F.coalesce("b.m2", F.lit(0.0)) - _between(
        m, s, F.coalesce("b.m", F.lit(0)), F.coalesce("b.s", F.lit(0.0)))
    return both.select(*[F.col(f"a.{k}") for k in KEYS], m.alias("m"), s.alias("s"),
                       F.greatest(rest, F.lit(0.0)).alias("m2")).filter("m > 0")


def _joined(a: DataFrame, b: DataFrame, how: str = "full") -> DataFrame:
    same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in KEYS]
    return a.alias("a").join(b.alias("b"), same[0] & same[1], how)


def merge_snapshots(state_a: DataFrame, scores_a: DataFrame, state_b: DataFrame,
                    scores_b: DataFrame) -> DataFrame:
    """The moments over two snapshots; samples with cells in both count once, by their sum.

    ``scores``: ``grp, cluster, sample_id, score``. A (cohort, cluster, sample) found in both
    is taken out of either state and its summed score put in.
    """
    spanning = (scores_a.select(*KEYS, "sample_id", F.col("score").alias("a"))
                .join(scores_b.select(*KEYS, "sample_id", F.col("score").alias("b")),
                      [*KEYS, "sample_id"]))

    def part(score: Column) -> DataFrame:
        return moments(spanning.select(*KEYS, score.alias("score")))

    alone = merge(without(state_a, part(F.col("a"))), without(state_b, part(F.col("b"))))
    return merge(alone, part(F.col("a") + F.col("b")))


def merge_sizes(*sizes: DataFrame) -> DataFrame:
    """``grp, n`` over snapshots: each matrix row is in one of them."""
    rows = sizes[0]
    for more in sizes[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("grp").agg(F.sum("n").alias("n"))


def stats_of(state: DataFrame, sizes: DataFrame) -> DataFrame:
    """Cohort statistics of a state, as :func:`stats.cohort_stats` gives them from scores."""
    mean, scored = F.col("s") / F.col("n"), F.try_divide(F.col("s"), F.col("m"))
    shift = scored - mean
    # one row per cohort: a shuffle on a two-valued key would use two tasks
    return state.join(F.broadcast(sizes), "grp").select(
        *KEYS, "n", F.col("m").alias("n_scored"), F.col("s").alias("score_sum"),
        mean.alias("mean"),
        F.sqrt(F.try_divide(F.col("m2"), F.col("m")) + shift * shift).alias("sd"))
