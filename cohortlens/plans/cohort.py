"""Composite cohort analyses: from sources to ranked clusters and features.

``CohortAnalysis`` holds the lazy plan pieces of one analysis; nothing runs
until the caller acts on a returned DataFrame, and each derived DataFrame is
built once and reused, so a caller asking for statistics, the ranking and
the feature table gets one consistent plan.

Ways in:

* :func:`from_wide` — delimited wide matrix (header row inside the data)
  plus annotation file, as in the original inputs;
* :func:`land_wide` + :func:`from_landed` — the same matrix parsed once into
  long parquet, for repeated analyses of a large matrix;
* :func:`from_long` — already-long cells (sample, feature, value) with a
  separate sample table, which is the layout that scales: no wide rows,
  no header, the feature→cluster map joined by feature id.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions import cell, cohort_label, to_double
from cohortlens.functions.columns import CASE_CODES, CONTROL_CODES
from cohortlens.operators import features as feat
from cohortlens.operators import rank, reshape, stats
from cohortlens.sources import text


@dataclass
class CohortAnalysis:
    cohort: DataFrame            # (sample_id, grp) — one row per matrix row
    cells: DataFrame             # (sample_id, grp, <key>, value)
    feature_clusters: DataFrame  # (<key>, cluster)
    key: str
    k: int = rank.TOP_K
    cohort_sizes: DataFrame | None = None  # (grp, n) when known from elsewhere
    salts: int = 1  # join keys per feature, for features that are few (join_map)
    partitions: int | None = None  # tasks that sum the cells (cluster_scores, sample_features)
    map_partitions: int | None = None  # tasks of the join with a large map (join_map)
    _memo: dict = field(default_factory=dict, repr=False)

    def _get(self, name, build):
        if name not in self._memo:
            self._memo[name] = build()
        return self._memo[name]

    @property
    def sizes(self) -> DataFrame:
        if self.cohort_sizes is not None:
            return self.cohort_sizes
        return self._get("sizes", lambda: stats.cohort_sizes(self.cohort))

    @property
    def scores(self) -> DataFrame:
        return self._get("scores", lambda: stats.cluster_scores(
            self.cells, self.feature_clusters, self.key, self.salts, self.partitions,
            self.map_partitions))

    @property
    def stats(self) -> DataFrame:
        return self._get("stats", lambda: stats.cohort_stats(self.scores, self.sizes))

    @property
    def t_scores(self) -> DataFrame:
        return self._get("t", lambda: stats.t_scores(self.stats))

    @property
    def ranked(self) -> DataFrame:
        return self._get("ranked", lambda: rank.top_k(self.t_scores, self.k))

    def lookup(self, cluster: str) -> DataFrame:
        return rank.lookup(self.t_scores, cluster)

    def report(self) -> DataFrame:
        return rank.report(self.ranked)

    def sample_features(self, background: DataFrame | None = None) -> DataFrame:
        return feat.sample_features(self.cells, self.feature_clusters, self.key, self.ranked,
                                    self.k, background, self.salts, self.partitions,
                                    self.map_partitions)


# Join keys per column position: tasks of a shuffled position join are at least
# this many times the number of positions, whatever the number of samples.
POSITION_SALTS = 32


def from_wide(spark: SparkSession, matrix: str | DataFrame, annotation: str | DataFrame,
              species: str | None = text.SPECIES_KEPT,
              control: Iterable[str] = CONTROL_CODES, case: Iterable[str] = CASE_CODES,
              k: int = rank.TOP_K, salts: int = POSITION_SALTS) -> CohortAnalysis:
    """Wide delimited matrix + annotation → analysis keyed by column position.

    One global aggregate yields both the header and the cohort sizes (its
    exchange is shared), and one pass unpivots the cohort rows; both list the
    files when the analysis is built. Nothing is kept between analyses.
    """
    rows = text.wide_rows(spark, matrix)
    summary = reshape.matrix_summary(rows, control, case)
    members = reshape.membership(text.annotation(spark, annotation, species))
    cohort_rows = reshape.cohort_rows(rows, control, case)
    return CohortAnalysis(
        cohort=cohort_rows.select("sample_id", "grp"),
        cells=reshape.unpivot(cohort_rows),
        feature_clusters=reshape.position_clusters(members, reshape.summary_positions(summary)),
        key="position",
        k=k,
        cohort_sizes=reshape.summary_sizes(summary),
        salts=salts,
    )


_LANDED = "_LANDED"
_SNAPSHOT = "snapshot-"


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def land_wide(spark: SparkSession, matrix: str | DataFrame, path: str,
              control: Iterable[str] = CONTROL_CODES, case: Iterable[str] = CASE_CODES) -> str:
    """Parse a wide text matrix once into a new snapshot of long parquet under ``path``.

    ``samples/`` (sample_id, code): one row per data row; ``cells/``
    (sample_id, code, position, value): numeric cells only, each carrying its
    row's code; ``header/`` (feature_id, position); ``summary/`` (the cohort codes and
    the cohorts' row counts). The text is read once, into ``rows/``, and header and
    counts are observed while that is written. A snapshot counts only when
    complete (its marker is written last), so a failed landing leaves the
    earlier one in use. Returns the snapshot's folder.
    """
    control, case = list(control), list(case)
    snapshot = f"{path}/{_SNAPSHOT}{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    seen = Observation()
    (text.wide_rows(spark, matrix).observe(seen, *reshape.summary_columns(control, case))
     .write.parquet(f"{snapshot}/rows"))
    found = seen.get
    header = found["_header_max"]
    if header != found["_header_min"]:
        raise ValueError("conflicting header rows in the matrix")
    rows = spark.read.parquet(f"{snapshot}/rows")
    is_header = F.coalesce(cell("cells", 0) == F.lit(text.HEADER_MARKER), F.lit(False))
    data = rows.filter(~is_header).select(
        cell("cells", 0).alias("sample_id"), cell("cells", 1).alias("code"), "cells")
    data.drop("cells").write.parquet(f"{snapshot}/samples")
    (data.select("sample_id", "code", F.posexplode("cells").alias("position", "raw"))
     .filter(F.col("position") >= 2)
     .select("sample_id", "code", "position", to_double("raw").alias("value"))
     .filter(F.col("value").isNotNull())
     .write.parquet(f"{snapshot}/cells"))
    spark.createDataFrame([(f, i) for i, f in enumerate(header or [])],
                          "feature_id string, position int").write.parquet(f"{snapshot}/header")
    spark.createDataFrame(
        [(control, case, found["n_control"], found["n_case"])],
        "control array<string>, case array<string>, n_control long, n_case long"
    ).write.parquet(f"{snapshot}/summary")
    fs, marker = _folder(spark, f"{snapshot}/{_LANDED}")
    fs.create(marker).close()
    return snapshot


def landed_snapshot(spark: SparkSession, path: str) -> str:
    """The newest complete snapshot below ``path`` (or ``path``, if it is one)."""
    fs, where = _folder(spark, path)
    marked = [str(status.getPath().getParent()) for at in (_LANDED, f"{_SNAPSHOT}*/{_LANDED}")
              for status in fs.globStatus(where.suffix(f"/{at}")) or []]
    if not marked:
        raise FileNotFoundError(f"no complete landed matrix below {path}")
    return max(marked)


def from_landed(spark: SparkSession, path: str, annotation: str | DataFrame,
                species: str | None = text.SPECIES_KEPT,
                control: Iterable[str] = CONTROL_CODES, case: Iterable[str] = CASE_CODES,
                k: int = rank.TOP_K, salts: int = POSITION_SALTS) -> CohortAnalysis:
    """Analysis over the newest matrix landed below ``path`` (same results as from_wide)."""
    control, case = list(control), list(case)
    codes, snapshot = [*control, *case], landed_snapshot(spark, path)
    summary = spark.read.parquet(f"{snapshot}/summary")
    counted = summary.first()
    # counts of the same cohorts were taken while the matrix was read
    known = (sorted(counted["control"]), sorted(counted["case"])) == (sorted(control), sorted(case))

    def with_grp(df):
        # a plain IN on the stored column reaches the parquet scan
        return (df.filter(F.col("code").isin(codes))
                .withColumn("grp", cohort_label("code", control, case)))

    members = reshape.membership(text.annotation(spark, annotation, species))
    return CohortAnalysis(
        cohort=with_grp(spark.read.parquet(f"{snapshot}/samples")).select("sample_id", "grp"),
        cells=with_grp(spark.read.parquet(f"{snapshot}/cells"))
        .select("sample_id", "grp", "position", "value"),
        feature_clusters=reshape.position_clusters(
            members, spark.read.parquet(f"{snapshot}/header")),
        key="position",
        k=k,
        cohort_sizes=reshape.summary_sizes(summary) if known else None,
        salts=salts,
    )


def from_long(samples: DataFrame, cells: DataFrame, feature_clusters: DataFrame,
              code: str = "code", control: Iterable[str] = CONTROL_CODES,
              case: Iterable[str] = CASE_CODES, key: str = "feature_id",
              k: int = rank.TOP_K, unique_samples: bool = False,
              partitions: int | None = None, sample_partitions: int | None = None,
              map_partitions: int | None = None) -> CohortAnalysis:
    """Sample table ``(sample_id, code)`` + long cells ``(sample_id, key, value)``.

    Cells get their cohort through a join on ``sample_id``. Repeated sample rows
    count in the cohort size, but their cells count once; ``unique_samples``
    says that ``sample_id`` is a key of ``samples`` and saves making it one.
    ``partitions``: tasks that sum the cells; ``sample_partitions`` and ``map_partitions``:
    tasks of their joins with many samples and with a large map (default of all three: as the
    session's shuffles).
    """
    cohort = stats.assign_cohorts(samples, code, control, case).select("sample_id", "grp")
    return CohortAnalysis(
        cohort=cohort,
        cells=stats.attach_cohort(cells, cohort if unique_samples else cohort.distinct(),
                                  sample_partitions),
        feature_clusters=feature_clusters,
        key=key,
        k=k,
        partitions=partitions,
        map_partitions=map_partitions,
    )
