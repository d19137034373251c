"""Snapshots with mergeable statistics, bucketed tables, in-row sums, landed lookups, groups."""

import random
import re

import pytest
from tests.conftest import ANNOTATION, MATRIX
from pyspark.sql import functions as F

from cohortlens.operators import moments, rank, reshape, stats, textcount
from cohortlens.plans import cohort, storage
from cohortlens.plans.cohort import from_landed, from_long, from_wide, land_wide
from cohortlens.sources import text


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- moments --------------------------------------------------------------------

def _long(spark, n, seed, samples=range(40)):
    rnd = random.Random(seed)
    codes = {s: rnd.choice("1452") for s in samples}
    cells = [(rnd.choice(list(samples)), rnd.randrange(8), rnd.uniform(-5, 5) * 10 ** rnd.randrange(4))
             for _ in range(n)]
    return (spark.createDataFrame(sorted(codes.items()), "sample_id long, code string"),
            cells, spark.createDataFrame([(f, c) for f in range(8) for c in ("x", "y", "z")
                                          if rnd.random() < 0.5], "feature_id long, cluster string"))


@pytest.mark.parametrize("parts", [2, 3])
def test_merged_snapshots_equal_the_whole(spark, tmp_path, parts):
    samples, cells, members = _long(spark, 600, 3)
    schema = "sample_id long, feature_id long, value double"
    whole = from_long(samples, spark.createDataFrame(cells, schema), members, unique_samples=True)
    states = []
    for i in range(parts):  # the cells of a sample are in all parts; its row is in one
        part = from_long(samples, spark.createDataFrame(cells[i::parts], schema), members,
                         unique_samples=True)
        part.cohort_sizes = stats.cohort_sizes(whole.cohort.filter(
            F.pmod("sample_id", F.lit(parts)) == i))
        states.append(storage.land_state(part, str(tmp_path / f"s{i}")))
    merged = {(r.grp, r.cluster): r for r in storage.merged_statistics(spark, *states).collect()}
    expected = {(r.grp, r.cluster): r for r in whole.stats.collect()}
    assert merged.keys() == expected.keys() and expected
    for key, r in expected.items():
        for name in ("n", "n_scored", "score_sum", "mean", "sd"):
            assert merged[key][name] == pytest.approx(r[name], rel=1e-9, abs=1e-9), (key, name)


def test_moments_merge_and_without_are_inverse(spark):
    def state(values):
        return moments.moments(spark.createDataFrame(
            [("case", "c", float(v)) for v in values], "grp string, cluster string, score double"))
    a, b = [1, 2, 4, 9], [100, 3]
    both = moments.merge(state(a), state(b)).first()
    assert tuple(both)[2:] == pytest.approx(tuple(state(a + b).first())[2:])
    back = moments.without(moments.merge(state(a), state(b)), state(b)).first()
    assert tuple(back)[2:] == pytest.approx(tuple(state(a).first())[2:])
    assert moments.without(state(a), state(a)).count() == 0


# ---- in-row sums ----------------------------------------------------------------

@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_in_row_scores_equal_exploded_ones(spark, lines, broadcast):
    rows = [*MATRIX, "P1,1,10,,x", "P7,4,,,"]  # a repeated sample, bad and empty cells
    members = ["c1,a,Human,,10;20;20", "c2,b,Human,,30;10"]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        a = from_wide(spark, lines(rows, 3), lines(members))
        values = reshape.row_values(reshape.cohort_rows(text.wide_rows(spark, lines(rows, 3))))
        small = stats.cluster_scores_wide(values, a.cells, a.feature_clusters, a.salts)
        large = stats.cluster_scores_wide(values, a.cells, a.feature_clusters, a.salts, most=0)
        expected = sorted(map(tuple, a.scores.collect()))
        assert sorted(map(tuple, small.collect())) == expected
        assert sorted(map(tuple, large.collect())) == expected
        plan = _plan(small)
        assert "posexplode" not in plan.split("Subquery")[0] and "posexplode" in _plan(large)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# ---- landing ----------------------------------------------------------------------

def test_landing_reads_the_text_once_and_keeps_header_and_counts(spark, lines, tmp_path, monkeypatch):
    reads = []
    real = text.wide_rows
    monkeypatch.setattr(cohort.text, "wide_rows", lambda *a: reads.append(1) or real(*a))
    snapshot = land_wide(spark, lines(MATRIX, 3), str(tmp_path / "m"))
    assert len(reads) == 1
    header = spark.read.parquet(f"{snapshot}/header").collect()
    assert {r.feature_id: r.position for r in header}["30"] == 4
    a = from_landed(spark, snapshot, lines(ANNOTATION))
    assert {r.grp: r.n for r in a.sizes.collect()} == {"control": 2, "case": 2}
    assert "/summary" in a.sizes.inputFiles()[0]
    other = from_landed(spark, snapshot, lines(ANNOTATION), case=["2"])
    assert {r.grp: r.n for r in other.sizes.collect()} == {"control": 2, "case": 1}


def test_conflicting_headers_fail_the_landing(spark, lines, tmp_path):
    with pytest.raises(ValueError, match="conflicting"):
        land_wide(spark, lines([*MATRIX, "PATIENT_ID,DIAGNOSIS,20,10,30"]), str(tmp_path / "m"))
    with pytest.raises(FileNotFoundError):
        cohort.landed_snapshot(spark, str(tmp_path / "m"))


def test_sources_of_another_path_scheme(spark, tmp_path):
    """S3: a mounted file system that only Spark's readers resolve."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.cohort.link./in", f"file://{tmp_path}")
    (tmp_path / "matrix.csv").write_text("\n".join(MATRIX) + "\n")
    (tmp_path / "ann.csv").write_text("\n".join(ANNOTATION) + "\n")
    a = from_wide(spark, "viewfs://cohort/in/matrix.csv", "viewfs://cohort/in/ann.csv")
    assert [r.cluster for r in a.ranked.collect()][0] == "c1"
    landed = land_wide(spark, "viewfs://cohort/in/matrix.csv", "viewfs://cohort/in/landed")
    b = from_landed(spark, "viewfs://cohort/in/landed", "viewfs://cohort/in/ann.csv")
    assert landed.startswith("viewfs://cohort/in/landed/")
    assert sorted(map(str, b.t_scores.collect())) == sorted(map(str, a.t_scores.collect()))


# ---- bucketed tables ----------------------------------------------------------------

def test_bucketed_cells_are_not_exchanged(spark, tmp_path):
    samples, cells, members = _long(spark, 400, 4)
    df = spark.createDataFrame(cells, "sample_id long, feature_id long, value double")
    a = storage.from_bucketed(samples, df, members, str(tmp_path / "b"))
    rows = a.cells.collect()
    plan = _plan(a.cells)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    b = from_long(samples, df, members, unique_samples=True)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, b.cells.collect()))
    per_sample = a.cells.groupBy("sample_id").agg(F.sum("value"))
    assert "Exchange" not in _plan(per_sample)
    assert sorted(map(str, a.stats.collect()))[0][:12] == sorted(map(str, b.stats.collect()))[0][:12]


# ---- lookup ---------------------------------------------------------------------------

def _scanned_rows(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found = []

    def walk(node):
        if node.nodeName().startswith("Scan parquet"):
            found.append(node.metrics().apply("numOutputRows").value())
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            walk(node.executedPlan())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))
    walk(plan)
    return sum(found)


def test_landed_lookup_reads_no_row_group_for_absent_keys(spark, tmp_path):
    t = spark.range(2000).select(F.concat(F.lit("c"), F.col("id") * 2).alias("cluster"),
                                 F.col("id").cast("double").alias("t"))
    path = rank.land_t_scores(t, str(tmp_path / "t"), 2000)
    there = rank.lookup_landed(spark, path, "c100")
    assert [r.t for r in there.collect()] == [50.0]
    assert re.search(r"PushedFilters: \[.*EqualTo\(cluster,c100\)", there._jdf.queryExecution()
                     .explainString(there._sc._jvm.org.apache.spark.sql.execution.ExplainMode
                                    .fromString("formatted")))
    assert _scanned_rows(rank.lookup_landed(spark, path, "c100")) > 0
    for absent in ("c101", "c1999", "zzz"):  # within the range of a row group, and beyond
        assert _scanned_rows(rank.lookup_landed(spark, path, absent)) == 0


# ---- group rows -------------------------------------------------------------------------

def test_group_rows_are_sorted_runs_with_boundaries(spark, lines):
    rnd = random.Random(5)
    rows = [f"{rnd.randrange(10 ** 6):06d},{rnd.choice('1114NZ')}," + "x" * 50 for _ in range(3000)]
    rows += ["000001,1,same"] * 40 + ["", "12"]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        runs = textcount.group_rows(lines(rows, 4), 7)
        got = runs.collect()
        expected = {}
        for key in "14":
            group = sorted(r for r in rows if r[7:8] == key)
            expected[key] = group
            own = sorted((r for r in got if r.key == key), key=lambda r: r.first_row)
            assert [r.line for r in own for _ in range(r.copies)] == group
            assert own[0].first_row == 1 and own[-1].last_row == len(group)
            assert all(a.last_row + 1 == b.first_row and a.chunk <= b.chunk
                       for a, b in zip(own, own[1:]))
        assert {r.key for r in got} == {"1", "4"}
        assert len({r.chunk for r in got if r.key == "1"}) > 3  # the hot key spans tasks
        bounds = {r.key: r for r in textcount.group_boundaries(runs).collect()}
        for key, group in expected.items():
            b = bounds[key]
            assert (b.n_lines, b.n_different, b.first_line, b.last_line) == (
                len(group), len(set(group)), group[0], group[-1])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_group_rows_of_no_lines(spark, lines):
    assert textcount.group_rows(lines([]), 0).count() == 0
