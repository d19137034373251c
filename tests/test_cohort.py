"""Cohort statistics on the hand-computed micro-fixture (FIXTURES.md)."""

import math

import pytest
from pyspark.sql import functions as F

from cohortlens import from_long, from_wide
from cohortlens.operators import rank, reshape
from cohortlens.sources import text
from tests.conftest import ANNOTATION, MATRIX


def _by_cluster(df):
    return {r["cluster"]: r for r in df.collect()}


def test_positions_and_membership(spark, lines):
    rows = text.wide_rows(spark, lines(MATRIX))
    pos = {r["feature_id"]: r["position"] for r in reshape.header_positions(rows).collect()}
    assert pos["10"] == 2 and pos["20"] == 3 and pos["30"] == 4
    members = reshape.membership(text.annotation(spark, lines(ANNOTATION)))
    got = sorted((r["cluster"], r["feature_id"]) for r in members.collect())
    # c3 is not Human; the header line of the annotation drops out too.
    assert got == [("c1", "10"), ("c1", "20"), ("c2", "30"), ("c4", "99")]


def test_base_case(spark, lines):
    a = from_wide(spark, lines(MATRIX, 3), lines(ANNOTATION, 2))
    sizes = {r["grp"]: r["n"] for r in a.sizes.collect()}
    assert sizes == {"control": 2, "case": 2}
    t = _by_cluster(a.t_scores)
    assert set(t) == {"c1", "c2"}  # c3 other species, c4 no matrix column
    assert t["c1"]["t"] == pytest.approx(6 / math.sqrt(5))
    assert t["c1"]["mean_case"] == pytest.approx(10) and t["c1"]["sd_case"] == pytest.approx(3)
    assert t["c1"]["mean_control"] == pytest.approx(4)
    assert t["c1"]["sd_control"] == pytest.approx(1)
    assert t["c2"]["t"] == pytest.approx(1.0)
    ranked = a.ranked.orderBy("rank").collect()
    assert [(r["rank"], r["cluster"]) for r in ranked] == [(1, "c1"), (2, "c2")]


def test_swapping_cohorts_negates_t(spark, lines):
    a = _by_cluster(from_wide(spark, lines(MATRIX), lines(ANNOTATION)).t_scores)
    b = _by_cluster(from_wide(spark, lines(MATRIX), lines(ANNOTATION),
                              control=("4", "5"), case=("1",)).t_scores)
    for c in a:
        assert b[c]["t"] == pytest.approx(-a[c]["t"])


def test_two_denominators_when_a_cell_is_missing(spark, lines):
    # Variant (a): P2 loses its last cell → c2 control has one score of 3,
    # mean 3/2 (cohort rows), sd over the one present score around 1.5.
    m = list(MATRIX)
    m[2] = "P2,1,3,2"
    t = _by_cluster(from_wide(spark, lines(m), lines(ANNOTATION)).t_scores)
    assert t["c2"]["mean_control"] == pytest.approx(1.5)
    assert t["c2"]["sd_control"] == pytest.approx(1.5)
    assert t["c2"]["n_scored_control"] == 1
    assert t["c2"]["t"] == pytest.approx(1.176697, abs=1e-6)


def test_zero_variance_gives_null_t_and_no_rank(spark, lines):
    m = ["PATIENT_ID,DIAGNOSIS,10,20,30", "P1,1,1,1,1", "P2,1,1,1,1", "P3,4,1,1,1",
         "P4,5,1,1,1"]
    a = from_wide(spark, lines(m), lines(ANNOTATION))
    assert all(r["t"] is None for r in a.t_scores.collect())
    assert a.ranked.count() == 0


def test_member_listed_twice_counts_twice(spark, lines):
    ann = list(ANNOTATION)
    ann[1] = "c1,a,Human,,10;20;10"
    scores = from_wide(spark, lines(MATRIX), lines(ann)).scores
    p1 = scores.filter((F.col("cluster") == "c1") & (F.col("sample_id") == "P1")).first()
    assert p1["score"] == 1 + 2 + 1


def test_blank_line_and_non_numeric_cell(spark, lines):
    m = list(MATRIX) + ["", "P7,4,x,2,4"]
    a = from_wide(spark, lines(m), lines(ANNOTATION))
    sizes = {r["grp"]: r["n"] for r in a.sizes.collect()}
    assert sizes["case"] == 3  # P7 is a cohort row even with a bad cell
    p7 = {r["cluster"]: r["score"] for r in a.scores.filter(F.col("sample_id") == "P7").collect()}
    assert p7 == {"c1": 2.0, "c2": 4.0}


def test_partitioning_does_not_change_results(spark, lines):
    a = from_wide(spark, lines(MATRIX, 1), lines(ANNOTATION, 1)).t_scores
    b = from_wide(spark, lines(MATRIX, 5), lines(ANNOTATION, 3)).t_scores
    ra, rb = _by_cluster(a), _by_cluster(b)
    for c in ra:
        assert ra[c]["t"] == pytest.approx(rb[c]["t"])


def test_long_input_matches_wide(spark, lines):
    samples = spark.createDataFrame(
        [("P1", "1"), ("P2", "1"), ("P3", "4"), ("P4", "5"), ("P5", "2"), ("P6", "NA")],
        "sample_id string, code string")
    values = {"P1": (1, 2, 3), "P2": (3, 2, 1), "P3": (5, 2, 4), "P4": (7, 6, 2),
              "P5": (9, 9, 9), "P6": (9, 9, 9)}
    cells = spark.createDataFrame(
        [(s, f, float(v)) for s, vs in values.items() for f, v in zip(("10", "20", "30"), vs)],
        "sample_id string, feature_id string, value double")
    fc = spark.createDataFrame([("10", "c1"), ("20", "c1"), ("30", "c2")],
                               "feature_id string, cluster string")
    t = _by_cluster(from_long(samples, cells, fc).t_scores)
    assert t["c1"]["t"] == pytest.approx(6 / math.sqrt(5))
    assert t["c2"]["t"] == pytest.approx(1.0)


def test_lookup_and_report(spark, lines):
    a = from_wide(spark, lines(MATRIX), lines(ANNOTATION))
    assert a.lookup("c2").first()["t"] == pytest.approx(1.0)
    assert a.lookup("missing").count() == 0
    rep = a.report().first()
    assert rep["rank"] == 1 and rep["case"]["mean"] == pytest.approx(10)


def test_top_k_by_abs_and_ties(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("b", -3.0), ("c", 2.0), ("d", 2.0), ("e", None), ("f", float("nan"))],
        "cluster string, t double")
    signed = [r["cluster"] for r in rank.top_k(df, 3).orderBy("rank").collect()]
    assert signed == ["c", "d", "a"]
    by_abs = [r["cluster"] for r in rank.top_k(df, 2, by="abs").orderBy("rank").collect()]
    assert by_abs == ["b", "c"]
    with pytest.raises(ValueError):
        rank.top_k(df, 2, by="other")


def test_take_n_is_ordered(spark):
    df = spark.createDataFrame([(i,) for i in range(20)], "x int").repartition(4)
    assert [r["x"] for r in rank.take_n(df, 3, "x").collect()] == [0, 1, 2]


def test_duplicate_header_counts_once_and_conflicting_header_fails(spark, lines):
    doubled = MATRIX + [MATRIX[0]]
    a = _by_cluster(from_wide(spark, lines(doubled, 3), lines(ANNOTATION)).t_scores)
    assert a["c1"]["t"] == pytest.approx(6 / math.sqrt(5))
    conflicting = MATRIX + ["PATIENT_ID,DIAGNOSIS,30,20,10"]
    with pytest.raises(Exception, match="conflicting header rows"):
        from_wide(spark, lines(conflicting), lines(ANNOTATION)).t_scores.collect()


def test_landed_matrix_gives_the_same_analysis(spark, lines, tmp_path):
    from cohortlens import from_landed, land_wide
    m = MATRIX + ["P1,1,1,1,1", "", "P7,4,x,2,4"]  # repeated sample row, blank, bad cell
    wide = from_wide(spark, lines(m, 3), lines(ANNOTATION))
    path = land_wide(spark, lines(m, 3), str(tmp_path / "landed"))
    landed = from_landed(spark, path, lines(ANNOTATION))
    assert {r["grp"]: r["n"] for r in landed.sizes.collect()} == \
        {r["grp"]: r["n"] for r in wide.sizes.collect()}
    a, b = _by_cluster(wide.t_scores), _by_cluster(landed.t_scores)
    assert set(a) == set(b)
    for c in a:
        assert b[c]["t"] == pytest.approx(a[c]["t"])
        assert b[c]["mean_control"] == pytest.approx(a[c]["mean_control"])


def test_repeated_sample_row_counts_twice_and_scores_merge(spark, lines):
    m = MATRIX + ["P1,1,1,1,1"]  # K4: P1 appears in two rows
    a = from_wide(spark, lines(m), lines(ANNOTATION))
    assert {r["grp"]: r["n"] for r in a.sizes.collect()}["control"] == 3
    p1 = a.scores.filter((F.col("cluster") == "c1") & (F.col("sample_id") == "P1")).first()
    assert p1["score"] == (1 + 2) + (1 + 1)
