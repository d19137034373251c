"""The plans large inputs get: shuffle joins instead of broadcasts, hot keys.

At scale the feature map and cohort tables are too large to broadcast, so
Spark plans sort-merge joins; one sample or one feature may hold a large
share of all cells. These tests force those plans on small data and check
the results do not change.
"""

import math
import random
import re
from collections import defaultdict
from contextlib import contextmanager

import duckdb
import pytest

import __spark_entry__ as se
from cohortlens import from_landed, from_long, from_wide, land_wide
from cohortlens.plans.cohort import landed_snapshot
from cohortlens.plans.registry import QUERIES, long_analysis
from cohortlens.sources import tables
from tests.conftest import ANNOTATION, MATRIX
from tests.test_entry import SMOKE, _norm

SHUFFLE_ONLY = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
FORCE_SKEW = {**SHUFFLE_ONLY,
              "spark.sql.adaptive.skewJoin.enabled": "true",
              "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
              "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256",
              "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256",
              "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@contextmanager
def conf(spark, settings):
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["top_k_clusters", "cohort_stats", "sample_features",
                                  "top_k_clusters_wide", "position_cluster_map"])
def test_shuffle_join_plans_give_same_results(spark, name):
    con = duckdb.connect()
    for t in ("orders", "lineitem", "part", "customer", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    with conf(spark, SHUFFLE_ONLY):
        df = se.queries()[name](spark, SMOKE)
        plan = df._jdf.queryExecution().executedPlan().toString()
        # data-sized joins shuffle; only bounded sides (cohort sizes, top-k) broadcast
        assert "SortMergeJoin" in plan
        got = df.collect()
    res = con.execute(se.oracle_sql()[name])
    cols = [d[0] for d in res.description]

    def canon(cs, rows):
        order = sorted(range(len(cs)), key=lambda i: cs[i])
        return sorted(tuple(_norm(r[i]) for i in order) for r in rows)

    assert canon(df.columns, got) == canon(cols, res.fetchall())


def _brute_force(samples, cells, fc):
    grp = {s: ("control" if c == "1" else "case") for s, c in samples if c in ("1", "4", "5")}
    n = defaultdict(int)
    for s, c in samples:
        if s in grp:
            n[grp[s]] += 1
    clusters = defaultdict(list)
    for f, c in fc:
        clusters[f].append(c)
    score = defaultdict(float)
    for s, f, v in cells:
        if s in grp:
            for c in clusters[f]:
                score[(grp[s], c, s)] += v
    by = defaultdict(list)
    for (g, c, _), v in score.items():
        by[(g, c)].append(v)
    stat = {}
    for (g, c), vs in by.items():
        mu = sum(vs) / n[g]
        stat[(g, c)] = (mu, math.sqrt(sum((v - mu) ** 2 for v in vs) / len(vs)))
    t = {}
    for (g, c), (mu, sd) in stat.items():
        if g == "case" and ("control", c) in stat:
            mu0, sd0 = stat[("control", c)]
            den = math.sqrt(sd * sd / n["case"] + sd0 * sd0 / n["control"])
            t[c] = (mu - mu0) / den if den else None
    return t


def test_hot_sample_and_hot_feature(spark):
    rnd = random.Random(7)
    samples = [(f"s{i}", rnd.choice("12345")) for i in range(300)]
    samples[0] = ("s0", "4")
    cells = []
    for i in range(3000):  # a third of all cells: one sample, one feature
        cells.append(("s0", f"f{i % 40}", float(rnd.randint(1, 9))))
        cells.append((f"s{rnd.randint(1, 299)}", "f0", float(rnd.randint(1, 9))))
        cells.append((f"s{rnd.randint(1, 299)}", f"f{rnd.randint(1, 39)}",
                      float(rnd.randint(1, 9))))
    fc = [(f"f{i}", f"c{i % 7}") for i in range(40)] + [(f"f{i}", f"d{i % 3}")
                                                          for i in range(0, 40, 2)]
    expect = _brute_force(samples, cells, fc)
    with conf(spark, FORCE_SKEW):
        a = from_long(
            spark.createDataFrame(samples, "sample_id string, code string").repartition(4),
            spark.createDataFrame(cells, "sample_id string, feature_id string, value double")
            .repartition(6),
            spark.createDataFrame(fc, "feature_id string, cluster string"))
        got = {r["cluster"]: r["t"] for r in a.t_scores.collect()}
    assert set(got) == set(expect)
    for c, t in expect.items():
        assert got[c] == pytest.approx(t, rel=1e-9)


def _plan(spark, name):
    with conf(spark, SHUFFLE_ONLY):
        return se.queries()[name](spark, SMOKE)._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_needed_columns(spark):
    plan = _plan(spark, "top_k_clusters")
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderpriority:string>" in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_brand:string,p_type:string>" in plan


def test_only_bounded_sides_are_broadcast_at_scale(spark):
    # cohort sizes (one row per cohort); plus the top-k table (<= k rows)
    assert _plan(spark, "top_k_clusters").count("BroadcastExchange") == 1
    assert _plan(spark, "sample_features").count("BroadcastExchange") == 2


def _skewed_tables(spark, folder):
    """Orders, line items and parts; one order holds a third of the line items."""
    rnd = random.Random(3)
    spark.createDataFrame([(i, rnd.choice(["1-URGENT", "4-NOT", "5-LOW", "2-HIGH"]))
                           for i in range(3000)], "o_orderkey long, o_orderpriority string"
                          ).repartition(3).write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(0 if i % 3 else rnd.randrange(3000), rnd.randrange(200), 1.0)
                           for i in range(60_000)],
                          "l_orderkey long, l_partkey long, l_quantity double"
                          ).repartition(6).write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(i, f"b{i % 5}", f"t{i % 7}") for i in range(200)],
                          "p_partkey long, p_brand string, p_type string"
                          ).write.parquet(f"{folder}/part.parquet")


def test_registered_long_query_splits_a_hot_order(spark, tmp_path):
    _skewed_tables(spark, tmp_path)
    settings = {**SHUFFLE_ONLY, "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k"}
    with conf(spark, settings):
        df = QUERIES["cluster_scores"](spark, str(tmp_path))
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan


def test_files_added_between_calls_are_read(spark, tmp_path):
    _skewed_tables(spark, tmp_path)
    before = {r["grp"]: r["n"] for r in QUERIES["cohort_sizes"](spark, str(tmp_path)).collect()}
    spark.createDataFrame([(10_000 + i, "1-URGENT") for i in range(7)],
                          "o_orderkey long, o_orderpriority string"
                          ).write.mode("append").parquet(f"{tmp_path}/orders.parquet")
    after = {r["grp"]: r["n"] for r in QUERIES["cohort_sizes"](spark, str(tmp_path)).collect()}
    assert after == {**before, "control": before["control"] + 7}


def test_wide_analysis_of_a_grown_file_is_fresh(spark, tmp_path):
    m, a = tmp_path / "m.csv", tmp_path / "a.csv"
    a.write_text("c1,x,Human,1,10\n")
    m.write_text("PATIENT_ID,DIAGNOSIS,10\nP1,1,1\nP2,1,2\nP3,4,5\nP4,5,7\n")
    first = from_wide(spark, str(m), str(a)).t_scores.first()
    with m.open("a") as f:
        f.write("P5,1,4\nP6,4,9\nP7,5,8\n")
    again = from_wide(spark, str(m), str(a)).t_scores.first()
    assert (first["n_control"], first["n_case"]) == (2, 2)
    assert (again["n_control"], again["n_case"]) == (3, 4)
    control, case = [1, 2, 4], [5, 7, 9, 8]
    mean = [sum(v) / len(v) for v in (case, control)]
    spread = [sum((x - mu) ** 2 for x in v) / len(v) ** 2
              for v, mu in zip((case, control), mean, strict=True)]
    assert again["t"] == pytest.approx((mean[0] - mean[1]) / math.sqrt(sum(spread)))


def test_salted_position_join_gives_more_tasks_and_the_same_result(spark, lines):
    plain = from_wide(spark, lines(MATRIX), lines(ANNOTATION), salts=1)
    salted = from_wide(spark, lines(MATRIX), lines(ANNOTATION), salts=8)
    with conf(spark, SHUFFLE_ONLY):
        assert sorted(plain.t_scores.collect()) == sorted(salted.t_scores.collect())
        assert "_salt" in salted.scores._jdf.queryExecution().executedPlan().toString()


def test_repeated_sample_rows_count_but_do_not_repeat_their_cells(spark):
    samples = [("a", "1"), ("a", "1"), ("b", "4"), ("c", "2")]
    cells = [("a", "f", 2.0), ("b", "f", 3.0), ("c", "f", 9.0)]
    a = from_long(spark.createDataFrame(samples, "sample_id string, code string"),
                  spark.createDataFrame(cells, "sample_id string, feature_id string, value double"),
                  spark.createDataFrame([("f", "k")], "feature_id string, cluster string"))
    stats = {r["grp"]: (r["n"], r["score_sum"], r["mean"]) for r in a.stats.collect()}
    assert stats == {"control": (2, 2.0, 1.0), "case": (1, 3.0, 3.0)}


def test_failed_background_write_does_not_shorten_later_results(spark, monkeypatch):
    def fail(lines, path):
        raise OSError("disk full")

    with monkeypatch.context() as m:
        m.setattr("cohortlens.sources.text.write_lines", fail)
        with pytest.raises(OSError):
            QUERIES["background_csv_parse"](spark, SMOKE)
    assert QUERIES["background_csv_parse"](spark, SMOKE).count() == \
        QUERIES["background_parse"](spark, SMOKE).count()


def test_incomplete_landing_is_not_read(spark, lines, tmp_path):
    path = str(tmp_path / "landed")
    snapshot = land_wide(spark, lines(MATRIX), path)
    (tmp_path / "landed" / "snapshot-99999999999999999999-x" / "samples").mkdir(parents=True)
    assert landed_snapshot(spark, path).endswith(snapshot.rsplit("/", 1)[-1])
    newer = land_wide(spark, lines(MATRIX[:3]), path)
    assert landed_snapshot(spark, path).endswith(newer.rsplit("/", 1)[-1])
    assert from_landed(spark, snapshot, lines(ANNOTATION)).cohort.count() == 4
    with pytest.raises(FileNotFoundError):
        landed_snapshot(spark, str(tmp_path / "none"))


def test_sums_of_larger_tables_get_more_tasks_and_the_same_results(spark, tmp_path, monkeypatch):
    _skewed_tables(spark, tmp_path)
    names = ("cluster_scores", "t_scores_all")
    before = [sorted(QUERIES[name](spark, str(tmp_path)).collect()) for name in names]
    plain = long_analysis(spark, str(tmp_path))
    assert plain.partitions is None
    monkeypatch.setattr(tables, "SUM_BYTES", 4096)
    parts = tables.sum_partitions(spark, str(tmp_path))
    assert parts > 16  # more than the session's 8 shuffle partitions
    split = long_analysis(spark, str(tmp_path))
    for a, n in ((plain, 1), (split, parts)):
        for df in (a.scores, a.sample_features()):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert (f", {parts}), REPARTITION_BY_NUM" in plan) == (n > 1)
    assert [sorted(QUERIES[name](spark, str(tmp_path)).collect()) for name in names] == before
    assert sorted(split.sample_features().collect()) == sorted(plain.sample_features().collect())


def test_joins_of_long_cells_go_by_table_size(spark, monkeypatch):
    """Joins with many orders, parts or customers have tasks by size, not by the session."""
    sf_dir = SMOKE
    names = ("cluster_scores", "t_scores_all", "sample_features")
    before = [sorted(QUERIES[name](spark, sf_dir).collect(), key=str) for name in names]
    monkeypatch.setattr(tables, "SUM_BYTES", 4096)
    monkeypatch.setattr(tables, "JOIN_BYTES", 0)
    parts = tables.long_partitions(spark, sf_dir)
    assert set(parts.values()) == {tables.sum_partitions(spark, sf_dir)}
    assert parts["partitions"] > 16  # more than the session's 8 shuffle partitions
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin [sample_id" not in plan
        for key in ("sample_id", "feature_id"):
            sized = rf"hashpartitioning\({key}#\d+L, {parts['partitions']}\), REPARTITION_BY_NUM"
            assert len(re.findall(sized, plan)) >= 2  # both sides of the join
    after = [sorted(QUERIES[name](spark, sf_dir).collect(), key=str) for name in names]
    assert after == before


def test_tasks_go_by_rows_where_files_are_small(spark, tmp_path):
    """Rows that compress to a few bytes take as much memory in a task as any others."""
    spark.range(300_000).selectExpr(
        "id div 300 AS l_orderkey", "id % 1000 AS l_partkey", "2.0D AS l_quantity"
    ).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(1000).selectExpr(
        "id AS o_orderkey", "if(id % 3 = 0, '1-URGENT', '4-NOT') AS o_orderpriority"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(250_000).selectExpr(
        "id AS p_partkey", "concat('b', id % 5) AS p_brand", "concat('t', id % 2) AS p_type"
    ).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    assert tables.table_bytes(spark, str(tmp_path), "lineitem") < tables.SUM_BYTES
    assert tables.table_bytes(spark, str(tmp_path), "part") < tables.JOIN_BYTES
    assert tables.long_partitions(spark, str(tmp_path)) == {
        "partitions": 2, "sample_partitions": None, "map_partitions": 2}
    df = QUERIES["cohort_stats"](spark, str(tmp_path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    # the session's 8 shuffle partitions are more than 2, so Spark takes these for the join
    sized = r"hashpartitioning\(feature_id#\d+L, 8\), REPARTITION_BY_NUM"
    assert len(re.findall(sized, plan)) >= 2  # both sides of the join with the parts
    con = duckdb.connect()
    for t in ("orders", "lineitem", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    res = con.execute(se.oracle_sql()["cohort_stats"])
    cols = [d[0] for d in res.description]
    expect = sorted(tuple(_norm(v) for v in r) for r in res.fetchall())
    assert sorted(tuple(_norm(v) for v in r) for r in df.select(*cols).collect()) == expect


def test_joins_by_size_sort_no_cells(spark, tmp_path, monkeypatch):
    """A task of a join by size keeps its orders or parts, not the cells of a hot one."""
    _skewed_tables(spark, tmp_path)
    monkeypatch.setattr(tables, "SUM_BYTES", 4096)
    monkeypatch.setattr(tables, "JOIN_BYTES", 0)
    con = duckdb.connect()
    for t in ("orders", "lineitem", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    df = QUERIES["cohort_stats"](spark, str(tmp_path))
    rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert len(re.findall(r"ShuffledHashJoin \[\w+#\d+L\], \[\w+#\d+L\], Inner, BuildRight", plan)) == 2
    assert "SortMergeJoin" not in plan
    res = con.execute(se.oracle_sql()["cohort_stats"])
    cols = [d[0] for d in res.description]
    at = [df.columns.index(c) for c in cols]
    assert sorted(tuple(_norm(r[i]) for i in at) for r in rows) == sorted(
        tuple(_norm(v) for v in r) for r in res.fetchall())


def test_joins_by_size_go_by_the_larger_table(spark, tmp_path):
    """Many orders of few line items: a task keeps its share of the orders in memory."""
    _skewed_tables(spark, tmp_path)
    spark.range(600_000).selectExpr("id AS o_orderkey", "'1-URGENT' AS o_orderpriority").coalesce(
        1).write.mode("overwrite").parquet(f"{tmp_path}/orders.parquet")
    assert tables.long_partitions(spark, str(tmp_path)) == {
        "partitions": None, "sample_partitions": 3, "map_partitions": None}
