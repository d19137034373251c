"""Exact splits, trees, hash forests and exact folds against brute force."""

import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from cohortlens.operators import model as ml
from cohortlens.operators import ordered, trees


def _points(spark, rows, partitions=3):
    df = spark.createDataFrame([(i, float(y), Vectors.dense(x)) for i, y, x in rows],
                               ["sample_id", "label", "features"])
    return df.repartition(partitions)


def _random_rows(n, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        x = [rnd.randrange(6), rnd.randrange(40) / 4, 1.0]
        rows.append((i, int(x[0] + rnd.random() * 4 > 4) ^ int(x[1] > 8), x))
    return rows


def _impurity(n, c, criterion):
    p = c / n
    if criterion == "gini":
        return 2 * p * (1 - p)
    return sum(-q * math.log2(q) for q in (p, 1 - p) if q > 0)


def _best(rows, criterion, features):
    best = None
    n, c = len(rows), sum(y for _, y, _ in rows)
    for f in features:
        values = sorted({x[f] for _, _, x in rows})
        for a, b in zip(values, values[1:]):
            left = [y for _, y, x in rows if x[f] <= a]
            nl, cl = len(left), sum(left)
            gain = (_impurity(n, c, criterion) - nl / n * _impurity(nl, cl, criterion)
                    - (n - nl) / n * _impurity(n - nl, c - cl, criterion))
            key = (-round(gain, 9), f, a + (b - a) / 2)
            if best is None or key < best:
                best = key
    return best


def _brute_tree(rows, depth, criterion, node=1, features=(0, 1, 2)):
    c = sum(y for _, y, _ in rows)
    best = _best(rows, criterion, features) if depth else None
    if best is None or best[0] >= 0:
        return {node: (None, None, len(rows) - c, c)}
    _, f, t = best
    out = {node: (f, t, len(rows) - c, c)}
    out |= _brute_tree([r for r in rows if r[2][f] <= t], depth - 1, criterion, 2 * node, features)
    out |= _brute_tree([r for r in rows if r[2][f] > t], depth - 1, criterion, 2 * node + 1,
                       features)
    return out


@pytest.mark.parametrize("criterion", trees.CRITERIA)
def test_grown_tree_matches_brute_force_in_any_layout(spark, criterion):
    rows = _random_rows(300, 5)
    for partitions in (1, 7):
        points = _points(spark, rows, partitions)
        nodes = trees.grow(trees.examples(points), 3, criterion)
        got = {r.node: (r.feature, r.threshold, r.n_control, r.n_case) for r in nodes.collect()}
        assert got == _brute_tree(rows, 3, criterion)
        walked = {r.sample_id: r.prediction for r in trees.traverse(
            trees.examples(points), nodes, 3).collect()}

        def leaf(x, node=1):
            f, t, a, b = got[node]
            if f is None:
                return float(b > a)
            return leaf(x, 2 * node + (x[f] > t))
        assert walked == {i: leaf(x) for i, _, x in rows}


def test_no_split_on_constant_features_one_label_and_empty(spark):
    same = [(i, i % 2, [1.0, 1.0]) for i in range(4)]
    assert [r.feature for r in trees.grow(trees.examples(_points(spark, same)), 2).collect()] == [
        None]
    pure = [(i, 1, [float(i), 0.0]) for i in range(4)]
    nodes = trees.grow(trees.examples(_points(spark, pure)), 2).collect()
    assert [(r.feature, r.n_case, r.prediction) for r in nodes] == [(None, 4, 1.0)]
    empty = _points(spark, pure).filter("label > 1")
    assert trees.grow(trees.examples(empty), 2).count() == 0
    assert trees.best_splits(trees.examples(empty).withColumn("node", F.lit(1))).count() == 0


def test_fitted_models_as_node_tables_predict_as_transform(spark):
    points = _points(spark, _random_rows(300, 6))
    rows = trees.examples(points)
    for kind in ("tree_gini", "forest_entropy"):
        fitted = ml.estimator(kind, 4).fit(points)
        nodes = trees.model_nodes(fitted)
        walked = {(r.tree, r.sample_id): r.prediction
                  for r in trees.traverse(rows, nodes, ml.MAX_DEPTH).collect()}
        parts = getattr(fitted, "trees", [fitted])
        for number, part in enumerate(parts):
            for r in part.transform(points).collect():
                assert walked[number, r.sample_id] == r.prediction


def test_bags_are_poisson_and_independent_of_layout(spark):
    rows = _random_rows(3000, 7)
    drawn = [trees.bags(trees.examples(_points(spark, rows, p)), 3) for p in (1, 5)]
    a, b = ({(r.tree, r.sample_id): r.weight for r in d.collect()} for d in drawn)
    assert a == b
    edges = trees.poisson_edges()
    for (tree, sample), w in list(a.items())[:200]:
        draw = int(hashlib.md5(f"{trees.BAG_SEED}:{tree}:{sample}".encode()).hexdigest()[:8], 16)
        assert w == sum(e <= draw for e in edges)
    counts = Counter(a.values())
    assert abs(sum(a.values()) / 9000 - 1) < 0.05
    assert abs((9000 - len(a)) / 9000 - math.exp(-1)) < 0.03 and counts[2] < counts[1]


def test_feature_subset_and_vote(spark):
    subset = trees.feature_subset(spark, 10, 6).collect()
    assert Counter(r.tree for r in subset) == {t: 3 for t in range(6)}
    assert len({tuple(sorted(r.feature for r in subset if r.tree == t)) for t in range(6)}) > 1
    votes = spark.createDataFrame([(1, 0.0, t, float(t < 2)) for t in range(4)]
                                  + [(2, 1.0, t, float(t < 3)) for t in range(4)],
                                  "sample_id long, label double, tree int, prediction double")
    got = {r.sample_id: (r.votes, r.prediction) for r in trees.vote(votes).collect()}
    assert got == {1: (2, 0.0), 2: (3, 1.0)}  # half is no majority


def test_running_sums_over_a_group_that_spans_chunks(spark):
    rnd = random.Random(8)
    rows = [("hot" if rnd.random() < 0.6 else rnd.choice([None, "a", "b"]), i, rnd.randrange(9))
            for i in range(4000)]
    df = spark.createDataFrame(rows, "k string, o long, v long").repartition(5)
    chunked = ordered.in_chunks(df, "k", "o")
    got = {(r.k, r.o): r.upto for r in ordered.running_sums(
        chunked, ["k"], ["o"], upto="v").collect()}
    want, totals = {}, Counter()
    for k, o, v in sorted(rows, key=lambda r: r[1]):
        totals[k] += v
        want[k, o] = totals[k]
    assert got == want


@pytest.mark.parametrize("few", [1, 10_000])
def test_exact_folds_have_exact_sizes_in_any_layout(spark, monkeypatch, few):
    monkeypatch.setattr(ordered, "FEW", few)
    ids = spark.range(997).select((F.col("id") * 3).alias("sample_id"))
    folds = [ml.exact_folds(ids.repartition(p)).collect() for p in (1, 6)]
    a, b = ({r.sample_id: r.fold for r in rows} for rows in folds)
    assert a == b
    assert Counter(a.values()) == {0: 333, 1: 667 - 333, 2: 997 - 667}

    def place(i):
        return int(hashlib.md5(f"{ml.RANDOM_SPLIT_SEED}:{i}".encode()).hexdigest()[:15], 16), str(i)
    order = sorted(a, key=place)
    assert [a[i] for i in order] == sorted(a.values())
    other = {r.sample_id: r.fold for r in ml.exact_folds(ids, seed=9).collect()}
    assert other != a


def test_exact_folds_of_few_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None,), (5,), (5,), (6,)], "sample_id long")
    rows = [(r.sample_id, r.fold) for r in ml.exact_folds(df).collect()]
    assert len({f for i, f in rows if i == 5}) == 1 and (None, 2) in rows
    assert ml.exact_folds(df.filter("sample_id > 9")).count() == 0


def test_comparison_has_folds_and_mean_side_by_side(spark):
    errors = spark.createDataFrame([("a", 0, 0.1), ("a", 1, 0.2), ("a", 2, None), ("b", 1, 0.5)],
                                   "model string, fold int, error double")
    got = {r.model: tuple(r)[1:] for r in ml.comparison(errors).collect()}
    assert got["a"] == (0.1, 0.2, None, 2, pytest.approx(0.15))
    assert got["b"] == (None, 0.5, None, 1, 0.5)


def test_votes_in_the_row_are_those_of_walks_and_counts(spark):
    points = _points(spark, _random_rows(200, 9))
    rows = trees.examples(points)
    nodes = trees.grow(trees.bags(rows, 5), 2, "entropy", trees.feature_subset(spark, 3, 5))
    want = {r.sample_id: (r.label, r.votes, r.prediction) for r in trees.vote(
        trees.traverse(rows, nodes, 2)).collect()}
    voted = trees.forest_votes(rows, nodes, 2)
    assert "Exchange hashpartitioning(sample_id" not in \
        voted._jdf.queryExecution().executedPlan().toString()
    assert {r.sample_id: (r.label, r.votes, r.prediction) for r in voted.collect()} == want
    some = F.array(F.lit(1), F.lit(3), F.lit(7))  # tree 7 is not there
    want = {r.sample_id: r.prediction for r in trees.vote(
        trees.traverse(rows, nodes, 2).filter("tree in (1, 3)")).collect()}
    assert {r.sample_id: r.prediction
            for r in trees.forest_votes(rows, nodes, 2, some).collect()} == want
    fitted = ml.estimator("forest_entropy", 3).fit(points)
    nodes = trees.model_nodes(fitted)
    want = {r.sample_id: r.votes for r in trees.vote(
        trees.traverse(rows, nodes, ml.MAX_DEPTH)).collect()}
    assert {r.sample_id: r.votes
            for r in trees.forest_votes(rows, nodes, ml.MAX_DEPTH).collect()} == want
    assert trees.forest_votes(rows, nodes.filter("tree > 9"), 2).count() == 0


def test_stumps_of_bags_are_grown_without_writing_the_bags(spark, monkeypatch):
    written = []
    landed = trees.landed
    monkeypatch.setattr(trees, "landed", lambda df, name: written.append(name) or landed(df, name))
    rows = trees.examples(_points(spark, _random_rows(200, 10)))
    trees.grow(trees.bags(rows, 4), 1, "entropy", trees.feature_subset(spark, 3, 4)).collect()
    assert "tree-rows" not in written


def test_children_of_values_without_a_number_between_are_counted_as_placed(spark):
    low, high = 1.0 + 2 ** -52, 1.0 + 2 ** -51  # half their distance rounds up to the higher
    rows = [(i, int(i % 4 == 0), [high if i % 2 else low]) for i in range(8)]
    nodes = {r.node: r for r in trees.grow(trees.examples(_points(spark, rows)), 1).collect()}
    assert nodes[1].threshold == high
    assert set(nodes) == {1, 2} and (nodes[2].n_control, nodes[2].n_case) == (6, 2)
    rows = [(i, int(i >= 4), [None if i == 7 else float(i)]) for i in range(8)]
    examples = spark.createDataFrame([(0, i, float(y), 1, x) for i, y, x in rows],
                                     "tree int, sample_id long, label double, weight long, "
                                     "x array<double>")
    nodes = {r.node: r for r in trees.grow(examples, 1).collect()}
    assert (nodes[1].threshold, nodes[2].n_control, nodes[3].n_case) == (3.5, 4, 4)


def test_bags_of_some_trees(spark):
    rows = trees.examples(_points(spark, _random_rows(100, 11)))
    every = {(r.tree, r.sample_id, r.weight) for r in trees.bags(rows, 4).collect()}
    some = trees.bags(rows, 4, trees=F.when(F.col("sample_id") < 50, F.array(F.lit(1))).otherwise(
        F.array(F.lit(0), F.lit(3))))
    assert {(r.tree, r.sample_id, r.weight) for r in some.collect()} == {
        (t, i, w) for t, i, w in every if (t == 1 if i < 50 else t in (0, 3))}
