"""Registered queries of exact splits, trees, forests and folds, with their DuckDB SQL."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.operators import model as ml
from cohortlens.operators import trees
from cohortlens.plans import registry as base
from cohortlens.plans.oracle import _BUCKET, _FOLD, _LABELED, _with
from cohortlens.session import durable
from cohortlens.sources import tables

# Fixed parameters of the registered queries.
TREE_DEPTH = 2
FOREST_TREES = 10
FOLD_TREES = 5
N_FEATURES = 10
N_THRESHOLD_FEATURES = 3


def q_best_splits(spark, sf_dir):
    """M5: the exact best split of every feature, by both criteria."""
    placed = trees.examples(base.labeled(spark, sf_dir)).withColumn("node", F.lit(1))
    splits = trees.landed(trees.candidate_splits(placed), "splits")
    out = None
    for criterion in trees.CRITERIA:
        best = trees.best_of(trees.with_gain(splits, criterion)).select(
            F.lit(criterion).alias("criterion"), "feature", "threshold", "gain", "n_left",
            "case_left", "n", "n_case")
        out = best if out is None else out.unionAll(best)
    return out


def q_exact_tree_nodes(spark, sf_dir):
    """M5 + M9: a tree grown on exact splits, as a table of nodes."""
    return trees.grow(trees.examples(base.labeled(spark, sf_dir)), TREE_DEPTH).drop("tree")


def q_exact_tree_rules(spark, sf_dir):
    """M9: the same tree as text, a line per node."""
    return trees.rules(trees.grow(trees.examples(base.labeled(spark, sf_dir)),
                                  TREE_DEPTH)).drop("tree")


def q_fitted_tree_nodes(spark, sf_dir):
    """M7 + M9: node tables of the trees that Spark ML fits on each fold's training part."""
    _, results = ml.cross_validate(base.threshold_points(spark, sf_dir), ("tree_gini",))
    out = None
    for r in results:
        nodes = trees.model_nodes(r.fitted).drop("tree").withColumn("fold", F.lit(r.fold))
        out = nodes if out is None else out.unionByName(nodes)
    return out


def q_tree_traversal(spark, sf_dir):
    """M7: held-out rows, and how many of them a walk over the nodes predicts as ``transform``."""
    points = durable(base.labeled(spark, sf_dir))
    train, test = ml.holdout_split(points)
    fitted = ml.estimator("tree_gini").fit(train)
    walked = trees.traverse(trees.examples(test), trees.model_nodes(fitted), ml.MAX_DEPTH).select(
        "sample_id", F.col("prediction").alias("walked"))
    both = fitted.transform(test).join(walked, "sample_id")
    alike = F.col("prediction") == F.col("walked")
    return both.groupBy("label").agg(F.count(F.lit(1)).alias("n_test"),
                                     F.count(F.when(alike, 1)).alias("n_alike"))


def q_forest_bag_counts(spark, sf_dir):
    """M6: samples, draws and drawn case samples of each tree's bootstrap."""
    drawn = trees.bags(trees.examples(base.labeled(spark, sf_dir)), FOREST_TREES)
    return drawn.groupBy("tree").agg(
        F.count(F.lit(1)).alias("n_samples"), F.sum("weight").alias("n_draws"),
        F.sum(F.when(F.col("label") == 1, F.col("weight")).otherwise(0)).alias("n_case"))


def q_forest_votes(spark, sf_dir):
    """M6: the majority vote of a forest of exact stumps on hash bags and feature subsets."""
    rows = trees.examples(base.labeled(spark, sf_dir))
    subset = trees.feature_subset(spark, N_FEATURES, FOREST_TREES)
    nodes = trees.grow(trees.bags(rows, FOREST_TREES), 1, "entropy", subset)
    return trees.forest_votes(rows, nodes, 1).select("sample_id", "label", "votes", "prediction")


def fold_forest(points: DataFrame, n_features: int, n_trees: int) -> DataFrame:
    """``fold, label, prediction``: each fold's samples by a forest grown on the others.

    The trees of all folds grow together; tree t belongs to fold ⌊t / n_trees⌋.
    """
    spark = points.sparkSession
    count = ml.N_FOLDS * n_trees
    rows = trees.examples(points, keep=("fold",))

    def by_fold(of) -> F.Column:
        return F.get(F.array(*[F.array(*[F.lit(t) for t in range(count) if of(t // n_trees, fold)])
                               for fold in range(ml.N_FOLDS)]), F.col("fold"))

    drawn = trees.bags(rows, count, trees=by_fold(lambda a, b: a != b)).drop("fold")
    nodes = trees.grow(drawn, 1, "entropy", trees.feature_subset(spark, n_features, count))
    return trees.forest_votes(rows, nodes, 1, by_fold(lambda a, b: a == b)).select(
        "fold", "label", "prediction")


def q_three_models(spark, sf_dir):
    """M10 + A13: each model's error on every fold and their mean, side by side."""
    points = ml.by_fold(base.threshold_points(spark, sf_dir))
    per_fold, _ = ml.cross_validate(points, ("tree_gini", "tree_entropy"), landed=True)
    forest = ml.confusion(fold_forest(points, N_THRESHOLD_FEATURES, FOLD_TREES), by=("fold",))
    errors = per_fold.select("model", "fold", "error").unionAll(forest.select(
        F.lit("forest_entropy"), "fold", "error"))
    return base._rounded_errors(ml.comparison(errors))


def q_exact_folds(spark, sf_dir):
    """M1: folds of .335/.335/.33 of the orders, exact to a row."""
    orders = tables.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("sample_id"))
    return ml.exact_folds(orders)


QUERIES = {
    "best_splits": q_best_splits,
    "exact_tree_nodes": q_exact_tree_nodes,
    "exact_tree_rules": q_exact_tree_rules,
    "fitted_tree_nodes": q_fitted_tree_nodes,
    "tree_traversal": q_tree_traversal,
    "forest_bag_counts": q_forest_bag_counts,
    "forest_votes": q_forest_votes,
    "three_models": q_three_models,
    "exact_folds": q_exact_folds,
}

# ---- SQL ------------------------------------------------------------------------

_FEATURES = [f"f{i:02d}" for i in range(1, N_FEATURES + 1)]


def _impurity(n: str, c: str, criterion: str) -> str:
    p = f"(({c}) / ({n}))"
    if criterion == "gini":
        return f"(2 * {p} * (1 - {p}))"
    return (f"((CASE WHEN {p} > 0 THEN -{p} * log2({p}) ELSE 0 END)"
            f" + (CASE WHEN 1 - {p} > 0 THEN -(1 - {p}) * log2(1 - {p}) ELSE 0 END))")


def _gain(criterion: str) -> str:
    right, case_right = "(n - n_left)", "(n_case - case_left)"
    return (f"round({_impurity('n', 'n_case', criterion)}"
            f" - n_left / n * {_impurity('n_left', 'case_left', criterion)}"
            f" - {right} / n * {_impurity(right, case_right, criterion)}, 9) + 0.0")


def _splits(rows: str, keys: str, name: str) -> str:
    """CTEs that end in ``name``: every split of ``rows`` (keys, feature, value, w, c)."""
    return f"""
{name}_counted AS (SELECT {keys}, feature, value, sum(w) AS w, sum(c) AS c FROM {rows}
                   WHERE value IS NOT NULL GROUP BY ALL),
{name} AS (
  SELECT * FROM (
    SELECT {keys}, feature,
           value + (lead(value) OVER o - value) / 2 AS threshold,
           CAST(sum(w) OVER o AS BIGINT) AS n_left, CAST(sum(c) OVER o AS BIGINT) AS case_left,
           CAST(sum(w) OVER p AS BIGINT) AS n, CAST(sum(c) OVER p AS BIGINT) AS n_case
    FROM {name}_counted
    WINDOW o AS (PARTITION BY {keys}, feature ORDER BY value),
           p AS (PARTITION BY {keys}, feature))
  WHERE threshold IS NOT NULL)"""


_EXAMPLES = f"""
examples AS (SELECT sample_id, label, [{", ".join(_FEATURES)}] AS x FROM points)"""
_CELLS = f"""
cells1 AS (SELECT 1 AS node, CAST(i AS INTEGER) AS feature, x[i + 1] AS value, 1 AS w,
                  CAST(label AS BIGINT) AS c
           FROM (SELECT x, label, unnest(range(0, {N_FEATURES})) AS i FROM examples))"""

BEST_SPLITS = _with(*_LABELED, _EXAMPLES, _CELLS, _splits("cells1", "node", "splits")) + "".join(
    f"""
{'UNION ALL' if i else ''}
SELECT '{c}' AS criterion, feature, threshold, gain, n_left, case_left, n, n_case FROM (
  SELECT *, {_gain(c)} AS gain FROM splits)
QUALIFY row_number() OVER (PARTITION BY feature ORDER BY gain DESC, threshold) = 1"""
    for i, c in enumerate(trees.CRITERIA))

_NODES = (*_LABELED, _EXAMPLES, _CELLS, _splits("cells1", "node", "splits1"), f"""
best1 AS (SELECT * FROM (SELECT *, {_gain('gini')} AS gain FROM splits1)
          QUALIFY row_number() OVER (ORDER BY gain DESC, feature, threshold) = 1),
placed AS (
  SELECT e.*, CASE WHEN x[feature + 1] <= threshold THEN 2 ELSE 3 END AS node
  FROM examples e, best1 WHERE gain > 0),
cells2 AS (SELECT node, CAST(i AS INTEGER) AS feature, x[i + 1] AS value, 1 AS w,
                  CAST(label AS BIGINT) AS c
           FROM (SELECT node, x, label, unnest(range(0, {N_FEATURES})) AS i FROM placed))""",
          _splits("cells2", "node", "splits2"), f"""
best2 AS (SELECT * FROM (SELECT *, {_gain('gini')} AS gain FROM splits2) WHERE gain > 0
          QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, feature, threshold) = 1),
leaves AS (
  SELECT p.node * 2 + CASE WHEN x[feature + 1] <= threshold THEN 0 ELSE 1 END AS node, label
  FROM placed p JOIN best2 USING (node)),
counts AS (
  SELECT 1 AS node, count(*) AS n, CAST(sum(label) AS BIGINT) AS n_case FROM examples
  UNION ALL SELECT node, count(*), CAST(sum(label) AS BIGINT) FROM placed GROUP BY node
  UNION ALL SELECT node, count(*), CAST(sum(label) AS BIGINT) FROM leaves GROUP BY node),
chosen AS (SELECT node, feature, threshold FROM best1 WHERE gain > 0
           UNION ALL SELECT node, feature, threshold FROM best2),
nodes AS (
  SELECT CAST(node AS INTEGER) AS node, feature, threshold,
         CAST(CASE WHEN feature IS NOT NULL THEN node * 2 END AS INTEGER) AS left_child,
         CAST(CASE WHEN feature IS NOT NULL THEN node * 2 + 1 END AS INTEGER) AS right_child,
         n - n_case AS n_control, n_case,
         CASE WHEN n_case * 2 > n THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction
  FROM counts LEFT JOIN chosen USING (node))""")

EXACT_TREE_NODES = _with(*_NODES) + "\nSELECT * FROM nodes"

EXACT_TREE_RULES = _with(*_NODES) + """
SELECT n.node, CASE WHEN p.node IS NULL THEN 'all' ELSE 'feature ' || p.feature
         || CASE WHEN n.node = p.left_child THEN ' <= ' ELSE ' > ' END
         || format('{:.6f}', p.threshold) END
       || ' (' || n.n_control || ' control, ' || n.n_case || ' case)'
       || CASE WHEN n.feature IS NULL THEN ' predict ' || CAST(n.prediction AS INTEGER) ELSE '' END
       AS rule
FROM nodes n LEFT JOIN nodes p ON n.node IN (p.left_child, p.right_child)"""

_ITEMS = f"""
items AS (SELECT l_orderkey * 16 + l_linenumber AS sample_id, l_linenumber >= 4 AS positive,
                 [l_linenumber::DOUBLE, l_quantity::DOUBLE, l_discount::DOUBLE] AS x,
                 {_FOLD.format(b=_BUCKET.format(id="l_orderkey * 16 + l_linenumber"))} AS fold
          FROM lineitem)"""

FITTED_TREE_NODES = _with(_ITEMS) + """,
train AS (SELECT CAST(f.fold AS INTEGER) AS fold, count(*) FILTER (WHERE NOT positive) AS a,
                 count(*) FILTER (WHERE positive) AS b
          FROM items JOIN (VALUES (0), (1), (2)) f(fold) ON items.fold <> f.fold GROUP BY 1)
SELECT fold, 0 AS node, 0 AS feature, 3.5::DOUBLE AS threshold, 1 AS left_child, 2 AS right_child,
       a AS n_control, b AS n_case, CASE WHEN b > a THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction
FROM train
UNION ALL SELECT fold, 1, NULL, NULL, NULL, NULL, a, 0, 0.0 FROM train
UNION ALL SELECT fold, 2, NULL, NULL, NULL, NULL, 0, b, 1.0 FROM train"""

_EDGES = trees.poisson_edges()


def _hash(text: str, digits: int) -> str:
    return f"('0x' || substr(md5({text}), 1, {digits}))::BIGINT"


def _weight(tree: str, sample: str) -> str:
    draw = _hash(f"'{trees.BAG_SEED}:' || {tree} || ':' || {sample}", trees.DRAW_DIGITS)
    return (f"len(list_filter([{', '.join(map(str, _EDGES))}], lambda e: e <= {draw}))")


def _subset(n_features: int, n_trees: int) -> str:
    size = max(1, round(math.sqrt(n_features)))
    order = _hash(f"'{trees.BAG_SEED}:' || tree || ':' || feature", trees.DRAW_DIGITS)
    return f"""
subset AS (
  SELECT CAST(tree AS INTEGER) AS tree, CAST(feature AS INTEGER) AS feature
  FROM range({n_trees}) t(tree), range({n_features}) f(feature)
  QUALIFY row_number() OVER (PARTITION BY tree ORDER BY {order}, feature) <= {size})"""


_BAGS = f"""
bags AS (
  SELECT * FROM (SELECT e.*, CAST(t.tree AS INTEGER) AS tree, {_weight('t.tree', 'sample_id')} AS w
                 FROM examples e, range({FOREST_TREES}) t(tree))
  WHERE w > 0)"""

FOREST_BAG_COUNTS = _with(*_LABELED, _EXAMPLES, _BAGS) + """
SELECT tree, count(*) AS n_samples, CAST(sum(w) AS BIGINT) AS n_draws,
       CAST(sum(w) FILTER (WHERE label = 1) AS BIGINT) AS n_case
FROM bags GROUP BY tree"""


def _stumps() -> str:
    """CTEs from ``bags`` (tree, label, x, w) and ``subset`` to ``stumps``."""
    return f"""
bag_cells AS (SELECT tree, feature, x[feature + 1] AS value, w,
                     CASE WHEN label = 1 THEN w ELSE 0 END AS c
              FROM bags JOIN subset USING (tree)),""" + _splits("bag_cells", "tree", "bag_splits") \
        + f""",
bag_best AS (SELECT * FROM (SELECT *, {_gain('entropy')} AS gain FROM bag_splits) WHERE gain > 0
             QUALIFY row_number() OVER (PARTITION BY tree ORDER BY gain DESC, feature, threshold)
                     = 1),
bag_totals AS (SELECT tree, sum(w) AS n, coalesce(sum(w) FILTER (WHERE label = 1), 0) AS n_case
               FROM bags GROUP BY tree),
stumps AS (
  SELECT t.tree, feature, threshold, t.n_case * 2 > t.n AS whole,
         case_left * 2 > n_left AS low,
         (b.n_case - case_left) * 2 > b.n - n_left AS high
  FROM bag_totals t LEFT JOIN bag_best b ON t.tree = b.tree)"""


_SAYS = """CASE WHEN feature IS NULL THEN whole
              WHEN x[feature + 1] <= threshold THEN low ELSE high END"""

FOREST_VOTES = _with(*_LABELED, _EXAMPLES, _BAGS, _subset(N_FEATURES, FOREST_TREES),
                     _stumps()) + f"""
SELECT sample_id, label, count(*) FILTER (WHERE says) AS votes,
       CASE WHEN count(*) FILTER (WHERE says) * 2 > count(*) THEN 1.0 ELSE 0.0 END::DOUBLE
         AS prediction
FROM (SELECT sample_id, label, {_SAYS} AS says FROM examples, stumps)
GROUP BY sample_id, label"""

THREE_MODELS = _with(_ITEMS, f"""
bags AS (
  SELECT * FROM (SELECT x, positive::INTEGER AS label, CAST(t.tree AS INTEGER) AS tree,
                        {_weight('t.tree', 'sample_id')} AS w
                 FROM items, range({3 * FOLD_TREES}) t(tree)
                 WHERE t.tree // {FOLD_TREES} <> fold)
  WHERE w > 0)""", _subset(N_THRESHOLD_FEATURES, 3 * FOLD_TREES), _stumps()) + f""",
voted AS (
  SELECT sample_id, fold, positive, count(*) FILTER (WHERE says) * 2 > count(*) AS says
  FROM (SELECT sample_id, fold, positive, {_SAYS} AS says
        FROM items JOIN stumps ON tree // {FOLD_TREES} = fold)
  GROUP BY ALL),
errors AS (SELECT fold, count(*) FILTER (WHERE says <> positive) / count(*) AS error
           FROM voted GROUP BY fold)
SELECT 'forest_entropy' AS model, {", ".join(
    f"round(max(error) FILTER (WHERE fold = {i}), 6) + 0.0 AS error_{i}" for i in range(3))},
       3::BIGINT AS n_folds, round(avg(error), 6) + 0.0 AS mean_error FROM errors
UNION ALL SELECT 'tree_gini', 0.0, 0.0, 0.0, 3, 0.0
UNION ALL SELECT 'tree_entropy', 0.0, 0.0, 0.0, 3, 0.0"""

EXACT_FOLDS = f"""
WITH placed AS (
  SELECT o_orderkey AS sample_id, count(*) OVER () AS n, row_number() OVER (
           ORDER BY {_hash("'1234:' || o_orderkey", 15)}, CAST(o_orderkey AS VARCHAR)) AS place
  FROM orders)
SELECT sample_id, CAST(CASE WHEN place <= n * 335 // 1000 THEN 0
                            WHEN place <= n * 670 // 1000 THEN 1 ELSE 2 END AS INTEGER) AS fold
FROM placed"""

ORACLE = {
    "best_splits": BEST_SPLITS,
    "exact_tree_nodes": EXACT_TREE_NODES,
    "exact_tree_rules": EXACT_TREE_RULES,
    "fitted_tree_nodes": FITTED_TREE_NODES,
    "tree_traversal": _with(*_LABELED) + """
SELECT label, count(*) AS n_test, count(*) AS n_alike FROM points WHERE bucket >= 140
GROUP BY label""",
    "forest_bag_counts": FOREST_BAG_COUNTS,
    "forest_votes": FOREST_VOTES,
    "three_models": THREE_MODELS,
    "exact_folds": EXACT_FOLDS,
}
