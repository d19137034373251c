"""Exact classification trees and reproducible forests as DataFrame plans (M5–M7, M9).

``best_splits``  exact best threshold of every feature of every node
``grow``         level-wise trees on these splits, as a table of nodes
``bags``         hash-Poisson bootstrap: how often each tree takes each sample
``feature_subset`` hash-chosen features of each tree
``traverse``     predictions by walking the node table
``vote``         majority vote of the trees of a forest
``model_nodes``  the same node table of a fitted Spark ML model

A node table has one row per node: ``tree, node, feature, threshold, left_child,
right_child, n_control, n_case, prediction``; leaves have null feature, threshold and
children. Rows with a feature of at most the threshold go left.

Splits come from sorted cumulative class counts: samples are counted by (tree,
node, feature, value) map-side, range-partitioned in that order, and each value's
counts so far are completed by the totals of the chunks before (``ordered``), so
neither a node nor a feature is ever in one task. Draws are md5 hashes of ids, the
same in every layout, run and engine.
"""

from __future__ import annotations

import math

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlens.functions.columns import hash_number
from cohortlens.operators.ordered import in_chunks, running_sums
from cohortlens.session import run_folder

CRITERIA = ("gini", "entropy")
#: Decimals at which gains count as equal; ties go to the first feature, then the least threshold.
GAIN_DECIMALS = 9
#: Hash digits (hex) of a bootstrap draw.
DRAW_DIGITS = 8
BAG_SEED = 123


def landed(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to a new folder of this application."""
    path = f"{run_folder(df.sparkSession, name)}/data"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def examples(points: DataFrame, tree: int = 0, keep: tuple[str, ...] = ()) -> DataFrame:
    """``tree, sample_id, label, weight, x`` (and ``keep``) of labelled points (features as an array).

    Written once, so that the conversion of vectors runs once and outside of the joins.
    """
    return landed(points.select(F.lit(tree).alias("tree"), "sample_id", "label",
                                F.lit(1).cast("long").alias("weight"),
                                vector_to_array("features").alias("x"), *keep), "examples")


# ---- split search -------------------------------------------------------------

def impurity(n: Column, n_case: Column, criterion: str) -> Column:
    """Gini or entropy (bits) of a node of ``n`` samples with ``n_case`` of label 1."""
    p = n_case / n
    if criterion == "gini":
        return 2 * p * (1 - p)
    if criterion == "entropy":
        def part(q: Column) -> Column:
            return F.when(q > 0, -q * F.log2(q)).otherwise(0.0)
        return part(p) + part(1 - p)
    raise ValueError(f"criterion must be one of {CRITERIA}, got {criterion!r}")


#: The number that stands for a feature in the counts of whole nodes.
WHOLE = -1


def value_counts(placed: DataFrame, whole: bool = False) -> DataFrame:
    """``chunk, tree, node, feature, value, w, c``: samples and case samples of each value.

    ``placed``: ``tree, node, label, weight, x`` and perhaps ``own``, the features that
    count; null features are left out. ``whole`` adds the counts of each node as a
    feature ``WHOLE`` of one value. One pass over ``placed``, combined map-side; the
    counts are written in order.
    """
    feature = F.col("own") if "own" in placed.columns else F.when(
        F.size("x") > 0, F.sequence(F.lit(0), F.size("x") - 1)).otherwise(
        F.array().cast("array<int>"))
    if whole:
        feature = F.concat(F.array(F.lit(WHOLE)), feature)
    counted = (placed.select("tree", "node", "label", "weight", "x",
                             F.explode(feature).alias("feature"))
               .withColumn("value", F.when(F.col("feature") == WHOLE, 0.0).otherwise(
                   F.get("x", F.col("feature"))))
               .filter("value is not null")
               .groupBy("tree", "node", "feature", "value")
               .agg(F.sum("weight").alias("w"),
                    F.sum(F.when(F.col("label") == 1, F.col("weight")).otherwise(0)).alias("c")))
    return in_chunks(counted, "tree", "node", "feature", "value", name="splits")


def candidate_splits(placed: DataFrame) -> DataFrame:
    """Every threshold of every node and feature with its class counts.

    ``placed`` as in :func:`value_counts`. Gives ``tree, node, feature, value, threshold,
    n_left, case_left, n, n_case, parts``; a threshold lies halfway to the feature's next
    value, and the largest value has none. ``parts``: the rows of at most the threshold
    are those of at most the value (not so if no number lies between two values).
    """
    return splits_of(value_counts(placed))


def splits_of(chunked: DataFrame) -> DataFrame:
    """:func:`candidate_splits` from the counts of values."""
    group = ["tree", "node", "feature"]
    chunked = chunked.filter(F.col("feature") != WHOLE)
    upto = running_sums(chunked, group, ["value"], n_left="w", case_left="c")
    totals = chunked.groupBy(*group).agg(F.sum("w").alias("n"), F.sum("c").alias("n_case"))
    # the next value is in this chunk or is the first of the next one
    firsts = chunked.groupBy("chunk", *group).agg(F.min("value").alias("first"))
    after = firsts.select("chunk", *group, F.lead("first").over(
        Window.partitionBy(*group).orderBy("chunk")).alias("after"))
    inside = Window.partitionBy("chunk", *group).orderBy("value")
    following = F.coalesce(F.col("inside"), F.col("after"))
    return (upto.withColumn("inside", F.lead("value").over(inside))
            .join(after, ["chunk", *group]).join(totals, group)
            .withColumn("threshold", F.col("value") + (following - F.col("value")) / 2)
            .filter(F.col("threshold").isNotNull())
            .select(*group, "value", "threshold", "n_left", "case_left", "n", "n_case",
                    ((F.col("value") <= F.col("threshold"))
                     & (F.col("threshold") < following)).alias("parts")))


def with_gain(splits: DataFrame, criterion: str) -> DataFrame:
    """``splits`` with the ``gain``: how much a split lowers the node's impurity."""
    n, left = F.col("n"), F.col("n_left")
    right, case_right = n - left, F.col("n_case") - F.col("case_left")
    gain = (impurity(n, F.col("n_case"), criterion)
            - left / n * impurity(left, F.col("case_left"), criterion)
            - right / n * impurity(right, case_right, criterion))
    return splits.withColumn("gain", F.round(gain, GAIN_DECIMALS) + F.lit(0.0))


def best_of(gains: DataFrame, by: tuple[str, ...] = ("feature",)) -> DataFrame:
    """The best of splits with gains per (tree, node, ``by``): largest gain, least feature, threshold."""
    order = F.struct((-F.col("gain")).alias("minus_gain"), "feature", "threshold", "n_left",
                     "case_left", "n", "n_case", "parts")
    best = gains.groupBy("tree", "node", *by).agg(F.min(order).alias("s"))
    return best.select("tree", "node", "s.feature", "s.threshold",
                       (-F.col("s.minus_gain") + F.lit(0.0)).alias("gain"), "s.n_left",
                       "s.case_left", "s.n", "s.n_case", "s.parts")


def best_splits(placed: DataFrame, criterion: str = "gini", by: tuple[str, ...] = ("feature",)
                ) -> DataFrame:
    """M5: the exact best split of every feature of every node (``by=()``: one per node).

    Nodes and features of one value have none.
    """
    return best_of(with_gain(candidate_splits(placed), criterion), by)


# ---- trees --------------------------------------------------------------------

def grow(rows: DataFrame, depth: int, criterion: str = "gini", subset: DataFrame | None = None
         ) -> DataFrame:
    """The node table of one tree per ``tree`` of ``rows`` (:func:`examples` or :func:`bags`).

    Level by level: each open node gets its exact best split if that has a gain. Node 1 is
    the root and node i has the children 2i and 2i + 1. ``subset`` (tree, feature)
    restricts the features of a tree. A level is one pass over ``rows``, which are placed
    in their nodes and written only where another level of splits follows; the counts
    of children are those of their parent's split. Only the node table is kept between
    levels.
    """
    if subset is not None:
        # a row per tree
        rows = rows.join(F.broadcast(subset.groupBy("tree").agg(
            F.array_sort(F.collect_list("feature")).alias("own"))), "tree")
    placed, counts = rows.withColumn("node", F.lit(1)), None
    levels = []
    for level in range(depth + 1):
        if level < depth:
            values = value_counts(placed, whole=level == 0)
            if level == 0:
                counts = values.filter(F.col("feature") == WHOLE).select(
                    "tree", "node", F.col("w").alias("n"), F.col("c").alias("n_case"))
            splits = best_of(with_gain(splits_of(values), criterion), ()).filter("gain > 0")
        else:
            if level == 0:
                counts = _node_counts(placed)
            splits = counts.select(
                "tree", "node", F.lit(None).cast("int").alias("feature"),
                *[F.lit(None).cast(kind).alias(name) for name, kind in (
                    ("threshold", "double"), ("n_left", "long"), ("case_left", "long"),
                    ("parts", "boolean"))])
        nodes = landed(counts.join(splits.select(
            "tree", "node", "feature", "threshold", "n_left", "case_left", "parts"),
            ["tree", "node"], "left"), "tree-level")
        levels.append(nodes)
        if level == depth:
            break
        open_ = nodes.filter("feature is not null")
        alike = open_.filter("not parts").isEmpty()
        if level + 1 < depth or not alike:
            goes_left = F.get("x", F.col("feature")) <= F.col("threshold")
            placed = landed(placed.join(open_.select("tree", "node", "feature", "threshold"),
                                        ["tree", "node"]).withColumn(
                "node", F.when(goes_left, F.col("node") * 2).otherwise(F.col("node") * 2 + 1))
                .drop("feature", "threshold"), "tree-rows")
        counts = _child_counts(open_) if alike else _node_counts(placed)
    table = levels[0]
    for nodes in levels[1:]:
        table = table.unionAll(nodes)
    split = F.col("feature").isNotNull()
    return table.select(
        "tree", "node", "feature", "threshold", F.when(split, F.col("node") * 2).alias("left_child"),
        F.when(split, F.col("node") * 2 + 1).alias("right_child"),
        (F.col("n") - F.col("n_case")).alias("n_control"), "n_case",
        F.when(F.col("n_case") * 2 > F.col("n"), 1.0).otherwise(0.0).alias("prediction"))


def _node_counts(placed: DataFrame) -> DataFrame:
    """``tree, node, n, n_case`` of placed rows."""
    return placed.groupBy("tree", "node").agg(
        F.sum("weight").alias("n"),
        F.sum(F.when(F.col("label") == 1, F.col("weight")).otherwise(0)).alias("n_case"))


def _child_counts(open_: DataFrame) -> DataFrame:
    """The same of the children of split nodes; rows without the feature go right."""
    left = F.struct((F.col("node") * 2).alias("node"), F.col("n_left").alias("n"),
                    F.col("case_left").alias("n_case"))
    right = F.struct((F.col("node") * 2 + 1).alias("node"),
                     (F.col("n") - F.col("n_left")).alias("n"),
                     (F.col("n_case") - F.col("case_left")).alias("n_case"))
    return open_.select("tree", F.inline(F.array(left, right)))


# ---- forests ------------------------------------------------------------------

def poisson_edges(digits: int = DRAW_DIGITS, most: int = 12) -> list[int]:
    """Draws below edge k (of ``16 ** digits``) give at most k: the Poisson(1) distribution."""
    total, term, out = 0.0, math.exp(-1), []
    for k in range(most):
        total += term
        out.append(math.floor(total * 16 ** digits))
        term /= k + 1
    return out


def bags(rows: DataFrame, n_trees: int, seed: int = BAG_SEED,
         trees: Column | None = None) -> DataFrame:
    """M6: each tree's bootstrap sample: ``rows`` with ``tree`` and the times it was drawn.

    A sample's weight in a tree is a Poisson(1) draw from the hash of seed, tree and
    sample id; samples drawn no time are left out. ``trees``: the trees that may draw
    a row, as an array (default: all).
    """
    if trees is None:
        trees = F.sequence(F.lit(0), F.lit(n_trees - 1))
    # hex digits of one length compare as their numbers. The hash is made by a generator, so
    # once: a filter on a column of the row would be moved below it, with a hash for each edge
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), "tree", "sample_id"))
    drawn = rows.withColumn("tree", F.explode(trees)).withColumn(
        "draw", F.explode(F.array(digest)))
    edges = poisson_edges()
    weight = F.lit(len(edges))
    for k in range(len(edges) - 1, -1, -1):
        weight = F.when(F.col("draw") < f"{edges[k]:0{DRAW_DIGITS}x}", F.lit(k)).otherwise(weight)
    return drawn.withColumn("weight", weight.cast("long")).filter("weight > 0").drop("draw")


def feature_subset(spark: SparkSession, n_features: int, n_trees: int, size: int | None = None,
                   seed: int = BAG_SEED) -> DataFrame:
    """``tree, feature``: the ``size`` features (default: √n) of smallest hash in each tree."""
    size = size or max(1, round(math.sqrt(n_features)))
    pairs = spark.range(n_trees).select(F.col("id").cast("int").alias("tree"), F.explode(
        F.sequence(F.lit(0), F.lit(n_features - 1))).alias("feature"))
    order = Window.partitionBy("tree").orderBy(
        hash_number(F.concat_ws(":", "tree", "feature"), seed, DRAW_DIGITS), "feature")
    return pairs.withColumn("at", F.row_number().over(order)).filter(
        F.col("at") <= size).drop("at")


def traverse(rows: DataFrame, nodes: DataFrame, depth: int) -> DataFrame:
    """M7: ``sample_id, label, tree, prediction``: each tree's leaf for each row's ``x``.

    A tree's nodes (at most 2^(depth + 1) − 1) are one row; rows meet the trees by
    number in one join and walk down inside an expression.
    """
    trees = nodes.groupBy("tree").agg(F.map_from_entries(F.collect_list(F.struct(
        "node", F.struct("feature", "threshold", "left_child", "right_child", "prediction"))))
        .alias("nodes"), F.min("node").alias("root"))
    joined = rows.drop("tree").withColumn("tree", F.explode(F.sequence(
        F.lit(0), F.lit(_n_trees(nodes) - 1)))).join(trees, "tree")

    def down(at: Column, _: Column) -> Column:
        node = F.element_at("nodes", at)
        return (F.when(node.feature.isNull(), at)
                .when(F.get("x", node.feature) <= node.threshold, node.left_child)
                .otherwise(node.right_child))

    leaf = F.aggregate(F.sequence(F.lit(1), F.lit(max(1, depth))), F.col("root"), down)
    return joined.select("sample_id", "label", "tree",
                         F.element_at("nodes", leaf).prediction.alias("prediction"))


def _n_trees(nodes: DataFrame) -> int:
    most = nodes.agg(F.max("tree")).first()[0]
    return 1 if most is None else most + 1


def vote(predictions: DataFrame) -> DataFrame:
    """``sample_id, label, votes, prediction``: 1 where more than half of the trees say so."""
    return predictions.groupBy("sample_id", "label").agg(
        F.sum("prediction").cast("long").alias("votes"),
        F.when(F.sum("prediction") * 2 > F.count(F.lit(1)), 1.0).otherwise(0.0)
        .alias("prediction"))


def forest_votes(rows: DataFrame, nodes: DataFrame, depth: int,
                 trees: Column | None = None) -> DataFrame:
    """``rows`` with the ``votes`` for 1 and the majority's ``prediction``.

    As :func:`traverse` and :func:`vote`, but all trees (the node table, as one row) meet
    each row and are walked and counted in it, so no row is repeated or moved. ``trees``:
    those that vote on a row, as an array (default: all). Rows without a voting tree drop out.
    """
    each = nodes.groupBy("tree").agg(
        F.map_from_entries(F.collect_list(F.struct("node", F.struct(
            "feature", "threshold", "left_child", "right_child", "prediction")))).alias("nodes"),
        F.min("node").alias("root"), F.max("node").alias("last"))
    # arrays by number, where a lookup takes no search
    grown = F.struct("root", F.transform(F.sequence(F.lit(0), "last"),
                                         lambda i: F.element_at("nodes", i)).alias("nodes"))
    forest = each.agg(F.map_from_entries(F.collect_list(F.struct("tree", grown))).alias("by_tree"),
                      F.max("tree").alias("most")).select(F.transform(
                          F.sequence(F.lit(0), "most"),
                          lambda t: F.element_at("by_tree", t)).alias("_forest"))

    def says(grown: Column) -> Column:
        def down(at: Column, _: Column) -> Column:
            node = F.get(grown.nodes, at)
            return (F.when(node.feature.isNull(), at)
                    .when(F.get("x", node.feature) <= node.threshold, node.left_child)
                    .otherwise(node.right_child))

        at = grown.root
        if depth <= 1:
            at = down(at, at)
        else:
            at = F.aggregate(F.sequence(F.lit(1), F.lit(depth)), at, down)
        return F.get(grown.nodes, at).prediction

    walked = F.col("_forest") if trees is None else F.transform(
        trees, lambda t: F.get("_forest", t))
    said = F.filter(F.transform(walked, says), lambda p: p.isNotNull())
    # one element, so that the walk is done once for the columns made of it
    voted = rows.crossJoin(F.broadcast(forest)).withColumn("_said", F.explode(F.array(said)))
    votes = F.aggregate("_said", F.lit(0.0), lambda a, p: a + p)
    return voted.filter(F.size("_said") > 0).withColumn("votes", votes.cast("long")).withColumn(
        "prediction", F.when(votes * 2 > F.size("_said"), 1.0).otherwise(0.0)).drop(
        "_said", "_forest")


# ---- fitted models ------------------------------------------------------------

def model_nodes(model: Model) -> DataFrame:
    """M9: the node table of a fitted Spark ML tree or forest, from its saved form.

    Spark numbers nodes from 0 in each tree. Class counts are those of training (a forest's
    are weighted by its bootstrap).
    """
    spark = SparkSession.getActiveSession()
    path = f"{run_folder(spark, 'nodes')}/model"
    model.write().overwrite().save(path)
    data = spark.read.parquet(f"{path}/data")
    if "nodeData" in data.columns:
        data = data.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        data = data.withColumn("tree", F.lit(0))
    split = F.col("leftChild") >= 0
    return data.select(
        "tree", F.col("id").alias("node"),
        F.when(split, F.col("split.featureIndex")).alias("feature"),
        F.when(split, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.when(split, F.col("leftChild")).alias("left_child"),
        F.when(split, F.col("rightChild")).alias("right_child"),
        F.get("impurityStats", F.lit(0)).cast("long").alias("n_control"),
        F.coalesce(F.get("impurityStats", F.lit(1)), F.lit(0.0)).cast("long").alias("n_case"),
        "prediction")


def rules(nodes: DataFrame) -> DataFrame:
    """M9: a tree as text, ``tree, node, rule``: one line per node in terms of its parent's split."""
    parents = nodes.filter("feature is not null").select(
        "tree", F.explode(F.array(
            F.struct(F.col("left_child").alias("node"), F.lit("<=").alias("sign"),
                     F.col("feature").alias("on"), F.col("threshold").alias("at")),
            F.struct(F.col("right_child").alias("node"), F.lit(">").alias("sign"),
                     F.col("feature").alias("on"), F.col("threshold").alias("at")))).alias("p"))
    above = parents.select("tree", "p.*")
    condition = F.when(F.col("sign").isNull(), F.lit("all")).otherwise(F.concat(
        F.lit("feature "), F.col("on").cast("string"), F.lit(" "), F.col("sign"), F.lit(" "),
        F.format_number("at", 6)))
    predicts = F.when(F.col("feature").isNull(), F.concat(
        F.lit(" predict "), F.col("prediction").cast("int").cast("string"))).otherwise(F.lit(""))
    counts = F.concat(F.lit(" ("), F.col("n_control").cast("string"), F.lit(" control, "),
                      F.col("n_case").cast("string"), F.lit(" case)"))
    return nodes.join(above, ["tree", "node"], "left").select(
        "tree", "node", F.concat(condition, counts, predicts).alias("rule"))
