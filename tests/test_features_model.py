"""Feature assembly, folds, classifiers and the confusion matrix."""

import pytest
from pyspark.sql import functions as F

from cohortlens import from_wide
from cohortlens.operators import features as feat
from cohortlens.operators import model as ml
from tests.conftest import ANNOTATION, MATRIX


def test_features_in_rank_order_with_background(spark, lines):
    a = from_wide(spark, lines(MATRIX), lines(ANNOTATION), k=2)
    bg = spark.createDataFrame([("P1", 70, "F", "BS"), ("P3", 80, "M", "MS")],
                               "sample_id string, age int, sex string, education string")
    rows = {r["sample_id"]: r for r in a.sample_features(bg).collect()}
    assert set(rows) == {"P1", "P2", "P3", "P4"}
    # rank 1 is c1 (10+20), rank 2 is c2 (30)
    assert (rows["P1"]["f01"], rows["P1"]["f02"]) == (3.0, 3.0)
    assert (rows["P4"]["f01"], rows["P4"]["f02"]) == (13.0, 2.0)
    assert rows["P1"]["label"] == 0.0 and rows["P4"]["label"] == 1.0
    assert rows["P1"]["age"] == 70 and rows["P2"]["age"] is None


def test_feature_set_names():
    assert feat.feature_columns("genes", 3) == ["f01", "f02", "f03"]
    assert feat.feature_columns("life_stats", 2) == ["age", "f01", "f02"]
    with pytest.raises(ValueError):
        feat.feature_columns("other")


def test_confusion_micro_fixture(spark):
    pairs = spark.createDataFrame([(0.0, 0.0), (0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 0.0)],
                                  "label double, prediction double")
    r = ml.confusion(pairs).first()
    assert (r["tn"], r["fp"], r["tp"], r["fn"]) == (2, 1, 1, 1)
    assert (r["tn_frac"], r["fp_frac"], r["tp_frac"], r["fn_frac"]) == (0.4, 0.2, 0.2, 0.2)
    assert r["error"] == pytest.approx(0.4)


def test_confusion_empty_input_gives_null_error(spark):
    pairs = spark.createDataFrame([], "label double, prediction double")
    assert ml.confusion(pairs).first()["error"] is None


def test_folds_are_deterministic_and_balanced(spark):
    ids = spark.range(0, 3000).withColumnRenamed("id", "sample_id")
    a = ml.with_folds(ids).repartition(7)
    b = ml.with_folds(ids.repartition(2))
    join = a.join(b.withColumnRenamed("fold", "fold_b"), "sample_id")
    assert join.filter(F.col("fold") != F.col("fold_b")).count() == 0
    counts = {r["fold"]: r["count"] for r in a.groupBy("fold").count().collect()}
    assert set(counts) == {0, 1, 2}
    assert all(800 < c < 1200 for c in counts.values())


def _separable(spark):
    rows = [(f"s{i}", float(i % 2), float(i % 2) * 5.0 + (i % 7) * 0.1, float(i % 3))
            for i in range(300)]
    df = spark.createDataFrame(rows, "sample_id string, label double, f01 double, f02 double")
    df = df.withColumn("grp", F.when(F.col("label") == 1.0, "case").otherwise("control"))
    return ml.labeled_points(df, "genes", k=2)


def test_cross_validation_learns_separable_data(spark):
    per_fold, results = ml.cross_validate(_separable(spark), num_trees=5)
    rows = per_fold.collect()
    assert len(rows) == 9 and len(results) == 9
    # single trees see every feature: exact; forests sample features per node
    assert all(r["error"] == 0.0 for r in rows if r["model"].startswith("tree"))
    assert all(r["error"] <= 0.05 for r in rows if r["model"].startswith("forest"))
    means = {r["model"]: r["mean_error"] for r in ml.mean_error(per_fold).collect()}
    assert set(means) == set(ml.MODELS)
    assert "If (feature" in ml.describe(results[0].fitted)


def test_model_save_and_reload(spark, tmp_path):
    points = _separable(spark)
    train, test = ml.training_split(points, 0)
    fitted = ml.estimator("forest_entropy", 3).fit(train)
    ml.save(fitted, str(tmp_path / "m"))
    again = ml.load(str(tmp_path / "m"))
    a = [r["prediction"] for r in fitted.transform(test).orderBy("sample_id").collect()]
    b = [r["prediction"] for r in again.transform(test).orderBy("sample_id").collect()]
    assert a == b


def test_random_folds_have_the_split_weights(spark):
    ids = spark.range(0, 6000).withColumnRenamed("id", "sample_id")
    counts = {r["fold"]: r["count"] for r in ml.with_folds(ids, method="random")
              .groupBy("fold").count().collect()}
    assert set(counts) == {0, 1, 2} and sum(counts.values()) == 6000
    assert all(1700 < c < 2300 for c in counts.values())
    with pytest.raises(ValueError):
        ml.with_folds(ids, method="other")


def test_holdout_split_is_about_70_30_and_disjoint(spark):
    ids = spark.range(0, 4000).withColumnRenamed("id", "sample_id")
    train, test = ml.holdout_split(ids)
    n_train, n_test = train.count(), test.count()
    assert n_train + n_test == 4000 and 0.65 < n_train / 4000 < 0.75
    assert train.join(test, "sample_id").count() == 0


def test_unknown_model_rejected():
    with pytest.raises(ValueError):
        ml.estimator("svm")


def test_life_stats_drops_samples_without_age(spark, lines):
    a = from_wide(spark, lines(MATRIX), lines(ANNOTATION), k=2)
    bg = spark.createDataFrame([("P1", 70, "F", "BS"), ("P3", 80, "M", "MS")],
                               "sample_id string, age int, sex string, education string")
    feats = a.sample_features(bg)
    genes = ml.labeled_points(feats, "genes", k=2)
    life = ml.labeled_points(feats, "life_stats", k=2)
    assert genes.count() == 4 and life.count() == 2
    row = life.filter(F.col("sample_id") == "P1").first()
    assert list(row["features"].toArray()) == [70.0, 3.0, 3.0]
