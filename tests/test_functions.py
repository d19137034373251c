"""Column expressions against plain-Python definitions."""

import hashlib

import pytest
from pyspark.sql import functions as F

from cohortlens.functions import (
    characters,
    cohort_label,
    fixed_width_key,
    hash_bucket,
    micro_units,
    to_double,
    welch_t,
)


def test_hash_bucket_is_md5_prefix_mod(spark):
    ids = list(range(0, 300, 7))
    got = {r["id"]: r["b"] for r in spark.createDataFrame([(i,) for i in ids], "id long")
           .select("id", hash_bucket("id", 200).alias("b")).collect()}
    for i in ids:
        assert got[i] == int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16) % 200


def test_micro_units_round_half_away_from_zero(spark):
    vals = [0.0000005, -0.0000005, 1.25, -1.2345675, 0.1]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in vals], "x double")
           .select(micro_units("x")).collect()]
    assert got == [1, -1, 1250000, -1234568, 100000]


def test_fixed_width_key_is_a_zero_based_slice(spark):
    line = "X332_120501,4,x"
    got = spark.createDataFrame([(line,), ("short",)], "value string").select(
        fixed_width_key("value", 12).alias("k")).collect()
    assert [r["k"] for r in got] == [line[12:13], ""]


def test_cohort_label_and_to_double(spark):
    df = spark.createDataFrame([("1", "3.5"), ("4", "x"), ("5", ""), ("NA", "2")],
                               "code string, v string")
    got = df.select(cohort_label("code").alias("g"), to_double("v").alias("d")).collect()
    assert [r["g"] for r in got] == ["control", "case", "case", None]
    assert [r["d"] for r in got] == [3.5, None, None, 2.0]


def test_welch_t_null_on_zero_denominator(spark):
    df = spark.createDataFrame([(10.0, 3.0, 2, 4.0, 1.0, 2), (5.0, 0.0, 3, 5.0, 0.0, 3)],
                               "ma double, sa double, na long, mb double, sb double, nb long")
    got = [r[0] for r in df.select(welch_t(F.col("ma"), F.col("sa"), F.col("na"),
                                           F.col("mb"), F.col("sb"), F.col("nb"))).collect()]
    assert got[0] == pytest.approx(6 / 5 ** 0.5) and got[1] is None


def test_characters(spark):
    got = spark.createDataFrame([("aé",), ("",)], "w string").select(
        characters("w").alias("c")).collect()
    assert [r["c"] for r in got] == [["a", "é"], []]


def test_to_double_takes_decimal_numbers_only(spark):
    cells = ["1.5", " 2 ", "-3e2", ".5", "5d", "2f", "0x1p3", "nan", "Infinity", "-inf", "", "NA",
             None]
    got = [r[0] for r in spark.createDataFrame([(c,) for c in cells], "x string").coalesce(1)
           .select(to_double("x")).collect()]
    assert got == [1.5, 2.0, -300.0, 0.5] + [None] * 9
