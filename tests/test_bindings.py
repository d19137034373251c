"""Bindings onto the parquet tables: renderings keep their promised shape."""

import os

import pytest
from pyspark.sql import functions as F

from cohortlens.sources import tables, text

SMOKE = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMOKE), reason="test tables not present")


def test_annotation_members_are_bounded_sorted_vector_indexes(spark):
    rows = tables.annotation_lines(spark, SMOKE).collect()
    n_parts = tables.table(spark, SMOKE, "part").count()
    dims = len(tables.table(spark, SMOKE, "embeddings").first()["embedding"])
    total = 0
    for r in rows:
        cells = r["value"].split(",")
        assert len(cells) == 5 and cells[2] in tables.SPECIES
        members = cells[4].split(";")
        assert members == sorted(members) and len(set(members)) == len(members)
        assert all(0 <= int(m) < dims for m in members)
        total += int(cells[3])
    assert total == n_parts  # every part is in exactly one line


def test_wide_lines_header_and_rows(spark):
    lines = [r["value"] for r in tables.wide_lines(spark, SMOKE).collect()]
    header = [v for v in lines if v.startswith("PATIENT_ID,")]
    assert len(header) == 1
    dims = len(tables.table(spark, SMOKE, "embeddings").first()["embedding"])
    assert header[0].split(",")[2:] == [str(i) for i in range(dims)]
    n = tables.table(spark, SMOKE, "embeddings").count()
    assert len(lines) == n + 1
    assert all(len(v.split(",")) == dims + 2 for v in lines)


def test_background_lines_have_one_malformed_line_per_segment(spark):
    parsed = text.background(spark, tables.background_lines(spark, SMOKE))
    bad = parsed.filter(F.col("_corrupt_record").isNotNull()).count()
    segments = tables.table(spark, SMOKE, "customer").select("c_mktsegment").distinct().count()
    assert bad == segments
    assert parsed.count() == tables.table(spark, SMOKE, "orders").count() + segments


def test_fixed_width_lines_put_the_code_after_the_id(spark):
    rows = tables.fixed_width_lines(spark, SMOKE).filter(
        ~F.col("value").startswith("PATIENT_ID")).limit(50).collect()
    for r in rows:
        v = r["value"]
        assert v[tables.ID_WIDTH] == "," and v[tables.ID_WIDTH + 1] in "12345"


def test_long_membership_puts_each_part_in_two_clusters(spark):
    m = tables.long_membership(spark, SMOKE)
    per_part = m.groupBy("feature_id").count().select(F.min("count"), F.max("count")).first()
    assert tuple(per_part) == (2, 2)


def test_too_long_id_fails_in_fixed_width_lines(spark, tmp_path):
    spark.createDataFrame([(10 ** 12, "1-URGENT", "O")],
                          "o_orderkey long, o_orderpriority string, o_orderstatus string"
                          ).write.parquet(f"{tmp_path}/orders.parquet")
    with pytest.raises(Exception, match="id too long"):
        tables.fixed_width_lines(spark, str(tmp_path)).collect()


def test_background_of_some_codes_is_a_part_of_all(spark):
    everyone = tables.long_background(spark, SMOKE)
    some = tables.long_background(spark, SMOKE, ("1", "4", "5"))
    assert 0 < some.count() < everyone.count() and some.subtract(everyone).isEmpty()
