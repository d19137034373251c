"""Bindings of the cohort data model onto the parquet tables.

Four bindings (names as in the blueprint):

* **L** long & sparse, grows with scale factor: sample = order, diagnosis
  code = first character of the order priority, feature = part key,
  value = quantity, cluster = part brand ∪ part type (many-to-many).
* **B** background per sample: order ⋈ customer.
* **W** wide & dense: the ``embeddings`` table rendered as the delimited
  wide matrix (header row inside the data, values in integer micro-units)
  and ``part`` rendered as the annotation file.
* **E** evaluation pairs: ``labels`` (label = quality, prediction = 1 − toxic).
* **T** text: ``documents.text`` and orders rendered as fixed-width lines.

Renderings are plain DataFrame expressions over whole tables, so each
registered query does work proportional to its inputs.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions import micro_units
from cohortlens.operators.stats import merge_join

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Fixed values of the W annotation rendering: species chosen by p_size mod 5.
SPECIES = ("Human", "Mouse", "Rat", "Zebrafish", "Yeast")
# Fixed value: width of the rendered sample id in fixed-width lines.
ID_WIDTH = 12


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A parquet table; its files are listed anew by every query."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Bytes and rows of line items whose scores one task sums.
SUM_BYTES = 8 << 20
SUM_ROWS = 250_000


# Bytes and rows of a table up to which the tasks of joins with it are left to
# the session.
JOIN_BYTES = 4 << 20
JOIN_ROWS = 200_000


def table_bytes(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Bytes of a table's files."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getContentSummary(where).getLength()


def table_rows(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Rows of a table, from the footers of its files: sorts and sums take memory by rows,
    and how many of these a byte of a file holds depends on its order and compression."""
    return table(spark, sf_dir, name).count()


def sum_partitions(spark: SparkSession, sf_dir: str, name: str = "lineitem") -> int | None:
    """Tasks for the sums over a table's rows, by its size; None if one is enough."""
    parts = max(-(-table_bytes(spark, sf_dir, name) // SUM_BYTES),
                -(-table_rows(spark, sf_dir, name) // SUM_ROWS))
    return parts if parts > 1 else None


def is_large(spark: SparkSession, sf_dir: str, name: str) -> bool:
    """Whether the tasks of joins with the table go by the tables' size."""
    return (table_bytes(spark, sf_dir, name) > JOIN_BYTES
            or table_rows(spark, sf_dir, name) > JOIN_ROWS)


def join_partitions(spark: SparkSession, sf_dir: str, name: str, large: str) -> int | None:
    """Tasks for the join of ``large`` with the table ``name``; None if that one is small.

    They go by the larger of the two: a task keeps its share of ``name`` in memory.
    """
    if not is_large(spark, sf_dir, name):
        return None
    return max(sum_partitions(spark, sf_dir, t) or 1 for t in (large, name))


def long_partitions(spark: SparkSession, sf_dir: str) -> dict[str, int | None]:
    """Tasks of a long analysis, by the tables' sizes (arguments of ``from_long``)."""
    return {"partitions": sum_partitions(spark, sf_dir),
            "sample_partitions": join_partitions(spark, sf_dir, "orders", "lineitem"),
            "map_partitions": join_partitions(spark, sf_dir, "part", "lineitem")}


# ---- L: long binding --------------------------------------------------------

def long_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matrix rows: ``(sample_id, code)``, one per order."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("sample_id"),
        F.substring("o_orderpriority", 1, 1).alias("code"),
    )


def long_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observed cells: ``(sample_id, feature_id, value)``, one per line item."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("sample_id"),
        F.col("l_partkey").alias("feature_id"),
        F.col("l_quantity").cast("double").alias("value"),
    )


def long_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature → cluster bag: every part is in its brand and its type."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("feature_id"),
        F.explode(F.array("p_brand", "p_type")).alias("cluster"),
    )


# ---- B: background ----------------------------------------------------------

def long_background(spark: SparkSession, sf_dir: str,
                    codes: Iterable[str] | None = None) -> DataFrame:
    """Typed background ``(sample_id, age, sex, education)`` per order.

    ``codes`` keeps only orders of these diagnosis codes, before the join.
    """
    orders = table(spark, sf_dir, "orders")
    if codes is not None:
        orders = orders.filter(F.substring("o_orderpriority", 1, 1).isin(list(codes)))
    customer = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    joined = merge_join(orders, customer, ["o_custkey"],
                        join_partitions(spark, sf_dir, "customer", "orders"))
    return joined.select(
        F.col("o_orderkey").alias("sample_id"),
        F.floor("c_acctbal").cast("int").alias("age"),
        F.col("o_orderstatus").alias("sex"),
        F.col("c_mktsegment").alias("education"),
    )


def background_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B rendered as the background text file, with malformed lines.

    Data lines ``id,age,sex,education``; per market segment one summary
    line without commas (``SEGMENT customers:N``) plays the part of the
    free-text lines at the top of the original file.
    """
    typed = long_background(spark, sf_dir)
    good = typed.select(F.concat_ws(",", F.col("sample_id").cast("string"),
                                    F.col("age").cast("string"), "sex", "education")
                        .alias("value"))
    notes = (table(spark, sf_dir, "customer").groupBy("c_mktsegment")
             .agg(F.count(F.lit(1)).alias("n"))
             .select(F.concat(F.col("c_mktsegment"), F.lit(" customers:"),
                              F.col("n").cast("string")).alias("value")))
    return notes.unionByName(good)


# ---- W: wide binding --------------------------------------------------------

def wide_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as the wide matrix text: header + one line per vector.

    Header ``PATIENT_ID,DIAGNOSIS,0,1,…`` (feature id = vector index) is
    derived from the vector length present in the data.
    """
    emb = table(spark, sf_dir, "embeddings")
    header = (emb.select(F.size("embedding").alias("dims")).distinct()
              .select(F.concat(
                  F.lit("PATIENT_ID,DIAGNOSIS,"),
                  F.array_join(F.transform(F.sequence(F.lit(0), F.col("dims") - 1),
                                           lambda i: i.cast("string")), ","),
              ).alias("value")))
    rows = emb.select(F.concat_ws(
        ",",
        F.col("vec_id").cast("string"),
        F.col("label").cast("string"),
        F.array_join(F.transform("embedding", lambda x: micro_units(x).cast("string")), ","),
    ).alias("value"))
    return header.unionByName(rows)


def annotation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` rendered as the annotation file for the wide matrix.

    One line per (brand, type, species): ``brand,type,species,count,m1;m2;…``
    where members are the vector indexes ``p_partkey mod dims`` of its parts,
    dims being the length of the vectors (a bounded set: at most ``dims``
    distinct ids per line).
    """
    species = F.element_at(F.array(*[F.lit(s) for s in SPECIES]),
                           (F.pmod("p_size", F.lit(len(SPECIES))) + 1).cast("int"))
    dims = table(spark, sf_dir, "embeddings").agg(F.max(F.size("embedding")).alias("dims"))
    return (table(spark, sf_dir, "part")
            .select("p_brand", "p_type", species.alias("species"),
                    F.pmod("p_partkey", dims.scalar()).cast("string").alias("member"))
            .groupBy("p_brand", "p_type", "species")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.array_sort(F.collect_set("member")).alias("members"))
            .select(F.concat_ws(",", "p_brand", "p_type", "species", F.col("n").cast("string"),
                                F.array_join("members", ";")).alias("value")))


# ---- E: evaluation pairs ----------------------------------------------------

def evaluation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, label, prediction)`` as doubles, like classifier output."""
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id"),
        F.col("quality").cast("double").alias("label"),
        (F.lit(1) - F.col("toxic")).cast("double").alias("prediction"),
    )


# ---- T: text ----------------------------------------------------------------

def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document texts as the ``value`` column of a text source."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.col("text").alias("value"))


def fixed_width_lines(spark: SparkSession, sf_dir: str, width: int = ID_WIDTH) -> DataFrame:
    """Orders as matrix lines with fixed-width ids: ``000000000042,4,O``.

    The diagnosis code sits at character ``width + 1`` (0-based); the
    header line puts a letter there. An id longer than ``width`` fails.
    """
    order = F.col("o_orderkey").cast("string")
    padded = F.when(F.length(order) <= width, F.lpad(order, width, "0")).otherwise(
        F.raise_error(F.concat(F.lit("id too long for fixed-width lines: "), order)))
    header = spark.createDataFrame([("PATIENT_ID,DIAGNOSIS,STATUS",)], "value string")
    rows = table(spark, sf_dir, "orders").select(F.concat_ws(
        ",",
        padded,
        F.substring("o_orderpriority", 1, 1),
        F.col("o_orderstatus"),
    ).alias("value"))
    return header.unionByName(rows)
