"""Delimited-text sources (S1, S2, S4, S5, S6) as typed DataFrames.

Every reader accepts either a path (any Hadoop scheme: ``hdfs://``,
``s3a://``, local) or a DataFrame with a single string column ``value`` —
the shape ``spark.read.text`` produces — so derived text can be parsed
without a round trip through storage.

Parsing follows the source format: plain ``split`` on the delimiter with no
quoting, whitespace kept, trailing empty cells kept (limit −1).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions import cell

# Fixed values of the input formats: the cell that marks the matrix header
# row, and the species the annotation filter keeps.
HEADER_MARKER = "PATIENT_ID"
SPECIES_KEPT = "Human"
CORRUPT = "_corrupt_record"


def read_lines(spark: SparkSession, source: str | DataFrame) -> DataFrame:
    """One row per text line in column ``value``."""
    if isinstance(source, DataFrame):
        return source.select(F.col("value").cast("string").alias("value"))
    return spark.read.text(source)


def write_lines(lines: DataFrame, path: str) -> str:
    """Text sink: write the ``value`` column as text files; fails if ``path`` exists."""
    lines.select("value").write.text(path)
    return path


def split_cells(value: Column | str, delimiter: str = ",") -> Column:
    """Line → array of cells; keeps trailing empty cells."""
    col = F.col(value) if isinstance(value, str) else value
    return F.split(col, _literal_pattern(delimiter), -1)


def _literal_pattern(delimiter: str) -> str:
    special = set("\\^$.|?*+()[]{}")
    return "".join("\\" + ch if ch in special else ch for ch in delimiter)


def wide_rows(spark: SparkSession, source: str | DataFrame) -> DataFrame:
    """The wide matrix as ``cells array<string>``; header row included.

    One array column instead of thousands of top-level columns keeps the
    plan and the analyzer cheap however wide the matrix is.
    """
    return read_lines(spark, source).select(split_cells("value").alias("cells"))


def annotation(spark: SparkSession, source: str | DataFrame,
               species: str | None = SPECIES_KEPT) -> DataFrame:
    """S4 + P1: ``(cluster, species, members)`` keeping one species.

    Positional layout: cell 0 cluster id, cell 2 species, cell 4 the
    ``;``-separated member feature ids (cells 1 and 3 are unused).
    Short lines yield NULLs and drop out at the species filter.
    """
    cells = split_cells("value")
    parsed = read_lines(spark, source).select(
        cell(cells, 0).alias("cluster"),
        cell(cells, 2).alias("species"),
        cell(cells, 4).alias("members"),
    )
    if species is not None:
        parsed = parsed.filter(F.col("species") == F.lit(species))
    return parsed


BACKGROUND_COLUMNS = ("sample_id", "age", "sex", "education")


def _checked_background(line: Column, cells: list[Column], complete: Column) -> list[Column]:
    """The typed fields of complete lines with an integer age; else the raw line, set aside."""
    age = F.trim(cells[1]).try_cast("int")
    ok = F.coalesce(complete & age.isNotNull(), F.lit(False))
    typed = (cells[0], age, cells[2], cells[3])
    return [*(F.when(ok, c).alias(name)
              for c, name in zip(typed, BACKGROUND_COLUMNS, strict=True)),
            F.when(~ok, line).alias(CORRUPT)]


def background(spark: SparkSession, source: str | DataFrame) -> DataFrame:
    """``(sample_id, age, sex, education, _corrupt_record)``.

    A line is well-formed when it has exactly four cells and an integer
    age. Malformed and blank lines are not dropped: their fields are NULL and
    the raw text is kept in ``_corrupt_record`` (PERMISSIVE-mode semantics), so
    the caller can quarantine and count them (:func:`background_quality`).
    """
    cells = split_cells("value")
    return read_lines(spark, source).select(*_checked_background(
        F.col("value"), [cell(cells, i) for i in range(4)], F.size(cells) == 4))


def background_csv(spark: SparkSession, source: str | DataFrame) -> DataFrame:
    """S6 through Spark's CSV parser: the same rows as :func:`background`.

    The parser runs per line (a CSV file scan would drop blank lines), without
    quoting; it gives empty cells as NULL, which are made empty again.
    """
    parsed = F.from_csv("value", ", ".join(f"{c} string" for c in BACKGROUND_COLUMNS)
                        + f", {CORRUPT} string",
                        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT,
                         "quote": "", "escape": "", "comment": "", "maxCharsPerColumn": "-1"})
    rows = read_lines(spark, source).select("value", parsed.alias("p"))
    return rows.select(*_checked_background(
        F.col("value"), [F.coalesce(F.col(f"p.{c}"), F.lit("")) for c in BACKGROUND_COLUMNS],
        F.col(f"p.{CORRUPT}").isNull()))


def background_quality(parsed: DataFrame) -> DataFrame:
    """``n_lines, n_used, n_set_aside`` of a parsed background."""
    return parsed.agg(F.count(F.lit(1)).alias("n_lines"),
                      F.count(F.when(F.col(CORRUPT).isNull(), 1)).alias("n_used"),
                      F.count(CORRUPT).alias("n_set_aside"))
