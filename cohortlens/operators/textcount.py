"""Thresholded token and character counts, fixed-width line groups.

R4 ``tokens``              split lines into tokens
A8 + P6 ``token_counts``   exact, case-sensitive counts kept when ≥ threshold
R5 + A9 ``char_counts``    characters of each *distinct* surviving token
P9 + A10 ``key_groups``    group lines by a fixed-width key, drop non-integer keys
A10 ``group_rows``         the lines of each group, as sorted runs with their places
A10 ``group_boundaries``   where each group begins and ends in them
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions import CASE, CONTROL, characters, fixed_width_key
from cohortlens.operators.ordered import in_chunks, running_sums

LINE = "\n"
# Fixed value: whitespace characters that separate words.
WHITESPACE = "[ \\t\\n\\r\\f]+"


def tokens(lines: DataFrame, pattern: str = LINE, drop_empty: bool = False) -> DataFrame:
    """One row per token of each line (``token`` column).

    The default splits on newlines only, so each line is one token and an
    empty line is the empty token. With ``WHITESPACE`` and
    ``drop_empty=True`` tokens are words.
    """
    out = lines.select(F.explode(F.split(F.col("value"), pattern, -1)).alias("token"))
    return out.filter(F.length("token") > 0) if drop_empty else out


def token_counts(toks: DataFrame, threshold: int) -> DataFrame:
    """A8 + P6: ``(token, n)`` for tokens seen at least ``threshold`` times."""
    return (toks.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") >= F.lit(threshold)))


def char_counts(counted: DataFrame) -> DataFrame:
    """R5 + A9: ``(ch, n)`` over the characters of each surviving token.

    Each distinct token contributes its characters once, whatever its count.
    """
    return (counted.select(F.explode(characters("token")).alias("ch"))
            .groupBy("ch").agg(F.count(F.lit(1)).alias("n")))


def key_groups(lines: DataFrame, start: int, width: int = 1) -> DataFrame:
    """P9 + A10 + P5 + P4: lines grouped by a fixed-width key.

    Returns ``(key, n_lines, grp)``: keys that do not parse as integers
    (header letters, ``N`` of ``NA``) are dropped; key 1 is the control
    cohort, 3 < key < 6 the case cohort, other integers have NULL ``grp``.
    The group is aggregated (line count), never materialised as a list.
    """
    key = fixed_width_key("value", start, width)
    k = F.col("key").try_cast("int")
    return (lines.select(key.alias("key"))
            .groupBy("key").agg(F.count(F.lit(1)).alias("n_lines"))
            .filter(k.isNotNull())
            .withColumn("grp", F.when(k == 1, F.lit(CONTROL))
                        .when((k > 3) & (k < 6), F.lit(CASE))))


def group_rows(lines: DataFrame, start: int, width: int = 1) -> DataFrame:
    """A10: the lines of each group: ``chunk, key, line, copies, first_row, last_row``.

    Keys as in :func:`key_groups`. Lines are in order within their key, equal lines as one
    row with their number; ``first_row`` and ``last_row`` are their places in the group,
    from 1. The rows are written in range partitions of (key, line), so a key that holds a
    large part of all lines spans many tasks and no group is in memory.
    """
    key = fixed_width_key("value", start, width)
    counted = (lines.select(key.alias("key"), F.col("value").alias("line"))
               .filter(F.col("key").try_cast("int").isNotNull())
               .groupBy("key", "line").agg(F.count(F.lit(1)).alias("copies")))
    placed = running_sums(in_chunks(counted, "key", "line", name="groups"), ["key"], ["line"],
                          last_row="copies")
    return placed.select("chunk", "key", "line", "copies",
                         (F.col("last_row") - F.col("copies") + 1).alias("first_row"), "last_row")


def group_boundaries(rows: DataFrame) -> DataFrame:
    """A10: ``key, n_lines, n_different, first_line, last_line`` of :func:`group_rows`."""
    return rows.groupBy("key").agg(
        F.max("last_row").alias("n_lines"), F.count(F.lit(1)).alias("n_different"),
        F.min("line").alias("first_line"), F.max("line").alias("last_line"))
