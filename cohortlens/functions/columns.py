"""Scalar column expressions shared by the operators.

Everything here is a composition of ``pyspark.sql.functions`` so it stays
inside whole-stage codegen; no Python UDFs.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cohort names and the reference's diagnosis codes.
CONTROL = "control"
CASE = "case"
CONTROL_CODES = ("1",)
CASE_CODES = ("4", "5")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c: Column | str) -> Column:
    """Text cell → double; cells that are no decimal number become NULL.

    The cast alone would also take Java's suffixes (``5d``, ``2f``) and hex
    floats. ``nan`` and infinities are NULL too: one such cell would otherwise
    make its cluster's statistics undefined and drop it from the ranking.
    """
    c = _col(c)
    value = F.when(~c.rlike("[dDfFxX]"), c.try_cast("double"))
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def cell(cells: Column | str, index: int) -> Column:
    """0-based array element, NULL when the row is too short (blank lines)."""
    return F.get(_col(cells), F.lit(index))


def cohort_label(code: Column | str, control: Iterable[str] = CONTROL_CODES,
                 case: Iterable[str] = CASE_CODES) -> Column:
    """Map a diagnosis code to 'control' / 'case'; other codes give NULL.

    Codes compare as strings, so header cells and ``NA`` fall out.
    """
    code = _col(code)
    return (F.when(code.isin(list(control)), F.lit(CONTROL))
            .when(code.isin(list(case)), F.lit(CASE)))


def fixed_width_key(line: Column | str, start: int, width: int = 1) -> Column:
    """Characters ``[start, start+width)`` of a line (0-based, like a slice)."""
    return F.substring(_col(line), start + 1, width)


def hash_bucket(key: Column | str, buckets: int = 200) -> Column:
    """Deterministic bucket in ``[0, buckets)`` from the md5 of the key text.

    Independent of partitioning and reproducible in any SQL engine with md5.
    """
    digest_prefix = F.substring(F.md5(_col(key).cast("string")), 1, 8)
    return F.pmod(F.conv(digest_prefix, 16, 10).cast("bigint"), F.lit(buckets))


def hash_number(key: Column | str, seed: int, digits: int) -> Column:
    """Seeded uniform integer in ``[0, 16 ** digits)`` from the md5 of seed and key text."""
    text = F.concat(F.lit(f"{seed}:"), _col(key).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def micro_units(x: Column | str) -> Column:
    """Float → integer micro-units, so text renderings and sums are exact."""
    return F.round(_col(x).cast("double") * F.lit(1e6)).cast("bigint")


def round6(x: Column | str) -> Column:
    return F.round(_col(x), 6)


def welch_t(mean_a: Column, sd_a: Column, n_a: Column,
            mean_b: Column, sd_b: Column, n_b: Column) -> Column:
    """(μa − μb) / √(σa²/na + σb²/nb); NULL when the denominator is 0."""
    denom = F.sqrt(sd_a * sd_a / n_a + sd_b * sd_b / n_b)
    return F.try_divide(mean_a - mean_b, F.nullif(denom, F.lit(0.0)))


def characters(word: Column | str) -> Column:
    """Array of the word's characters (code points); empty word → empty array."""
    return F.filter(F.split(_col(word), ""), lambda ch: ch != "")
