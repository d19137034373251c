"""Column-expression helpers (all built-in, JVM-side, codegen-friendly)."""

from cohortlens.functions.columns import (
    CASE,
    CONTROL,
    cell,
    characters,
    cohort_label,
    fixed_width_key,
    hash_bucket,
    micro_units,
    round6,
    to_double,
    welch_t,
)

__all__ = [
    "CASE",
    "CONTROL",
    "cell",
    "characters",
    "cohort_label",
    "fixed_width_key",
    "hash_bucket",
    "micro_units",
    "round6",
    "to_double",
    "welch_t",
]
