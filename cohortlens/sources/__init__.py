"""Sources: delimited text readers and bindings onto the parquet tables."""

from cohortlens.sources.text import (
    CORRUPT,
    HEADER_MARKER,
    annotation,
    background,
    background_csv,
    background_quality,
    read_lines,
    split_cells,
    wide_rows,
)

__all__ = [
    "CORRUPT",
    "HEADER_MARKER",
    "annotation",
    "background",
    "background_csv",
    "background_quality",
    "read_lines",
    "split_cells",
    "wide_rows",
]
