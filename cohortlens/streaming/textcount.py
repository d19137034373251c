"""Thresholded token counts over a stream of text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortlens.operators import textcount


def token_counts_stream(spark: SparkSession, path: str, threshold: int,
                        pattern: str = textcount.LINE, drop_empty: bool = False,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """A8 + P6 on a streaming text source: running counts ≥ ``threshold``.

    Returns a streaming DataFrame. The threshold applies to the running
    totals, so a token appears once it reaches it. Run it in ``update`` mode
    to emit only tokens whose count changed in a trigger, or in ``complete``
    mode for the whole table each time. Exact running counts keep one state
    row per distinct token (no watermark can retire a token that may still
    recur), so the state store grows with the vocabulary, not with the
    stream length.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(path)
    return textcount.token_counts(textcount.tokens(lines, pattern, drop_empty), threshold)
