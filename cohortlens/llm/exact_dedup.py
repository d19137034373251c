"""Exact de-duplication with a heavy-hitter split.

Texts are equal when their SHA-256 digests are. Misra–Gries summaries of the
partitions find the digests that may be frequent; their exact counts are
verified, and the winners (at most ``counters`` rows, by construction) are
broadcast, so copies of a frequent text are resolved map-side. All remaining
digests, none of which holds more than about ``2 / counters`` of the rows, go
through an ordinary shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import text_of, written

COUNTERS = 1024


def misra_gries(counts: dict, more: dict, k: int) -> dict:
    """Merge two summaries into one of at most ``k`` counters (counts never overestimate)."""
    for key, n in more.items():
        counts[key] = counts.get(key, 0) + n
    if len(counts) <= k:
        return counts
    cut = sorted(counts.values(), reverse=True)[k]
    return {key: n - cut for key, n in counts.items() if n > cut}


def heavy_digests(digests: DataFrame, k: int = COUNTERS) -> DataFrame:
    """Candidate frequent digests: fewer than ``k + 1`` rows ``(digest)``.

    Each partition's summary underestimates a count by at most rows/(k+1), and
    so does their sum. A digest with over 2N/(k+1) of N rows keeps an estimate
    above N/(k+1); since the estimates sum to at most N, fewer than k + 1
    digests pass.
    """
    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, rows = {}, 0
        for batch in batches:
            rows += len(batch)
            counts = misra_gries(counts, batch["digest"].value_counts().to_dict(), k)
        yield pd.DataFrame({"digest": [*counts, None], "n": [*counts.values(), rows]})

    found = digests.select("digest").mapInPandas(summarise, "digest string, n long")
    sums = written(found.groupBy("digest").agg(F.sum("n").alias("n")), "misra-gries")
    total = sums.filter("digest is null").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return (sums.filter("digest is not null").filter(F.col("n") * (k + 1) > total)
            .select("digest"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                counters: int = COUNTERS) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts (a null text is empty, nothing else is changed) the row with
    the largest id stays. A group whose ids are all null has a null ``keep_id``
    and keeps its rows; a null id beside others is dropped. Repeated rows (same
    id and text) count in ``group_size`` each and share one decision. An empty
    table gives no rows; other columns are ignored.
    """
    digests = written(docs.select(F.col(id_col).alias("doc_id"),
                                  F.sha2(text_of(text_col), 256).alias("digest")), "digests")
    group = (F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    candidates = heavy_digests(digests, counters)
    winners = written(digests.join(F.broadcast(candidates), "digest")
                      .groupBy("digest").agg(*group), "frequent")
    split = digests.join(F.broadcast(winners), "digest", "left")
    rest = digests.join(F.broadcast(winners), "digest", "left_anti")
    shuffled = rest.join(rest.groupBy("digest").agg(*group), "digest")
    columns = ("doc_id", "keep_id", "group_size",
               F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
               F.col("digest").alias("text_sha256"))
    return (split.filter("group_size is not null").select(*columns)
            .unionAll(shuffled.select(*columns)))
