"""Order-based operators without a global sort in one task.

Rows are written in range partitions of their sort key (``chunk`` numbers them in
order). What a row needs from the chunks before it — a running sum, a row number —
comes from one small row per chunk and group, so a group of any size is spread over
as many chunks as its rows need, provided that the sort key tells its rows apart.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.columns import hash_number
from cohortlens.session import run_folder

#: Hash digits (hex) of a selection, and how many of them one counting round resolves.
DIGITS = 15
ROUND_DIGITS = 4
#: Candidates that are sorted directly.
FEW = 10_000


def in_chunks(df: DataFrame, *order: str, name: str = "chunks") -> DataFrame:
    """``df`` written once in range partitions of ``order``, numbered by ``chunk``.

    Rows equal in ``order`` share a chunk; chunks ascend with the order.
    """
    path = f"{run_folder(df.sparkSession, name)}/data"
    chunked = df.repartitionByRange(*order).withColumn("chunk", F.spark_partition_id())
    chunked.write.parquet(path)
    return df.sparkSession.read.schema(chunked.schema).parquet(path)


def running_sums(chunked: DataFrame, group: Iterable[str], order: Iterable[str | Column],
                 **sums: str | Column) -> DataFrame:
    """Columns ``sums`` (name=value): the value summed over a group up to each row in order.

    ``chunked`` comes from :func:`in_chunks` on ``group`` followed by ``order``.
    """
    group, order = list(group), list(order)
    values = {name: F.col(v) if isinstance(v, str) else v for name, v in sums.items()}
    totals = chunked.groupBy("chunk", *group).agg(
        *[F.sum(v).alias(f"_{name}") for name, v in values.items()])
    before = Window.partitionBy(*group).orderBy("chunk").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = totals.select("chunk", *group, *[
        F.coalesce(F.sum(f"_{name}").over(before), F.lit(0)).alias(f"_{name}") for name in values])
    inside = Window.partitionBy("chunk", *group).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    within = chunked.select("*", *[F.sum(v).over(inside).alias(name)
                                   for name, v in values.items()])
    # a group's key may be null
    a, b = within.alias("a"), offsets.alias("b")
    same = F.col("a.chunk") == F.col("b.chunk")
    for g in group:
        same = same & F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}"))
    return a.join(b, same).select(
        *[F.col(f"a.{c}") for c in chunked.columns],
        *[(F.col(f"a.{name}") + F.col(f"b._{name}")).alias(name) for name in values])


def order_statistics(ids: DataFrame, ranks: Iterable[int], seed: int, id_col: str = "sample_id"
                     ) -> list[tuple[int, str] | None]:
    """For each rank (from 1), the ``(hash, id text)`` with so many at or before it.

    Ids are ordered by a seeded hash, then by their text. Each round counts the ids by
    the next digits of the hash within the range that holds the rank (at most
    ``16 ** ROUND_DIGITS`` counts), until few enough are left to be sorted. Nothing but
    counts and these few reach the driver. A rank of 0 or less gives None.
    """
    keyed = ids.select(F.col(id_col).cast("string").alias("id")).withColumn(
        "hash", hash_number(F.col("id"), seed, DIGITS))
    out: list[tuple[int, str] | None] = []
    for rank in ranks:
        if rank <= 0:
            out.append(None)
            continue
        low, left, rest = 0, DIGITS, rank
        inside = keyed
        while left:
            step = min(ROUND_DIGITS, left)
            size = 16 ** (left - step)
            counts = (inside.groupBy(F.floor((F.col("hash") - low) / size).alias("at"))
                      .agg(F.count(F.lit(1)).alias("n")))
            running = F.sum("n").over(Window.orderBy("at"))
            found = (counts.withColumn("upto", running).filter(F.col("upto") >= rest)
                     .orderBy("at").first())
            if found is None:
                raise ValueError(f"rank {rank} of fewer rows")
            rest -= found["upto"] - found["n"]
            low, left = low + found["at"] * size, left - step
            inside = keyed.filter((F.col("hash") >= low) & (F.col("hash") < low + size))
            if found["n"] <= FEW:
                break
        row = inside.orderBy("hash", "id").limit(rest).orderBy(
            F.desc("hash"), F.desc("id")).first()
        out.append((row["hash"], row["id"]))
    return out
