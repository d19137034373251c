"""Mixing sources to target weights by Sainte-Laguë apportionment (DataFrame functions only).

Each source's documents form a stream of words cut into equal blocks. The
blocks of the mix are given to sources by the highest quotients V / (2j − 1),
then each source's quota is given to its shards in the same way, and inside a
shard seeded block selection takes every block ⌊quota / blocks⌋ times and an
evenly spread, seeded remainder once more. Positions come from a window over
one shard, so no task ever sees a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import WORD_PATTERN, text_of, written

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_REPEATS = 2
#: Words a shard holds about; a source has at most MOST_SHARDS shards.
SHARD_WORDS = 32_768
MOST_SHARDS = 4096
#: The smallest source spans at least so many blocks (block size 1 at least).
LEAST_BLOCKS = 512
MOST_BLOCK_WORDS = 1024
SEED = 17


def source_targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   most: int = MOST_REPEATS) -> DataFrame:
    """``(source, source_size)`` → plus ``weight, target`` (one row per source).

    target = min(most · size, weight · μ) with Σ target = share · Σ size: what
    remains when capped sources pass their excess on by weight until none is
    above its cap. Ordered by cap / weight the capped sources are a prefix, so
    μ follows from running sums.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)),
                          (F.row_number().over(by_name) - 1) % len(weights) + 1)
    w = sources.withColumn("weight", weight).withColumn(
        "cap", F.lit(float(most)) * F.col("source_size"))
    everything = Window.partitionBy(F.lit(0))
    before = (Window.partitionBy(F.lit(0))
              .orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
              .rowsBetween(Window.unboundedPreceding, -1))
    mu = ((F.lit(float(share)) * F.sum("source_size").over(everything)
           - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
          / (F.sum("weight").over(everything)
             - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    w = w.withColumn("mu", mu)
    level = F.min(F.when(F.col("mu") * F.col("weight") <= F.col("cap"),
                         F.struct(F.col("cap") / F.col("weight"), "mu"))).over(everything)["mu"]
    return w.select("source", "source_size", "weight", F.least(
        "cap", F.coalesce(level, F.lit(float("inf"))) * F.col("weight")).alias("target"))


def highest_quotients(parties: DataFrame, within: list[str], key: list[str], votes: str,
                      seats: Column, most: str) -> DataFrame:
    """``parties`` plus ``quota``: Sainte-Laguë seats of each party of a group.

    ``seats``: seats of the group ``within``; ``most``: a party's column of most
    seats. With K parties the divisor lies between Σv / (N + K/2) and
    Σv / (N − K/2), so all but about two seats a party are certain and only the
    few open quotients of each party are ranked.
    """
    group = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    total = F.sum(votes).over(group)
    count = F.count(F.lit(1)).over(group)
    share = F.when(total > 0, F.col(votes) / total).otherwise(F.lit(0.0))
    p = (parties.withColumn("_n", seats).withColumn("_share", share).withColumn("_k", count)
         .withColumn("_low", F.least(F.col(most), F.greatest(F.lit(0), F.floor(
             F.col("_share") * (F.col("_n") - F.col("_k") / 2) - 0.5))))
         .withColumn("_high", F.least(F.col(most), F.ceil(
             F.col("_share") * (F.col("_n") + F.col("_k") / 2) + 2.5)))
         .withColumn("_open", F.col("_n") - F.sum("_low").over(group)))
    quotients = (p.filter((F.col("_high") > F.col("_low")) & (F.col(votes) > 0))
                 .select(*within, *key, votes, "_open",
                         F.explode(F.sequence(F.col("_low") + 1, F.col("_high"))).alias("_j"))
                 .withColumn("_q", F.col(votes) / (2 * F.col("_j") - 1)))
    order = ((Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0)))
             .orderBy(F.col("_q").desc(), *key, "_j"))
    won = (quotients.withColumn("_rank", F.row_number().over(order))
           .filter(F.col("_rank") <= F.col("_open"))
           .groupBy(*within, *key).agg(F.count(F.lit(1)).alias("_won")))
    return (p.join(won, [*within, *key], "left")
            .withColumn("quota", F.col("_low") + F.coalesce("_won", F.lit(0)))
            .drop("_n", "_share", "_k", "_low", "_high", "_open", "_won"))


def selected_before(position: Column, block: Column, blocks: Column, extra: Column,
                    offset: Column) -> Column:
    """Words of a shard's first ``position`` words that the extra selection takes.

    Block i is taken when ⌊((i + 1) · extra + offset) / blocks⌋ exceeds
    ⌊(i · extra + offset) / blocks⌋, so exactly ``extra`` blocks are.
    """
    def taken(i: Column) -> Column:
        return F.floor((i * extra + offset) / blocks)

    i = F.floor(position / block)
    return taken(i) * block + (taken(i + 1) - taken(i)) * (position - i * block)


def measured(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``doc_id, source, size, digest`` of each row, and the row itself as ``row``."""
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        F.regexp_count(text_of(text_col), F.lit(WORD_PATTERN)).cast("long").alias("size"),
        F.sha2(text_of(text_col), 256).alias("digest"),
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))


def apportioned_sources(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE,
                        shard_words: int = SHARD_WORDS) -> DataFrame:
    """Per source: its number, size, target, quota of blocks, block size and shards."""
    targets = source_targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")),
                             weights, share)
    everything = Window.partitionBy(F.lit(0))
    least = F.min(F.when(F.col("source_size") > 0, F.col("source_size"))).over(everything)
    targets = (targets
               .withColumn("block", F.greatest(F.lit(1), F.least(
                   F.lit(MOST_BLOCK_WORDS), F.floor(F.coalesce(least, F.lit(1)) / LEAST_BLOCKS))))
               .withColumn("most", MOST_REPEATS * F.ceil(F.col("source_size") / F.col("block")))
               .withColumn("shards", F.greatest(F.lit(1), F.least(
                   F.lit(MOST_SHARDS), F.ceil(F.col("source_size") / shard_words))))
               .withColumn("source_no", F.row_number().over(
                   Window.orderBy(F.col("source").asc_nulls_last()))))
    return highest_quotients(
        targets, [], ["source_no"], "target",
        F.round(F.sum("target").over(everything) / F.col("block")).cast("long"), "most"
    ).withColumnRenamed("quota", "source_quota").drop("weight", "most")


def selected(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, seed: int = SEED,
             shard_words: int = SHARD_WORDS) -> DataFrame:
    """``rows`` (of :func:`measured`, or without ``row``) with what the mix takes of them.

    ``source_size, target``; ``whole``: times all of the document is taken;
    ``start, block, blocks, extra, offset``: its place in its shard's stream and
    the shard's extra selection.
    """
    sizes = written(rows.select("doc_id", "source", "size", "digest"), "sizes")
    sources = written(apportioned_sources(sizes, weights, share, shard_words), "targets")

    def placed(docs: DataFrame) -> DataFrame:
        return (docs.alias("d").join(sources.alias("a"),
                                     F.col("d.source").eqNullSafe(F.col("a.source")))
                .drop(F.col("a.source"))
                .withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "digest"),
                                              F.col("shards"))))

    shards = (placed(sizes).groupBy("source_no", "shard", "block", "source_quota")
              .agg(F.sum("size").alias("shard_size"))
              .withColumn("shard_most",
                          MOST_REPEATS * F.ceil(F.col("shard_size") / F.col("block"))))
    quotas = highest_quotients(shards, ["source_no"], ["shard"], "shard_size",
                               F.col("source_quota"), "shard_most")
    stream = (Window.partitionBy("source_no", "shard")
              .orderBy(F.xxhash64(F.lit(seed + 1), "doc_id", "digest"), "doc_id", "digest")
              .rowsBetween(Window.unboundedPreceding, 0))
    keep = rows if "row" in rows.columns else sizes
    return (placed(keep)
            .join(quotas.select("source_no", "shard", "shard_size", "quota"),
                  ["source_no", "shard"])
            .withColumn("start", F.sum("size").over(stream) - F.col("size"))
            .withColumn("blocks", F.greatest(
                F.lit(1), F.ceil(F.col("shard_size") / F.col("block"))))
            .withColumn("whole", F.floor(F.col("quota") / F.col("blocks")))
            .withColumn("extra", F.col("quota") - F.col("whole") * F.col("blocks"))
            .withColumn("offset", F.pmod(F.xxhash64(F.lit(seed + 2), "source_no", "shard"),
                                         F.col("blocks"))))


def extra_words() -> Column:
    """Words of a document of :func:`selected` that its shard's extra selection takes."""
    def before(position: Column) -> Column:
        return selected_before(position, F.col("block"), F.col("blocks"), F.col("extra"),
                               F.col("offset"))

    return (before(F.col("start") + F.col("size")) - before(F.col("start"))).cast("long")


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", weights=WEIGHTS, share: float = SHARE,
                seed: int = SEED, shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, taken``.

    ``size`` counts the words of the whole text (null: 0); a null source is a
    source of its own, last in order. ``taken`` is the number of words the mix
    takes from the document, at most twice its size. Sources without words have
    target 0 and are taken 0 times. Repeated rows are separate documents; an
    empty table gives no rows; other columns are ignored. The result depends on
    ids, texts, sources and ``seed`` only, never on partitions.
    """
    rows = measured(docs, id_col, text_col, source_col).drop("row")
    return selected(rows, weights, share, seed, shard_words).select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("whole") * F.col("size") + extra_words()).alias("taken"))


def mix_documents(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, seed: int = SEED
                  ) -> DataFrame:
    """The mix itself, with the columns of ``docs``: repeated and partly taken documents.

    A document that is taken whole appears unchanged, once per repeat. Blocks of
    the extra selection that cut a document give a row with the words taken,
    joined by spaces, and their ``n_chars``. Documents that are not taken, and
    documents without words, which count nothing towards any target, are left out.
    """
    rows = selected(measured(docs, "doc_id", "text", "source"), weights, share, seed)
    rows = rows.withColumn("some", extra_words()).withColumn("text", F.col("row.text"))

    def taken(i: Column) -> Column:
        return F.floor((i * F.col("extra") + F.col("offset")) / F.col("blocks"))

    def block_taken(_, i: Column) -> Column:
        block = F.floor((F.col("start") + i) / F.col("block"))
        return taken(block + 1) > taken(block)

    part = F.when(F.col("some") == F.col("size"), F.col("text")).otherwise(F.array_join(
        F.filter(F.regexp_extract_all("text", F.lit(f"({WORD_PATTERN})"), 1), block_taken), " "))
    texts = F.concat(F.array_repeat("text", F.col("whole").cast("int")),
                     F.when(F.col("some") > 0, F.array(part)).otherwise(F.array().cast(
                         "array<string>")))
    new = {"text": F.col("new"), "n_chars": F.char_length("new").cast("long")}
    return (rows.filter("size > 0").select("row", F.explode(texts).alias("new"))
            .select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns)))
