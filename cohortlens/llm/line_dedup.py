"""Line dedup over levelled sorted runs of line hashes.

A store of runs counts, for each line key, the documents that hold it. A run is a
table of ``hash, n`` bucketed and sorted by hash. Documents arrive in batches. A
batch merge-anti-joins the settled runs (keys that are in enough documents
already, which need no more counting) and adds the rest as a new run of level 0.
When a level has ``fanout`` runs they are compacted: counts of equal hashes are added
up, keys that have reached the threshold go to a settled run and the others to one run
of the next level. A last compaction over all levels settles every frequent key,
in whichever batches its documents came.

All runs have the same buckets, so batches and settled runs meet without a shuffle; a
compaction deals the hashes of its runs once. Everything on the main path is DataFrame functions.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm.common import delete_path, release, scratch_path, text_of, written

MIN_DOCS = 10
MIN_CHARS = 1
#: Batches that a whole table is dealt into.
BATCHES = 8
#: Runs of one level that are compacted into one of the next.
FANOUT = 4
#: What is stripped at both ends of a line, and the letters that are lowered.
STRIPPED = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    """The lines of a text; an empty one has one empty line."""
    return F.split(text, "\n", -1)


def key_of(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(STRIPPED)), UPPER, LOWER)


def hash_of(key: Column) -> Column:
    """128 bits that stand for a key."""
    return F.unhex(F.md5(key))


class LineRuns:
    """The levelled runs of one corpus, in the shared folder.

    ``min_docs`` documents settle a key. The object keeps the list of runs; each run is (part
    of) a written table, so lost executors cost no earlier work.
    """

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fanout: int = FANOUT):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.folder = scratch_path(spark, "lines")
        self.levels: dict[int, list[str]] = defaultdict(list)
        self.settled: list[str] = []

    def store(self, counts: DataFrame, *parts: str) -> str:
        """``counts`` as a table bucketed and sorted by ``hash``; its name."""
        name = f"line_run_{uuid.uuid4().hex}"
        writer = counts.write.format("parquet").bucketBy(self.buckets, "hash").sortBy("hash")
        if parts:
            writer = writer.partitionBy(*parts)
        writer.option("path", f"{self.folder}/{name}").saveAsTable(name)
        return name

    def unsettled(self, counts: DataFrame) -> DataFrame:
        """``counts`` without the keys of settled runs, one merge anti-join a run."""
        for name in self.settled:
            counts = counts.join(self.run(name, True).hint("merge"), "hash", "left_anti")
        return counts

    def run(self, name: str, settled: bool = False, bucketed: bool = True) -> DataFrame:
        """The counts of a run, or the settled hashes of a compaction.

        Not ``bucketed`` for unions: Spark 4.1 takes a union of bucketed scans for one that is
        dealt by bucket, leaves out the exchange and does not bring equal hashes together.
        """
        table = self.spark.table(name)
        if not bucketed:
            table = self.spark.read.schema(table.schema).parquet(f"{self.folder}/{name}")
        if "settled" not in table.columns:
            return table
        table = table.filter(F.col("settled") == settled)
        return table.select("hash") if settled else table.select("hash", "n")

    def add(self, counts: DataFrame) -> None:
        """A batch: ``hash, n`` (documents of the batch that hold the key), a hash once."""
        self.levels[0].append(self.store(self.unsettled(counts.select("hash", "n"))))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            self.compact([level], level + 1)
            level += 1

    def compact(self, levels: list[int], to: int) -> None:
        """Merge all runs of ``levels`` into one of level ``to`` and one settled run."""
        names = [name for level in levels for name in self.levels.pop(level, [])]
        if not names:
            return
        runs = reduce(DataFrame.unionAll, (self.run(n, bucketed=False) for n in names))
        merged = (self.unsettled(runs).groupBy("hash").agg(F.sum("n").alias("n"))
                  .withColumn("settled", F.col("n") >= self.min_docs))
        name = self.store(merged, "settled")
        self.settled.append(name)
        self.levels[to].append(name)
        self.drop(*names)

    def frequent(self) -> DataFrame:
        """``hash`` of the keys found in ``min_docs`` documents or more of all batches."""
        if sum(map(len, self.levels.values())) > 1 or self.levels[0]:
            self.compact(sorted(self.levels), max(self.levels) + 1)
        if not self.settled:
            return self.spark.createDataFrame([], "hash binary")
        return reduce(DataFrame.unionAll, (self.run(n, True, bucketed=False)
                                           for n in self.settled))

    def drop(self, *names: str) -> None:
        """Forget tables; files stay for the settled part of a compacted run."""
        for name in names:
            if name not in self.settled:
                self.spark.sql(f"DROP TABLE {name}")
                delete_path(self.spark, f"{self.folder}/{name}")

    def close(self) -> None:
        """Delete all runs."""
        names = {n for names in self.levels.values() for n in names} | set(self.settled)
        self.settled.clear()
        self.levels.clear()
        self.drop(*sorted(names))
        delete_path(self.spark, self.folder)
        release(self.spark)


def batch_counts(docs: DataFrame, batches: int = BATCHES, min_chars: int = MIN_CHARS) -> DataFrame:
    """``hash, n, batch``: documents of each batch that hold a key, a document counting once.

    ``docs``: ``digest, text``. A line in every document is counted map-side first.
    """
    keys = F.array_distinct(F.filter(F.transform(lines_of(F.col("text")), key_of),
                                     lambda k: F.length(k) >= min_chars))
    rows = docs.select(F.pmod(F.xxhash64("digest", "doc_id"), F.lit(batches)).cast("int")
                       .alias("batch"), F.explode(keys).alias("key"))
    return (rows.select("batch", hash_of(F.col("key")).alias("hash"))
            .groupBy("hash", "batch").agg(F.count(F.lit(1)).alias("n")))


def frequent_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
                   batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """``hash`` of the line keys in ``min_docs`` or more of ``docs`` (doc_id, digest, text)."""
    runs = LineRuns(docs.sparkSession, min_docs, fanout)
    counts = batch_counts(docs, batches, min_chars)
    staged = runs.store(counts.repartition(runs.buckets, "hash"), "batch")
    for batch in range(batches):
        runs.add(docs.sparkSession.table(staged).filter(F.col("batch") == batch))
    runs.drop(staged)
    found = written(runs.frequent(), "frequent-lines")
    runs.close()
    return found


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, batches: int = BATCHES,
               fanout: int = FANOUT) -> DataFrame:
    """One row per input row: ``doc_id, n_lines, n_dropped, kept`` (the text that stays).

    A line's key is the line without ASCII white space at both ends, A–Z in lower
    case. Keys of ``min_chars`` or more code points in ``min_docs`` or more rows lose all
    their lines; the others stay as they are, joined by line feeds. A null text is
    empty, and an empty text is one empty line. Repeated rows, and rows whose id is null
    or repeated, count as a document each. An empty table gives no rows; other columns are
    ignored.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    rows = rows.select("doc_id", hash_of(F.col("text")).alias("digest"), "text")
    frequent = frequent_lines(rows, min_docs, min_chars, batches, fanout)
    # equal texts lose the same places, so these are found once a digest
    keys = F.transform(lines_of(F.col("text")), key_of)
    places = (rows.select("digest", F.posexplode(keys).alias("place", "key"))
              .filter(F.length("key") >= min_chars)
              .select("digest", "place", hash_of(F.col("key")).alias("hash"))
              .join(frequent, "hash", "left_semi")
              .groupBy("digest").agg(F.collect_set("place").alias("gone")))
    lines = lines_of(F.col("text"))
    gone = F.coalesce(F.col("gone"), F.array().cast("array<int>"))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n"))
    return rows.join(places, "digest", "left").select(
        "doc_id", F.size(lines).cast("long").alias("n_lines"),
        F.size(gone).cast("long").alias("n_dropped"), kept.alias("kept"))
