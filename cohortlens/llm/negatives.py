"""Hard-negative mining by exact inner products, pruned by length and coordinates.

Vectors of integer codes are put into buckets of similar length. A bucket holds, for
each coordinate, its vectors sorted by that coordinate of their direction. A search
for rows that score at least θ with an anchor q leaves out the buckets whose longest
vector is too short (|q| · longest < θ). In the others a direction p must have a
cosine of at least t = θ / (|q| · longest) with q's, and so, with q_f = cos α and
t = cos δ, a coordinate p_f in [cos(α + δ), cos(α − δ)]: a range of the sorted list.
The ranges of an anchor's focus coordinates (the largest of its direction) are
intersected, and the candidates are verified by their exact score.

Anchors come in blocks. Blocks meet buckets through a plain join on a slot into
which buckets are dealt, so neither side is ever broadcast or gathered whole. A
first search over the buckets of one slot gives each anchor a threshold (its k-th
best score there), which prunes the search of the rest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import discard, written

#: Rows of a bucket and of a block of anchors.
BUCKET = 2048
BLOCK = 512
#: Focus coordinates of an anchor.
FOCUS = 4
#: Room for rounding when cosines and lengths are compared.
SLACK = 1e-9
#: Share of a bucket from which its candidates are scored by one matrix product.
DENSE = 0.125
POSITIVES = 5
NEGATIVES = 10
#: Percent of the positive's score between which a negative's lies.
LOW, HIGH = 30, 90

PACKED = ("part int, seq int, n int, dim int, width int, ids binary, labels binary, codes binary,"
          " orders binary, longest double")


# ---- buckets ----------------------------------------------------------------

def quantised(rows: DataFrame, id_col: str, vector_col: str, label_col: str,
              scale: int) -> DataFrame:
    """``id, label, codes, length`` of the rows that take part."""
    vector = F.col("vector")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = rows.select(F.col(id_col).cast("long").alias("id"),
                       F.col(label_col).cast("long").alias("label"),
                       F.col(vector_col).cast("array<double>").alias("vector"))
    kept = kept.filter(F.col("id").isNotNull() & F.col("label").isNotNull()
                       & vector.isNotNull() & F.coalesce(finite, F.lit(False)))
    coded = kept.select("id", "label", F.transform(
        vector, lambda x: F.floor(x * scale).cast("long")).alias("codes"))
    return coded.withColumn("length", F.sqrt(F.aggregate(
        "codes", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))))


def packed(rows: DataFrame, size: int, lists: bool) -> DataFrame:
    """Runs of ``size`` rows as one row each, in the order and partitions they come in."""
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, seq, held = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            while len(held) >= size:
                yield pd.DataFrame([_pack(held[:size], part, seq, lists)])
                held, seq = held[size:].reset_index(drop=True), seq + 1
        if held is not None and len(held):
            yield pd.DataFrame([_pack(held, part, seq, lists)])

    return rows.select("id", "label", "codes").mapInPandas(pack, PACKED)


def _pack(rows: pd.DataFrame, part: int, seq: int, lists: bool) -> dict:
    dim = max(map(len, rows["codes"]))
    codes = np.zeros((len(rows), dim), np.int64)  # a shorter vector ends with zeros
    for i, row in enumerate(rows["codes"]):
        codes[i, :len(row)] = row
    most = max(int(codes.max(initial=0)), -int(codes.min(initial=0)))
    width = 2 if most < 1 << 15 else 4 if most < 1 << 31 else 8
    lengths, unit = directions(codes)
    orders = np.argsort(unit, axis=0, kind="stable").T.astype(np.int32) if lists else np.zeros(0)
    return {"part": part, "seq": seq, "n": len(rows), "dim": dim, "width": width,
            "ids": rows["id"].to_numpy(np.int64).tobytes(),
            "labels": rows["label"].to_numpy(np.int64).tobytes(),
            "codes": codes.astype(f"i{width}").tobytes(), "orders": orders.tobytes(),
            "longest": float(lengths.max(initial=0.0))}


def directions(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and unit vectors; a zero vector has no direction and stays zero."""
    real = codes.astype(np.float64)
    lengths = np.sqrt((real * real).sum(axis=1))
    return lengths, real / np.where(lengths > 0, lengths, 1.0)[:, None]


class Pack:
    """A row of :func:`packed`, read back."""

    def __init__(self, row, prefix: str = ""):
        def value(name):
            return getattr(row, prefix + name)

        self.ids = np.frombuffer(value("ids"), np.int64)
        self.labels = np.frombuffer(value("labels"), np.int64)
        self.codes = np.frombuffer(value("codes"), f"i{value('width')}").reshape(
            value("n"), value("dim"))
        self.lengths, self.unit = directions(self.codes)
        self.longest = value("longest")
        self.orders = self.sorted = None

    def lists(self, orders: bytes) -> None:
        """The sorted coordinate lists: places, and values in that order."""
        self.orders = np.frombuffer(orders, np.int32).reshape(self.unit.shape[::-1])
        self.sorted = np.take_along_axis(self.unit.T, self.orders, axis=1)


# ---- search of a block in a bucket --------------------------------------------

def feasible(q: np.ndarray, cosine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges of a coordinate of directions that have at least ``cosine`` with one with ``q``."""
    alpha, delta = np.arccos(np.clip(q, -1, 1)), np.arccos(np.clip(cosine, -1, 1))
    return (np.cos(np.minimum(np.pi, alpha + delta)) - SLACK,
            np.cos(np.maximum(0, alpha - delta)) + SLACK)


def candidates(block: Pack, bucket: Pack, least: np.ndarray) -> list[np.ndarray | None]:
    """Places in the bucket that may score ``least`` with each anchor; None: all of them."""
    n, dim = bucket.unit.shape
    reach = block.lengths * bucket.longest
    cosine = np.where(reach > 0, least / np.where(reach > 0, reach, 1.0), np.where(
        least > 0, np.inf, -np.inf)) - SLACK
    unit = block.unit[:, :dim]
    focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :FOCUS]
    low, high = feasible(np.take_along_axis(unit, focus, axis=1), cosine[:, None])
    out: list[np.ndarray | None] = []
    for i, t in enumerate(cosine.tolist()):
        if t > 1 + SLACK:  # not even the longest row in the anchor's own direction
            out.append(np.zeros(0, np.int64))
        elif t <= 0 or not focus.shape[1]:
            out.append(None)
        else:
            ranges = []
            for f, a, b in zip(focus[i].tolist(), low[i].tolist(), high[i].tolist(), strict=True):
                start, end = np.searchsorted(bucket.sorted[f], [a, b + SLACK])
                if end - start < n:
                    ranges.append((int(end - start), f, int(start), int(end)))
            found = None
            for _, f, start, end in sorted(ranges):
                places = bucket.orders[f, start:end]
                if found is None:
                    found = np.zeros(n, np.int8)
                    found[places] = 1
                    seen = 1
                else:
                    found[places] += found[places] == seen
                    seen += 1
            out.append(None if found is None else np.flatnonzero(found == seen))
    return out


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of rows; floating-point where that is exact."""
    dim = min(a.shape[1], b.shape[1])
    a, b = a[:, :dim], b[:, :dim]
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, dim)
    kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64
    return a.astype(kind) @ b.astype(kind).T


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: by score, then id."""
    places = np.arange(len(scores))
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= edge)
    return places[np.lexsort((ids[places], -scores[places]))[:k]]


def search_block(block: Pack, bucket: Pack, wants: list[tuple[int, int, int, int]], k: int,
                 same: bool) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``anchor, window, ids, scores``: the k best of the bucket for each window.

    ``wants``: anchor (place in the block), window, least and most score. ``same``: rows
    of the anchor's label other than the anchor, else rows of other labels.
    """
    by_anchor: dict[int, list] = {}
    for anchor, window, low, high in wants:
        by_anchor.setdefault(anchor, []).append((window, low, high))
    anchors = np.array(sorted(by_anchor), np.int64)
    least = np.array([float(min(low for _, low, _ in by_anchor[a])) for a in anchors.tolist()])
    part = Pack.__new__(Pack)
    part.codes, part.lengths, part.unit = (x[anchors] for x in (block.codes, block.lengths,
                                                               block.unit))
    found = candidates(part, bucket, least)
    n = len(bucket.ids)
    dense = [i for i, c in enumerate(found) if c is None or len(c) >= DENSE * n]
    product = exact_scores(part.codes[dense], bucket.codes) if dense else None
    row_of = {i: r for r, i in enumerate(dense)}
    for i, anchor in enumerate(anchors.tolist()):
        places = found[i]
        if places is not None and not len(places):
            continue
        alike = bucket.labels == block.labels[anchor]
        if same:
            alike = alike & (bucket.ids != block.ids[anchor])
        else:
            alike = ~alike
        places = np.flatnonzero(alike) if places is None else places[alike[places]]
        scores = (product[row_of[i]][places] if i in row_of else
                  exact_scores(part.codes[i:i + 1], bucket.codes[places])[0])
        for window, low, high in by_anchor[anchor]:
            fit = np.flatnonzero((scores >= low) & (scores <= high))
            if len(fit):
                top = fit[best(bucket.ids[places[fit]], scores[fit], k)]
                yield anchor, window, bucket.ids[places[top]], scores[top].astype(np.int64)


FOUND = "part int, seq int, anchor int, window int, anchor_id long, id long, score long"


def search(blocks: DataFrame, buckets: DataFrame, k: int, same: bool) -> DataFrame:
    """``KEY, anchor_id, id, score``: the k best of each bucket for each window.

    ``blocks`` has the packed anchors and ``wants``; ``buckets`` the packed rows and ``slot``.
    Both are dealt by slot, blocks to every slot; rows meet one pair of packs at a time.
    """
    slots = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = blocks.drop("orders").withColumn("slot", F.explode(F.sequence(
        F.lit(0), F.lit(slots - 1)))).repartition(slots, "slot")
    rows = buckets.select("slot", *(F.col(c).alias(f"b_{c}") for c in buckets.columns
                                    if c != "slot")).repartition(slots, "slot")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                block, bucket = Pack(row), Pack(row, "b_")
                bucket.lists(row.b_orders)
                wants = [(w["anchor"], w["window"], w["low"], w["high"]) for w in row.wants]
                found = list(search_block(block, bucket, wants, k, same))
                if found:
                    anchors, windows, ids, scores = zip(*found, strict=True)
                    sizes = [len(x) for x in ids]
                    at = np.repeat(np.array(anchors, np.int32), sizes)
                    yield pd.DataFrame({
                        "part": row.part, "seq": row.seq, "anchor": at,
                        "window": np.repeat(np.array(windows, np.int32), sizes),
                        "anchor_id": block.ids[at], "id": np.concatenate(ids),
                        "score": np.concatenate(scores)})

    return spread.join(rows, "slot").mapInPandas(run, FOUND)


KEY = ("part", "seq", "anchor", "window")


def first_k(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy(*KEY).orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def with_wants(blocks: DataFrame, wants: DataFrame) -> DataFrame:
    """``blocks`` that have windows ``(KEY, low, high)``, with these as ``wants``."""
    lists = wants.groupBy("part", "seq").agg(F.collect_list(F.struct(
        "anchor", "window", "low", "high")).alias("wants"))
    return blocks.join(lists, ["part", "seq"])


def best_rows(blocks: DataFrame, buckets: DataFrame, wants: DataFrame, k: int, same: bool
              ) -> DataFrame:
    """``KEY, anchor_id, id, score, rank``: the k best rows of all buckets for each window."""
    probe = written(first_k(search(with_wants(blocks, wants), buckets.filter("slot = 0"), k, same),
                            k), "probe")
    known = probe.filter(F.col("rank") == k).select(*KEY, F.col("score").alias("known"))
    raised = wants.join(known, [*KEY], "left").withColumn(
        "low", F.greatest("low", "known")).drop("known")
    rest = search(with_wants(blocks, raised), buckets.filter("slot > 0"), k, same)
    out = written(first_k(probe.drop("rank").unionByName(rest), k), "best")
    discard(probe)
    return out


# ---- mining -------------------------------------------------------------------

def hard_negatives(rows: DataFrame, is_anchor: Column, id_col: str = "vec_id",
                   vector_col: str = "embedding", label_col: str = "label", scale: int = 256,
                   positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
                   high: int = HIGH, bucket: int = BUCKET, block: int = BLOCK) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    A score is the integer inner product of vectors whose components are ⌊scale · x⌋; higher
    comes first, ties by smaller id. The anchors are the rows for which ``is_anchor`` (of
    column ``id``) holds. An anchor's positives are its first rows of the same label under
    another id; for each positive, its negatives are the first rows of another label whose
    score is from ``low`` to ``high`` percent of the positive's.

    Rows with a null id, label or vector, or a null or non-finite component take no part. A
    shorter vector counts as ending with zeros, an empty one as zero. Repeated rows are
    rows each: as anchors they give their results again, as others they take places
    of their own. Anchors without positives, and positives without negatives, give no rows;
    so does an empty table. Other columns are ignored. Scores must fit in 64 bits.
    """
    slots = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    coded = quantised(rows, id_col, vector_col, label_col, scale)
    by_length = coded.repartitionByRange(slots, F.col("length").desc(), "id").sortWithinPartitions(
        F.col("length").desc(), "id")
    buckets = written(packed(by_length, bucket, lists=True).withColumn(
        "slot", F.pmod(F.col("part") + F.col("seq"), F.lit(slots))), "buckets")
    blocks = written(packed(coded.filter(is_anchor), block, lists=False), "blocks")
    everything = blocks.select("part", "seq", F.explode(F.sequence(F.lit(0), F.col("n") - 1))
                               .alias("anchor")).select(
        "part", "seq", "anchor", F.lit(0).alias("window"),
        F.lit(-(1 << 63)).cast("long").alias("low"), F.lit((1 << 63) - 1).cast("long").alias("high"))
    first = best_rows(blocks, buckets, everything, positives, same=True)
    near = first.select("part", "seq", "anchor", F.col("rank").alias("window"), "anchor_id",
                        F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    # the least and most whole score between the two shares
    score = F.col("positive_score").cast("decimal(20,0)")
    wants = near.select(*KEY, F.ceil(score * F.lit(low) / F.lit(100)).cast("long").alias("low"),
                        F.floor(score * F.lit(high) / F.lit(100)).cast("long").alias("high"))
    wants = wants.filter("low <= high")
    found = best_rows(blocks, buckets, wants, negatives, same=False)
    discard(buckets)
    return found.drop("anchor_id").join(near, [*KEY]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
