"""Near-duplicate detection: consistent weighted sampling over TF-IDF shingles.

Texts are weighted sets of shingles of five words (tf × idf). Improved consistent
weighted sampling draws, for each of ``BANDS × ROWS`` hash functions, one
shingle with its quantised weight, such that two texts draw the same with the
probability of their weighted Jaccard similarity. Texts that agree in a whole
band are candidates and are verified by the exact similarity. Classes are the
connected components of the verified links.

Candidates are tested without forming all pairs of a bucket. All members are
tested against one hub, the member that shares most buckets with others; while a bucket has members outside its largest class,
these become hubs too and are tested against every member of another class. A
bucket is left when each member is in its largest class or has been a hub, so
every link between different classes has been tested; later rounds read only the buckets
that are left over, and a pair that shares several buckets is tested in one of them. In large buckets, pairs
whose weights alone exclude a link (:func:`weight_limits`) need no test.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import discard, release, text_of, tidy, written
from cohortlens.llm.words import gram_hashes, mixed, slabs, word_hashes

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 16
ROWS = 4
#: Counters of a Misra–Gries summary of shingles.
COUNTERS = 131_072
#: (document, shingle) pairs that are counted at once.
RANGE_PAIRS = 1 << 20
#: Entries of the table of random numbers of one hash function.
TABLE_BITS = 14
#: A bucket of more members is large; also its further hubs in the first round of testing.
LARGE = 32
#: So many times more hubs in each next round.
MORE_HUBS = 32
#: Pairs of texts that a task compares.
PAIRS_AT_ONCE = 2048
#: Edges whose components one task finds.
FEW_EDGES = 10_000
#: Room for rounding when sums of weights are compared.
SLACK = 1e-6
SEED = 29


# ---- shingles and their weights ---------------------------------------------

def shingle_sets(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted different shingle hashes of each text in a row, their counts, and sizes by text.

    A text of one to four words is one shingle; a text without words has none.
    """
    words, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    all_grams = gram_hashes(words, SHINGLE)
    hashes, repeats, sizes = [], [], np.zeros(len(texts), np.int64)
    for i, (end, n) in enumerate(zip(ends.tolist(), counts.tolist(), strict=True)):
        if n >= SHINGLE:
            grams = np.sort(all_grams[end - n:end - SHINGLE + 1])
        elif n:
            grams = gram_hashes(words[end - n:end], n)
        else:
            continue
        new = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
        hashes.append(grams[new])
        repeats.append(np.diff(np.append(new, len(grams))))
        sizes[i] = len(new)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), sizes
    return np.concatenate(hashes), np.concatenate(repeats), sizes


@dataclass
class Weights:
    """Inverse document frequencies: a table of frequent shingles, the others' by text.

    ``ceiling`` is the weight of shingles in one document only. ``rare`` has a row
    ``ref, hash, n`` per text and shingle of its in 2 documents or more that is not
    in the table; None if there is no such shingle.
    """

    hashes: np.ndarray
    idf: np.ndarray
    ceiling: float
    rows: int = 0
    rare: DataFrame | None = None

    def table(self) -> Weights:
        """What tasks need besides the frequencies that come with each text."""
        return replace(self, rare=None)

    def of(self, hashes: np.ndarray, counts: np.ndarray, found: np.ndarray | None = None
           ) -> np.ndarray:
        """tf × idf of shingles; ``found``: document frequencies of those not in the table."""
        out = np.full(len(hashes), self.ceiling)
        if found is not None:
            several = found > 1
            out[several] = 1 + np.log((self.rows + 1) / (found[several] + 1.0))
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            hit = self.hashes[at] == hashes
            out[hit] = self.idf[at[hit]]
        return out * counts


def merged(hashes: np.ndarray, counts: np.ndarray, k: int | None = None
           ) -> tuple[np.ndarray, np.ndarray]:
    """Counts added up by hash; with ``k`` a Misra–Gries summary of at most k counters."""
    order = np.argsort(hashes, kind="stable")
    hashes, counts = hashes[order], counts[order]
    if len(hashes):
        new = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
        hashes, counts = hashes[new], np.add.reduceat(counts, new)
    if k is not None and len(hashes) > k:
        counts = counts - np.partition(counts, len(counts) - k - 1)[len(counts) - k - 1]
        hashes, counts = hashes[counts > 0], counts[counts > 0]
    return hashes, counts


def shingle_weights(docs: DataFrame, counters: int = COUNTERS) -> Weights:
    """Weights from the exact document frequencies of the whole corpus.

    With T the number of (document, shingle) pairs, shingles in more than
    t = 2T / (counters + 1) documents are found by Misra–Gries summaries (at most
    ``counters`` candidates, as their estimates exceed T / (counters + 1) and
    sum to at most T) and counted exactly in a second pass; their table goes to
    all tasks. The rarer ones, none of which is in more than t documents, are
    shuffled by shingle and counted there (:func:`rare_frequencies`).
    idf = 1 + ln((N + 1) / (df + 1)).
    """
    spark = docs.sparkSession

    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        rows = pairs = 0
        for batch in batches:
            for _, texts in slabs(batch["text"].tolist()):
                hashes, _, sizes = shingle_sets(texts)
                rows, pairs = rows + len(texts), pairs + int(sizes.sum())
                known, counts = merged(np.concatenate([known, hashes]), np.concatenate(
                    [counts, np.ones(len(hashes), np.int64)]), counters)
        yield pd.DataFrame({"hash": pd.array([*known.view(np.int64).tolist(), None, None],
                                             dtype="Int64"),
                            "kind": [0] * len(known) + [1, 2],
                            "n": [*counts.tolist(), rows, pairs]})

    sums = written(docs.mapInPandas(tidy(summarise), "hash long, kind int, n long")
                   .groupBy("kind", "hash").agg(F.sum("n").alias("n")), "shingle-summaries")
    totals = {r.kind: r.n for r in sums.filter("kind > 0").collect()}
    rows, pairs = totals.get(1, 0), totals.get(2, 0)
    candidates = sorted(r.hash for r in sums.filter("kind = 0").filter(
        F.col("n") * (counters + 1) > pairs).select("hash").collect())
    shared = spark.sparkContext.broadcast(np.sort(
        np.array(candidates, dtype=np.int64).view(np.uint64)))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted = shared.value
        found = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for _, texts in slabs(batch["text"].tolist()):
                hashes, _, _ = shingle_sets(texts)
                if len(wanted):
                    at = np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)
                    found += np.bincount(at[wanted[at] == hashes], minlength=len(wanted))
        yield pd.DataFrame({"hash": wanted[found > 0].view(np.int64), "n": found[found > 0]})

    least = 2.0 * pairs / (counters + 1)
    frequent = (docs.mapInPandas(tidy(count), "hash long, n long").groupBy("hash")
                .agg(F.sum("n").alias("n")).filter(F.col("n") > least).collect()
                if candidates else [])
    hashes = np.array([r.hash for r in frequent], dtype=np.int64).view(np.uint64)
    df = np.array([r.n for r in frequent], dtype=float)
    order = np.argsort(hashes)
    out = Weights(hashes[order], 1 + np.log((rows + 1) / (df[order] + 1)),
                  1 + float(np.log((rows + 1) / 2)) if rows else 1.0, rows)
    if least > 1:
        out.rare = rare_frequencies(docs, out.hashes, pairs)
    return out


def ref_of(node: str | Column) -> Column:
    """32 bits that stand for a node where rows are many.

    Nodes that share them get each other's frequencies as well, and take those of their own
    shingles (:func:`with_rare`); a frequency belongs to the shingle alone.
    """
    return F.hash(node)


def _planes(values: np.ndarray) -> bytes:
    """The bytes of numbers, the first bytes of all first: sorted numbers then compress."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def _unplaned(data: list[bytes], dtype: type) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    parts = [np.frombuffer(d, np.uint8).reshape(width, -1).T for d in data]
    return np.ascontiguousarray(np.concatenate(parts)).view(dtype).ravel()


def rare_frequencies(docs: DataFrame, frequent: np.ndarray, pairs: int) -> DataFrame:
    """``ref, hash, n``: a text's shingles in n > 1 documents that are not ``frequent``.

    The (document, shingle) pairs are dealt by range of the shingle's hash, as sorted blocks
    of numbers, and counted there; there are so many ranges that about ``RANGE_PAIRS``
    pairs meet in one, and none of these shingles is frequent.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    bits = max(1, int(pairs // RANGE_PAIRS).bit_length())
    shift = np.uint64(64 - bits)

    def blocks(hashes: list[np.ndarray], refs: list[np.ndarray]) -> pd.DataFrame:
        h, r = np.concatenate(hashes), np.concatenate(refs)
        order = np.argsort(h, kind="stable")
        h, r = h[order], r[order]
        of = (h >> shift).astype(np.int64)
        at = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(of) else []
        parts = list(zip(at, np.append(at[1:], len(h)), strict=True)) if len(of) else []
        return pd.DataFrame({"range": [int(of[i]) for i, _ in parts],
                             "hashes": [_planes(h[i:j]) for i, j in parts],
                             "refs": [_planes(r[i:j]) for i, j in parts]})

    def explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: tuple[list, list] = ([], [])
        count = 0
        for batch in batches:
            for first, texts in slabs(batch["text"].tolist()):
                hashes, _, sizes = shingle_sets(texts)
                refs = np.repeat(batch["ref"].to_numpy(np.int32)[first:first + len(texts)], sizes)
                if len(shared.value):
                    at = np.minimum(np.searchsorted(shared.value, hashes), len(shared.value) - 1)
                    other = shared.value[at] != hashes
                    hashes, refs = hashes[other], refs[other]
                held[0].append(hashes)
                held[1].append(refs)
                count += len(hashes)
                if count >= RANGE_PAIRS:
                    yield blocks(*held)
                    held, count = ([], []), 0
        if count:
            yield blocks(*held)

    def counted(hashes: list[bytes], refs: list[bytes]) -> Iterator[pd.DataFrame]:
        h, r = _unplaned(hashes, np.uint64), _unplaned(refs, np.int32)
        order = np.lexsort((r, h))
        h, r = h[order], r[order]
        new = np.append(True, h[1:] != h[:-1])
        starts = np.flatnonzero(new)
        n = np.diff(np.append(starts, len(h)))[np.cumsum(new) - 1]
        # equal texts have the same shingles: one row is enough
        keep = np.flatnonzero((n > 1) & (new | np.append(True, r[1:] != r[:-1])))
        for i in range(0, len(keep), 1 << 18):
            k = keep[i:i + (1 << 18)]
            yield pd.DataFrame({"ref": r[k], "hash": h[k].view(np.int64),
                                "n": n[k].astype(np.int32)})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, hashes, refs = None, [], []
        for batch in batches:
            for number, some, of in zip(batch["range"], batch["hashes"], batch["refs"],
                                        strict=True):
                if number != now and hashes:
                    yield from counted(hashes, refs)
                    hashes, refs = [], []
                now = number
                hashes.append(some)
                refs.append(of)
        if hashes:
            yield from counted(hashes, refs)

    rows = docs.select(ref_of(node_of(F.col("text"))).alias("ref"), "text").mapInPandas(
        tidy(explode), "range int, hashes binary, refs binary")
    dealt = rows.repartition("range").sortWithinPartitions("range")
    out = written(dealt.mapInPandas(tidy(count), "ref int, hash long, n int"), "rare")
    del rows, dealt  # their shuffle goes with them
    release(docs.sparkSession)
    return out


def with_lists(texts: DataFrame, weights: Weights) -> DataFrame:
    """``texts (node, text, …)`` plus ``rare_hash, rare_n``: the rare shingles of its reference.

    Null for a text without rare shingles.
    """
    if weights.rare is None:
        return texts.withColumns({"rare_hash": F.lit(None).cast("array<long>"),
                                  "rare_n": F.lit(None).cast("array<int>")})
    kept = texts.columns
    lists = (weights.rare.groupBy("ref").agg(F.collect_list(F.struct("hash", "n")).alias("rare"))
             .select("ref", F.col("rare.hash").alias("rare_hash"), F.col("rare.n").alias("rare_n")))
    return texts.withColumn("ref", ref_of("node")).join(lists, "ref", "left").select(
        *kept, "rare_hash", "rare_n")


def aligned(hashes: np.ndarray, known: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Document frequencies of a text's sorted shingles, 1 for those that are not ``known``."""
    own = np.ones(len(hashes), np.int32)
    if len(hashes):  # a node of the same reference may have other shingles
        known = np.asarray(known, np.int64).view(np.uint64)
        at = np.minimum(np.searchsorted(hashes, known), len(hashes) - 1)
        same = hashes[at] == known
        own[at[same]] = np.asarray(n, np.int32)[same]
    return own


def with_rare(texts: DataFrame, weights: Weights) -> DataFrame:
    """``texts (node, text, …)`` plus ``found``: document frequencies of its sorted shingles.

    As 32-bit numbers, 1 for those in the table of ``weights`` also; null where all are 1.
    """
    if weights.rare is None:
        return texts.withColumn("found", F.lit(None).cast("binary"))
    kept = texts.columns

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[kept].assign(found=[
                None if known is None else aligned(shingle_sets([text])[0], known, n).tobytes()
                for text, known, n in zip(batch["text"], batch["rare_hash"], batch["rare_n"],
                                          strict=True)])

    schema = ", ".join(f"{c} {t}" for c, t in texts.dtypes)
    return with_lists(texts, weights).mapInPandas(tidy(align), f"{schema}, found binary")


def frequencies_of(found: list[bytes | None], sizes: np.ndarray) -> np.ndarray | None:
    """The ``found`` of several texts in a row."""
    if all(f is None for f in found):
        return None
    return np.concatenate([np.ones(n, np.int32) if f is None else np.frombuffer(f, np.int32)
                           for f, n in zip(found, sizes.tolist(), strict=True)])


# ---- signatures -------------------------------------------------------------

@lru_cache(maxsize=2)
def _tables(functions: int, ceiling: float) -> tuple:
    """Random r, ln c and β by function and entry, and the samples at the ceiling weight."""
    random = np.random.default_rng(SEED)
    shape = (functions, 1 << TABLE_BITS)
    r = random.gamma(2.0, 1.0, shape)
    log_c = np.log(random.gamma(2.0, 1.0, shape))
    beta = random.random(shape)
    factors = random.integers(0, 1 << 63, functions, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return factors, r, log_c, beta, _sample(r, log_c, beta, np.log(ceiling))


def _sample(r: np.ndarray, log_c: np.ndarray, beta: np.ndarray, log_weight) -> np.ndarray:
    """ln a = ln c − r (⌊ln w / r + β⌋ − β + 1) as ordered bits in the upper half of a word."""
    log_a = log_c - r * (np.floor(log_weight / r + beta) - beta + 1.0)
    bits = np.exp(log_a).astype(np.float32).view(np.uint32)  # positive floats order as integers
    return bits.astype(np.uint64) << np.uint64(32)


def signatures(hashes: np.ndarray, weights: np.ndarray, sizes: np.ndarray, ceiling: float,
               functions: int = BANDS * ROWS) -> np.ndarray:
    """The samples of texts with shingles: a row per text, a column per function.

    A sample is the shingle of the smallest a, written as the bits of a and of
    the shingle's hash; as r, c and β belong to the shingle, equal a means an equal
    quantised weight. Most weights are the ceiling, whose samples are tabled.
    """
    factors, r, log_c, beta, tabled = _tables(functions, ceiling)
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    out = np.zeros((len(starts), functions), np.uint64)
    other = np.flatnonzero(weights != ceiling)
    log_weight = np.log(weights[other])
    low = hashes >> np.uint64(32)
    for k in range(functions if len(starts) else 0):
        entry = ((hashes * factors[k]) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        samples = tabled[k][entry]
        if len(other):
            e = entry[other]
            samples[other] = _sample(r[k][e], log_c[k][e], beta[k][e], log_weight)
        out[:, k] = np.minimum.reduceat(samples | low, starts)
    return out


def band_hashes(samples: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One hash per band of a signature."""
    rows = samples.shape[1] // bands
    out = np.zeros((len(samples), bands), np.uint64)
    for i in range(rows):
        out = mixed(out + samples[:, i::rows][:, :bands] + np.uint64(i + 1))
    return out


def node_of(text: Column) -> Column:
    """Equal texts are one node: 128 bits of their digest."""
    return F.unhex(F.md5(text))


def banded(docs: DataFrame, weights: Weights) -> DataFrame:
    """``doc_id, node, bands`` of all rows ``(doc_id, node, text)``."""
    shared = docs.sparkSession.sparkContext.broadcast(weights.table())
    rare = weights.rare is not None

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for batch in batches:
            ids = batch["doc_id"].astype("Int64")
            for first, texts in slabs(batch["text"].tolist()):
                hashes, counts, sizes = shingle_sets(texts)
                last = first + len(texts)
                found = None
                if rare:
                    starts = np.cumsum(sizes) - sizes
                    found = np.ones(len(hashes), np.int32)
                    for at, size, own, n in zip(
                            starts.tolist(), sizes.tolist(), batch["rare_hash"].array[first:last],
                            batch["rare_n"].array[first:last], strict=True):
                        if own is not None:
                            found[at:at + size] = aligned(hashes[at:at + size], own, n)
                bands = band_hashes(signatures(hashes, known.of(hashes, counts, found), sizes,
                                               known.ceiling)).view(np.int64)
                rows = iter(bands)
                yield pd.DataFrame({
                    "doc_id": ids.array[first:last], "node": batch["node"].array[first:last],
                    "bands": [next(rows) if n else [] for n in sizes.tolist()]})

    return with_lists(docs, weights).mapInPandas(
        tidy(sign), "doc_id long, node binary, bands array<long>")


# ---- verification -----------------------------------------------------------

def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two ``(sorted hashes, weights)``."""
    common, left, right = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = np.minimum(a[1][left], b[1][right]).sum() if len(common) else 0.0
    total = a[1].sum() + b[1].sum() - shared
    return float(shared / total) if total else 0.0


def verified(pairs: DataFrame, texts: DataFrame, weights: Weights, least: float) -> DataFrame:
    """The ``pairs`` (hub, node) whose texts are similar; a hot hub's pairs are split by Spark.

    ``pairs`` are of :func:`written`; ``texts``: node, text and found (of :func:`with_rare`).
    """
    shared = pairs.sparkSession.sparkContext.broadcast(weights.table())

    def vector(text: str, found: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        hashes, counts, sizes = shingle_sets([text])
        return hashes, shared.value.of(hashes, counts, frequencies_of([found], sizes))

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hub, known = None, None
        for batch in batches:
            keep = []
            for name, text, found, hub_text, hub_found in zip(
                    batch["hub"], batch["text"], batch["found"], batch["hub_text"],
                    batch["hub_found"], strict=True):
                if name != hub:
                    hub, known = name, vector(hub_text, hub_found)
                keep.append(similarity(known, vector(text, found)) >= least)
            yield batch.loc[keep, ["hub", "node"]]

    # few pairs are small as rows but not as work: tasks by their number
    dealt = pairs.repartition(pairs.count() // PAIRS_AT_ONCE + 1).sortWithinPartitions("hub")
    both = (dealt.join(texts, "node")
            .join(texts.select(F.col("node").alias("hub"), F.col("text").alias("hub_text"),
                               F.col("found").alias("hub_found")), "hub"))
    return both.select("hub", "node", "text", "found", "hub_text", "hub_found").mapInPandas(
        tidy(check), "hub binary, node binary")


# ---- components -------------------------------------------------------------

def joined_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``node, comp`` of few edges ``a, b``."""
    above: dict[bytes, bytes] = {}

    def top(node: bytes) -> bytes:
        while above.setdefault(node, node) != node:
            above[node] = node = above[above[node]]
        return node

    for batch in batches:
        for a, b in zip(batch["a"], batch["b"], strict=True):
            low, high = sorted((top(a), top(b)))
            above[high] = low
    yield pd.DataFrame({"node": list(above), "comp": [top(node) for node in above]})


def components(edges: DataFrame) -> DataFrame:
    """``node, comp`` of the nodes of ``edges (a, b)``: the smallest node of the component.

    Each round sets a node's label to the smallest among its neighbours' and
    then to that label's own label, until nothing changes. Up to ``FEW_EDGES`` edges
    are joined in one task.
    """
    edges = written(edges.select("a", "b").distinct(), "edges")
    if edges.limit(FEW_EDGES + 1).count() <= FEW_EDGES:
        return written(edges.coalesce(1).mapInPandas(
            tidy(joined_up), "node binary, comp binary"), "labels")
    both = written(edges.unionAll(edges.select("b", "a")).distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node"))
                     .agg(F.least(F.min("b"), F.first("a")).alias("comp")), "labels")
    while True:
        near = (both.join(labels, both.b == labels.node).groupBy("a")
                .agg(F.min("comp").alias("near")))
        step = (labels.join(near, labels.node == near.a)
                .select("node", "comp", F.least("comp", "near").alias("next")))
        jump = labels.select(F.col("node").alias("next"), F.col("comp").alias("far"))
        moved = written(step.join(jump, "next", "left").select(
            "node", F.coalesce(F.least("next", "far"), "next").alias("comp"),
            (F.coalesce(F.least("next", "far"), "next") != F.col("comp")).alias("changed")),
            "labels")
        labels = moved.select("node", "comp")
        if moved.filter("changed").isEmpty():
            return labels


def weight_limits(buckets: DataFrame, texts: DataFrame, weights: Weights) -> DataFrame:
    """``node, all, known``: weight of a text, and of its shingles that others have too.

    For the members of large buckets, others being all of these. The overlap of
    two of them is at most the smaller ``known``, and a similarity of s needs an
    overlap of s / (1 + s) of both weights together; so edited copies whose
    edits are their own are told apart without comparing them with each other.
    """
    shared = buckets.sparkSession.sparkContext.broadcast(weights.table())

    def explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            first = 0
            for _, group in slabs(batch["text"].tolist()):
                hashes, counts, sizes = shingle_sets(group)
                names = batch["node"].to_numpy()[first:first + len(group)]
                found = frequencies_of(batch["found"].tolist()[first:first + len(group)], sizes)
                first += len(group)
                yield pd.DataFrame({"node": np.repeat(names, sizes),
                                    "shingle": hashes.view(np.int64),
                                    "weight": shared.value.of(hashes, counts, found)})

    large = buckets.filter(F.col("n") > LARGE).select("node").distinct()
    rows = written(texts.join(large, "node").mapInPandas(
        tidy(explode), "node binary, shingle long, weight double")
        .withColumn("id", F.xxhash64("node")), "weights")
    own = (rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id"),
                                       F.max("weight").alias("weight"))
           .filter("n = 1").groupBy("id").agg(F.sum("weight").alias("own")))
    out = written(rows.groupBy("node", "id").agg(F.sum("weight").alias("all"))
                  .join(own, "id", "left")
                  .select("node", "all", (F.col("all") - F.coalesce("own", F.lit(0.0)))
                          .alias("known")), "limits")
    discard(rows)
    return out


def linked_classes(nodes: DataFrame, docs: DataFrame, weights: Weights,
                   least: float = SIMILARITY) -> DataFrame:
    """``node, comp`` of the texts that are linked to others; ``nodes``: node, doc_id, bands."""
    spark = nodes.sparkSession
    rows = nodes.select("node", F.posexplode("bands").alias("band", "hash"))
    shared = (rows.groupBy("band", "hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    buckets = written(rows.join(shared, ["band", "hash"])
                      .withColumn("bucket", F.xxhash64("band", "hash")), "buckets")
    # a text in the middle of a group shares more bands than its edited copies do
    degrees = buckets.groupBy("node").agg(F.sum("n").alias("degree"),
                                          F.collect_list("bucket").alias("own"))
    placed = buckets.join(degrees, "node").withColumn(
        "order", F.struct(-F.col("degree"), "node"))
    hubs = placed.groupBy("band", "hash").agg(F.min("order")["node"].alias("hub"))
    members = written(placed.drop("degree", "order").join(hubs, ["band", "hash"]), "members")
    texts = written(with_rare(
        docs.join(nodes.join(members.select("node").distinct(), "node")
                  .select("node", F.col("doc_id").alias("own")), "node")
        .filter(F.col("doc_id").eqNullSafe(F.col("own"))).select("node", "text"), weights),
        "texts")
    release(spark)
    tested = written(members.filter("node != hub").select("hub", "node").distinct(), "pairs")
    links = written(verified(tested, texts, weights, least), "links")
    release(spark)
    classes = components(links.select(F.col("hub").alias("a"), F.col("node").alias("b")))
    used = members.filter("node = hub").select("node", "bucket")
    limits = weight_limits(buckets, texts, weights)
    members = members.drop("band", "hash", "hub").join(limits, "node", "left")
    hubs_now = LARGE
    while True:
        led = used.groupBy("node").agg(F.collect_set("bucket").alias("led"))
        placed = written(
            members.join(classes, "node", "left").join(led, "node", "left")
            .withColumns({"comp": F.coalesce("comp", "node"),
                          "led": F.coalesce("led", F.array().cast("array<long>"))})
            .withColumn("able", ~F.array_contains("led", F.col("bucket")) & (
                (F.col("n") <= LARGE) | (F.col("known") >= least * F.col("all") - SLACK))),
            "placed")
        # members outside the bucket's largest class that may have links and were no hubs yet
        outside = (placed.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("size"),
                                                        F.count_if("able").alias("able"))
                   .groupBy("bucket").agg(
                       F.max_by(F.struct("comp", "able"), "size").alias("main"),
                       F.sum("able").alias("able"), F.count(F.lit(1)).alias("classes"))
                   .select("bucket", F.col("main.comp").alias("main"), "classes",
                           (F.col("able") - F.col("main.able")).alias("outside"))
                   .filter("classes > 1 and outside > 0").drop("classes"))
        # as many as hubs_now of a bucket, more or less; the same texts in all their buckets
        chance = F.pmod(F.xxhash64("node"), F.lit(1 << 20)) / float(1 << 20)
        chosen = written(
            placed.join(outside, "bucket").filter(
                F.col("able") & (F.col("comp") != F.col("main"))
                & (chance * F.col("outside") < hubs_now))
            .select("bucket", "node", "comp", "all", "known", "own", "led", "outside"), "hubs")
        open_ = outside.filter(F.col("outside") > hubs_now).select("bucket")
        ended = open_.isEmpty()
        if ended and chosen.isEmpty():
            return classes
        now = chosen.groupBy("node").agg(F.collect_list("bucket").alias("now"))
        # a pair that shares several buckets is tested once: not if either led one of them
        # before, and in the first of those that its hub leads now
        both = chosen.join(now, "node").alias("h").join(placed.alias("m"), (
            (F.col("h.bucket") == F.col("m.bucket")) & (F.col("h.comp") != F.col("m.comp"))
            & ((F.col("m.n") <= LARGE) | (
                F.least("h.known", "m.known") >= least / (1 + least)
                * (F.col("h.all") + F.col("m.all")) - SLACK))
            & ~F.arrays_overlap("h.led", "m.own") & ~F.arrays_overlap("m.led", "h.own")
            & (F.col("h.bucket") == F.array_min(F.array_intersect("h.now", "m.own")))))
        pairs = both.select(F.least("h.node", "m.node").alias("hub"),
                            F.greatest("h.node", "m.node").alias("node"))
        pairs = written(pairs.distinct(), "pairs")
        links = written(verified(pairs, texts, weights, least), "links")
        if not links.isEmpty():
            named = classes.select(F.col("node"), "comp")
            between = (links.join(named.select(F.col("node").alias("hub"),
                                               F.col("comp").alias("a")), "hub", "left")
                       .join(named.select("node", F.col("comp").alias("b")), "node", "left")
                       .select(F.coalesce("a", "hub").alias("a"), F.coalesce("b", "node").alias("b"),
                               "hub", "node"))
            merged_ = components(between.select("a", "b")).toDF("comp", "to")
            everyone = classes.unionAll(
                between.select(F.explode(F.array("hub", "node")).alias("node"))
                .join(classes, "node", "left_anti").distinct().select("node", F.col("node")))
            classes = written(everyone.toDF("node", "comp").join(merged_, "comp", "left").select(
                "node", F.coalesce("to", "comp").alias("comp")), "classes")
        if ended:
            return classes
        members = placed.drop("comp", "led", "able").join(open_, "bucket", "left_semi")
        used = used.unionAll(chosen.select("node", "bucket"))
        hubs_now *= MORE_HUBS
        release(spark)


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               least: float = SIMILARITY) -> DataFrame:
    """One row per input row: ``doc_id, node, class_id, class_size, kept``.

    ``class_id`` is the smallest id of the documents that are linked, directly
    or through others, by a similarity of ``least`` or more, and ``kept`` marks
    it. Equal texts (a null text is empty) are always of one class; texts
    without words are linked to equal texts only. Null ids count in their
    class but are kept only where a class has no other; repeated rows share one
    decision. An empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    rows = rows.select("doc_id", node_of(F.col("text")).alias("node"), "text")
    weights = shingle_weights(rows.select("text"))
    signed = written(banded(rows, weights), "signatures")
    nodes = written(signed.groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.any_value("bands").alias("bands")), "nodes")
    classes = linked_classes(nodes, rows, weights, least)
    release(docs.sparkSession)
    named = signed.select("doc_id", "node").join(classes, "node", "left").withColumn(
        "comp", F.coalesce("comp", "node"))
    named = written(named, "classes")
    sizes = named.groupBy("comp").agg(F.min("doc_id").alias("class_id"),
                                      F.count(F.lit(1)).alias("class_size"))
    return named.join(sizes, "comp").select(
        "doc_id", "node", "class_id", "class_size",
        F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row of ``docs``, with all its columns, of each class: that of the smallest id.

    Of repeated rows of that id and text one stays; of different texts in one
    class with that id, the one of the smallest digest.
    """
    marked = near_dedup(docs, least=least).filter("kept")
    chosen = marked.groupBy("class_id").agg(F.min("node").alias("_node"))
    no_id = marked.filter("class_id is null").select("class_id", F.col("node").alias("_node"))
    chosen = chosen.filter("class_id is not null").unionAll(no_id.distinct()).select(
        F.col("class_id").alias("_id"), "_node")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                       F.col("doc_id").alias("_id"), node_of(text_of("text")).alias("_node"))
    both = rows.alias("r").join(chosen.alias("c"), (F.col("r._node") == F.col("c._node"))
                                & F.col("r._id").eqNullSafe(F.col("c._id")))
    return (both.select("r.row", "r._id", "r._node").dropDuplicates(["_node", "_id"])
            .select("row.*"))
