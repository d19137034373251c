"""Benchmark decontamination by the q-gram lemma.

An occurrence of an item with at most e edits shares at least
(m − q + 1) − q·e of its q-grams with the text, on diagonals (text position −
item position) that differ by at most e. Shared q-grams are counted in bands of
2(e + 1) diagonals, each overlapping the next by half, so some band holds all of
an occurrence's; bands that reach the bound are verified by banded alignment,
thousands at once, from both ends: what items share with a text at one end only
is given up after the few characters that use up the edit budget. Items shorter
than a q-gram have no bound and must occur exactly, as whole words.

Every task reads whole documents and needs no other document: nothing is
shuffled, and a passage common to a third of the corpus costs each document its
own verification only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import give_back, text_of, tidy

Q = 12
#: Edits allowed, as a share of an item's length.
EDIT_RATE = 0.06
#: Longer items are searched as overlapping segments of this length.
SEGMENT = 512
#: Characters of benchmark text in one broadcast index; a larger benchmark takes more passes.
BLOCK_CHARS = 4_000_000
SLAB_CHARS = 1_000_000
#: Shared q-grams counted at once, where the least window of text has no more.
SHARED_GRAMS = 2_000_000
#: Bands aligned at once.
ALIGNED = 4096
BITS = 22
_BASE = np.uint64(0x9E3779B97F4A7C15)


def normalised(text: str) -> str:
    """Lower case, white space runs as one space."""
    return " ".join(text.lower().split())


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def gram_hashes(points: np.ndarray, q: int) -> np.ndarray:
    """A hash of each of the ``len − q + 1`` q-grams, built by doubling."""
    if len(points) < q:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        power = (points.astype(np.uint64) + np.uint64(1)) * _BASE
        power ^= power >> np.uint64(29)
        factor, length, done, left = _BASE, 1, None, q
        while True:
            if left & 1:  # append `length` more points to what is done
                if done is None:
                    done, size = power, length
                else:
                    n = len(points) - size - length + 1
                    done = done[:n] * factor + power[size:size + n]
                    size += length
            left >>= 1
            if not left:
                break
            n = len(power) - length
            power = power[:n] * factor + power[length:length + n]
            factor, length = factor * factor, 2 * length
        done = done * _BASE
        return done ^ (done >> np.uint64(32))


@dataclass
class Index:
    """Q-grams of benchmark segments, and for each segment its text and edit budget.

    ``short``: for each length below q, the items of that length by hash.
    """

    q: int
    items: list
    points: list[np.ndarray]
    lengths: np.ndarray
    budgets: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    segments: np.ndarray
    places: np.ndarray
    marked: np.ndarray
    short: dict[int, dict[int, list[tuple[object, str]]]]


def edit_budget(length: int, q: int, rate: float) -> int:
    """Most edits of an occurrence: the rate's share, and so few that the lemma's bound is positive."""
    return max(0, min(int(length * rate), (length - q) // q))


def build_index(items: list[tuple], q: int = Q, rate: float = EDIT_RATE,
                segment: int = SEGMENT) -> Index | None:
    """The index of ``(item_id, text)`` rows; None if no item has a character."""
    ids, points = [], []
    short: dict[int, dict[int, list[tuple[object, str]]]] = {}
    for item_id, text in items:
        item = normalised(text or "")
        whole = code_points(item)
        if 0 < len(whole) < q:
            key = int(gram_hashes(whole, len(whole))[0])
            short.setdefault(len(whole), {}).setdefault(key, []).append((item_id, item))
        last = max(0, len(whole) - segment)
        for start in [*range(0, last, segment // 2), last]:
            if len(whole) >= q:
                ids.append(item_id)
                points.append(whole[start:start + segment])
    if not ids and not short:
        return None
    grams = [gram_hashes(p, q) for p in points]
    hashes = np.concatenate([*grams, np.zeros(0, np.uint64)])
    segments = np.repeat(np.arange(len(grams), dtype=np.int32), [len(g) for g in grams])
    places = np.concatenate([*(np.arange(len(g), dtype=np.int32) for g in grams),
                             np.zeros(0, np.int32)])
    order = np.argsort(hashes, kind="stable")
    unique, first = np.unique(hashes[order], return_index=True)
    marked = np.zeros(1 << BITS, bool)
    marked[(unique >> np.uint64(64 - BITS)).astype(np.int64)] = True
    return Index(q, ids, points, np.array([len(p) for p in points], np.int64),
                 np.array([edit_budget(len(p), q, rate) for p in points], np.int64),
                 unique, np.append(first, len(hashes)), segments[order], places[order], marked,
                 short)


def align_bands(text: np.ndarray, items: list[np.ndarray], low: np.ndarray, start: np.ndarray,
                stop: np.ndarray, budget: int, most: int = SEGMENT
                ) -> tuple[np.ndarray, np.ndarray]:
    """Fewest edits of each item against a part of ``text[start:stop]``, and where that part ends.

    For each item only cells on the ``4·budget + 3`` diagonals from its ``low``
    on are filled; the part may begin and end anywhere. More than ``budget``
    edits are given as ``budget + 1``. Of an item's characters only the first
    ``most`` are read: the edits are those that these take at least.
    """
    width, far = 4 * budget + 3, budget + 1
    lengths = np.array([len(i) for i in items])
    longest = int(lengths.max())
    chars = np.zeros((len(items), longest), np.uint32)
    for row, item in zip(chars, items, strict=True):
        row[:len(item)] = item
    at = low[:, None] + np.arange(longest + width + 1)
    window = text[np.clip(at[:, :-1], 0, len(text) - 1)]
    # states before the text's start or after its end are out of reach
    outside = np.where((at >= start[:, None]) & (at <= stop[:, None]), 0, far).astype(np.int16)
    steps = np.arange(width, dtype=np.int16)
    edits, ends = np.full(len(items), far), np.zeros(len(items), np.int64)
    cost, row = outside[:, :width].copy(), np.arange(len(items))
    for i in range(min(longest, most)):
        change = cost + (window[:, i:i + width] != chars[:, i:i + 1])
        change += outside[:, i:i + width]  # of a character before the start
        change[:, :-1] = np.minimum(change[:, :-1], cost[:, 1:] + 1)  # item's without partner
        # text's without partner
        cost = np.minimum.accumulate(change - steps, axis=1) + steps + outside[:, i + 1:i + 1 + width]
        np.minimum(cost, far, out=cost)
        done = (lengths == i + 1) if i + 1 < most else np.ones(len(row), bool)
        if done.any():
            best = cost[done].argmin(axis=1)
            edits[row[done]] = cost[done, best]
            ends[row[done]] = at[done, i + 1 + best]
        alive = (cost.min(axis=1) <= budget) & ~done
        left = int(alive.sum())
        if not left:
            break
        if left < 0.75 * len(row):
            cost, row, lengths, at = cost[alive], row[alive], lengths[alive], at[alive]
            chars, window, outside = chars[alive], window[alive], outside[alive]
    return edits, ends


def windows_of(at: np.ndarray, counts: np.ndarray) -> Iterator[slice]:
    """Runs of hits with about ``SHARED_GRAMS`` shared q-grams; each overlaps the next by a band."""
    total = np.cumsum(counts)
    begin = 0
    while begin < len(at):
        before = int(total[begin - 1]) if begin else 0
        stop = max(int(np.searchsorted(total, before + SHARED_GRAMS, side="right")),
                   int(np.searchsorted(at, at[begin] + 4 * SEGMENT)))
        yield slice(begin, stop)
        if stop >= len(at):
            return
        begin = max(begin + 1, int(np.searchsorted(at, at[stop] - 2 * SEGMENT)))


def find_items(index: Index, points: np.ndarray, ends: np.ndarray
               ) -> Iterator[tuple[int, int, int, int]]:
    """``(text, segment, edits, end)`` of the occurrences in texts that end before ``ends``."""
    hashes = gram_hashes(points, index.q)
    if not len(index.hashes):
        return
    at = np.flatnonzero(index.marked[(hashes >> np.uint64(64 - BITS)).astype(np.int64)])
    found = np.searchsorted(index.hashes, hashes[at])
    hit = index.hashes[np.minimum(found, len(index.hashes) - 1)] == hashes[at]
    at, found = at[hit], found[hit]
    counts = index.first[found + 1] - index.first[found]
    for part in windows_of(at, counts):
        yield from _find_in_window(index, points, ends, at[part], found[part], counts[part])


def _find_in_window(index: Index, points: np.ndarray, ends: np.ndarray, at: np.ndarray,
                    found: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    text = np.repeat(np.searchsorted(ends, at, side="right"), counts)
    at = np.repeat(at, counts)
    entry = np.repeat(index.first[found] - np.append(0, np.cumsum(counts)[:-1]), counts)
    entry += np.arange(len(entry))
    segment = index.segments[entry].astype(np.int64)
    step = index.budgets[segment] + 1
    bands = len(points) + 2 * SEGMENT
    # 1 for the lower of the two bands of the first diagonals
    band = (at - index.places[entry] + SEGMENT) // step + 1
    key = (text * len(index.points) + segment) * bands + band
    keys, shared = np.unique(np.concatenate([key, key - 1]), return_counts=True)
    band = keys % bands - 1
    text, segment = np.divmod(keys // bands, len(index.points))
    lengths, budgets = index.lengths[segment], index.budgets[segment]
    start = np.where(text > 0, ends[text - 1], 0)
    stop = ends[text] - 1
    enough = np.flatnonzero(
        (shared >= np.maximum(1, lengths - index.q + 1 - index.q * budgets))
        & (stop - start >= lengths - budgets))
    enough = enough[np.lexsort((lengths[enough], budgets[enough]))]
    changes = np.flatnonzero(np.diff(budgets[enough])) + 1
    for same in np.split(enough, changes):
        for k in range(0, len(same), ALIGNED):
            some = same[k:k + ALIGNED]
            budget = int(budgets[some[0]])
            low = band[some] * (budget + 1) - SEGMENT - budget
            yield from _verified(index, points, segment[some], text[some], low, start[some],
                                 stop[some], budget)


def _verified(index: Index, points: np.ndarray, segment: np.ndarray, text: np.ndarray,
              low: np.ndarray, start: np.ndarray, stop: np.ndarray, budget: int
              ) -> Iterator[tuple[int, int, int, int]]:
    """Alignment of a few characters at both ends, then of whole items where these succeed."""
    items = [index.points[s] for s in segment]
    size, high = len(points), low + 4 * budget + 2
    kept = np.arange(len(items))
    few = 3 * (budget + 1)
    for most in (few, SEGMENT):
        edits, _ = align_bands(
            points[::-1], [items[k][::-1] for k in kept],
            size - index.lengths[segment[kept]] - high[kept], size - stop[kept],
            size - start[kept], budget, most)
        kept = kept[edits <= budget]
        if not len(kept):
            return
        edits, ends = align_bands(points, [items[k] for k in kept], low[kept], start[kept],
                                  stop[kept], budget, most)
        kept, edits, ends = kept[edits <= budget], edits[edits <= budget], ends[edits <= budget]
        if not len(kept):
            return
    for k, e, end in zip(kept, edits, ends, strict=True):
        yield int(text[k]), int(segment[k]), int(e), int(end - start[k])


def find_short_items(index: Index, joined: str, points: np.ndarray
                     ) -> Iterator[tuple[object, int, int]]:
    """``(item_id, start, end)`` of the short items that occur as whole words."""
    if not index.short:
        return
    known, where = np.unique(points, return_inverse=True)
    letter = np.array([chr(c).isalnum() for c in known], bool)[where]
    letter = np.concatenate([[False], letter, [False]])
    for length, by_hash in index.short.items():
        hashes = gram_hashes(points, length)
        at = np.flatnonzero(np.isin(hashes, np.array(list(by_hash), np.uint64)))
        # no letter next to a letter of the item's ends
        at = at[~(letter[at] & letter[at + 1])
                & ~(letter[at + length] & letter[at + length + 1])]
        for start in at.tolist():
            here = joined[start:start + length]
            for item_id, item in by_hash[int(hashes[start])]:
                if item == here:
                    yield item_id, start, start + length


def scan_texts(index: Index, texts: list[str], inner: list[tuple[bool, bool]]) -> list[dict]:
    """For each normalised text, its items: item number → (edits, end), the fewest edits first.

    ``inner``: whether a text goes on before its start and after its end; short
    items at such an edge are left to the piece that holds their neighbour too.
    """
    out = [{} for _ in texts]
    joined = "\n".join(texts)
    points = code_points(joined)
    ends = np.cumsum([len(t) + 1 for t in texts])
    for text, segment, edits, end in find_items(index, points, ends):
        item, here = index.items[segment], (edits, end)
        out[text][item] = min(out[text].get(item, here), here)
    for item, start, end in find_short_items(index, joined, points):
        text = int(np.searchsorted(ends, start, side="right"))
        base = int(ends[text - 1]) if text else 0
        before, after = inner[text]
        if not (before and start == base or after and end == ends[text] - 1):
            here = (0, end - base)
            out[text][item] = min(out[text].get(item, here), here)
    return out


def pieces(text: str, size: int = SLAB_CHARS, overlap: int = 2 * SEGMENT) -> Iterator[tuple[int, str]]:
    """A very long text in overlapping pieces, with their offsets."""
    for start in range(0, max(1, len(text) - overlap), size):
        yield start, text[start:start + size + overlap]


def match_batch(index: Index, texts: list[str]) -> Iterator[tuple[int, object, int, int]]:
    """``(row, item_id, edits, end)`` for each item a text contains; slabs bound the memory."""
    best: dict = {}
    slab, rows, inner, chars = [], [], [], 0
    least = min(index.short, default=index.q)

    def flush() -> None:
        for (row, offset), items in zip(rows, scan_texts(index, slab, inner), strict=True):
            for item, (edits, end) in items.items():
                here = (edits, end + offset)
                best[row, item] = min(best.get((row, item), here), here)

    for row, text in enumerate(texts):
        whole = normalised(text)
        for offset, piece in pieces(whole):
            if len(piece) < least:
                continue
            slab.append(piece)
            rows.append((row, offset))
            inner.append((offset > 0, offset + len(piece) < len(whole)))
            chars += len(piece)
            if chars >= SLAB_CHARS:
                flush()
                slab, rows, inner, chars = [], [], [], 0
    if slab:
        flush()
    for (row, item), (edits, end) in sorted(best.items(), key=lambda x: x[0][0]):
        yield row, item, edits, end


def benchmark_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple]]:
    """The benchmark's rows in blocks of about ``block_chars`` characters."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                            text_of("text").alias("text"))
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    count = -(-total // block_chars)
    for n in range(count):
        part = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == n)
        yield [tuple(r) for r in part.orderBy("item_id", "text").collect()]


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text", q: int = Q, rate: float = EDIT_RATE) -> DataFrame:
    """``doc_id, item_id, edits, end_char``: the benchmark items each document contains.

    Texts are compared in lower case with white space runs as one space. An item
    is contained if some part of the document differs from it (or from a
    512-character segment of a longer item) by at most ``rate`` of its length in
    edits; ``end_char`` is where the closest such part ends in the normalised
    text. Items of fewer than q characters are contained where they occur exactly
    and as whole words. Null and empty texts contain nothing, null and empty
    items are contained nowhere; repeated rows give repeated results; an empty
    table on either side gives no rows; other columns are ignored.
    """
    schema = "doc_id long, item_id long, edits int, end_char long"
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       text_of(text_col).alias("text"))
    out = docs.sparkSession.createDataFrame([], schema)
    for block in benchmark_blocks(benchmark):
        out = out.unionAll(rows.mapInPandas(tidy(_matcher(docs, block, q, rate)), schema))
    return out


class _Block:
    """A block's rows, shared with the tasks, which make their index of them."""

    def __init__(self, docs: DataFrame, rows: list[tuple], q: int, rate: float):
        self.shared = docs.sparkSession.sparkContext.broadcast(rows)
        self.key, self.q, self.rate = uuid4().hex, q, rate

    def match(self, texts: list[str]) -> Iterator[tuple[int, object, int, int]]:
        index = _index_of(self)
        return match_batch(index, texts) if index else iter(())


_made: dict[str, Index | None] = {}


def _index_of(block: _Block) -> Index | None:
    """The block's index, made once in a worker; a worker holds one block's at a time."""
    if block.key not in _made:
        _made.clear()
        _made[block.key] = build_index(block.shared.value, block.q, block.rate)
    return _made[block.key]


def _matcher(docs: DataFrame, rows: list[tuple], q: int, rate: float):
    block = _Block(docs, rows, q, rate)

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = list(block.match(batch["text"].tolist()))
            ids = batch["doc_id"].astype("Int64").array[[f[0] for f in found]]
            yield pd.DataFrame({
                "doc_id": ids, "item_id": pd.array([f[1] for f in found], dtype="Int64"),
                "edits": pd.array([f[2] for f in found], dtype="int32"),
                "end_char": pd.array([f[3] for f in found], dtype="int64")})

    return match


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                      q: int = Q, rate: float = EDIT_RATE) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text contains no benchmark item.

    The decision is made row by row as in :func:`contaminated`, so rows without
    or with repeated ids are kept or dropped by their own text.
    """
    for block in benchmark_blocks(benchmark):
        docs = docs.filter(_clean(docs, block, q, rate)(F.col(text_col)))
    return docs


def _clean(docs: DataFrame, rows: list[tuple], q: int, rate: float):
    block = _Block(docs, rows, q, rate)

    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        dirty = {f[0] for f in block.match(texts.fillna("").tolist())}
        give_back()
        return pd.Series([i not in dirty for i in range(len(texts))], dtype=bool)

    return clean
