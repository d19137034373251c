"""Substring de-duplication with suffix automata of reference shards.

A window is ``WINDOW`` consecutive words of one document; a word goes if some
window over it also occurs in a document with a smaller id.

Finding what to compare. Each window's minimizer (its smallest 8-word hash) cuts
a document into runs of windows with one minimizer, about one run per 22 words.
Equal windows have equal minimizers, so only runs whose minimizer occurs in
several documents matter. A run whose whole content occurs earlier refers to
the first document with it; the windows of other such runs are looked up one by
one for the first document that has them. First occurrences are the reference:
every repeated window is in it, and a passage in a third of all documents is
in it once.

Comparing. The reference is cut into shards of bounded size. A shard's suffix
automaton goes to every task that has documents with references into it, and
the documents stream through it: matching statistics give at each word the
longest match that ends there, and maximal spans of matches of ``WINDOW`` words
or more, whose first document is smaller, are removed. Groups of documents for
one shard are split, so a reference used by a third of all documents is sent to
many tasks.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import discard, text_of, written
from cohortlens.llm.words import (
    gram_hashes, mixed, prefix_sums, range_hash, slabs, sliding_min, word_hashes)

WINDOW = 50
GRAM = 8
#: Words of documents per shard and per task of a shard; windows of one unit of a document.
SHARD_WORDS = 65_536
TASK_WORDS = 262_144
UNIT_WINDOWS = 16_384


class SuffixAutomaton:
    """The substrings of token sequences; each state knows the smallest document it occurs in."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = array("q", [-1])
        self.length = array("q", [0])
        self.first = [float("inf")]
        self.last = 0

    def add(self, tokens: list, doc: int) -> None:
        """Add a sequence; no match crosses from one added sequence to another."""
        self.last = 0
        for token in tokens:
            self._extend(token, doc)

    def _extend(self, token, doc: int) -> None:
        nexts, link, length, first = self.next, self.link, self.length, self.first
        p = self.last
        known = nexts[p].get(token)
        if known is not None:  # another sequence goes on like this
            if length[known] == length[p] + 1:
                self.last = known
            else:
                self.last = self._clone(p, token, known)
            first[self.last] = min(first[self.last], doc)
            return
        new = len(nexts)
        nexts.append({})
        length.append(length[p] + 1)
        link.append(0)
        first.append(doc)
        while p >= 0 and token not in nexts[p]:
            nexts[p][token] = new
            p = link[p]
        if p >= 0:
            q = nexts[p][token]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, token, q)
        self.last = new

    def _clone(self, p: int, token, q: int) -> int:
        nexts, link, length = self.next, self.link, self.length
        clone = len(nexts)
        nexts.append(dict(nexts[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        self.first.append(float("inf"))
        link[q] = clone
        while p >= 0 and nexts[p].get(token) == q:
            nexts[p][token] = clone
            p = link[p]
        return clone

    def finish(self) -> None:
        """Pass first documents on to all suffixes."""
        order = np.argsort(np.frombuffer(self.length, dtype=np.int64), kind="stable")
        first, link = self.first, self.link
        for state in order[:0:-1].tolist():
            up = link[state]
            if first[state] < first[up]:
                first[up] = first[state]

    def covered(self, tokens: list, doc: int, window: int) -> list[tuple[int, int]]:
        """Maximal spans of ``tokens`` under matches of ``window`` tokens of a smaller document.

        ``size`` is the matching statistic, cut to the state whose substrings
        include the last ``window`` tokens.
        """
        nexts, link, length, first = self.next, self.link, self.length, self.first
        spans: list[tuple[int, int]] = []
        state = size = 0
        start = end = -1
        for i, token in enumerate(tokens):
            to = nexts[state].get(token)
            while to is None and state:
                state = link[state]
                size = length[state]
                to = nexts[state].get(token)
            if to is None:
                size = 0
                continue
            state, size = to, size + 1
            if size >= window:
                while length[link[state]] >= window:
                    state = link[state]
                    size = length[state]
                if first[state] < doc:
                    if i + 1 - window > end:
                        if end >= 0:
                            spans.append((start, end))
                        start = i + 1 - window
                    end = i + 1
        if end >= 0:
            spans.append((start, end))
        return spans


def window_runs(words: np.ndarray, counts: np.ndarray, window: int = WINDOW, gram: int = GRAM
                ) -> tuple[np.ndarray, ...]:
    """Runs of windows with one minimizer: text number, first window, windows, minimizer, content."""
    ends = np.cumsum(counts)
    if len(words) < window:
        return tuple(np.zeros(0, t) for t in (int, int, int, np.uint64, np.uint64))
    smallest = sliding_min(gram_hashes(words, gram), window - gram + 1)
    text = np.repeat(np.arange(len(counts)), counts)
    at = np.flatnonzero(text[:len(smallest)] == text[window - 1:])
    least = smallest[at]
    new = np.flatnonzero(np.concatenate([
        [True] * bool(len(at)), (least[1:] != least[:-1]) | (np.diff(at) != 1)]))
    first, size = at[new], np.diff(np.append(new, len(at)))
    content = range_hash(prefix_sums(words), first, first + size + window - 1)
    number = text[first]
    return number, first - (ends - counts)[number], size, least[new], content


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def document_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, key, first, windows, minimizer, content``: the runs of all documents."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, keys = batch["doc_id"].to_numpy(), batch["key"].to_numpy()
            for begin, texts in slabs(batch["text"].tolist()):
                number, first, size, least, content = window_runs(*word_hashes(texts))
                yield pd.DataFrame({
                    "doc_id": ids[begin + number], "key": keys[begin + number], "first": first,
                    "windows": size, "minimizer": _signed(least), "content": _signed(content)})

    return docs.mapInPandas(cut, "doc_id long, key long, first int, windows int, "
                                 "minimizer long, content long")


def repeated_runs(runs: DataFrame) -> DataFrame:
    """Per document, its runs whose minimizer other documents have too.

    ``runs``: a list of ``first, windows, ref_doc, ref_first, shared``: the first
    document with the run's content (itself if that is new), and whether others have it.
    """
    several = (runs.groupBy("minimizer")
               .agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
               .filter("a < b").select("minimizer"))
    some = written(runs.join(several, "minimizer"), "repeated-runs")
    contents = some.groupBy("minimizer", "content").agg(
        F.min("doc_id").alias("ref_doc"), F.max("doc_id").alias("last_doc"),
        F.min_by("first", "doc_id").alias("ref_first"))
    known = contents.withColumn("shared", F.col("ref_doc") < F.col("last_doc")).drop("last_doc")
    lists = written(some.join(known, ["minimizer", "content"]).groupBy("doc_id", "key").agg(
        F.collect_list(F.struct("first", "windows", "ref_doc", "ref_first", "shared"))
        .alias("runs")), "run-lists")
    discard(some)
    return lists


RUN_FIELDS = ("first", "windows", "ref_doc", "ref_first", "shared")


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of all ranges ``first .. first + size`` in a row."""
    size = size.astype(np.int64)
    before = np.cumsum(size) - size
    return np.repeat(first - before, size) + np.arange(size.sum())


def segments(docs: DataFrame, plan: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document of ``plan``, the word hashes under its runs and the hashes of new windows.

    ``starts, sizes, words``: segments of words and their hashes in a row;
    ``places, hashes``: the windows of runs whose content has no earlier document,
    ``fresh`` where a window is the first of its kind in the document. The
    fields of the plan's runs are kept as lists.
    """
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = batch.drop(columns="text").itertuples(index=False)
            for _, texts in slabs(batch["text"].tolist()):
                words, counts = word_hashes(texts)
                ends = np.cumsum(counts).tolist()
                out = [one(next(rows), words[end - n:end])
                       for end, n in zip(ends, counts.tolist(), strict=True)]
                yield pd.DataFrame(out, columns=["doc_id", "key", *RUN_FIELDS, "starts", "sizes",
                                                 "words", "places", "hashes", "fresh"])

    def one(row, words: np.ndarray) -> tuple:
        inside = np.zeros(len(words) + 1, np.int64)
        np.add.at(inside, row.first, 1)
        np.add.at(inside, row.first + row.windows + window - 1, -1)
        under = np.cumsum(inside) > 0
        edge = np.diff(under.astype(np.int8), prepend=0)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        new = row.ref_doc >= row.doc_id
        places = np.unique(_ranges(row.first[new], row.windows[new]))
        hashes = range_hash(prefix_sums(words), places, places + window)
        fresh = np.zeros(len(places), bool)
        fresh[np.unique(hashes, return_index=True)[1]] = True
        return (*row, starts, ends - starts, _signed(words[under[:-1]]), places,
                _signed(hashes), fresh)

    lists = plan.select("doc_id", "key", *(F.col(f"runs.{f}").alias(f) for f in RUN_FIELDS))
    return docs.join(lists, ["doc_id", "key"]).select("doc_id", "key", *RUN_FIELDS, "text"
        ).mapInPandas(cut, (
            "doc_id long, key long, first array<int>, windows array<int>, ref_doc array<long>, "
            "ref_first array<int>, shared array<boolean>, starts array<int>, sizes array<int>, "
            "words array<long>, places array<int>, hashes array<long>, fresh array<boolean>"))


def first_windows(cut: DataFrame) -> DataFrame:
    """Per document, ``found``: the first document and place of its new windows that others have."""
    windows = cut.select("doc_id", "key", F.explode(F.arrays_zip("hashes", "places", "fresh"))
                         .alias("w")).filter("w.fresh")
    rows = written(windows.select("doc_id", "key", F.col("w.hashes").alias("hash"),
                                  F.col("w.places").alias("place")), "windows")
    first = (rows.groupBy("hash")
             .agg(F.min("doc_id").alias("ref_doc"), F.max("doc_id").alias("last_doc"),
                  F.min_by("place", "doc_id").alias("ref_place"))
             .filter("ref_doc < last_doc").drop("last_doc"))
    lists = written(rows.join(first, "hash").groupBy("doc_id", "key")
                    .agg(F.collect_list(F.struct("hash", "ref_doc", "ref_place")).alias("found")),
                    "first-windows")
    discard(rows)
    return lists


def shard_of(doc_ids: np.ndarray, places: np.ndarray, shards: int) -> np.ndarray:
    """The shard of reference windows: by document, and by unit of a very long one."""
    unit = doc_ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed(unit + (places // UNIT_WINDOWS).astype(np.uint64))
            % np.uint64(shards)).astype(np.int64)


def _spans(shard: np.ndarray, place: np.ndarray, window: int) -> Iterator[tuple]:
    """``(shard, starts, sizes in words)`` for the windows ``place`` that concern each shard."""
    both = np.unique((shard << 32) | place)
    shard, place = both >> 32, both & 0xFFFFFFFF
    for part in np.split(np.arange(len(both)), np.flatnonzero(np.diff(shard)) + 1):
        if len(part):
            p = place[part]
            new = np.flatnonzero(np.diff(p, prepend=-window - 1) > window)
            last = np.append(p[new[1:] - 1], p[-1])
            yield int(shard[part[0]]), p[new], last - p[new] + window


def shard_rows(cut: DataFrame, found: DataFrame, shards: int, window: int = WINDOW) -> DataFrame:
    """``shard, reference, doc_id, key, starts, sizes, words, n``.

    Reference rows hold the windows a document is the first to have; the others
    the windows of a document that a shard's reference may have earlier.
    """
    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, held = [], 0
            for row in batch.itertuples(index=False):
                for part in rows_of(row):
                    out.append(part)
                    held += part[-1]
                if held > 2_000_000:
                    yield frame(out)
                    out, held = [], 0
            yield frame(out)

    def rows_of(row) -> Iterator[tuple]:
        old = row.ref_doc < row.doc_id  # whole runs that an earlier document has
        own = [_ranges(row.first[~old & row.shared], row.windows[~old & row.shared])]
        places = [_ranges(row.first[old], row.windows[old])]
        ref_docs = [np.repeat(row.ref_doc[old], row.windows[old])]
        ref_places = [_ranges(row.ref_first[old], row.windows[old])]
        if row.hash is not None and len(row.hash):
            order = np.argsort(row.hash)
            known = row.hash[order]
            near = np.minimum(np.searchsorted(known, row.hashes), len(known) - 1)
            hit = known[near] == row.hashes
            place, near = row.places[hit], order[near[hit]]
            earlier = row.found_doc[near] < row.doc_id
            own.append(place[~earlier])
            places.append(place[earlier])
            ref_docs.append(row.found_doc[near][earlier])
            ref_places.append(row.found_place[near][earlier])
        own, places = (np.concatenate(x).astype(np.int64) for x in (own, places))
        offsets = np.concatenate([[0], np.cumsum(row.sizes)])
        routed = (
            (True, shard_of(np.full(len(own), row.doc_id), own, shards), own),
            (False, shard_of(np.concatenate(ref_docs), np.concatenate(ref_places), shards), places))
        for reference, shard, place in routed:
            for number, starts, sizes in _spans(shard, place, window):
                segment = np.searchsorted(row.starts, starts, side="right") - 1
                begin = offsets[segment] + starts - row.starts[segment]
                words = row.words[_ranges(begin, sizes)]
                yield number, reference, row.doc_id, row.key, starts, sizes, words, len(words)

    def frame(out: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(out, columns=["shard", "reference", "doc_id", "key", "starts",
                                          "sizes", "words", "n"])

    lists = found.select("doc_id", "key", F.col("found.hash").alias("hash"),
                         F.col("found.ref_doc").alias("found_doc"),
                         F.col("found.ref_place").alias("found_place"))
    return cut.drop("fresh").join(lists, ["doc_id", "key"], "left").mapInPandas(route, (
        "shard long, reference boolean, doc_id long, key long, starts array<int>, "
        "sizes array<int>, words array<long>, n long"))


def repeated_spans(rows: DataFrame, window: int = WINDOW, task_words: int = TASK_WORDS
                   ) -> DataFrame:
    """``doc_id, key, starts, ends``: spans of words that a smaller document has, by shard.

    A shard's reference goes to as many tasks as its documents fill.
    """
    tasks = (rows.filter("not reference").groupBy("shard").agg(F.sum("n").alias("words"))
             .select("shard", F.ceil(F.col("words") / task_words).alias("tasks")))
    own = F.array(F.pmod("key", "tasks"))
    dealt = (rows.join(tasks, "shard")
             .withColumn("task", F.explode(
                 F.when(F.col("reference"), F.sequence(F.lit(0).cast("long"), F.col("tasks") - 1))
                 .otherwise(own))))

    def match(group: pd.DataFrame) -> pd.DataFrame:
        queries, out = group[~group["reference"]], []
        if len(queries):
            automaton = SuffixAutomaton()
            for row in group[group["reference"]].sort_values("doc_id").itertuples(index=False):
                for words in np.split(row.words, np.cumsum(row.sizes)[:-1]):
                    automaton.add(words.tolist(), row.doc_id)
            automaton.finish()
            for row in queries.itertuples(index=False):
                spans = [(start + a, start + b)
                         for start, words in zip(row.starts, np.split(
                             row.words, np.cumsum(row.sizes)[:-1]), strict=True)
                         for a, b in automaton.covered(words.tolist(), row.doc_id, window)]
                if spans:
                    starts, ends = zip(*spans, strict=True)
                    out.append((row.doc_id, row.key, list(starts), list(ends)))
        return pd.DataFrame(out, columns=["doc_id", "key", "starts", "ends"])

    # dealt by task as well: after a join on the shard, grouping alone would leave all tasks of
    # a shard in one partition
    return (dealt.select("shard", "task", "reference", "doc_id", "starts", "sizes", "words", "key")
            .repartition("shard", "task").groupBy("shard", "task")
            .applyInPandas(match, "doc_id long, key long, starts array<int>, ends array<int>"))


def removed_spans(docs: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``doc_id, key, starts, ends`` of the documents ``(doc_id, key, text)`` that lose words."""
    known = docs.filter("doc_id is not null")
    runs = written(document_runs(known), "runs")
    plan = repeated_runs(runs)
    discard(runs)
    cut = written(segments(known, plan), "segments")
    discard(plan)
    total = cut.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))
                    ).first()[0] or 0
    found = first_windows(cut)
    rows = written(shard_rows(cut, found, max(1, -(-total // shard_words))), "shards")
    discard(cut, found)
    spans = written(repeated_spans(rows), "spans")
    discard(rows)
    return spans.groupBy("doc_id", "key").agg(F.flatten(F.collect_list("starts")).alias("starts"),
                                              F.flatten(F.collect_list("ends")).alias("ends"))


def kept_words(text: str, starts, ends) -> tuple[list[bytes], int]:
    """The words of ``text`` outside the spans, and the number of all its words."""
    words = text.encode("utf-8", "surrogatepass").split()
    if starts is None or not len(starts):
        return words, len(words)
    inside = np.zeros(len(words) + 1, np.int64)
    np.add.at(inside, starts, 1)
    np.add.at(inside, ends, -1)
    gone = np.cumsum(inside[:-1]) > 0
    return [w for w, g in zip(words, gone.tolist(), strict=True) if not g], len(words)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    with_text: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row (and ``kept``, the words left).

    Windows are judged on the whole input, not on what is left of it. Texts
    shorter than a window lose nothing; a null text has no words; a row without
    id loses nothing and nobody loses words to it; repeated rows lose the same,
    and rows that share an id do not lose words to each other. An empty table
    gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    rows = rows.withColumn("key", F.xxhash64("doc_id", "text"))
    removed = removed_spans(rows)

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, starts, ends in zip(batch["text"], batch["starts"], batch["ends"],
                                          strict=True):
                words, total = kept_words(text, starts, ends)
                kept = b" ".join(words)
                out.append((total, total - len(words), hashlib.sha256(kept).hexdigest(),
                            kept.decode("utf-8", "surrogatepass") if with_text else None))
            result = pd.DataFrame(out, columns=["n_words", "n_removed", "kept_sha256", "kept"])
            result.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy(dtype=object))
            yield result.astype({"doc_id": "Int64"})

    result = rows.join(removed, ["doc_id", "key"], "left").select(
        "doc_id", "text", "starts", "ends").mapInPandas(
        finish, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
    return result if with_text else result.drop("kept")
