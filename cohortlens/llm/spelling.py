"""Spelling variant grouping over permuterm rotations.

A word with a terminator at its end has one rotation for each of its places. For a
word ``x c y``, the rotation ``y $ x c`` ends with the character ``c``; the words near
it by an edit at that place are those with a rotation in the range of the prefix
``y $ x``, whatever follows for one character (a replacement) or nothing (``x y``, from
which ``c`` was deleted). So each rotation is a row under its prefix without the last
character, and also a row under itself; sorted by that prefix, the rows of an edit
are next to one another and one scan of a group finds all its neighbours.

Rotations of a word take the square of its length, so prefixes of more than ``LONG``
characters are replaced by two digests, of what comes before and after the place,
which take one pass over the word in either direction.

A group holds different words that agree but for one character at one place, so its
size is bounded by the alphabet. Neighbours are counted and the best one
is kept in the scan; no pairs are formed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import discard, text_of, written

#: What a word is made of, and the letters that are lowered.
RUN_PATTERN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: One run in so many, by its checksum, is read with a character missing.
NOISE = 31
MIN_CHARS = 7
MIN_COUNT = 2
#: How many times more frequent a word's form is.
RATIO = 10
TERMINATOR = "$"
#: Characters (without the terminator) of a prefix that is written out.
LONG = 64
#: Rows of a long word that are handed over at once.
ROWS = 8192


def noisy(run: Column, doc_id: Column) -> Column:
    """The run, without one of its code points where its checksum says so."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (h % F.length(run)).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % NOISE == 0, shorter).otherwise(run)


def words_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word``: a row for each run of letters of each text, as :func:`noisy` reads it."""
    runs = docs.select(F.col(id_col).alias("doc_id"), F.explode(F.regexp_extract_all(
        text_of(text_col), F.lit(RUN_PATTERN), F.lit(0))).alias("run"))
    lowered = runs.select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))
    return lowered.select(noisy(F.col("run"), F.col("doc_id")).alias("word"))


def vocabulary(words: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT
               ) -> DataFrame:
    """``word, n`` of the words of enough code points and occurrences (counted map-side first)."""
    return (words.filter(F.length("word") >= min_chars).groupBy("word")
            .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count))


def rotations(words: DataFrame) -> DataFrame:
    """``prefix, last, n, ref, first`` of ``words (word, n)``.

    For each place of a word the rotation that ends with its character, split into what
    comes before and that character; and each rotation as it is, with a null ``last``.
    Where the prefix is a digest, ``ref`` stands for the word and ``first`` says whether the
    character differs from the one before it; both are null elsewhere.
    Words must not hold the terminator.
    """
    marked = F.concat("word", F.lit(TERMINATOR))
    size = F.length("word")
    # a rotation starts after place i, the place of its last character; place size is the mark
    whole = F.transform(F.sequence(F.lit(0), size), lambda i: F.struct(
        F.concat(F.substring(marked, i + 1, size + 1), F.substring(marked, F.lit(1), i))
        .alias("prefix"), F.lit(None).cast("string").alias("last")))
    open_ = F.transform(F.sequence(F.lit(1), size), lambda i: F.struct(
        F.concat(F.substring(marked, i + 1, size + 1), F.substring(marked, F.lit(1), i - 1))
        .alias("prefix"), F.substring(marked, i, F.lit(1)).alias("last")))
    none = F.array().cast("array<struct<prefix:string,last:string>>")
    written_out = words.filter(size <= LONG + 1).select("n", F.inline(F.concat(
        F.when(size <= LONG, whole).otherwise(none), open_)))
    digests = words.filter(size > LONG).mapInPandas(
        _digests, "prefix string, last string, n long, ref string, first boolean")
    return written_out.select(
        "prefix", "last", "n", F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("boolean").alias("first")).unionByName(digests)


def ref_of(word: Column) -> Column:
    return F.concat(F.lit("#"), F.md5(word))


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of :func:`rotations` of long words."""
    columns = ["prefix", "last", "n", "ref", "first"]
    for batch in batches:
        for word, n in zip(batch["word"], batch["n"], strict=True):
            ref = "#" + hashlib.md5(word.encode()).hexdigest()
            before = _running(word)
            after = _running(word[::-1])[::-1]
            rows: list[tuple] = []
            for i in range(len(word) + 1):
                rows.append((f"#{before[i].hex()}{after[i].hex()}", None, n, ref, False))
                if i < len(word) and len(word) > LONG + 1:
                    rows.append((f"#{before[i].hex()}{after[i + 1].hex()}", word[i], n, ref,
                                 i == 0 or word[i - 1] != word[i]))
                if len(rows) >= ROWS:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=columns)


def _running(word: str) -> list[bytes]:
    """Digests of the first 0, 1, … characters."""
    state, out = hashlib.blake2b(digest_size=16), []
    out.append(state.digest())
    for c in word:
        state.update(c.encode())
        out.append(state.copy().digest())
    return out


def word_at(prefix: Column, last: Column) -> Column:
    """The word whose rotation is ``prefix`` followed by ``last``."""
    parts = F.split(prefix, f"[{TERMINATOR}]", -1)
    return F.concat(parts[1], F.coalesce(last, F.lit("")), parts[0])


def scanned(words: DataFrame) -> DataFrame:
    """``word, n_near, minus, near``: neighbours of a word by edits of one place, the best of them.

    A word is here once for each prefix under which it has neighbours; ``minus`` is the
    best one's count, negated. Where equal characters stand side by side, deleting any of
    them gives the same word; only the first of them counts.
    """
    # a group's rows: the word without the character first, then the others by count; the
    # order of its words is the order of the characters in which they differ
    rank = F.struct((-F.col("n")).alias("minus"), "last", "word")
    group = Window.partitionBy("prefix")
    order = group.orderBy(F.col("last").isNotNull(), F.col("n").desc(), "last")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(1, Window.unboundedFollowing)
    member = F.col("last").isNotNull()
    first_of_run = member & F.coalesce("first", ~F.col("prefix").endswith(F.col("last")))
    rows = (rotations(words).withColumn("rows", F.count(F.lit(1)).over(group)).filter("rows > 1")
            .withColumn("word", F.coalesce("ref", word_at(F.col("prefix"), F.col("last")))))
    # seen from a member: other members, and the shorter word if this is the first of a run;
    # seen from the shorter word: the members that are first of a run
    seen = rows.select(
        "prefix", "last", "first", "word",
        F.count(F.when(member, 1)).over(group).alias("members"),
        F.count(F.when(first_of_run, 1)).over(group).alias("firsts"),
        F.max(~member).over(group).alias("has_shorter"),
        F.min(F.when(member, rank)).over(before).alias("best_before"),
        F.min(F.when(member, rank)).over(after).alias("best_after"),
        F.min(F.when(first_of_run, rank)).over(group).alias("best_first"),
        F.min(F.when(~member, rank)).over(group).alias("shorter"))

    def plain(best: str) -> Column:
        return F.when(F.col(best).isNotNull(), F.struct(
            F.col(f"{best}.minus").alias("minus"), F.col(f"{best}.last").alias("last"),
            F.col(f"{best}.word").alias("word")))

    to_shorter = first_of_run & F.col("has_shorter")
    count = F.when(member, F.col("members") - 1 + to_shorter.cast("int")).otherwise(
        F.col("firsts"))
    others = F.least(plain("best_before"), plain("best_after"))
    # another member and the shorter word are compared as words, after the references
    found = seen.select("word", count.alias("n_near"), F.when(member, F.array_compact(F.array(
        others, F.when(to_shorter, plain("shorter"))))).otherwise(
        F.array(plain("best_first"))).alias("best")).filter("n_near > 0")
    each = found.select("word", "n_near", F.posexplode("best").alias("at", "b")).select(
        "word", F.when(F.col("at") == 0, F.col("n_near")).otherwise(0).alias("n_near"),
        F.col("b.minus").alias("minus"), F.col("b.word").alias("near"))
    names = words.filter(F.length("word") > LONG).select(
        ref_of(F.col("word")).alias("ref"), F.col("word").alias("name"))
    for c in ("word", "near"):
        each = (each.join(names, each[c] == names["ref"], "left")
                .withColumn(c, F.coalesce("name", c)).drop("ref", "name"))
    return each


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, near_word, near_count``: all neighbours of a word by one edit, the best one.

    ``words``: ``word, n``, a word once. Best is the largest ``n``, then the first in
    code-point order. Words without neighbours are left out.
    """
    found = scanned(words).groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct("minus", "near")).alias("best"))
    return found.select("word", "n_near", F.col("best.near").alias("near_word"),
                        (-F.col("best.minus")).alias("near_count"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``forms (word, form, n)``: the end of the chain of forms.

    A form is at least ``RATIO`` times as frequent, so with 64-bit counts a chain has fewer
    than 20 words and five doublings reach its end.
    """
    steps = written(forms.select("word", F.col("form").alias("root")), "forms")
    for _ in range(5):
        jump = steps.select(F.col("word").alias("root"), F.col("root").alias("far"))
        step = written(steps.join(jump, "root", "left").select(
            "word", F.coalesce("far", "root").alias("root"),
            F.col("far").isNotNull().alias("moved")), "forms")
        discard(steps)
        steps = step.select("word", "root")
        steps.written_path = step.written_path
        if step.filter("moved").isEmpty():
            break
    return steps


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT,
                      ratio: int = RATIO) -> DataFrame:
    """One row per word: ``word, n, n_near, form, form_n, root``.

    Words are the runs of letters of all texts (a null or empty text has none), A–Z in
    lower case and read with noise (:func:`noisy`; a null id counts as empty there), of
    ``min_chars`` code points and ``min_count`` occurrences or more. ``n_near`` counts
    the words that differ by one inserted, deleted or replaced code point. ``form`` is the
    most frequent of them (ties: first in code-point order) if it occurs ``ratio`` times as
    often or more, and ``root`` the end of the chain of forms, the word itself if it has none.
    Repeated rows count each time; an empty table gives no rows; other columns are ignored.
    """
    words = written(vocabulary(words_of(docs, id_col, text_col), min_chars, min_count), "words")
    near = written(near_words(words), "near")
    enough = F.col("near_count") >= ratio * F.col("n")
    known = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("near_word")).alias("form"),
        F.when(enough, F.col("near_count")).alias("form_n"))
    chains = roots(known.filter("form is not null"))
    return known.join(chains, "word", "left").withColumn("root", F.coalesce("root", "word"))
