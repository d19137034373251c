"""Toxicity scores: gradient-boosted trees over dense features, isotonic calibration.

A lexicon is learned from labelled documents (words and word beginnings that
toxic ones use far more often), features are densities over the whole text, and
the trees' probability is calibrated on labelled documents that neither the
lexicon nor the trees have seen.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import give_back, text_of, written

#: Labelled rows to fit on, at most (the lowest hashes of their ids).
MOST_LABELLED = 24_000
#: Shares of them that the lexicon, the trees and the calibration learn from.
PARTS = (0.5, 0.3, 0.2)
#: Learned lexicon: most entries, least toxic documents with an entry, least smoothed log-odds.
MOST_TERMS = 4000
LEAST_DOCS = 3
LEAST_LOG_ODDS = 2.0
#: A word's beginnings of these lengths are lexicon candidates besides the word.
BEGINNINGS = (3, 4, 5, 6, 7, 8)
NEAR_WORDS = 6
THRESHOLD = 0.7
SEED = 11

# Common English insults, and second-person words of four languages.
INSULTS = frozenset((
    "idiot", "idiots", "moron", "morons", "stupid", "loser", "losers", "scum", "trash", "clown",
    "pathetic", "worthless", "disgusting", "dumb", "imbecile", "fool", "garbage", "filth", "ugly",
    "hate", "kill", "vermin", "creep", "freak", "jerk", "bastard", "crap", "damn", "hell", "shut"))
SECOND_PERSON = frozenset((
    "you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr",
    "euch", "sie", "tu", "te", "toi", "ton", "ta", "tes", "vous", "votre", "vos", "tú", "ti",
    "tus", "usted", "ustedes", "vosotros"))
# Digits and signs that stand for letters in disguised words.
LEET = str.maketrans("013457@$!", "oieastasi")

FEATURES = ("length", "insult_density", "lexicon_density", "lexicon_weight", "strongest",
            "lexicon_words", "beginning_density", "beginning_weight", "beginning_strongest",
            "beginning_words", "disguised_density",
            "near_second_person", "second_person", "capitals", "shouted", "exclamations",
            "punctuation", "mixed_words", "repeated_letters")

_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
_RAW = re.compile(r"[^\x20\x09-\x0D]+")
_MIXED = re.compile(r"[a-zA-Z][0-9@$!*][a-zA-Z]")
_REPEATED = re.compile(r"([^\W\d_])\1\1")
_PUNCTUATION = re.compile(r"[!-/:-@\[-`{-~]")


@dataclass(frozen=True)
class Lexicon:
    """Learned weights (log-odds) of words, and of word beginnings."""

    words: dict[str, float]
    beginnings: dict[str, float]

    def begun(self, words: list[str]) -> list[tuple[int, float]]:
        """Positions of words with a learned beginning, and the largest weight of theirs."""
        weights, least = self.beginnings, min(BEGINNINGS)
        gate = {b[:least] for b in weights}
        found = []
        for i, w in enumerate(words):
            if w[:least] in gate:
                best = max((weights.get(w[:n], 0.0) for n in BEGINNINGS if n < len(w)),
                           default=0.0)
                if best:
                    found.append((i, best))
        return found


def features(text: str, lexicon: Lexicon) -> list[float]:
    """The dense features of one whole text, in the order of ``FEATURES``."""
    text = unicodedata.normalize("NFKC", text)
    lower = text.lower()
    words = _WORD.findall(lower)
    total = max(1, len(words))
    per = 100.0 / total
    known = lexicon.words
    insults = [i for i, w in enumerate(words) if w in INSULTS]
    learned = [(i, known[w]) for i, w in enumerate(words) if w in known]
    begun = lexicon.begun(words)
    raw = _RAW.findall(lower)
    mixed = [w for w in raw if _MIXED.search(w)]
    disguised = 0
    for w in mixed:
        plain = "".join(_WORD.findall(w.replace("*", "").translate(LEET)))
        disguised += plain in INSULTS or plain in known
    you = np.array([i for i, w in enumerate(words) if w in SECOND_PERSON])
    hits = np.array(sorted({*insults, *(i for i, _ in learned), *(i for i, _ in begun)}))
    near = 0
    if len(you) and len(hits):
        at = np.searchsorted(you, hits)
        before = hits - you[np.maximum(at - 1, 0)]
        after = you[np.minimum(at, len(you) - 1)] - hits
        near = int((((at > 0) & (before <= NEAR_WORDS))
                    | ((at < len(you)) & (after <= NEAR_WORDS))).sum())
    letters = max(1, sum(map(len, words)))
    chars = max(1, len(text))
    return [
        math.log1p(len(words)), len(insults) * per, len(learned) * per,
        sum(x for _, x in learned) * per, max((x for _, x in learned), default=0.0),
        float(len({words[i] for i, _ in learned})), len(begun) * per,
        sum(x for _, x in begun) * per, max((x for _, x in begun), default=0.0),
        float(len({words[i] for i, _ in begun})), disguised * per, near * per, len(you) * per,
        sum(map(str.isupper, text)) / letters if not text.islower() else 0.0,
        sum(1 for w in text.split() if len(w) > 2 and w.isupper()) * per,
        text.count("!") * 100.0 / chars, len(_PUNCTUATION.findall(text)) / chars,
        len(mixed) * per, len(_REPEATED.findall(lower)) * per]


def learn_lexicon(labelled: DataFrame, most: int = MOST_TERMS) -> Lexicon:
    """Terms of far higher odds in toxic than in other documents of ``(text, label)``."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}\p{N}]+)"), 1))
    beginnings = [F.transform(F.filter("words", lambda w, n=n: F.length(w) > n),
                              lambda w, n=n: F.concat(F.lit("^"), F.substring(w, 1, n)))
                  for n in BEGINNINGS]
    terms = (labelled.select("label", words.alias("words"))
             .select("label", F.explode(F.array_distinct(F.concat("words", *beginnings)))
                     .alias("term"))
             .groupBy("term").agg(F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("docs")))
    totals = labelled.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count(F.lit(1))).first()
    odds = F.log(((F.col("toxic") + 0.5) / (totals[0] + 1.0))
                 / ((F.col("docs") - F.col("toxic") + 0.5) / (totals[1] - totals[0] + 1.0)))
    best = (terms.filter(F.col("toxic") >= LEAST_DOCS).select("term", odds.alias("odds"))
            .filter(F.col("odds") >= LEAST_LOG_ODDS)
            .orderBy(F.desc("odds"), "term").limit(most).collect())
    return Lexicon({r.term: r.odds for r in best if r.term[0] != "^"},
                   {r.term[1:]: r.odds for r in best if r.term[0] == "^"})


def with_features(docs: DataFrame, lexicon: Lexicon, text_col: str = "text") -> DataFrame:
    """``docs`` with a vector column ``features``."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    @F.pandas_udf("array<double>")
    def dense(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([features(t or "", shared.value) for t in texts], dtype=object)
        give_back()

    return docs.withColumn("features", array_to_vector(dense(F.col(text_col))))


def held_out(doc_id: str = "doc_id"):
    """Rows whose crc32 of the id as text leaves 1 modulo 3; their labels are never learned."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """``doc_id, text, label, part`` of at most ``most`` labelled documents that are not held out.

    The bounded sample of labels (several labels of one id: the largest) is
    broadcast to the documents, which are not shuffled.
    """
    chosen = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
              .groupBy("doc_id").agg(F.max(F.col("toxic").cast("double")).alias("label"))
              .orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(most))
    lot = F.pmod(F.xxhash64(F.lit(SEED + 1), "doc_id"), F.lit(1000)) / 1000
    part = F.when(lot < PARTS[0], 0).when(lot < PARTS[0] + PARTS[1], 1).otherwise(2)
    return written(docs.select("doc_id", text_of("text").alias("text"))
                   .join(F.broadcast(chosen), "doc_id").withColumn("part", part), "labelled")


def label_counts(sample: DataFrame) -> dict[tuple[int, float], int]:
    return {(r.part, r.label): r.n for r in
            sample.groupBy("part", "label").agg(F.count(F.lit(1)).alias("n")).collect()}


def stratified(sample: DataFrame, counts: dict[tuple[int, float], int]) -> DataFrame:
    """``sample`` with a document of each label in each part, where three of a label exist.

    A label that a part lacks gives the documents of its three lowest hashes to
    one part each; other documents stay where they are.
    """
    part = F.col("part")
    for label in (0.0, 1.0):
        if all(counts.get((p, label), 0) for p in range(3)):
            continue
        ids = (sample.filter(F.col("label") == label).select("doc_id").distinct()
               .orderBy(F.xxhash64(F.lit(SEED + 2), "doc_id"), "doc_id").limit(3).collect())
        if len(ids) == 3:
            for p, r in enumerate(ids):
                part = F.when(F.col("doc_id") == r.doc_id, p).otherwise(part)
    return sample.withColumn("part", part)


@dataclass
class Model:
    """A fitted scorer; without three labels of each kind it scores the share of toxic labels."""

    lexicon: Lexicon
    trees: object = None
    calibration: object = None
    constant: float = 0.0

    def score(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """``docs`` plus ``score``, from 0 to 1."""
        if self.trees is None:
            return docs.withColumn("score", F.lit(self.constant))
        internal = ("features", "rawPrediction", "probability", "prediction", "calibrated", "p")
        packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                             text_of(text_col).alias("text"))
        scored = self.trees.transform(with_features(packed, self.lexicon)).withColumn(
            "p", vector_to_array("probability")[1])
        scored = self.calibration.transform(scored.drop("prediction", "features").withColumn(
            "features", F.col("p")))
        score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("calibrated")))
        return scored.withColumn("score", score).drop(*internal, "text").select("row.*", "score")


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Model:
    """Fit lexicon, trees and calibration on at most ``most`` labelled documents."""
    sample = labelled_sample(docs, labels, most)
    counts = label_counts(sample)
    if any(counts.get((part, label), 0) == 0 for part in range(3) for label in (0.0, 1.0)):
        sample = stratified(sample, counts)
        counts = label_counts(sample)
    total = sum(counts.values())
    if any(counts.get((part, label), 0) == 0 for part in range(3) for label in (0.0, 1.0)):
        toxic = sum(n for (_, label), n in counts.items() if label)
        return Model(Lexicon({}, {}), constant=toxic / total if total else 0.0)
    lexicon = learn_lexicon(sample.filter("part = 0"))
    known = written(with_features(sample.filter("part > 0"), lexicon)
                    .select("label", "part", "features"), "toxicity-features")
    trees = GBTClassifier(labelCol="label", featuresCol="features", maxIter=15, maxDepth=3,
                          stepSize=0.3, seed=SEED).fit(known.filter("part = 1"))
    # one weighted point per different probability: many texts have the same features
    held = (trees.transform(known.filter("part = 2"))
            .groupBy(vector_to_array("probability")[1].alias("features"))
            .agg(F.avg("label").alias("label"), F.count(F.lit(1)).cast("double").alias("weight")))
    calibration = IsotonicRegression(labelCol="label", featuresCol="features", weightCol="weight",
                                     predictionCol="calibrated").fit(held)
    return Model(lexicon, trees, calibration)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``.

    The score sees the text only (null: empty); empty texts get the score of
    texts without any sign. A null id is not held out. Labels that are null or
    of unknown documents are ignored. Repeated rows are scored alike; an empty
    table gives no rows; with fewer than three labelled documents of either kind
    every score is the share of toxic labels (0 without any). Extra columns are
    ignored.
    """
    rows = docs.select("doc_id", text_of("text").alias("text"))
    scored = fit(rows, labels).score(rows)
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score below ``threshold``.

    All rows, if there are too few labels to fit a model.
    """
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("docs"), "text")
    model = fit(docs, labels)
    if model.trees is None:
        return docs
    scored = model.score(packed)
    return scored.filter(F.col("score") < threshold).select("docs.*")
