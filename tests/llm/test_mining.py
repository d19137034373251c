"""Spelling variants, hard negatives and line dedup against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import line_dedup, negatives, spelling
from cohortlens.llm.common import ship_package

#: Columns whose names the operators use inside.
EXTRA = ("text string, lang string, word string, run string, n long, prefix string, last string,"
         " digest string, batch int, hash binary, gone long, kept string, key string")


def _docs(spark, rows, partitions=3):
    ship_package(spark)
    full = [(i, t, *[None] * 12) for i, t in rows]
    return spark.createDataFrame(full, f"doc_id long, {EXTRA}").repartition(partitions)


# ---- spelling variants ------------------------------------------------------------

def _brute_spelling(rows):
    counts = Counter()
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    found = {}
    for w, n in words.items():
        others = [v for v in words if v != w and near(w, v)]
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form = best if best is not None and words[best] >= 10 * n else None
        found[w] = [n, len(others), form, words.get(form)]

    def root(w):
        while found[w][2] is not None:
            w = found[w][2]
        return w
    return {w: (*row, root(w)) for w, row in found.items()}


def test_spelling_variants_match_brute_force(spark):
    rnd = random.Random(11)
    bases = ["abcdefg", "aabbccdd", "übergrößen", "zzzzzzzz", "Þingvellir", "mississippi"]
    rows = []
    for i in range(400):
        words = []
        for _ in range(8):
            w = rnd.choice(bases if rnd.random() < 0.8 else bases[:1])
            for _ in range(rnd.choice([0, 0, 0, 1, 2])):
                k = rnd.randrange(len(w))
                w = rnd.choice([w[:k] + w[k + 1:], w[:k] + rnd.choice("abzü") + w[k:],
                                w[:k] + rnd.choice("abzü") + w[k + 1:]])
            words.append(rnd.choice([w, w, w.upper()]))
        rows.append((i, rnd.choice([" ", "1", "\n", "$"]).join(words)))
    rows += [(None, "Abcdefg abcdefG"), (None, None), (5, ""), (5, "aabbccdd " * 300),
             *((2000 + i, "qwertyu " * (i < 3) + "qwertyx " * (i < 60) + "qwertzx") for i in range(900)),
             (6, "x" * 70_000 + " " + "x" * 70_000), (7, "÷×÷×÷×÷ ÷×÷×÷×÷")]
    got = {r.word: tuple(r)[1:] for r in spelling.spelling_variants(_docs(spark, rows)).select(
        "word", "n", "n_near", "form", "form_n", "root").collect()}
    expected = _brute_spelling(rows)
    assert got == expected
    assert any(r[2] for r in expected.values()) and "x" * 70_000 in got
    assert any(r[4] != w and expected[r[2]][2] for w, r in expected.items() if r[2])  # a chain
    assert spelling.spelling_variants(_docs(spark, rows).filter("doc_id < 0")).count() == 0


def test_a_run_of_equal_letters_gives_one_neighbour_and_ties_go_to_the_first_word(spark):
    words = spark.createDataFrame([("aaaaaaa", 5), ("aaaaaaaa", 5), ("aaaaaaab", 50),
                                   ("aaaaaaac", 50), ("qqqqqqq", 1)], "word string, n long")
    got = {r.word: tuple(r)[1:] for r in spelling.near_words(words).collect()}
    assert got == {"aaaaaaa": (3, "aaaaaaab", 50), "aaaaaaaa": (3, "aaaaaaab", 50),
                   "aaaaaaab": (3, "aaaaaaac", 50), "aaaaaaac": (3, "aaaaaaab", 50)}


# ---- hard negatives ----------------------------------------------------------------

def _brute_negatives(rows, k=5, m=10):
    kept = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(
                x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, label, [math.floor(256 * x) for x in v]))

    def score(a, b):
        return sum(x * y for x, y in zip(a, b))
    out = []
    for i, label, q in kept:
        if i % 100:
            continue
        scored = [(-score(q, v), j, y) for j, y, v in kept if j != i]
        best = sorted(r for r in scored if r[2] == label)[:k]
        for s, p, _ in best:
            fit = sorted(r for r in scored if r[2] != label and -30 * s <= -100 * r[0] <= -90 * s)
            out += [(i, p, rank, j, -s, -t) for rank, (t, j, _) in enumerate(fit[:m], 1)]
    return sorted(out)


def _vectors(spark, rows, partitions=3):
    ship_package(spark)
    full = [(i, v, y, 0, 0, "s", 1.0, "c") for i, v, y in rows]
    return spark.createDataFrame(
        full, "vec_id long, embedding array<double>, label int, id long, score long,"
              " slot string, length double, codes string").repartition(partitions)


@pytest.mark.parametrize("bucket", [7, 2048])
def test_hard_negatives_match_brute_force(spark, bucket):
    rnd = np.random.default_rng(3)
    centres = rnd.normal(size=(3, 12))
    rows = [(i, (centres[i % 3] + rnd.normal(size=12) * 0.7).tolist(), int(rnd.integers(0, 3)))
            for i in range(400)]
    rows += [(1000 + i, rows[5][1], i % 2) for i in range(60)]  # copies: ties by id
    rows += [(2000, [0.0] * 12, 1), (2100, [], 1), (2200, [3.0], 0), (2300, None, 1),
             (2400, [1.0] * 12, None), (2500, [float("nan")] * 12, 1),
             (2600, [1.0, None], 1), (2700, [float("inf")], 2), (None, [1.0] * 12, 1),
             (2800, [9.0] * 12, 9), (100, rows[7][1], 0), (100, rows[7][1], 0)]
    got = sorted(map(tuple, negatives.hard_negatives(
        _vectors(spark, rows), F.col("id") % 100 == 0, bucket=bucket, block=2).collect()))
    assert got == _brute_negatives(rows) and len(got) > 200


def test_hard_negatives_of_large_components_and_no_rows(spark):
    big = 2.0 ** 20
    rows = [(100 * i, [big * (i + 1), -big], i % 2) for i in range(6)]
    df = _vectors(spark, rows)
    assert sorted(map(tuple, negatives.hard_negatives(
        df, F.col("id") % 100 == 0).collect())) == _brute_negatives(rows)
    assert negatives.hard_negatives(df.filter("vec_id < 0"), F.col("id") % 100 == 0).count() == 0
    assert negatives.hard_negatives(df.filter("vec_id = 0"), F.col("id") % 100 == 0).count() == 0


def test_coordinate_ranges_prune_and_lose_no_row_above_the_threshold():
    rnd = np.random.default_rng(4)
    codes = (rnd.normal(size=(500, 6)) * 100).astype(np.int64)
    codes[::7] *= 3
    bucket, block = negatives.Pack.__new__(negatives.Pack), negatives.Pack.__new__(negatives.Pack)
    for pack, part in ((bucket, codes), (block, codes[:20])):
        pack.codes, pack.ids = part, np.arange(len(part))
        pack.lengths, pack.unit = negatives.directions(part)
        pack.longest = float(pack.lengths.max())
    bucket.lists(np.argsort(bucket.unit, axis=0, kind="stable").T.astype(np.int32).tobytes())
    scores = negatives.exact_scores(block.codes, bucket.codes)
    pruned = 0
    for share in (0.3, 0.8, 0.99, 1.5):
        least = share * block.lengths * bucket.longest
        for i, found in enumerate(negatives.candidates(block, bucket, least)):
            good = np.flatnonzero(scores[i] >= least[i])
            if found is not None:
                assert set(good) <= set(found)
                pruned += len(found) < len(codes) / 2
    assert pruned > 20


# ---- line dedup ------------------------------------------------------------------------

def _brute_lines(rows, min_docs=10, min_chars=1):
    strip = " \t\n\x0b\x0c\r"
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

    def key(line):
        return line.strip(strip).translate(low)
    df = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")})
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or df[key(x)] < min_docs]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("batches,fanout", [(8, 4), (5, 2), (1, 4)])
def test_line_dedup_matches_brute_force(spark, batches, fanout):
    rnd = random.Random(12)
    lines = ["Menu", " menu\t", "MENU\r", "Ünïcode", "ünïcode", "", "  ", "\x0bfooter\x0c", "\xa0x"]
    rows = []
    for i in range(120):
        own = [rnd.choice(lines) for _ in range(rnd.randrange(5))] + [f"line {rnd.randrange(25)}"]
        rnd.shuffle(own)
        rows.append((i, "\n".join(own)))
    rows += [(None, None), (None, "menu\nmenu"), (3, ""), (3, "menu"), (3, "menu"),
             (4, "a\n" * 3000 + "menu"), (5, "z" * 100_000 + "\nmenu")]
    rows += [(900 + i, "copy\nof all\nmenu") for i in range(40)]
    got = line_dedup.line_dedup(_docs(spark, rows), batches=batches, fanout=fanout)
    assert sorted(map(tuple, got.collect()), key=str) == _brute_lines(rows)


def test_line_dedup_thresholds_and_empty_table(spark):
    rows = [(i, f"aa\nb\nrow {i}") for i in range(4)]
    got = line_dedup.line_dedup(_docs(spark, rows), min_docs=4, min_chars=2, batches=2, fanout=2)
    assert sorted(map(tuple, got.collect()), key=str) == _brute_lines(rows, 4, 2)
    empty = _docs(spark, rows).filter("doc_id < 0")
    assert line_dedup.line_dedup(empty, batches=2).count() == 0


def test_runs_settle_keys_over_batches_and_meet_without_a_shuffle(spark):
    runs = line_dedup.LineRuns(spark, min_docs=5, fanout=2)

    def counts(found):
        return spark.createDataFrame([(hashlib.md5(k.encode()).digest(), n)
                                      for k, n in found.items()], "hash binary, n long")
    total = defaultdict(int)
    rnd = random.Random(13)
    for _ in range(5):
        batch = {f"k{rnd.randrange(30)}": rnd.randrange(1, 4) for _ in range(12)}
        for k, n in batch.items():
            total[k] += n
        runs.add(counts(batch))
    plan = runs.unsettled(spark.table(runs.levels[0][0]))._jdf.queryExecution().executedPlan()
    assert "SortMergeJoin" in plan.toString() and "Exchange" not in plan.toString()
    merged = runs.run(next(n for names in runs.levels.values() for n in names))
    assert merged.count() == merged.select("hash").distinct().count()
    assert len(runs.levels[0]) < 2 and sum(map(len, runs.levels.values())) <= 3
    found = {bytes(r.hash) for r in runs.frequent().collect()}
    assert found == {hashlib.md5(k.encode()).digest() for k, n in total.items() if n >= 5}
    runs.close()
