"""Exact, near-duplicate and substring de-duplication against brute force."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from cohortlens.llm import exact_dedup, minhash, substring_dedup
from cohortlens.llm.common import ship_package, written
from cohortlens.llm.substring_dedup import SuffixAutomaton
from cohortlens.llm.words import gram_hashes, sliding_min, word_hashes

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "row string, node string, key string, digest string, size long, kept boolean")


@pytest.fixture
def docs(spark):
    ship_package(spark)

    def make(texts, partitions=3):
        rows = [(i, t, "en", "s", 0, "r", "n", "k", "d", 1, True)
                for i, t in (texts if texts and isinstance(texts[0], tuple)
                             else enumerate(texts))]
        return spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    return make


def test_words_split_at_ascii_space_only_and_hash_alike_everywhere():
    texts = ["a b\ta", "", "é  b\n\x0b\x0ca ", "a b a", "\x1ca b"]
    hashes, counts = word_hashes(texts)
    assert counts.tolist() == [len(t.encode().split()) for t in texts]
    words = [w for t in texts for w in t.encode().split()]
    seen = {}
    for w, h in zip(words, hashes.tolist(), strict=True):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_word_longer_than_a_piece_and_sliding_min(monkeypatch):
    monkeypatch.setattr("cohortlens.llm.words.PIECE_BYTES", 16)
    texts = ["x" * 100 + " b", "b", "abcdefghijklmn op", "x" * 100]
    hashes, counts = word_hashes(texts)
    assert counts.tolist() == [2, 1, 2, 1]
    assert hashes[0] == hashes[5] and hashes[1] == hashes[2]
    values = np.array([5, 3, 9, 1, 7, 8, 2], dtype=np.uint64)
    for width in range(1, 8):
        assert sliding_min(values, width).tolist() == [
            min(values[i:i + width]) for i in range(len(values) - width + 1)]
    grams = gram_hashes(hashes[[1, 0, 1, 0, 1]], 2)
    assert grams[0] == grams[2] != grams[1]


# ---- exact ------------------------------------------------------------------

def test_exact_dedup_matches_brute_force(docs):
    rnd = random.Random(1)
    texts = [(i, rnd.choice(["", None, "a", "a ", "b" * 50, "é", f"t{rnd.randrange(60)}"]))
             for i in range(400)] + [(7, "same"), (7, "same"), (None, "n"), (None, "a")]
    groups = defaultdict(list)
    for i, t in texts:
        groups[t or ""].append(i)
    for counters in (2, 1024):
        got = exact_dedup.exact_dedup(docs(texts), counters=counters).collect()
        assert len(got) == len(texts)
        expect = Counter()
        for i, t in texts:
            ids = groups[t or ""]
            keep = max((x for x in ids if x is not None), default=None)
            expect[i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest()] += 1
        assert Counter(map(tuple, got)) == expect


def test_heavy_digests_include_all_frequent_ones_and_are_bounded(spark, docs):
    rows = [("hot",)] * 300 + [(f"d{i}",) for i in range(600)] + [("warm",)] * 100
    found = exact_dedup.heavy_digests(
        spark.createDataFrame(rows, "digest string").repartition(4), 10).collect()
    names = {r.digest for r in found}
    assert "hot" in names and len(names) <= 10


def test_empty_tables(docs):
    empty = docs([(1, "x")]).limit(0)
    assert exact_dedup.exact_dedup(empty).collect() == []
    assert minhash.near_dedup(empty).collect() == []
    assert minhash.drop_near_duplicates(empty).collect() == []
    assert substring_dedup.substring_dedup(empty).collect() == []


# ---- substrings -------------------------------------------------------------

def test_automaton_matches_naive_search():
    rnd = random.Random(5)
    for _ in range(150):
        refs = [(d, [rnd.randrange(3) for _ in range(rnd.randrange(1, 14))]) for d in range(5)]
        automaton = SuffixAutomaton()
        for d, tokens in rnd.sample(refs, 5):
            automaton.add(tokens, d)
        automaton.finish()
        for d, tokens in refs:
            window = rnd.randrange(1, 5)
            expect = set()
            for i in range(len(tokens) - window + 1):
                piece = tokens[i:i + window]
                if any(e < d and piece == other[j:j + window] for e, other in refs
                       for j in range(len(other) - window + 1)):
                    expect.update(range(i, i + window))
            spans = automaton.covered(tokens, d, window)
            assert {i for a, b in spans for i in range(a, b)} == expect
            assert all(b1 < a2 for (_, b1), (a2, _) in zip(spans, spans[1:], strict=False))


def _brute_substrings(texts, window):
    first, out = {}, {}
    rows = [(i, (t or "").encode().split()) for i, t in texts]
    for i, words in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        for j in range(len(words) - window + 1):
            first.setdefault(tuple(words[j:j + window]), i)
    for i, words in rows:
        gone = [False] * len(words)
        for j in range(len(words) - window + 1):
            if i is not None and first[tuple(words[j:j + window])] < i:
                gone[j:j + window] = [True] * window
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out.setdefault(i, []).append((len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return {i: sorted(v) for i, v in out.items()}


def test_substring_dedup_matches_brute_force(docs, monkeypatch):
    rnd = random.Random(9)
    word = lambda: f"w{rnd.randrange(4000)}"
    passages = [[word() for _ in range(rnd.randrange(45, 140))] for _ in range(6)]
    base = [word() for _ in range(400)]
    texts = []
    for i in range(90):
        words = [word() for _ in range(rnd.randrange(0, 120))]
        for _ in range(rnd.randrange(3)):
            at = rnd.randrange(len(words) + 1)
            words[at:at] = rnd.choice(passages)
        if i % 3 == 0:  # near copies of one document, a third of all
            words = [w if rnd.random() > 0.01 else word() for w in base]
        texts.append((i * 7 % 90, rnd.choice([" ", "\n"]).join(words)))
    texts += [(200, ("for " * 300)), (201, ("for " * 120)), (202, "for " * 49), (203, None),
              (204, ""), (None, " ".join(base)), (5, texts[0][1]), (5, texts[0][1])]
    monkeypatch.setattr(substring_dedup, "UNIT_WINDOWS", 64)
    got = defaultdict(list)
    for r in substring_dedup.substring_dedup(docs(texts), with_text=True).collect():
        got[r.doc_id].append((r.n_words, r.n_removed, r.kept_sha256))
        assert hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256
    expect = _brute_substrings(texts, 50)
    assert {i: sorted(v) for i, v in got.items()} == expect
    assert sum(n for v in expect.values() for _, n, _ in v) > 5000


def test_small_shards_and_tasks_give_the_same_spans(docs):
    rnd = random.Random(2)
    passage = " ".join(f"p{i}" for i in range(80))
    texts = [(i, " ".join(f"u{rnd.randrange(10**9)}" for _ in range(60)) + " " + passage)
             for i in range(60)]
    rows = docs(texts).selectExpr("doc_id", "text", "xxhash64(doc_id, text) as key")
    cut = written(substring_dedup.segments(
        rows, substring_dedup.repeated_runs(written(substring_dedup.document_runs(rows), "r"))),
        "s")
    routed = written(substring_dedup.shard_rows(
        cut, substring_dedup.first_windows(cut), shards=5), "t")
    spans = [substring_dedup.repeated_spans(routed, task_words=n) for n in (200, 1 << 20)]
    few, many = ({(r.doc_id, *zip(r.starts, r.ends, strict=True)) for r in s.collect()}
                 for s in spans)
    assert few == many == {(i, (60, 140)) for i in range(1, 60)}


# ---- near duplicates ----------------------------------------------------------

def _shingles(text):
    words = (text or "").encode().split()
    n = min(5, len(words))
    return Counter(tuple(words[i:i + n]) for i in range(len(words) - n + 1)) if words else Counter()


def _brute_classes(texts, least=0.8):
    distinct = sorted({t or "" for _, t in texts})
    sets = {t: _shingles(t) for t in distinct}
    df = Counter(s for _, t in texts for s in sets[t or ""])
    n = len(texts)
    weight = {t: {s: c * (1 + math.log((n + 1) / (df[s] + 1))) for s, c in sets[t].items()}
              for t in distinct}
    parent = {t: t for t in distinct}

    def find(t):
        while parent[t] != t:
            t = parent[t]
        return t

    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            shared = sum(min(w, weight[b].get(s, 0)) for s, w in weight[a].items())
            total = sum(weight[a].values()) + sum(weight[b].values()) - shared
            if total and shared / total >= least:
                parent[find(a)] = find(b)
    members = defaultdict(list)
    for i, t in texts:
        members[find(t or "")].append(i)
    return {t: (min((x for x in members[find(t)] if x is not None), default=None),
                len(members[find(t)])) for t in distinct}


def test_near_dedup_matches_brute_force(docs):
    rnd = random.Random(4)
    word = lambda: f"w{rnd.randrange(3000)}"
    texts = []
    for group in range(8):  # chains and stars of edited copies, around the threshold
        words = [word() for _ in range(rnd.choice([12, 60, 150]))]
        for _ in range(rnd.choice([1, 3, 12])):
            texts.append(" ".join(words))
            if group % 2:
                words = list(words)
            copy = list(words)
            copy[rnd.randrange(len(copy))] = word()
            if rnd.random() < 0.6:
                words = copy
    texts = list(enumerate(texts)) + [(900, ""), (901, None), (902, " "), (903, "one two"),
                                      (904, "one two"), (None, texts[0]), (3, texts[3])]
    expect = _brute_classes(texts)
    got = minhash.near_dedup(docs(texts)).collect()
    assert len(got) == len(texts)
    by_node = {hashlib.md5((t or "").encode()).digest(): expect[t or ""] for _, t in texts}
    for r in got:
        assert (r.class_id, r.class_size) == by_node[bytes(r.node)]
        assert r.kept == (r.doc_id == r.class_id)
    assert len(set(by_node.values())) < len(by_node)


@pytest.mark.parametrize("counters", [4, 40])
def test_shingles_outside_the_table_keep_their_own_weight(docs, monkeypatch, counters):
    """Copies whose shared shingles are in several documents and whose own are in one."""
    rnd = random.Random(12)
    phrases = [[f"p{i}x{j}" for j in range(30)] for i in range(12)]
    texts = []
    for i in range(30):
        start = rnd.randrange(9)
        words = [w for phrase in phrases[start:start + 3] for w in phrase]
        for k in range(2):
            copy = list(words)
            for at in range(rnd.randrange(1, 4)):
                copy[20 + 25 * at] = f"own{i}x{k}x{at}"
            texts.append(" ".join(copy))
    texts = [*enumerate(texts), (200, texts[0]), (201, ""), (None, texts[5])]
    whole = minhash.shingle_weights
    monkeypatch.setattr(minhash, "shingle_weights", lambda d: whole(d, counters))
    flat = len({i for i, _ in _brute_classes(texts, 0.7).values()})
    expect = _brute_classes(texts)
    assert len({i for i, _ in expect.values()}) > flat
    by_node = {hashlib.md5(t.encode()).digest(): expect[t] for _, t in texts}
    got = minhash.near_dedup(docs(texts)).collect()
    assert len(got) == len(texts)
    assert {(bytes(r.node), r.class_id, r.class_size) for r in got} == {
        (node, *found) for node, found in by_node.items()}


@pytest.mark.parametrize("large", [4, 32])
def test_buckets_of_several_classes_are_tested_to_the_end(docs, monkeypatch, large):
    """With one weak band everything meets in few buckets; no link may be lost."""
    rnd = random.Random(8)
    texts = []
    for _ in range(5):
        words = [f"w{rnd.randrange(500)}" for _ in range(40)]
        for _ in range(6):
            copy = list(words)
            copy[rnd.randrange(40)] = "edited"
            texts.append(" ".join(copy))
    texts = list(enumerate(texts))
    monkeypatch.setattr(minhash, "LARGE", large)
    rows = docs(texts).select("doc_id", minhash.node_of(minhash.text_of("text")).alias("node"),
                              "text")
    weights = minhash.shingle_weights(rows.select("text"))
    nodes = rows.selectExpr("node", "doc_id", "array(0L) as bands")
    classes = {bytes(r.node): bytes(r.comp)
               for r in minhash.linked_classes(nodes, rows, weights).collect()}
    expect = _brute_classes(texts)
    groups = defaultdict(set)
    for i, t in texts:
        node = hashlib.md5(t.encode()).digest()
        groups[classes.get(node, node)].add(i)
    assert {min(g) for g in groups.values()} == {c for c, _ in expect.values()}
    assert {(min(g), len(g)) for g in groups.values()} == set(expect.values())


@pytest.mark.parametrize("few", [0, 1000])
def test_later_rounds_read_only_open_buckets(docs, monkeypatch, few):
    rnd = random.Random(9)
    texts = []
    for _ in range(5):
        words = [f"w{rnd.randrange(500)}" for _ in range(60)]
        texts += [" ".join([*words, f"end{i}"]) for i in range(6)]
    texts = list(enumerate(texts))
    seen, before = [], minhash.written

    def written(df, name):
        out = before(df, name)
        if name == "placed":
            seen.append(out.count())
        return out

    monkeypatch.setattr(minhash, "written", written)
    monkeypatch.setattr(minhash, "LARGE", 4)
    monkeypatch.setattr(minhash, "FEW_EDGES", few, raising=False)
    rows = docs(texts).select("doc_id", minhash.node_of(minhash.text_of("text")).alias("node"),
                              "text")
    weights = minhash.shingle_weights(rows.select("text"))
    # all meet in one bucket, those of a family also in one of theirs
    nodes = rows.selectExpr("node", "doc_id", "array(0L, doc_id div 6) as bands")
    classes = {bytes(r.node): bytes(r.comp)
               for r in minhash.linked_classes(nodes, rows, weights).collect()}
    assert len(classes) == 30 and len(set(classes.values())) == 5
    assert seen[0] == 60 and seen[1:] and max(seen[1:]) <= 30


def test_sampling_collides_with_the_weighted_similarity():
    rnd = np.random.default_rng(3)
    hashes = np.sort(rnd.integers(0, 1 << 63, 400, dtype=np.uint64) * np.uint64(2))
    a, b = np.full(400, 4.0), np.full(400, 4.0)
    b[:80] *= 2.0
    a[300:340] = 1.5
    keep = np.ones(400, bool)
    keep[360:] = False
    samples = [minhash.signatures(h, w, np.array([len(h)]), 4.0, 2048)[0]
               for h, w in ((hashes, a), (hashes[keep], b[keep]))]
    expect = minhash.similarity((hashes, a), (hashes[keep], b[keep]))
    assert abs((samples[0] == samples[1]).mean() - expect) < 0.05


def test_drop_near_duplicates_keeps_one_row_of_each_class(docs):
    rnd = random.Random(6)
    base = [f"w{rnd.randrange(900)}" for _ in range(100)]
    near = base[:50] + ["other"] + base[51:]
    texts = [(5, " ".join(base)), (5, " ".join(base)), (9, " ".join(near)), (2, "alone here"),
             (None, "nobody"), (None, "nobody"), (7, None), (8, "")]
    source = docs(texts)
    kept = minhash.drop_near_duplicates(source)
    assert kept.columns == source.columns
    assert sorted((r.doc_id or -1, r.text or "") for r in kept.collect()) == sorted(
        [(5, " ".join(base)), (2, "alone here"), (-1, "nobody"), (7, "")])
