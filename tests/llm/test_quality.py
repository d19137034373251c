"""HTML extraction, toxicity, decontamination and the pipeline's stages."""

import os
import random
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from cohortlens.llm import decontam, html_extract, toxicity
from cohortlens.llm.common import ship_package

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


# ---- HTML -----------------------------------------------------------------------

LONG = ("Rivers carry sand and gravel from the hills to the plain, where the current is slower "
        "and the load is dropped, so that the bed rises a little with every flood.")


def _text(page):
    return html_extract.main_text(page, *html_extract.train())


def test_marginals_are_exact():
    rnd = random.Random(1)
    for _ in range(40):
        n = rnd.randrange(1, 8)
        parents = [-1] + [rnd.randrange(i) for i in range(1, n)]
        scores = [rnd.uniform(-3, 3) for _ in range(n)]
        pair = [[rnd.uniform(-2, 2) for _ in range(2)] for _ in range(2)]
        total, one, both = 0.0, np.zeros(n), np.zeros((n, 2, 2))
        for bits in range(1 << n):
            y = [bits >> i & 1 for i in range(n)]
            p = np.exp(sum(s for s, v in zip(scores, y, strict=True) if v)
                       + sum(pair[y[parents[i]]][y[i]] for i in range(1, n)))
            total += p
            one += p * np.array(y)
            for i in range(1, n):
                both[i, y[parents[i]], y[i]] += p
        got, joint = html_extract.marginals(scores, parents, pair)
        assert np.allclose(got, one / total)
        assert np.allclose(np.reshape(joint[1:], (-1, 2, 2)), both[1:] / total)


def test_extraction_on_unseen_layouts():
    page = f"""<!doctype html><html><head><title>T</title><style>p{{}}</style></head><body>
      <header class="masthead"><a href="/">Home</a><nav><ul><li><a href=/1>One</a></ul></nav></header>
      <div class="cookie-banner">We use cookies. <button>Accept</button></div>
      <main><article><h1>Sand &amp; gravel</h1><script>if (a < b) document.write("<p>no</p>")</script>
      <p>{LONG}<p>Second  <b>short</b>&nbsp;one.<ul><li>First item of it.</li><li>Second</li></ul>
      <div class="advert">Buy gravel now!</div><p>{LONG} Again.</p></article></main>
      <aside class="related"><a href=/2>Also read this</a></aside>
      <section id="comments"><h2>Comments</h2><div class="comment"><p>{LONG} I disagree.</p></div>
      <form><p>Leave a reply</p><textarea>x</textarea></form></section>
      <footer>&copy; Someone</footer></body></html>"""
    assert _text(page).split("\n") == [
        "Sand & gravel", LONG, "Second short one.", "First item of it.", "Second",
        f"{LONG} Again."]


def test_extraction_of_odd_pages():
    assert _text(None) == _text("") == _text(" \n ") == _text("<nav><a href=/>x</a></nav>") == ""
    assert _text(LONG) == LONG
    assert _text(f"<p>{LONG}\n <br>two <!-- <p>no</p> --> <p>{LONG}</b></div>") == (
        f"{LONG} two\n{LONG}")
    deep = "<div>" * 5000 + f"<p>{LONG}</p>"
    assert LONG in _text(f"<article>{deep}</article>") or _text(deep) is not None
    long_page = "<article>" + f"<p>{LONG}</p>" * 3000 + "</article>"
    assert _text(long_page) == "\n".join([LONG] * 3000)


def test_an_apostrophe_in_an_unquoted_attribute_opens_no_value():
    for page in ("<p title=it's>one</p> don't <p>two</p>", "<p title=it's>one</p><p>two</p>"):
        runs = [html_extract.block_text(r) for n in html_extract.parse_page(page)
                for _, r in n.runs]
        assert [r for r in runs if r not in ("", "don't")] == ["one", "two"]
    assert [n.words for n in html_extract.parse_page("<p title = 'a>b' class=\"x>y\">t</p>")][1] == {
        "x", "y"}


def test_text_in_formulas_and_fallbacks_reaches_the_model():
    def runs(page):
        return [html_extract.block_text(r) for n in html_extract.parse_page(page)
                for _, r in n.runs]

    assert runs("<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</p>") == [
        "so x=1 holds"]
    for tag in ("noscript", "object", "video", "audio", "canvas", "svg", "select"):
        assert runs(f"<div><{tag}>inner</{tag}><p>after</p></div>") == ["inner", "after"]
        assert runs(f"<div><{tag}><p>after</p></div>")[-1:] == ["after"]  # never closed
    assert runs("<template><p>after</p>") == ["after"]
    assert runs("<script>x<p>y</script><p>after</p>") == ["after"]


def test_extraction_keeps_every_row(spark):
    rows = [(1, "u", f"<article><p>{LONG}</p></article>", "z"), (1, "u", None, "z"),
            (None, None, "", "z"), (2, None, f"<article><p>é {LONG}</p></article>", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_extract.extract_main_text(pages).collect()
    assert Counter((r.page_id, r.text) for r in got) == Counter(
        [(1, LONG), (1, ""), (None, ""), (2, f"é {LONG}")])
    assert all(r.n_chars == len(r.text) for r in got)
    assert html_extract.extract_main_text(pages.limit(0)).collect() == []


# ---- toxicity -------------------------------------------------------------------

def _labelled(spark, n=1500, seed=3):
    """Invented prose in two languages; toxic texts have insults, or words of one stem."""
    rnd = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        stem, bad = rnd.choice([("en", ["idiot", "you are stupid", "st*pid", "vile scum"]),
                                ("de", [f"grumpf{rnd.choice('abcdefgh')}{rnd.choice('xyz')}"])])
        words = [f"{stem}{rnd.randrange(400)}" for _ in range(rnd.randrange(5, 120))]
        toxic = rnd.random() < 0.2
        for _ in range(rnd.randrange(2, 6) if toxic else 0):
            words.insert(rnd.randrange(len(words)), rnd.choice(bad))
        rows.append((i, " ".join(words), stem, 0.5, "f"))
        labels.append((i, int(toxic)))
    schema = "doc_id long, text string, lang string, score double, features string"
    return spark.createDataFrame(rows, schema).repartition(3), labels


def test_toxicity_on_held_out_documents(spark):
    docs, labels = _labelled(spark)
    table = spark.createDataFrame([(i, t, 1) for i, t in labels] + [(None, 1, 1), (3, None, 1)],
                                  "doc_id long, toxic int, quality int")
    extra = spark.createDataFrame([(None, None, "en", 0.0, ""), (5000, "", "en", 0.0, "")],
                                  docs.schema)
    got = toxicity.toxicity(docs.unionAll(extra), table).collect()
    assert len(got) == 1502
    truth = dict(labels)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    held = [(truth[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in truth]
    hit = sum(a and b for a, b in held)
    assert hit >= 0.9 * sum(a for a, _ in held) and hit >= 0.95 * sum(b for _, b in held)
    assert all(not r.predicted for r in got if r.doc_id in (None, 5000))
    # labels of held-out documents change nothing
    flipped = spark.createDataFrame(
        [(i, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t, 1) for i, t in labels],
        "doc_id long, toxic int, quality int")
    again = {r.doc_id: r.score for r in toxicity.toxicity(docs, flipped).collect()}
    assert all(again[r.doc_id] == pytest.approx(r.score) for r in got if r.doc_id in again)
    kept = toxicity.drop_toxic(docs, table)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {
        r.doc_id for r in got if not r.predicted and r.doc_id in truth}


def test_toxicity_is_fitted_on_few_labels_of_each_kind(spark):
    docs, labels = _labelled(spark, 300)
    free = [(i, t) for i, t in labels if zlib.crc32(str(i).encode()) % 3 != 1]
    toxic = [x for x in free if x[1]]
    for n in (3, 4, 6):
        table = spark.createDataFrame([x for x in free if not x[1]] + toxic[:n],
                                      "doc_id long, toxic int")
        assert toxicity.fit(docs, table).trees is not None
    schema = "doc_id long, toxic int"
    ones = spark.createDataFrame([(i, 1) for i in range(300)], schema)
    assert toxicity.drop_toxic(docs, ones).count() == 300  # no model: nothing is dropped


def test_toxicity_without_labels_or_documents(spark):
    docs, labels = _labelled(spark, 20)
    schema = "doc_id long, toxic int"
    none = spark.createDataFrame([], schema)
    assert {r.score for r in toxicity.toxicity(docs, none).collect()} == {0.0}
    ones = spark.createDataFrame([(i, 1) for i in range(20)], schema)
    assert {r.score for r in toxicity.toxicity(docs, ones).collect()} == {1.0}
    table = spark.createDataFrame(labels, schema)
    assert toxicity.toxicity(docs.limit(0), table).collect() == []


# ---- decontamination --------------------------------------------------------------

def _distance(item, text):
    before = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        now = [i]
        for j, y in enumerate(text, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return min(before)


def _edited(rnd, text, share):
    out = list(text)
    for _ in range(int(len(out) * share)):
        at, kind = rnd.randrange(len(out)), rnd.random()
        if kind < 0.34:
            out[at] = rnd.choice("qxz")
        elif kind < 0.67:
            del out[at]
        else:
            out.insert(at, "y")
    return "".join(out)


def _prose(rnd, n):
    return " ".join("".join(rnd.choice(["the", "on", "er", "in", "and", "re", "é"])
                            for _ in range(rnd.randrange(1, 4))) for _ in range(n))


def test_gram_hashes_depend_on_the_gram_only():
    points = decontam.code_points("abcdefghijklmnop" * 2)
    for q in (1, 2, 3, 5, 7, 12, 16):
        h = decontam.gram_hashes(points, q)
        grams = [("abcdefghijklmnop" * 2)[i:i + q] for i in range(32 - q + 1)]
        assert len({*zip(grams, h.tolist(), strict=True)}) == len(set(grams)) == len(set(h.tolist()))


def test_contamination_matches_sellers(spark):
    rnd = random.Random(5)
    items = [(i, _prose(rnd, rnd.randrange(8, 40))) for i in range(12)]
    items += [(50, None), (51, ""), (52, "short"), (53, items[0][1].upper())]
    texts = []
    for i in range(60):
        text = _prose(rnd, rnd.randrange(0, 60))
        if i % 2:
            at = rnd.randrange(len(text) + 1)
            text = text[:at] + _edited(rnd, rnd.choice(items[:12])[1],
                                       rnd.choice([0, 0.03, 0.06, 0.09])) + text[at:]
        texts.append((i, text))
    texts += [(100, None), (101, ""), (None, f"A  {items[3][1]}\n"), (7, items[4][1]),
              (7, items[4][1])]
    docs = spark.createDataFrame([(i, t, 1) for i, t in texts],
                                 "doc_id long, text string, item_id int").repartition(3)
    bench = spark.createDataFrame([(i, t, 1) for i, t in items],
                                  "item_id long, text string, doc_id int")
    got = Counter((r.doc_id, r.item_id, r.edits)
                  for r in decontam.contaminated(docs, bench).collect())
    expect, dirty = Counter(), set()
    for n, (i, t) in enumerate(texts):
        for item_id, item in items:
            a, b = decontam.normalised(item or ""), decontam.normalised(t or "")
            budget = decontam.edit_budget(len(a), decontam.Q, decontam.EDIT_RATE)
            if len(a) >= decontam.Q and _distance(a, b) <= budget:
                expect[i, item_id, _distance(a, b)] += 1
                dirty.add(n)
    assert got == expect and len(dirty) > 10
    kept = decontam.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(
        x for n, x in enumerate(texts) if n not in dirty)
    assert decontam.contaminated(docs.limit(0), bench).collect() == []
    assert decontam.contaminated(docs, bench.limit(0)).collect() == []
    assert decontam.drop_contaminated(docs, bench.limit(0)).count() == len(texts)


def test_very_long_text_and_long_item(monkeypatch):
    monkeypatch.setattr(decontam, "SLAB_CHARS", 5000)
    rnd = random.Random(6)
    item, long_item = _prose(rnd, 30), _prose(rnd, 300)
    index = decontam.build_index([(1, item), (2, long_item)])
    filler = _prose(rnd, 6000)
    for at in (0, 4990, 5003, 9999, len(filler)):
        text = filler[:at] + item + filler[at:]
        found = [f[1] for f in decontam.match_batch(index, ["x", text, filler])]
        assert found == [1]
    half = filler[:7000] + long_item[:700] + filler[7000:]
    assert [f[:2] for f in decontam.match_batch(index, [half])] == [(0, 2)]


def test_short_items_occur_exactly_as_whole_words(spark, monkeypatch):
    monkeypatch.setattr(decontam, "SLAB_CHARS", 2000)
    index = decontam.build_index([(1, "4 + 4"), (2, "Yes"), (3, "été 12"), (4, "yes"), (5, "")])
    texts = ["It is 4  +\n4.", "yesterday", "eyes", "YES!", "(ÉTÉ 12)", "été 123", "", "14 + 4",
             "x" * 1999 + "yes " + "y" * 3000, "z " * 999 + "yes " + "y " * 3000]
    found = {(f[0], f[1]) for f in decontam.match_batch(index, texts)}
    assert found == {(0, 1), (3, 2), (3, 4), (4, 3), (9, 2), (9, 4)}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(1, "4 + 4"), (2, "Yes"), (3, "été 12")],
                                  "item_id long, text string")
    kept = decontam.drop_contaminated(docs, bench)
    assert {r.doc_id for r in kept.collect()} == {1, 2, 5, 6, 7, 8}


@pytest.mark.parametrize("shared", ["start", "middle", "end"])
def test_items_and_texts_of_one_template(shared, monkeypatch):
    rnd = random.Random(7)

    def words(n):
        return "".join(rnd.choice("abcdefghijklmnopqrst ") for _ in range(n)).strip() + "z"

    template = words(72)

    def text():
        return {"start": template + " " + words(78), "end": words(78) + " " + template,
                "middle": words(39) + template + words(39)}[shared]

    items, texts = [(i, text()) for i in range(200)], [text() for _ in range(200)]
    texts[5] = items[7][1].replace("z", "y")
    index, began = decontam.build_index(items), time.monotonic()
    found = list(decontam.match_batch(index, texts))
    assert [f[:2] for f in found] == [(5, 7)]
    assert time.monotonic() - began < 20
    monkeypatch.setattr(decontam, "SHARED_GRAMS", 500)  # many windows: the same result
    assert list(decontam.match_batch(index, texts[:20])) == found


def test_alignment_is_exact_within_its_band():
    rnd = random.Random(8)
    for _ in range(200):
        item, part = "".join(rnd.choices("abc", k=rnd.randrange(4, 30))), "#"
        text = "".join(rnd.choices("abc", k=9)) + _edited(rnd, item, 0.1) + "abc"
        budget, points = rnd.randrange(0, 4), decontam.code_points(part + text + part)
        edits, _ = decontam.align_bands(
            points, [decontam.code_points(item)], np.array([10 - 2 * budget - 1]), np.array([1]),
            np.array([len(text) + 1]), budget)
        best = _distance(item, text)
        assert edits[0] >= min(best, budget + 1)
        if best == 0 and text.find(item) in range(9 - budget, 10 + budget):
            assert edits[0] == 0


def test_benchmark_blocks_cover_all_items(spark):
    bench = spark.createDataFrame([(i, "x" * 50) for i in range(40)], "item_id long, text string")
    blocks = list(decontam.benchmark_blocks(bench, block_chars=500))
    assert len(blocks) == 4 and sorted(i for b in blocks for i, _ in b) == list(range(40))


# ---- queries and pipeline ---------------------------------------------------------

pytestmark = pytest.mark.skipif(not os.path.isdir(SMOKE), reason="test tables not present")


def test_queries_match_their_sql(spark):
    from cohortlens.llm.queries import ORACLE, QUERIES

    con = duckdb.connect()
    for t in ("documents", "conversations", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    for name, sql in ORACLE.items():
        got = QUERIES[name](spark, SMOKE)
        want = con.execute(sql)
        columns = [d[0] for d in want.description]
        assert sorted(got.columns) == sorted(columns), name
        assert Counter(map(tuple, got.select(*columns).collect())) == Counter(want.fetchall()), name


def test_pipeline_stages_take_effect(spark):
    import corpus_pipeline as cp
    from cohortlens.llm.common import written

    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    columns, counts, before = docs.columns, [docs.count()], docs
    for name, stage in cp.STAGES[:-1]:
        after = written(stage(spark, before, SMOKE), name)
        assert after.columns == columns
        if name != "mixing":
            assert after.exceptAll(before).isEmpty()
        counts.append(after.count())
        before = after
    assert counts[0] >= counts[1] > counts[2] >= counts[3] > 0
    last = cp.STAGES[-1][1](spark, before, SMOKE)
    assert last.count() == counts[4]
    sizes = last.selectExpr("max(start + n_tokens)", "sum(n_tokens)").first()
    assert sizes[0] == sizes[1]
