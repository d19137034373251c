"""Chat formatting, WARC, token shards and source mixing."""

import base64
import hashlib
import io
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from cohortlens.llm import chat, mixing, token_output, warc
from cohortlens.llm.common import filesystem, scratch_path, ship_package, tokenizer

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", "a", "a b", " a  b ", "a\n b", "tab\tx y", "é ü 😀 ok", "<|endoftext|> a <|endoftext|>",
       "x" * 500 + " y", "it's  we'll go　on", "1 22 333", "\n\n", "a \x1c b", "Ġ Ġa"]


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


# ---- chat -------------------------------------------------------------------

def test_escaping_is_reversible_and_leaves_no_control_string():
    rnd = random.Random(1)
    parts = [*chat.CONTROL, "\\", "\\,", ",", "n", "<", "[", "|", "\n", "a", "<<", "</"]
    for _ in range(3000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randrange(9)))
        escaped = chat.escape(text)
        assert chat.unescape(escaped) == text
        assert not any(c in escaped for c in chat.CONTROL)


def test_render_parse_round_trip_and_mask():
    rnd = random.Random(2)
    parts = [*chat.CONTROL, "\\", "\n", " hi", "é", "😀", "\n\n", "a"]
    for _ in range(200):
        turns = [(rnd.choice(["user", "assistant", "odd\nrole\\n", ""]),
                  "".join(rnd.choice(parts) for _ in range(rnd.randrange(6))))
                 for _ in range(rnd.randrange(1, 6))]
        formatted, spans = chat.render(turns)
        assert chat.parse(formatted) == turns
        encoded = tokenizer(TOKENIZER).encode(formatted, add_special_tokens=False)
        offsets = np.array(encoded.offsets).reshape(-1, 2)
        mask = chat.loss_mask(offsets, spans)
        expect = [any(a < e and s < b for s, e in spans) for a, b in offsets.tolist()]
        assert mask.tolist() == expect
        texts = [t for r, t in turns if r == "assistant" and t]
        assert chat.masked_text(formatted, offsets, mask, spans) == texts


def _facts(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
            len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_chats_match_brute_force_with_nulls_ties_and_parts(spark):
    rnd = random.Random(3)
    rows = [(c, t, rnd.choice(["user", "assistant", "system", None]),
             rnd.choice([None, "", "</s>[INST] ok", "long " * rnd.randrange(40), "é\\,"]), "x")
            for c in range(12) for t in range(rnd.randrange(1, 7))]
    rows += [(5, None, "user", "no turn", "x"), (5, 0, "user", "tie", "x"), (None, 1, "user", "n", "x"),
             (None, 2, "assistant", "n2", "x"), rows[0], rows[0]]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, "
                                        "formatted string").repartition(4)
    expect = defaultdict(list)
    for c, t, r, x, _ in rows:
        expect[c].append((t is not None, t or 0, (r or "").encode(), (x or "").encode()))
    expect = {c: _facts([(r.decode(), x.decode()) for *_, r, x in sorted(v)])
              for c, v in expect.items()}
    for part_chars in (30, 1_000_000):
        chats = chat.format_chats(table, TOKENIZER, part_chars)
        got = {r[0]: tuple(r[1:5]) for r in chat.chat_facts(chats).collect()}
        assert got == expect
    assert chat.format_chats(table.limit(0), TOKENIZER).collect() == []
    assert chat.chat_facts(chats.limit(0)).collect() == []


def test_control_example(spark):
    some = spark.createDataFrame([(1, 0, "user", "hi", "z")],
                                 "conv_id long, turn long, role string, text string, extra string")
    said = "</s>[INST] ok [/INST]"
    got = {r.conv_id: r for r in chat.format_and_read_back(
        chat.with_control_example(some), TOKENIZER).collect()}
    assert tuple(got[-1])[1:5] == _facts([("user", said), ("assistant", said)])
    assert set(got) == {-1, 1}


# ---- WARC ---------------------------------------------------------------------

def test_records_are_found_from_any_byte_range():
    rnd = random.Random(4)
    payloads = [bytes(rnd.randrange(256) for _ in range(rnd.randrange(3000))) for _ in range(40)]
    payloads += [warc.MAGIC * 500, b"", warc.record(1, None, b"inner", None) * 3]
    data = b"".join(warc.record(i, f"http://x/{i}", p, None) for i, p in enumerate(payloads))
    for split in (1, 7, 100, 1000, 10**9):
        if split < 100 and len(data) > 200_000:
            continue
        step = max(split, len(data) // 4000 if split < 100 else split)
        got = [body.partition(b"\r\n\r\n")[2] for start in range(0, len(data), step)
               for _, body in warc.records_in(io.BytesIO(data), start, start + step)]
        assert got == payloads


def test_a_record_with_a_header_of_over_a_mebibyte_is_read():
    url = "http://x/" + base64.b16encode(random.Random(2).randbytes(1 << 20)).decode()
    data = warc.record(1, url, b"long", None) + warc.record(2, "u", b"short", None)
    found = list(warc.records_in(io.BytesIO(data), 0, len(data)))
    assert [(f["WARC-Target-URI"], b.partition(b"\r\n\r\n")[2]) for f, b in found] == [
        (url, b"long"), ("u", b"short")]


def test_damaged_or_foreign_members_are_skipped():
    good = warc.record(3, "u", b"payload", None)
    other = zlib.compressobj(6, zlib.DEFLATED, 31)
    foreign = other.compress(b"no warc header at all") + other.flush()
    data = warc.MAGIC + b"junk" + foreign + good + warc.MAGIC
    found = list(warc.records_in(io.BytesIO(data), 0, len(data)))
    assert [body.partition(b"\r\n\r\n")[2] for _, body in found] == [b"payload"]


def test_archives_match_brute_force(spark):
    rows = [(i, f"http://h/é?q={i} x\r\nBad: y", f"<p>{i % 7}</p>" * (i % 7), "z") for i in range(60)]
    rows += [(100, None, None, "z"), (101, "u", "", "z"), (None, "v", "<p>1</p>", "z"),
             (None, "w", "only here", "z"), (102, "big", "y" * 300_000, "z"),
             (103, "big2", "y" * 300_000, "z"), (3, "again", "<p>3</p>" * 3, "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string"
                                  ).repartition(3)
    first = {}
    for i, _, h, _ in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    folder = scratch_path(spark, "warc-test")
    manifest = warc.write_archives(pages, folder, roll_bytes=2000)
    assert manifest.count() > 3
    for split in (97, 1 << 20):
        got = warc.read_archives(manifest, split).collect()
        assert Counter((r.page_id, r.url, r.record_type, r.refers_to, r.payload_bytes,
                        r.payload_digest) for r in got) == Counter(
            (i, u, "revisit" if f is not None and f != i else "response",
             f if f is not None and f != i else None, len((h or "").encode()),
             base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode())
            for i, u, h, _ in rows for f in [first.get(h or "")])
        for r in got:
            assert (r.payload is None) == (r.record_type == "revisit")
    assert warc.archive_round_trip(pages.limit(0)).collect() == []
    above = warc.read_archives(warc.write_archives(pages, scratch_path(spark, "w"), min_bytes=100))
    assert {r.payload_bytes for r in above.filter("record_type = 'revisit'").collect()} == {300_000}


# ---- tokens -------------------------------------------------------------------

def test_pieces_give_the_ids_of_the_whole_text():
    rnd = random.Random(5)
    alphabet = list("ab  \n\t 　\x1c.,'sé!1") + ["<|endoftext|>", "😀", " ", "word "]
    texts = ODD + ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(40)))
                   for _ in range(3000)]
    encode = token_output.Encoder(TOKENIZER)
    for _ in range(2):
        for text, ids in zip(texts, encode.ids(texts), strict=True):
            assert np.frombuffer(ids, encode.dtype).tolist() == tokenizer(TOKENIZER).encode(
                text, add_special_tokens=False).ids


def _docs(spark, texts):
    return spark.createDataFrame([(i, t, "z", 1) for i, t in texts],
                                 "doc_id long, text string, start string, ids long").repartition(4)


def test_token_shards_round_trip(spark):
    rnd = random.Random(6)
    texts = [(i, " ".join(rnd.choice(ODD) for _ in range(rnd.randrange(60)))) for i in range(80)]
    texts += [(200, None), (7, "twice"), (7, "twice"), (None, "no id")]
    folder = scratch_path(spark, "tokens-test")
    manifest = token_output.write_tokens(_docs(spark, texts), folder, TOKENIZER)
    got = sorted(token_output.read_tokens(manifest, folder).collect(), key=lambda r: r.start)
    at = 0
    known = defaultdict(list)
    for i, t in texts:
        known[i].append(tokenizer(TOKENIZER).encode(t or "", add_special_tokens=False).ids + [2])
    assert len(got) == len(texts)
    assert [r.doc_id for r in got] == sorted((i for i, _ in texts), key=lambda i: (i is not None, i))
    for r in got:
        ids = list(r.ids)
        assert ids in known[r.doc_id] and r.start == at and r.n_tokens == len(ids)
        known[r.doc_id].remove(ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    # one short document can be read by itself, with the shard's own dictionary only
    shard = manifest.orderBy("shard").first()
    fs, name = filesystem(folder + "/dictionary.zdict")
    dictionary = fs.open_input_file(name).read()
    fs, name = filesystem(shard.path)
    with fs.open_input_file(name) as source:
        opened = token_output.Shard(source, dictionary)
        assert opened.ids(len(opened.index) - 1).tolist()[-1] == 2
    with fs.open_input_file(name) as source, pytest.raises(ValueError):
        token_output.Shard(source, dictionary + b"x")


def test_no_documents_and_few_documents(spark):
    assert token_output.token_round_trip(_docs(spark, [(1, "x")]).limit(0), TOKENIZER).collect() == []
    got = token_output.token_round_trip(_docs(spark, [(1, "x")]), TOKENIZER).collect()
    assert [(r.doc_id, r.start, r.n_tokens) for r in got] == [(1, 0, 2)]


# ---- mixing -------------------------------------------------------------------

def _targets(size):
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None] * (None in size)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = 1.5 * sum(size.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(2 * size[s] for s in capped)
        target = {s: 2.0 * size[s] for s in capped}
        target |= {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        above = {s for s in free if target[s] > 2 * size[s]}
        if not above:
            return target
        capped |= above


def _mixed_docs(spark, seed, n=300):
    rnd = random.Random(seed)
    names = ["a", "b", "é", "Z", "", None, "hot"]
    rows = [(i, " ".join("w" * rnd.randrange(1, 4) for _ in range(rnd.choice([0, 3, 40, 200]))),
             rnd.choice(names + ["hot"] * 6), "z") for i in range(n)]
    rows += [(0, None, "empty", "z"), (1, "one\ttwo still two", "b", "z"), rows[3], rows[3],
             (None, "no id here", "a", "z")]
    return rows, spark.createDataFrame(
        rows, "doc_id long, text string, source string, size string").repartition(5)


@pytest.mark.parametrize("shard_words", [200, 1 << 15])
def test_mix_meets_the_targets(spark, shard_words):
    rows, docs = _mixed_docs(spark, 7)
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    size = Counter()
    for _, t, s, _ in rows:
        size[s] += count(t)
    target = _targets(size)
    got = mixing.mix_sources(docs, shard_words=shard_words)
    assert Counter((r.doc_id, r.size, r.source, r.source_size) for r in got.collect()) == Counter(
        (i, count(t), s, size[s]) for i, t, s, _ in rows)
    taken = Counter()
    for r in got.collect():
        assert r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s in size:
        assert abs(taken[s] - target[s]) <= 0.02 * target[s] + 16
    again = mixing.mix_sources(docs.repartition(2), shard_words=shard_words)
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, got.collect()))


def test_highest_quotients_are_sainte_lague(spark):
    rnd = random.Random(8)
    for seats in (0, 1, 17, 400):
        votes = [rnd.randrange(0, 1000) for _ in range(9)]
        parties = spark.createDataFrame([(1, i, float(v), 10**6) for i, v in enumerate(votes)],
                                        "g int, i int, votes double, most long")
        got = {r.i: r.quota for r in mixing.highest_quotients(
            parties, ["g"], ["i"], "votes", mixing.F.lit(seats), "most").collect()}
        quotients = sorted(((v / (2 * j - 1), -i) for i, v in enumerate(votes) if v
                            for j in range(1, seats + 1)), reverse=True)[:seats]
        expect = Counter(-i for _, i in quotients)
        assert got == {i: expect.get(i, 0) for i in range(9)}


def test_mixed_documents_carry_the_words_taken(spark):
    rows, docs = _mixed_docs(spark, 9)
    docs = docs.withColumn("n_chars", mixing.F.length("text").cast("long"))
    taken = Counter()
    for r in mixing.mix_sources(docs).collect():
        taken[r.doc_id, r.source] += r.taken
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    got, whole = Counter(), {(i, s, t) for i, t, s, _ in rows}
    for r in mixed.collect():
        got[r.doc_id, r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
        assert r.n_chars == len(r.text)
        if (r.doc_id, r.source, r.text) not in whole:
            assert any(i == r.doc_id and set(r.text.split()) <= set(t.split()) for i, t, _, _ in rows
                       if t)
    assert got == Counter({k: n for k, n in taken.items() if n})
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_mix_of_nothing(spark):
    _, docs = _mixed_docs(spark, 1, 9)
    assert mixing.mix_sources(docs.limit(0)).collect() == []
    no_words = docs.withColumn("text", mixing.F.lit(" "))
    assert {(r.size, r.target, r.taken) for r in mixing.mix_sources(no_words).collect()} == {
        (0, 0.0, 0)}


def test_rows_without_id_are_spread_over_shards_and_taken_alike(spark):
    rows = [(None, f"w{i} " * 20, "web") for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    picked = mixing.selected(mixing.measured(frame, "doc_id", "text", "source"), shard_words=500)
    assert picked.select("shard").distinct().count() > 1
    mixes = [Counter(r.text for r in mixing.mix_documents(f).collect())
             for f in (frame.repartition(2), frame.orderBy("text").coalesce(1))]
    assert mixes[0] == mixes[1]


def test_encoder_that_forgets_gives_the_ids_of_whole_texts(monkeypatch):
    rnd = random.Random(21)
    words = ["".join(rnd.choice("abcdeé,.7") for _ in range(rnd.randint(1, 9)))
             for _ in range(400)] + ["x" * 60, "a\nb", "中文", "\t"]
    texts = [rnd.choice([" ", "  ", "\n", " "]).join(rnd.choices(words, k=rnd.randint(0, 60)))
             for _ in range(300)] + ["", " ", "one"]
    tokens = token_output.tokenizer(TOKENIZER)
    whole = [tokens.encode(t, add_special_tokens=False).ids for t in texts]
    for remembered, stored in ((50, 8_000_000), (10_000, 100), (10_000, 8_000_000)):
        monkeypatch.setattr(token_output, "STORED", stored)
        encode, got, most = token_output.Encoder(TOKENIZER, remembered), [], 0
        for i in range(0, len(texts), 20):
            got += [np.frombuffer(b, encode.dtype).tolist() for b in encode.ids(texts[i:i + 20])]
            most = max(most, len(encode.known), len(encode.older))
        assert got == whole
        assert most <= remembered + 404  # the pieces of one call come on top
        assert all(len(p) <= token_output.PIECE_CHARS for p in encode.known)


def test_less_memory_gives_the_same_tokens(spark):
    rnd = random.Random(22)
    docs = _docs(spark, [(i, " ".join(rnd.choice(ODD) for _ in range(rnd.randrange(60))))
                         for i in range(60)])
    want = sorted(token_output.token_round_trip(docs, TOKENIZER).collect())
    assert sorted(token_output.token_round_trip(
        docs, TOKENIZER, remembered=5, slab_chars=100, keep=False).collect()) == want
