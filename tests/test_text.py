"""Sources and text counts."""

from collections import Counter

from cohortlens.operators import textcount
from cohortlens.sources import text

WORDS = ["Names", "Lesley", "Tashya", "Lesley", "TaShya", "Tashya", "Jada", "Cadman", "Jada",
         "Cadman", "Zed"]


def test_split_keeps_trailing_empty_cells(spark, lines):
    rows = text.wide_rows(spark, lines(["a,b,,", "x"])).collect()
    assert sorted(len(r["cells"]) for r in rows) == [1, 4]


def test_read_lines_from_file(spark, tmp_path):
    p = tmp_path / "words.txt"
    p.write_text("\n".join(WORDS))
    assert text.read_lines(spark, str(p)).count() == len(WORDS)


def test_word_and_char_counts(spark, lines):
    counted = textcount.token_counts(textcount.tokens(lines(WORDS, 3)), 2)
    words = {r["token"]: r["n"] for r in counted.collect()}
    assert words == {"Lesley": 2, "Tashya": 2, "Jada": 2, "Cadman": 2}  # TaShya differs
    chars = {r["ch"]: r["n"] for r in textcount.char_counts(counted).collect()}
    assert chars == dict(Counter("".join(words)))


def test_whitespace_words(spark, lines):
    toks = textcount.tokens(lines(["  a b\ta", "b\n\na "]), textcount.WHITESPACE, drop_empty=True)
    counted = {r["token"]: r["n"] for r in textcount.token_counts(toks, 1).collect()}
    assert counted == {"a": 3, "b": 2}


def test_characters_are_code_points(spark, lines):
    counted = textcount.token_counts(textcount.tokens(lines(["éé", "éé"])), 2)
    chars = {r["ch"]: r["n"] for r in textcount.char_counts(counted).collect()}
    assert chars == {"é": 2}


def test_fixed_width_key_groups(spark, lines):
    rows = ["PATIENT_ID,DIAGNOSIS,AGE", "X332_120501,1,3", "X333_120501,4,3",
            "X334_120501,NA,3", "X335_120501,5,1", "X336_120501,2,1"]
    got = {r["key"]: (r["n_lines"], r["grp"]) for r in textcount.key_groups(lines(rows), 12)
           .collect()}
    assert got == {"1": (1, "control"), "4": (1, "case"), "5": (1, "case"), "2": (1, None)}


def test_background_quarantines_malformed_lines(spark, lines, tmp_path):
    src = ["1 Age:50 Sex:M Ed:PhD", "X700_120605,71,F,PhD", "X701_120605,abc,M,HS",
           "X702_120605,60,M"]
    got = text.background(spark, lines(src)).collect()
    good = [r for r in got if r["_corrupt_record"] is None]
    assert [(r["sample_id"], r["age"]) for r in good] == [("X700_120605", 71)]
    assert len(got) - len(good) == 3
    quality = text.background_quality(text.background(spark, lines(src))).first()
    assert tuple(quality) == (4, 1, 3)


def test_both_background_readers_agree(spark, tmp_path):
    src = ['X1,71,F,"BS"', "", "no commas here", "X2, 60 ,M,", "X3,1,2,3,4", "X4,5x,M,HS",
           'X5,40,"F,MS', "X6,30,,MS", ",50,M,MS", "#X7,20,M,HS", "X8,,M,HS", "a\\,9,F,HS"]
    p = tmp_path / "patients.csv"
    p.write_text("\n".join(src) + "\n")
    split = sorted(map(str, text.background(spark, str(p)).collect()))
    assert sorted(map(str, text.background_csv(spark, str(p)).collect())) == split
    rows = {r["_corrupt_record"]: r for r in text.background(spark, str(p)).collect()}
    assert {"", "no commas here", "X3,1,2,3,4", "X4,5x,M,HS", "X8,,M,HS"} < set(rows)
    assert all(rows[line]["sample_id"] is None for line in rows if line is not None)


def test_characters_take_linear_time_and_keep_code_points(spark, lines):
    long = "aé😀" * 30_000
    counted = textcount.token_counts(textcount.tokens(lines([long, long])), 2)
    chars = {r["ch"]: r["n"] for r in textcount.char_counts(counted).collect()}
    assert chars == {"a": 30_000, "é": 30_000, "😀": 30_000}
