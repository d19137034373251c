"""Streaming token counts and the command line."""

import os
import tempfile

from cohortlens.__main__ import main
from cohortlens.operators.model import MODELS
from cohortlens.streaming import token_counts_stream
from tests.conftest import ANNOTATION, MATRIX


def test_stream_counts_match_batch(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("Lesley\nJada\nLesley\n")
    (src / "b.txt").write_text("Jada\nZed\n")
    counts = token_counts_stream(spark, str(src), 2)
    q = (counts.writeStream.outputMode("complete").format("memory").queryName("tok_counts")
         .option("checkpointLocation", tempfile.mkdtemp(dir=str(tmp_path)))
         .start())
    try:
        q.processAllAvailable()
        got = {r["token"]: r["n"] for r in spark.sql("SELECT * FROM tok_counts").collect()}
    finally:
        q.stop()
    assert got == {"Lesley": 2, "Jada": 2}


def test_cli_rank_and_wordcount(spark, tmp_path):
    m, a = tmp_path / "matrix.csv", tmp_path / "ann.csv"
    m.write_text("\n".join(MATRIX) + "\n")
    a.write_text("\n".join(ANNOTATION) + "\n")
    out = str(tmp_path / "ranked")
    main(["rank", "--matrix", str(m), "--annotation", str(a), "--out", out])
    rows = spark.read.parquet(out).orderBy("rank").collect()
    assert [r["cluster"] for r in rows] == ["c1", "c2"]

    w = tmp_path / "words.txt"
    w.write_text("a\nb\na\n")
    main(["wordcount", str(w), "2", "--out", str(tmp_path / "wc")])
    words = {r["token"]: r["n"] for r in spark.read.parquet(str(tmp_path / "wc/words")).collect()}
    assert words == {"a": 2}
    assert os.path.isdir(tmp_path / "wc/chars")


def test_cli_land_then_rank_from_landed(spark, tmp_path):
    m, a = tmp_path / "matrix.csv", tmp_path / "ann.csv"
    m.write_text("\n".join(MATRIX) + "\n")
    a.write_text("\n".join(ANNOTATION) + "\n")
    main(["land", "--matrix", str(m), "--out", str(tmp_path / "landed")])
    main(["rank", "--landed", str(tmp_path / "landed"), "--annotation", str(a),
          "--out", str(tmp_path / "ranked")])
    rows = spark.read.parquet(str(tmp_path / "ranked")).orderBy("rank").collect()
    assert [r["cluster"] for r in rows] == ["c1", "c2"]


def test_cli_features_and_classify(spark, tmp_path):
    rows = ["PATIENT_ID,DIAGNOSIS,10,20,30"]
    bg = ["1 Age:50 Sex:M Ed:PhD"]  # a malformed line is quarantined
    for i in range(60):
        code = "1" if i % 2 else "4"
        hi = 9 if code == "4" else 1
        rows.append(f"S{i},{code},{hi + i % 3},{i % 4},{(i * 7) % 5}")
        bg.append(f"S{i},{50 + i % 30},{'F' if i % 3 else 'M'},BS")
    m, a, b = tmp_path / "m.csv", tmp_path / "a.csv", tmp_path / "b.csv"
    m.write_text("\n".join(rows) + "\n")
    a.write_text("\n".join(ANNOTATION) + "\n")
    b.write_text("\n".join(bg) + "\n")
    common = ["--matrix", str(m), "--annotation", str(a), "--background", str(b), "--k", "2"]
    main(["features", *common, "--out", str(tmp_path / "f")])
    feats = spark.read.parquet(str(tmp_path / "f"))
    assert feats.count() == 60 and feats.filter("age IS NULL").count() == 0
    main(["classify", *common, "--feature-set", "life_stats", "--trees", "3",
          "--out", str(tmp_path / "cv")])
    cv = spark.read.parquet(str(tmp_path / "cv/folds")).collect()
    assert len(cv) == 9 and all(r["n"] > 0 for r in cv)
    mean = spark.read.parquet(str(tmp_path / "cv/mean_error"))
    assert {r["model"] for r in mean.collect()} == set(MODELS)
    trees = spark.read.parquet(str(tmp_path / "cv/trees"))
    assert trees.select("model", "fold").distinct().count() == 9
    assert trees.filter("line like '%If (feature%'").count() > 0
    assert spark.read.parquet(str(tmp_path / "cv/holdout")).first()["n"] > 0
