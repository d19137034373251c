"""Command line: ``spark-submit`` / ``python -m cohortlens <command> …``.

Commands mirror the original scripts and menu actions:

  rank       rank clusters by Welch t (optionally look one cluster up)
  features   per-sample top-k feature table with background
  classify   3-fold cross-validation of tree / forest classifiers
  wordcount  thresholded token counts and character counts
  land       parse a wide text matrix once into long parquet (then --landed)

Results are written with ``--out`` (parquet, overwrite) or a bounded number
of rows is shown; nothing unbounded is collected to the driver.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from cohortlens.operators import model as ml
from cohortlens.operators import textcount
from cohortlens.plans.cohort import from_landed, from_wide, land_wide
from cohortlens.session import durable
from cohortlens.sources import text


def _emit(df: DataFrame, out: str | None, show: int) -> None:
    if out:
        df.write.mode("overwrite").parquet(out)
    else:
        df.show(show, truncate=False)


def _analysis(spark, args):
    opts = dict(species=args.species, control=args.control.split(","),
                case=args.case.split(","), k=args.k)
    if args.landed:
        return from_landed(spark, args.landed, args.annotation, **opts)
    return from_wide(spark, args.matrix, args.annotation, **opts)


def _background(spark, args) -> DataFrame:
    """The usable background lines; how many were set aside is shown."""
    parsed = text.background(spark, args.background)
    text.background_quality(parsed).show()
    return parsed.filter(f"{text.CORRUPT} IS NULL").drop(text.CORRUPT)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="cohortlens")
    sub = p.add_subparsers(dest="command", required=True)

    def cohort_args(sp):
        src = sp.add_mutually_exclusive_group(required=True)
        src.add_argument("--matrix", help="wide delimited matrix (header inside)")
        src.add_argument("--landed", help="folder written by the land command")
        sp.add_argument("--annotation", required=True, help="cluster annotation file")
        sp.add_argument("--species", default=text.SPECIES_KEPT)
        sp.add_argument("--control", default="1", help="comma-separated control codes")
        sp.add_argument("--case", default="4,5", help="comma-separated case codes")
        sp.add_argument("--k", type=int, default=10)
        sp.add_argument("--out")
        sp.add_argument("--show", type=int, default=20)

    rank = sub.add_parser("rank")
    cohort_args(rank)
    rank.add_argument("--lookup", help="print this cluster's statistics instead")

    feats = sub.add_parser("features")
    cohort_args(feats)
    feats.add_argument("--background", required=True)

    cls = sub.add_parser("classify")
    cohort_args(cls)
    cls.add_argument("--background", required=True)
    cls.add_argument("--feature-set", default="genes", choices=("genes", "life_stats"))
    cls.add_argument("--trees", type=int, default=ml.DEFAULT_TREES)
    # --out gets folds/, mean_error/, trees/ (the learned trees as text) and holdout/

    wc = sub.add_parser("wordcount")
    wc.add_argument("path")
    wc.add_argument("threshold", type=int)
    wc.add_argument("--out", help="folder; words/ and chars/ are written below it")
    wc.add_argument("--show", type=int, default=20)

    land = sub.add_parser("land")
    land.add_argument("--matrix", required=True)
    land.add_argument("--out", required=True)

    args = p.parse_args(argv)
    spark = SparkSession.builder.appName(f"cohortlens-{args.command}").getOrCreate()

    if args.command == "land":
        land_wide(spark, args.matrix, args.out)
        return

    if args.command == "wordcount":
        counted = textcount.token_counts(textcount.tokens(text.read_lines(spark, args.path)),
                                         args.threshold)
        if args.out:
            # characters come from the written word table: the corpus is read once
            _emit(counted, f"{args.out}/words", args.show)
            words = spark.read.parquet(f"{args.out}/words")
            _emit(textcount.char_counts(words), f"{args.out}/chars", args.show)
        else:
            counted = durable(counted)
            _emit(textcount.char_counts(counted), None, args.show)
            _emit(counted, None, args.show)
        return

    a = _analysis(spark, args)
    if args.command == "rank":
        _emit(a.lookup(args.lookup) if args.lookup else a.report(), args.out, args.show)
    elif args.command == "features":
        _emit(a.sample_features(_background(spark, args)), args.out, args.show)
    elif args.command == "classify":
        features = durable(a.sample_features(_background(spark, args)))
        ml.age_quality(features).show()
        points = ml.labeled_points(features, args.feature_set, args.k)
        per_fold, results = ml.cross_validate(points, num_trees=args.trees)
        per_fold = durable(per_fold)
        for name, table in (("folds", per_fold), ("mean_error", ml.mean_error(per_fold)),
                            ("trees", ml.tree_texts(spark, results)),
                            ("holdout", ml.holdout_error(points))):
            _emit(table, args.out and f"{args.out}/{name}", args.show)


if __name__ == "__main__":
    main()
