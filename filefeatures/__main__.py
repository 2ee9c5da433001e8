"""Command line for spark-submit: one sub-command per job."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from filefeatures.contracts import CATEGORY_COLUMN, IN_PATTERN, OUT_PATTERN, SOURCE_FILE
from filefeatures.functions.paths import without_scheme
from filefeatures.operators.labels import fit_labels, load_labels
from filefeatures.operators.scoring import score_constant
from filefeatures.plans.delivery import deliver_predictions, undelivered
from filefeatures.plans.features import (
    features_handler,
    listing_features,
    run_features,
    score_target,
    train_on_target,
)
from filefeatures.plans.importer import run_import
from filefeatures.session import build_session, scratch_scope, stage
from filefeatures.sinks.csv import write_csv
from filefeatures.sources.csv import named_root, read_by_header
from filefeatures.streaming.arrivals import append_files, watch_files
from filefeatures.streaming.ledger import Ledger
from filefeatures.streaming.rows import FILES_PER_BATCH, append_csv, read_csv_stream


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="filefeatures", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    labels = jobs.add_parser("labels", help="rank the categories of a folder and store them")
    train = jobs.add_parser("train", help="fit a model of the target column on a folder and store it")
    features = jobs.add_parser("features", help="turn the files of a folder into features")
    watch = jobs.add_parser("watch", help="turn each file that lands in FOLDER/in into features")
    watch.add_argument("--checkpoint", required=True)
    watch.add_argument("--quarantine", help="folder for the names of files that fail")
    watch.add_argument("--in-pattern", default=IN_PATTERN, help="paths below FOLDER that are taken, matched as a whole")
    watch.add_argument("--out-pattern", default=OUT_PATTERN, help="paths below FOLDER that are answers")
    watch.add_argument("--max-files", type=int, default=FILES_PER_BATCH, help="files per micro-batch")
    take = jobs.add_parser("take", help="one pass: features of the files that are new, or were replaced under their name")
    take.add_argument("--ledger", required=True, help="folder that says which files were taken")
    for job in (labels, train, features, watch, take):
        job.add_argument("folder")
        job.add_argument("out")
        job.add_argument("--one-line-rows", action="store_true", help="no value holds a line break")
    for job in (features, watch, take):
        job.add_argument("--id-column", help="name of the feed's identifier column")
        job.add_argument("--labels", help="stored categories; without them they are ranked from the input")
        job.add_argument("--per-file", action="store_true", help="rank the categories of each file alone")
        job.add_argument("--model", help="stored model to predict with")
    train.add_argument("--labels", required=True)
    train.add_argument("--numeric", nargs="*", default=[], help="columns the model takes as numbers")

    stream = jobs.add_parser("stream", help="append a prediction to each row that arrives")
    stream.add_argument("folder")
    stream.add_argument("out")
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--schema", required=True, help="column types, such as 'a string, b int'")
    stream.add_argument("--no-header", action="store_true")
    stream.add_argument("--quarantine", help="folder for files with another header and for rows that break the schema")
    stream.add_argument("--max-files", type=int, default=FILES_PER_BATCH, help="files per micro-batch")

    importer = jobs.add_parser("import", help="import the CSV files of a folder once")
    importer.add_argument("folder")
    importer.add_argument("out")
    for job in (stream, importer):
        job.add_argument("--one-line-rows", action="store_true", help="no value holds a line break")

    deliver = jobs.add_parser("deliver", help="join predictions to their features, one folder per input file")
    deliver.add_argument("features", help="parquet of features")
    deliver.add_argument("predictions", help="parquet of predictions, one row per key")
    deliver.add_argument("out")
    deliver.add_argument("--keys", nargs="+", required=True)
    deliver.add_argument("--by", default=SOURCE_FILE, help="column that names the input file")
    missing = jobs.add_parser("undelivered", help="which input files have an answer")
    missing.add_argument("folder")
    missing.add_argument("answers")
    missing.add_argument("out")

    return parser.parse_args(argv)


def feature_options(spark: SparkSession, args: argparse.Namespace) -> dict:
    labels = load_labels(spark, args.labels) if args.labels else None
    options = {"labels": labels, "id_column": args.id_column, "multiline": multiline(args)}
    if args.per_file:
        options["per_file"] = True
    if args.model:
        options["score"] = lambda features: score_target(features, args.model)
    return options


def multiline(args: argparse.Namespace) -> bool | None:
    return False if args.one_line_rows else None


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    spark = build_session(f"filefeatures-{args.job}")
    if args.job == "watch":
        watch_files(
            spark,
            args.folder,
            args.checkpoint,
            on_in=features_handler(spark, args.out, root=without_scheme(f"{args.folder.rstrip('/')}/in"), **feature_options(spark, args)),
            quarantine=args.quarantine,
            root=without_scheme(args.folder),
            in_pattern=args.in_pattern,
            out_pattern=args.out_pattern,
            max_files=args.max_files,
        ).awaitTermination()
    elif args.job == "take":
        root = named_root(spark, args.folder)
        Ledger(spark, args.ledger).take(args.folder, features_handler(spark, args.out, root, **feature_options(spark, args)))
    elif args.job == "stream":
        how = {"header": not args.no_header, "max_files": args.max_files}
        if args.quarantine:
            schema = T.StructType.fromDDL(args.schema)
            target = (args.out, args.quarantine, args.checkpoint)
            append_files(
                spark, args.folder, schema, *target, derive=score_constant, multiline=multiline(args), **how
            ).awaitTermination()
        else:
            rows = read_csv_stream(spark, args.folder, args.schema, multiline=not args.one_line_rows, **how)
            append_csv(score_constant(rows), args.out, args.checkpoint).awaitTermination()
    elif args.job == "import":
        with scratch_scope(spark):
            run_import(spark, args.folder, args.out, multiline=multiline(args))
    elif args.job == "deliver":
        features, predictions = spark.read.parquet(args.features), spark.read.parquet(args.predictions)
        deliver_predictions(features, predictions, args.keys, args.out, by=args.by)
    elif args.job == "undelivered":
        write_csv(undelivered(spark, args.folder, args.answers), args.out)
    else:
        with scratch_scope(spark):
            if args.job == "features":
                run_features(spark, args.folder, args.out, **feature_options(spark, args))
                return
            rows = read_by_header(spark, args.folder, multiline=multiline(args))
            if args.job == "labels":
                fit_labels(rows, CATEGORY_COLUMN).save(args.out)
            else:
                features = stage(listing_features(rows))
                train_on_target(features, load_labels(spark, args.labels), args.numeric, args.out)


if __name__ == "__main__":
    main()
