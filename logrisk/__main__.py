"""Run one stage: ``spark-submit ... -m logrisk <stage> ...`` or ``python -m logrisk``."""

from __future__ import annotations

import argparse
from importlib import import_module

from pyspark.sql import SparkSession

from logrisk.functions.buckets import BucketStyle
from logrisk.operators import alerts, counts
from logrisk.operators.alerts import CompletionSettings
from logrisk.operators.features import FeatureParams
from logrisk.operators.risk_model import ModelParams
from logrisk.plans import stages
from logrisk.sources import readers
from logrisk.sources.headers import read_first_lines


def _bucket_options(stage: argparse.ArgumentParser) -> None:
    stage.add_argument("--hourly-hdfs", action="store_true")
    stage.add_argument("--separator", default=" ")


def _lengths(text: str) -> tuple[int, ...]:
    return tuple(int(part) for part in text.split(",") if part)


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="logrisk")
    stage = parser.add_subparsers(dest="stage", required=True)

    parse = stage.add_parser("parse", help="raw lines to records and rejects")
    parse.add_argument("source", choices=("HDFS", "BGL"))
    parse.add_argument("raw")
    parse.add_argument("output")

    count = stage.add_parser("count", help="structured files to count lines and rejects")
    count.add_argument("structured", help="comma-separated paths")
    count.add_argument("output")
    _bucket_options(count)
    count.add_argument("--hdfs-header-of", help="find HDFS columns by the header of these files")
    count.add_argument("--bgl-header-of", help="find BGL columns by the header of these files")
    count.add_argument("--own-headers", action="store_true", help="find columns by each file's own header")
    count.add_argument("--rejects")

    records = stage.add_parser("count-records", help="parsed records to count lines")
    records.add_argument("output")
    records.add_argument("--hdfs", help="records of the parse stage")
    records.add_argument("--bgl", help="records of the parse stage")
    _bucket_options(records)

    usual = FeatureParams()
    feature = stage.add_parser("features", help="count lines to the feature table and rejects")
    feature.add_argument("counts", help="comma-separated paths or globs")
    feature.add_argument("output")
    feature.add_argument("--share-of", default=usual.share_of, choices=("source", "cluster"))
    feature.add_argument("--label-by", default=usual.label_by, choices=("rule", "horizon"))
    feature.add_argument("--label-share", type=float, default=usual.label_share)
    feature.add_argument("--horizon-hours", type=int, default=usual.horizon_hours)
    feature.add_argument("--level-of", default=usual.level_of, choices=("history", "as_of"))
    feature.add_argument("--slices", default=usual.slices, choices=("prefix", "range"))
    feature.add_argument("--slice-chars", type=_lengths, default=usual.slice_chars, help="like 7,4")
    feature.add_argument("--bucket-parts", type=int, default=usual.bucket_parts)
    feature.add_argument("--rejects")

    forest = ModelParams()
    model = stage.add_parser("model", help="feature table to model, predictions and metrics")
    model.add_argument("features")
    model.add_argument("model")
    model.add_argument("predictions")
    model.add_argument("--train-tenths", type=int, default=forest.train_tenths)
    model.add_argument("--split", default=forest.split, choices=("key", "random", "time"))
    model.add_argument("--gap-hours", type=int, default=forest.gap_hours, help="between training and test by time")
    model.add_argument("--sql", help="store the forest as a query over the feature table")
    model.add_argument("--trees", type=int, default=forest.trees)
    model.add_argument("--depth", type=int, default=forest.depth)
    model.add_argument("--seed", type=int, default=forest.seed)
    model.add_argument("--partitions", type=int, default=forest.partitions)

    told = CompletionSettings()
    alert = stage.add_parser("alerts", help="strongest alerts with prompts and answers")
    alert.add_argument("table")
    alert.add_argument("output")
    alert.add_argument("--by", default="flag", choices=("flag", "model"))
    alert.add_argument("--limit", type=int, default=3)
    alert.add_argument("--per-source", action="store_true")
    alert.add_argument("--velocity", action="store_true", help="tell the change in the prompt")
    alert.add_argument("--connect", help="module:function that returns the completion function")
    alert.add_argument("--model-name", default=told.model)
    alert.add_argument("--temperature", type=float, default=told.temperature)
    alert.add_argument("--max-tokens", type=int, default=told.max_tokens)
    alert.add_argument("--answers", help="folder of answers that are not asked for again")
    alert.add_argument("--tasks", type=int, default=8, help="completions at once")
    return parser.parse_args(argv)


def _layout(spark: SparkSession, args: argparse.Namespace):
    if args.own_headers:
        return counts.file_layouts(read_first_lines(spark, args.structured))
    header = lambda paths: readers.first_header(spark, paths) if paths else None
    return counts.header_layout(header(args.hdfs_header_of), header(args.bgl_header_of))


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = SparkSession.builder.appName(f"logrisk-{args.stage}").getOrCreate()
    if args.stage == "parse":
        stages.parse_stage(spark, args.raw, args.source, args.output)
    elif args.stage == "count":
        style = BucketStyle(args.hourly_hdfs, args.separator)
        stages.count_stage(spark, args.structured, args.output, _layout(spark, args), style, args.rejects)
    elif args.stage == "count-records":
        records = {source: path for source, path in (("HDFS", args.hdfs), ("BGL", args.bgl)) if path}
        if not records:
            raise SystemExit("count-records needs --hdfs or --bgl")
        style = BucketStyle(args.hourly_hdfs, args.separator)
        stages.count_records_stage(spark, records, args.output, style)
    elif args.stage == "features":
        params = FeatureParams(
            label_share=args.label_share,
            share_of=args.share_of,
            label_by=args.label_by,
            horizon_hours=args.horizon_hours,
            level_of=args.level_of,
            slices=args.slices,
            slice_chars=args.slice_chars,
            bucket_parts=args.bucket_parts,
        )
        stages.feature_stage(spark, args.counts, args.output, params, args.rejects)
    elif args.stage == "model":
        params = ModelParams(
            train_tenths=args.train_tenths,
            split=args.split,
            gap_hours=args.gap_hours,
            trees=args.trees,
            depth=args.depth,
            seed=args.seed,
            partitions=args.partitions,
        )
        metrics = stages.model_stage(spark, args.features, args.model, args.predictions, params, args.sql)
        metrics.show(truncate=False)
    else:
        connect = None
        if args.connect:
            module, _, function = args.connect.partition(":")
            connect = getattr(import_module(module), function)
        stages.alert_stage(
            spark,
            args.table,
            args.output,
            by=args.by,
            limit=args.limit,
            per_source=args.per_source,
            template=alerts.PROMPT_WITH_VELOCITY if args.velocity else alerts.PROMPT,
            connect=connect,
            settings=CompletionSettings(args.model_name, args.temperature, args.max_tokens),
            tasks=args.tasks,
            store=args.answers,
        )


if __name__ == "__main__":
    main()
