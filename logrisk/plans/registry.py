"""The registered queries: every operator run over whole tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logrisk.functions.buckets import BucketStyle, bucket_timestamp
from logrisk.functions.text import csv_tokens, evaluate_once
from logrisk.operators import alerts, counts, features, forest_columns, raw_logs, risk_model
from logrisk.operators.features import FeatureParams
from logrisk.operators.risk_model import ModelParams
from logrisk.plans import event_logs as logs
from logrisk.plans import stages
from logrisk.sources import readers, writers
from logrisk.sources.headers import read_first_lines
from logrisk.sources.scratch import materialize, scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.count_keys(logs.event_keys(logs.read_events(spark, sf_dir)))


def event_features(
    spark: SparkSession, sf_dir: str, params: FeatureParams = FeatureParams()
) -> DataFrame:
    return features.engineer_features(event_counts(spark, sf_dir), params)


def _stored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features as a written table, which training and scoring read repeatedly."""
    return materialize(event_features(spark, sf_dir), "features")


# Raw lines


@_query
def hdfs_parse(spark, sf_dir):
    lines = logs.hdfs_lines(logs.read_events(spark, sf_dir))
    return raw_logs.parse_logs(lines, raw_logs.HDFS).records


@_query
def hdfs_rejects(spark, sf_dir):
    lines = logs.hdfs_lines(logs.read_events(spark, sf_dir))
    return raw_logs.parse_logs(lines, raw_logs.HDFS).rejects


@_query
def bgl_parse(spark, sf_dir):
    lines = logs.bgl_lines(logs.read_events(spark, sf_dir))
    return raw_logs.parse_logs(lines, raw_logs.BGL).records


@_query
def bgl_details(spark, sf_dir):
    lines = logs.bgl_lines(logs.read_events(spark, sf_dir))
    return raw_logs.with_bgl_details(raw_logs.parsed_records(lines, raw_logs.BGL)).select(
        "alert_flag", "timestamp_raw", "severity", "facility", "node_id", "event_time", "message"
    )


@_query
def parse_rejects(spark, sf_dir):
    """Lines per source and outcome."""
    events = logs.read_events(spark, sf_dir)
    hdfs = raw_logs.classify_lines(logs.hdfs_lines(events), raw_logs.HDFS).select(
        F.lit("HDFS").alias("source"), "status"
    )
    bgl = raw_logs.classify_lines(logs.bgl_lines(events), raw_logs.BGL).select(
        F.lit("BGL").alias("source"), "status"
    )
    return hdfs.unionByName(bgl).groupBy("source", "status").agg(F.count("*").alias("total_lines"))


@_query
def document_lines(spark, sf_dir):
    """Every line of the free-text documents through the HDFS grammar."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lines = documents.select(
        "doc_id", F.explode(F.split("text", r"\r\n|\r|\n")).alias("value")
    )
    classified = raw_logs.classify_lines(lines, raw_logs.HDFS)
    count_of = lambda status: F.count_if(F.col("status") == status)
    return classified.groupBy("doc_id").agg(
        count_of(raw_logs.PARSED).alias("parsed_lines"),
        count_of(raw_logs.BLANK).alias("blank_lines"),
        count_of(raw_logs.MALFORMED).alias("malformed_lines"),
        F.sum(F.length("component")).alias("component_chars"),
        F.sum(F.length("message")).alias("message_chars"),
    )


@_query
def records_from_files(spark, sf_dir):
    """Raw lines through text files: read, classify in one pass, store, read back."""
    raw, stored = scratch_path(spark, "raw-hdfs"), scratch_path(spark, "classified-hdfs")
    logs.hdfs_lines(logs.read_events(spark, sf_dir)).write.text(raw)
    lines = readers.read_lines(spark, raw)
    writers.write_classified(raw_logs.classify_lines(lines, raw_logs.HDFS), stored)
    return (
        readers.read_table(spark, stored)
        .filter(F.col("status") == raw_logs.PARSED)
        .select(*raw_logs.HDFS.fields)
    )


@_query
def records_text(spark, sf_dir):
    """Parsed records stored as delimited text and read back."""
    path = scratch_path(spark, "records-text")
    writers.write_delimited(bgl_parse(spark, sf_dir), path)
    return readers.read_lines(spark, path)


@_query
def rejects_located(spark, sf_dir):
    """Rejected raw lines by reason, and whether each stands in its file where it is said to."""
    raw, stored = scratch_path(spark, "raw-hdfs"), scratch_path(spark, "classified-hdfs")
    logs.hdfs_lines(logs.read_events(spark, sf_dir)).write.text(raw)
    stages.parse_stage(spark, raw, "HDFS", stored)
    located = stages.stored_rejects(spark, stored)
    whole = spark.read.text(raw, wholetext=True).select("_metadata.file_path", F.split("value", "\n").alias("lines"))
    there = whole.select("file_path", F.posexplode("lines").alias("line_no", "written"))
    there = there.withColumn("line_no", F.col("line_no") + 1)
    found = located.join(there, ["file_path", "line_no"], "left")
    same = F.col("value").eqNullSafe(F.col("written"))
    return found.groupBy("reason").agg(F.count("*").alias("total_lines"), F.min(same).alias("in_place"))


# Structured rows to counts


@_query
def hourly_counts(spark, sf_dir):
    return event_counts(spark, sf_dir)


@_query
def csv_split(spark, sf_dir):
    """Quote-aware tokens of every structured HDFS row."""
    rows = logs.hdfs_rows(logs.read_events(spark, sf_dir))
    tokens = rows.select("value", evaluate_once(csv_tokens(F.col("value"))).alias("tokens"))
    return tokens.select(
        "value", F.size("tokens").alias("token_count"), F.array_join("tokens", "|").alias("tokens")
    )


@_query
def counts_hdfs_csv(spark, sf_dir):
    return counts.count_errors(logs.hdfs_rows(logs.read_events(spark, sf_dir)))


@_query
def counts_bgl_csv(spark, sf_dir):
    return counts.count_errors(logs.bgl_rows(logs.read_events(spark, sf_dir)))


@_query
def csv_rejects(spark, sf_dir):
    """Structured lines that are not counted, by source and reason."""
    events = logs.read_events(spark, sf_dir)
    both = logs.hdfs_rows(events).unionByName(logs.bgl_rows(events))
    rejected = counts.rejected_rows(both)
    return rejected.groupBy("source", "reason").agg(F.count("*").alias("total_lines"))


@_query
def counts_by_path(spark, sf_dir):
    rows = logs.mixed_rows(logs.read_events(spark, sf_dir))
    path = F.concat(F.lit("hdfs://cluster/Logs/"), F.upper("folder"), F.lit("/part-0.csv"))
    return counts.count_errors(rows.select("value", path.alias("file_path")))


@_query
def counts_from_files(spark, sf_dir):
    """Structured rows in three folders, told apart by the path they are read from."""
    path = scratch_path(spark, "structured")
    logs.mixed_rows(logs.read_events(spark, sf_dir)).write.partitionBy("folder").text(path)
    return counts.count_errors(readers.read_rows(spark, path))


@_query
def counts_from_path_list(spark, sf_dir):
    """Folders given as one comma-separated list; the folder left out is not read."""
    path = scratch_path(spark, "structured")
    logs.mixed_rows(logs.read_events(spark, sf_dir)).write.partitionBy("folder").text(path)
    listed = ",".join(f"{path}/folder={folder}" for folder in ("hdfs_logs", "bgl_logs"))
    return counts.count_errors(readers.read_rows(spark, listed))


@_query
def bgl_records_from_files(spark, sf_dir):
    """Raw BGL lines through text files to stored records."""
    raw, stored = scratch_path(spark, "raw-bgl"), scratch_path(spark, "classified-bgl")
    logs.bgl_lines(logs.read_events(spark, sf_dir)).write.text(raw)
    stages.parse_stage(spark, raw, "BGL", stored)
    return stages.stored_records(spark, stored, "BGL")


@_query
def counts_and_rejects_from_files(spark, sf_dir):
    """What the count stage makes of structured files: lines counted and rejected, by reason."""
    path, output = scratch_path(spark, "structured"), scratch_path(spark, "counts")
    events = logs.read_events(spark, sf_dir)
    for rows, folder in ((logs.hdfs_rows(events), "hdfs_logs"), (logs.bgl_rows(events), "bgl_logs")):
        rows.select("value").write.text(f"{path}/{folder}")
    stages.count_stage(spark, f"{path}/hdfs_logs,{path}/bgl_logs", output)
    rejected = readers.read_table(spark, f"{output}-rejects")
    counted = counts.parse_wire(readers.read_lines(spark, output))
    lines = counted.select("source", F.lit("counted").alias("status"), F.col("total_count").alias("n"))
    lines = lines.unionByName(rejected.select("source", F.col("reason").alias("status"), F.col("total_lines").alias("n")))
    return lines.groupBy("source", "status").agg(F.sum("n").cast("bigint").alias("total_lines"))


@_query
def counts_by_file_header(spark, sf_dir):
    """Columns found by the header of each file; the files of a source need not agree."""
    rows = logs.header_rows(logs.read_events(spark, sf_dir))
    moved = logs.moved_columns(rows)
    heads = logs.header_lines(spark)
    lines = moved.unionByName(heads)
    return counts.count_errors(lines, counts.file_layouts(lines), BucketStyle(hourly_hdfs=True))


@_query
def counts_by_own_headers_from_files(spark, sf_dir):
    """Files whose first line is their own header, through the count stage."""
    path, output = scratch_path(spark, "structured"), scratch_path(spark, "counts")
    rows = logs.own_header_files(logs.read_events(spark, sf_dir))
    rows.write.partitionBy("folder", "part").text(path)
    layouts = counts.file_layouts(read_first_lines(spark, path))
    stages.count_stage(spark, path, output, layouts, BucketStyle(hourly_hdfs=True))
    return counts.parse_wire(readers.read_lines(spark, output))


@_query
def counts_of_odd_times(spark, sf_dir):
    """HDFS rows whose days and clocks are empty, no numbers or short, in hourly buckets."""
    rows = logs.odd_time_rows(logs.read_events(spark, sf_dir))
    return counts.count_errors(rows, counts.header_layout(logs.HDFS_HEADER), BucketStyle(hourly_hdfs=True))


@_query
def counts_by_header(spark, sf_dir):
    """Structured rows whose columns are found by header name, in hourly buckets."""
    layout = counts.header_layout(logs.HDFS_HEADER, logs.BGL_HEADER)
    rows = logs.header_rows(logs.read_events(spark, sf_dir))
    return counts.count_errors(rows, layout, BucketStyle(hourly_hdfs=True))


@_query
def hourly_hdfs(spark, sf_dir):
    """HDFS rows in hourly buckets with a dash before the hour."""
    rows = logs.hdfs_rows(logs.read_events(spark, sf_dir))
    return counts.count_errors(rows, style=BucketStyle(hourly_hdfs=True, separator="-"))


@_query
def counts_from_records(spark, sf_dir):
    """Parsed records of both sources straight to counts."""
    events = logs.read_events(spark, sf_dir)
    hdfs = raw_logs.parsed_records(logs.hdfs_lines(events), raw_logs.HDFS)
    bgl = raw_logs.with_bgl_details(raw_logs.parsed_records(logs.bgl_lines(events), raw_logs.BGL))
    keys = counts.record_keys(hdfs, "HDFS").unionByName(counts.record_keys(bgl, "BGL"))
    return counts.count_keys(keys)


@_query
def bucket_times(spark, sf_dir):
    """Typed start of every bucket, day buckets and free-form ones included."""
    day = counts.count_errors(logs.bgl_rows(logs.read_events(spark, sf_dir)))
    keyed = day.unionByName(event_counts(spark, sf_dir))
    return keyed.groupBy("date_hour").agg(
        F.sum("total_count").alias("total_count"),
        F.max(F.date_format(bucket_timestamp(F.col("date_hour")), "yyyy-MM-dd HH:mm:ss")).alias("starts_at"),
    )


@_query
def counts_wire(spark, sf_dir):
    return event_counts(spark, sf_dir).select(counts.wire_text())


@_query
def counts_from_wire(spark, sf_dir):
    """Counts stored as text lines in key order, read back and parsed."""
    path = scratch_path(spark, "counts")
    writers.write_counts(event_counts(spark, sf_dir), path)
    return counts.parse_wire(readers.read_lines(spark, f"{path}/part-*"))


@_query
def wire_round_trip(spark, sf_dir):
    """Counts of types that hold commas and quotes, through text files and back."""
    path = scratch_path(spark, "counts")
    writers.write_counts(counts.count_keys(logs.awkward_keys(logs.read_events(spark, sf_dir))), path)
    return counts.parse_wire(readers.read_lines(spark, path))


@_query
def wire_counts_checked(spark, sf_dir):
    """Count lines of all kinds, through files and the feature stage: counted and rejected."""
    path, output = scratch_path(spark, "wire"), scratch_path(spark, "features")
    logs.wire_lines(logs.read_events(spark, sf_dir)).write.text(path)
    stages.feature_stage(spark, path, output)
    rejected = readers.read_table(spark, f"{output}-rejects").groupBy("reason").agg(F.count("*").alias("total_lines"))
    kept = readers.read_table(spark, output).agg(F.sum("error_frequency").cast("bigint").alias("total_lines"))
    return rejected.unionByName(kept.withColumn("reason", F.lit("sum of counts")))


@_query
def wire_counts_exact(spark, sf_dir):
    """Counts above 2 to the power of 53, through files: their sums to the last digit."""
    path = scratch_path(spark, "wire")
    logs.large_wire_lines(logs.read_events(spark, sf_dir)).write.text(path)
    found = counts.parse_wire(readers.read_lines(spark, path)).groupBy("date_hour", "error_type")
    total = F.sum(F.col("total_count").cast("decimal(38,0)")).cast("string")
    return found.agg(total.alias("total"), F.max("total_count").alias("largest"))


@_query
def wire_rejects(spark, sf_dir):
    """Count lines that hold no count: every structured row read as if it were one."""
    rows = logs.mixed_rows(logs.read_events(spark, sf_dir)).select("value")
    lines = rows.unionByName(event_counts(spark, sf_dir).select(counts.wire_text()))
    return counts.classify_wire(lines).groupBy("status").agg(F.count("*").alias("total_lines"))


@_query
def counts_preview(spark, sf_dir):
    return counts.first_counts(event_counts(spark, sf_dir))


# Features


@_query
def features_full(spark, sf_dir):
    return event_features(spark, sf_dir)


def _feature(name: str) -> Query:
    def run(spark, sf_dir):
        return event_features(spark, sf_dir).select(*counts.COUNT_KEY, "error_frequency", name)

    return run


QUERIES["feat_distribution"] = _feature("error_distribution")
QUERIES["feat_rate_of_change"] = _feature("rate_of_change")
QUERIES["feat_high_flag"] = _feature("high_error_flag")
QUERIES["risk_label"] = _feature("label")


def large_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly counts, each above 2 to the power of 40: doubles cannot tell their deviations."""
    counted = event_counts(spark, sf_dir)
    return counted.withColumn("total_count", F.lit(1 << 40) + F.col("total_count"))


@_query
def features_of_large_counts(spark, sf_dir):
    """Flags of counts that differ in their last digits only."""
    made = features.engineer_features(large_counts(spark, sf_dir))
    return made.select(*counts.COUNT_KEY, "error_frequency", "high_error_flag")


@_query
def features_ranged(spark, sf_dir):
    """Features whose time slices are ranges of rows instead of prefixes."""
    return event_features(spark, sf_dir, FeatureParams(slices="range"))


@_query
def features_as_of(spark, sf_dir):
    """Features whose usual level knows nothing of later buckets."""
    return event_features(spark, sf_dir, FeatureParams(level_of="as_of"))


@_query
def label_horizon_as_of(spark, sf_dir):
    """Horizon labels of flags that know nothing of later buckets."""
    return event_features(spark, sf_dir, FeatureParams(level_of="as_of", label_by="horizon"))


@_query
def features_daily(spark, sf_dir):
    """Features of structured HDFS rows, whose buckets are days."""
    return features.engineer_features(counts_hdfs_csv(spark, sf_dir))


@_query
def features_from_files(spark, sf_dir):
    """Features stored as a table and read back."""
    return _stored_features(spark, sf_dir)


@_query
def distribution_cluster(spark, sf_dir):
    return event_features(spark, sf_dir, FeatureParams(share_of="cluster"))


@_query
def label_horizon(spark, sf_dir):
    return event_features(spark, sf_dir, FeatureParams(label_by="horizon"))


@_query
def label_horizon_daily(spark, sf_dir):
    """Horizon labels where buckets are days."""
    return features.engineer_features(counts_hdfs_csv(spark, sf_dir), FeatureParams(label_by="horizon"))


@_query
def label_horizon_mixed(spark, sf_dir):
    """Horizon labels of keys with day and hour buckets."""
    hours = event_counts(spark, sf_dir).withColumn("source", F.lit("HDFS"))
    hours = hours.groupBy(*counts.COUNT_KEY).agg(F.sum("total_count").alias("total_count"))
    both = counts_hdfs_csv(spark, sf_dir).unionByName(hours)
    return features.engineer_features(both, FeatureParams(label_by="horizon"))


@_query
def features_preview(spark, sf_dir):
    return features.preview_features(event_features(spark, sf_dir))


# Risk model


@_query
def source_index(spark, sf_dir):
    rows = _stored_features(spark, sf_dir)
    indexed = risk_model.source_indexer().fit(rows).transform(rows)
    return indexed.groupBy("source", "source_index").agg(F.count("*").alias("total_rows"))


@_query
def split_assignment(spark, sf_dir):
    return event_features(spark, sf_dir).select(
        *counts.COUNT_KEY, risk_model.in_training().cast("int").alias("in_training")
    )


@_query
def time_split_assignment(spark, sf_dir):
    """The side of every row where training ends before the test begins."""
    rows = materialize(event_features(spark, sf_dir, FeatureParams(label_by="horizon")), "features")
    side = risk_model.side_of(risk_model.time_cut(rows), ModelParams().gap_hours)
    return rows.select(*counts.COUNT_KEY, side.alias("side"))


@_query
def feature_rows(spark, sf_dir):
    """Model input in vector order, as plain columns."""
    rows = _stored_features(spark, sf_dir)
    indexed = risk_model.source_indexer().fit(rows).transform(rows)
    return indexed.filter(risk_model.is_complete()).select(
        *counts.COUNT_KEY, *risk_model.MODEL_INPUTS, "label"
    )


def _test_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = risk_model.split_features(_stored_features(spark, sf_dir))
    return risk_model.score_risk(risk_model.train_risk_model(train), test)


@_query
def risk_scores(spark, sf_dir):
    scored = _test_predictions(spark, sf_dir)
    return scored.select(
        *counts.COUNT_KEY, "error_frequency", "rate_of_change", "label", "prediction", "risk"
    )


@_query
def scored_rows(spark, sf_dir):
    """Which rows are scored, and whether risk and prediction agree; not the model's opinion."""
    agree = (F.col("risk") > 0.5) == (F.col("prediction") == 1)
    sound = F.col("risk").between(0, 1) & agree
    return _test_predictions(spark, sf_dir).select(
        *counts.COUNT_KEY, "error_frequency", "label", sound.cast("int").alias("sound")
    )


@_query
def risk_by_columns(spark, sf_dir):
    """Every feature row scored by the model and by its trees as column expressions: whether
    prediction and risk are the same to the last bit."""
    rows = _stored_features(spark, sf_dir)
    model = risk_model.train_risk_model(risk_model.split_features(rows)[0])
    by_model = risk_model.score_risk(model, rows).withColumnsRenamed({"risk": "model_risk", "prediction": "model_prediction"})
    both = forest_columns.score_by_columns(forest_columns.forest_of(model), by_model)
    same = F.col("risk").eqNullSafe(F.col("model_risk")) & F.col("prediction").eqNullSafe(F.col("model_prediction"))
    return both.select(*counts.COUNT_KEY, F.col("risk").isNotNull().alias("scored"), same.alias("same"))


def _metrics_by_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored rows, positives and metrics of the horizon label, learned from rows spread over all
    times and learned from earlier rows only; no flag knows later buckets."""
    rows = materialize(label_horizon_as_of(spark, sf_dir), "features")
    measured = []
    for split in ("key", "time"):
        train, test = risk_model.split_features(rows, ModelParams(split=split))
        scored = materialize(risk_model.score_risk(risk_model.train_risk_model(train), test), "predictions")
        size = scored.agg(F.count("prediction").alias("scored_rows"), F.sum("label").cast("bigint").alias("positives"))
        size = size.withColumn("split", F.lit(split))
        # Both tables have one row.
        measured.append(size.join(risk_model.evaluate_risk(scored).withColumn("split", F.lit(split)), "split"))
    return measured[0].unionByName(measured[1])


@_query
def risk_metrics_by_split(spark, sf_dir):
    return _metrics_by_split(spark, sf_dir)


@_query
def risk_metrics_by_split_checked(spark, sf_dir):
    """What must hold for the metrics of both splits, whatever the forests."""
    share = F.greatest(F.col("positives"), F.col("scored_rows") - F.col("positives")) / F.col("scored_rows")
    return _metrics_by_split(spark, sf_dir).select(
        "split",
        "scored_rows",
        "positives",
        (F.col("accuracy") > share - 0.05).alias("near_the_majority_or_better"),
        (F.abs(F.col("accuracy") - F.col("weighted_recall")) < 1e-12).alias("recall_is_accuracy"),
    )


@_query
def risk_metrics(spark, sf_dir):
    return risk_model.evaluate_risk(_test_predictions(spark, sf_dir))


@_query
def metrics_flag_as_predictor(spark, sf_dir):
    """The metrics of a predictor that SQL can state: the flag itself."""
    flagged = event_features(spark, sf_dir).withColumn("prediction", F.col("high_error_flag"))
    measured = risk_model.evaluate_risk(flagged)
    return measured.select(*[F.round(name, 10).alias(name) for name in measured.columns])


@_query
def risk_metrics_checked(spark, sf_dir):
    """What must hold for the metrics whatever the forest: rows, positives, and an accuracy on
    the rule label above 0.95 and no lower than that of the larger class."""
    scored = _test_predictions(spark, sf_dir).filter("prediction IS NOT NULL")
    size = scored.agg(F.count("*").alias("scored_rows"), F.sum("label").cast("bigint").alias("positives"))
    share = F.greatest(F.col("positives"), F.col("scored_rows") - F.col("positives")) / F.col("scored_rows")
    # Both tables have one row.
    return size.withColumn("k", F.lit(1)).join(risk_model.evaluate_risk(scored).withColumn("k", F.lit(1)), "k").select(
        "scored_rows",
        "positives",
        (F.col("accuracy") > 0.95).alias("accurate"),
        (F.col("accuracy") >= share).alias("no_worse_than_the_majority"),
        (F.abs(F.col("accuracy") - F.col("weighted_recall")) < 1e-12).alias("recall_is_accuracy"),
    )


@_query
def predictions_preview(spark, sf_dir):
    return risk_model.preview_predictions(_test_predictions(spark, sf_dir))


@_query
def predictions_preview_keys(spark, sf_dir):
    """The preview without the model's opinion."""
    return predictions_preview(spark, sf_dir).drop("prediction", "risk")


# Alerts


@_query
def alerts_topk(spark, sf_dir):
    return alerts.top_alerts(event_features(spark, sf_dir))


@_query
def alerts_topk_per_source(spark, sf_dir):
    return alerts.top_alerts(event_features(spark, sf_dir), per_source=True)


@_query
def alert_display(spark, sf_dir):
    """All alerts in words."""
    return alerts.display_alerts(alerts.raised_alerts(event_features(spark, sf_dir)))


@_query
def alert_prompts(spark, sf_dir):
    """The prompt of every alert."""
    raised = alerts.raised_alerts(event_features(spark, sf_dir))
    return alerts.build_prompts(raised).select(*counts.COUNT_KEY, "prompt")


@_query
def alert_prompts_velocity(spark, sf_dir):
    raised = alerts.raised_alerts(event_features(spark, sf_dir))
    prompts = alerts.build_prompts(raised, alerts.PROMPT_WITH_VELOCITY)
    return prompts.select(*counts.COUNT_KEY, "prompt")


@_query
def alerts_by_model(spark, sf_dir):
    predictions = _test_predictions(spark, sf_dir)
    return alerts.top_alerts(predictions, by="model").select(
        *counts.COUNT_KEY, "error_frequency", "prediction", "risk"
    )


@_query
def alerts_by_stated_model(spark, sf_dir):
    """Alerts by a prediction and a risk that SQL can state: the label and the share."""
    stated = event_features(spark, sf_dir).withColumns(
        {"prediction": F.col("label").cast("double"), "risk": F.col("error_distribution")}
    )
    return alerts.top_alerts(stated, limit=10, by="model").select(
        *counts.COUNT_KEY, "error_frequency", "prediction", "risk"
    )


@_query
def alerts_enriched(spark, sf_dir):
    """Answers to the prompts of all alerts, one failure not affecting the others.

    In place of a service, the completion repeats the source and refuses warnings.
    """

    def connect():
        def complete(prompt, model, temperature, max_tokens):
            lines = prompt.splitlines()
            if "WARN" in lines[2]:
                raise ValueError("refused")
            return f"{lines[1]} / {max_tokens}"

        return complete

    raised = alerts.raised_alerts(event_features(spark, sf_dir))
    prompts = alerts.build_prompts(raised).select(*counts.COUNT_KEY, "prompt")
    answered = alerts.answer_prompts(prompts, connect)
    return answered.select(*counts.COUNT_KEY, "answer", "error")


@_query
def alerts_answered_once(spark, sf_dir):
    """The answers of ``alerts_enriched`` from a folder of answers that a first run has filled; the second
    run's completion refuses everything."""

    def first():
        def complete(prompt, model, temperature, max_tokens):
            lines = prompt.splitlines()
            if "WARN" in lines[2]:
                raise ValueError("no answer yet")
            return f"{lines[1]} / {max_tokens}"

        return complete

    def second():
        def complete(prompt, **told):
            raise ValueError("refused")

        return complete

    store = f"{scratch_path(spark, 'answers')}/answers"
    raised = alerts.raised_alerts(_stored_features(spark, sf_dir))
    prompts = alerts.build_prompts(raised).select(*counts.COUNT_KEY, "prompt")
    alerts.answer_once(prompts, first, store).count()
    return alerts.answer_once(prompts, second, store).select(*counts.COUNT_KEY, "answer", "error")


@_query
def alerts_stored(spark, sf_dir):
    """Strongest alerts of each source with prompts, stored as a table and read back."""
    table, output = scratch_path(spark, "features"), scratch_path(spark, "alerts")
    writers.write_table(event_features(spark, sf_dir), table)
    stages.alert_stage(spark, table, output, per_source=True)
    return readers.read_table(spark, output)
