"""The batch job: each stage reads stored tables and stores one.

Stored tables cut the lineage between stages, so a stage that fails is repeated alone and a
raw line is read once per stage that needs it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logrisk.functions.buckets import BucketStyle
from logrisk.operators import alerts, counts, features, forest_columns, raw_logs, risk_model
from logrisk.operators.features import FeatureParams
from logrisk.operators.risk_model import ModelParams
from logrisk.sources import readers, writers
from logrisk.sources.scratch import materialize


def parse_stage(
    spark: SparkSession, raw: str | Sequence[str], source: str, output: str
) -> None:
    """Raw lines to parsed records and rejects: ``output/status=parsed``, ``.../malformed``, ...

    Every line is stored with its file and place."""
    lines = readers.read_placed_lines(spark, raw)
    writers.write_classified(raw_logs.classify_lines(lines, raw_logs.GRAMMARS[source]), output)


def stored_records(spark: SparkSession, path: str, source: str) -> DataFrame:
    """The records of ``parse_stage``; other lines are not read."""
    stored = readers.read_table(spark, path).filter(F.col("status") == raw_logs.PARSED)
    return stored.select(*raw_logs.GRAMMARS[source].fields)


def stored_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The lines that ``parse_stage`` rejected, with ``reason``, ``file_path`` and ``line_no``."""
    return raw_logs.located_rejects(readers.read_table(spark, path))


def count_stage(
    spark: SparkSession,
    structured: str | Sequence[str],
    output: str,
    layout: counts.CsvLayout | DataFrame = counts.POSITIONAL,
    style: BucketStyle = BucketStyle(),
    rejects: str | None = None,
) -> None:
    """Structured files, told apart by their path, to ordered count lines.

    Lines that are not counted are stored with their ``reason`` and number in ``rejects``, by
    default ``<output>-rejects``. The files are read once for both.
    """
    lines = readers.read_rows(spark, structured)
    rows = counts.classify_rows(lines, layout, style)
    counted = F.col("status") == counts.COUNTED
    # Of a counted line only its key is kept, a byte or two in a column of few values.
    text = F.when(~counted, F.col("value")).alias("value")
    done = materialize(rows.select("status", *counts.COUNT_KEY, text), "counted")
    writers.write_counts(counts.count_keys(done.filter(counted)), output)
    writers.write_table(counts.count_rejects(done), rejects or _beside(output, "rejects"))


def _beside(output: str, name: str) -> str:
    return f"{output.rstrip('/')}-{name}"


def count_records_stage(
    spark: SparkSession,
    records: dict[str, str],
    output: str,
    style: BucketStyle = BucketStyle(),
) -> None:
    """Records of ``parse_stage``, by source, to ordered count lines."""
    keys = []
    for source, path in records.items():
        parsed = stored_records(spark, path, source)
        if source == "BGL":
            parsed = raw_logs.with_bgl_details(parsed)
        keys.append(counts.record_keys(parsed, source, style))
    writers.write_counts(counts.count_keys(reduce(DataFrame.unionByName, keys)), output)


def feature_stage(
    spark: SparkSession,
    count_files: str | Sequence[str],
    output: str,
    params: FeatureParams = FeatureParams(),
    rejects: str | None = None,
) -> None:
    """Count lines to the feature table.

    Lines that hold no count are stored with their ``reason`` in ``rejects``, by default
    ``<output>-rejects``. The text is read and parsed once for both.
    """
    classified = materialize(counts.classify_wire(readers.read_lines(spark, count_files)), "wire")
    counted = F.col("status") == counts.COUNTED
    rejected = classified.filter(~counted).select("value", F.col("status").alias("reason"))
    writers.write_table(rejected, rejects or _beside(output, "rejects"))
    writers.write_table(features.engineer_features(classified.filter(counted), params), output)


def model_stage(
    spark: SparkSession,
    feature_table: str,
    model_output: str,
    predictions_output: str,
    params: ModelParams = ModelParams(),
    sql_output: str | None = None,
) -> DataFrame:
    """Train on the training rows, score the others, store both and the metrics, which are
    returned, in ``<predictions>-metrics``. ``sql_output`` takes the forest as a query over a table
    named ``features``."""
    train, test = risk_model.split_features(readers.read_table(spark, feature_table), params)
    risk_model.train_risk_model(train, params).write().overwrite().save(model_output)
    model = PipelineModel.load(model_output)
    if sql_output is not None:
        query = forest_columns.forest_sql(forest_columns.read_forest(spark, model_output), "features")
        one = spark.createDataFrame([(query,)], "value string").coalesce(1)
        one.write.mode("overwrite").text(sql_output)
    writers.write_table(risk_model.score_risk(model, test), predictions_output)
    metrics = risk_model.evaluate_risk(readers.read_table(spark, predictions_output))
    writers.write_table(metrics, _beside(predictions_output, "metrics"))
    return readers.read_table(spark, _beside(predictions_output, "metrics"))


def alert_stage(
    spark: SparkSession,
    table: str,
    output: str,
    by: str = "flag",
    limit: int = 3,
    per_source: bool = False,
    template: str = alerts.PROMPT,
    connect: Callable[[], Callable[..., str]] | None = None,
    settings: alerts.CompletionSettings = alerts.CompletionSettings(),
    tasks: int = 8,
    store: str | None = None,
) -> None:
    """The strongest alerts of a feature or prediction table, in words and with prompts.

    With ``connect`` they are answered as well, by ``tasks`` tasks at once; with ``store``, a folder of
    answers, each distinct prompt is asked once over all runs.
    """
    raised = alerts.top_alerts(readers.read_table(spark, table), limit, by, per_source)
    prompts = alerts.with_summary(alerts.build_prompts(raised, template))
    shown = [name for name in features.FEATURE_COLUMNS if name in prompts.columns]
    result = prompts.select(*shown, "frequency", "distribution", "prompt")
    if connect is not None and store is not None:
        result = alerts.answer_once(result, connect, store, settings, tasks)
    elif connect is not None:
        result = alerts.answer_prompts(result, connect, settings, tasks)
    writers.write_table(result, output)
