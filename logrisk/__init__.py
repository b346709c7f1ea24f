"""System logs to parsed records, counts, features, failure risk and alerts on Spark."""

from logrisk.functions.buckets import BucketStyle
from logrisk.operators.alerts import (
    CompletionSettings,
    answer_once,
    answer_prompts,
    build_prompts,
    display_alerts,
    top_alerts,
)
from logrisk.operators.counts import (
    POSITIONAL,
    CsvLayout,
    classify_rows,
    classify_wire,
    count_errors,
    count_keys,
    file_layouts,
    header_layout,
    parse_wire,
    record_keys,
)
from logrisk.operators.features import FeatureParams, engineer_features
from logrisk.operators.forest_columns import forest_of, forest_sql, score_by_columns
from logrisk.operators.raw_logs import BGL, HDFS, classify_lines, located_rejects, parse_logs, with_bgl_details
from logrisk.operators.risk_model import (
    ModelParams,
    evaluate_risk,
    score_risk,
    split_features,
    train_risk_model,
)
from logrisk.sources.headers import read_first_lines
from logrisk.sources.readers import read_lines, read_placed_lines, read_rows, read_table

__all__ = [
    "BGL",
    "BucketStyle",
    "CompletionSettings",
    "CsvLayout",
    "FeatureParams",
    "HDFS",
    "ModelParams",
    "POSITIONAL",
    "answer_once",
    "answer_prompts",
    "build_prompts",
    "classify_lines",
    "classify_rows",
    "classify_wire",
    "count_errors",
    "count_keys",
    "display_alerts",
    "engineer_features",
    "evaluate_risk",
    "file_layouts",
    "forest_of",
    "forest_sql",
    "header_layout",
    "located_rejects",
    "parse_logs",
    "parse_wire",
    "read_first_lines",
    "read_lines",
    "read_placed_lines",
    "read_rows",
    "read_table",
    "record_keys",
    "score_by_columns",
    "score_risk",
    "split_features",
    "top_alerts",
    "train_risk_model",
    "with_bgl_details",
]
