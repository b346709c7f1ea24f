"""Features or predictions to alerts, prompts and answers."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass
from string import Formatter

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logrisk.functions.text import as_wire_number
from logrisk.sources.scratch import materialize

# Sampling settings handed to the completion function.
TEMPERATURE = 0.2
MAX_TOKENS = 400

PROMPT = (
    "A monitored cluster shows an unusual number of errors.\n"
    "Log source: {source}\n"
    'Error signature: "{error_type}"\n'
    "Occurrences in the window: {frequency}\n"
    "Answer with:\n"
    "1. the most likely root cause in {source};\n"
    "2. two concrete steps for the administrator on duty."
)
PROMPT_WITH_VELOCITY = PROMPT.replace(
    "Answer with:", "Change against the previous window: {velocity}\nAnswer with:"
)


def raised_alerts(features: DataFrame, by: str = "flag") -> DataFrame:
    """Rows that raise an alert: by their flag, or by the model's ``prediction``."""
    if by not in ("flag", "model"):
        raise ValueError(f"by: {by!r}")
    return features.filter("high_error_flag = 1" if by == "flag" else "prediction = 1")


def _strongest_first(by: str) -> list[Column]:
    lead = [F.desc("risk")] if by == "model" else []
    return [*lead, F.desc("error_frequency"), F.asc("date_hour"), F.asc("error_type"), F.asc("source")]


def top_alerts(
    features: DataFrame, limit: int = 3, by: str = "flag", per_source: bool = False
) -> DataFrame:
    """The ``limit`` strongest alerts, overall or of each source.

    Both forms keep ``limit`` rows per task (and source) before anything is shuffled.
    """
    raised = raised_alerts(features, by)
    if not per_source:
        return raised.orderBy(*_strongest_first(by)).limit(limit)
    place = F.row_number().over(Window.partitionBy("source").orderBy(*_strongest_first(by)))
    return raised.withColumn("_place", place).filter(F.col("_place") <= limit).drop("_place")


def with_summary(alerts: DataFrame) -> DataFrame:
    """Add ``frequency`` and ``distribution``, the frequency and the share in words."""
    share = F.col("error_distribution")
    return alerts.withColumns(
        {
            "frequency": F.concat(as_wire_number(F.col("error_frequency")), F.lit(" hits/hr")),
            "distribution": F.when(share.isNotNull(), F.format_string("%.2f%%", share * 100)),
        }
    )


def display_alerts(alerts: DataFrame) -> DataFrame:
    """Alerts in words: source, pattern, frequency and share."""
    return with_summary(alerts).select(
        "date_hour", "source", F.col("error_type").alias("error_pattern"), "frequency", "distribution"
    )


def build_prompts(alerts: DataFrame, template: str = PROMPT) -> DataFrame:
    """Add ``prompt``, the template bound to each alert.

    Placeholders: ``{source}``, ``{error_type}``, ``{frequency}``, ``{velocity}``.
    """
    velocity = F.col("rate_of_change")
    bound = {
        "source": F.col("source"),
        "error_type": F.col("error_type"),
        "frequency": as_wire_number(F.col("error_frequency")),
        "velocity": F.when(velocity.isNotNull(), F.format_string("%.4f", velocity)),
    }
    parts = []
    for text, name, _, _ in Formatter().parse(template):
        parts.append(F.lit(text))
        if name is not None:
            parts.append(F.coalesce(bound[name], F.lit("")))
    return alerts.withColumn("prompt", F.concat(*parts))


@dataclass(frozen=True)
class CompletionSettings:
    """What a completion function is told besides the prompt, as keyword arguments."""

    model: str = ""
    temperature: float = TEMPERATURE
    max_tokens: int = MAX_TOKENS


def answer_prompts(
    prompts: DataFrame,
    connect: Callable[[], Callable[..., str]],
    settings: CompletionSettings = CompletionSettings(),
    tasks: int | None = None,
) -> DataFrame:
    """Add ``answer`` and ``error``, one completion per row.

    ``connect`` runs once per task and returns the function to call as ``complete(prompt,
    model=..., temperature=..., max_tokens=...)``, so clients are made where they are used.
    A call that raises sets ``error`` for its row only. ``tasks`` spreads the calls over
    that many tasks; a lost task calls again for its rows, so store the result before using
    it more than once.
    """
    text = T.StringType()
    schema = T.StructType(
        [*prompts.schema.fields, T.StructField("answer", text), T.StructField("error", text)]
    )
    # Plain values, so that tasks need nothing of this package.
    told = asdict(settings)

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        complete = connect()

        def attempt(prompt: str) -> tuple[str | None, str | None]:
            try:
                return complete(prompt, **told), None
            except Exception as failure:
                return None, f"{type(failure).__name__}: {failure}"

        for batch in batches:
            outcome = [attempt(prompt) for prompt in batch["prompt"]]
            yield batch.assign(
                answer=pd.Series([a for a, _ in outcome], index=batch.index, dtype=object),
                error=pd.Series([e for _, e in outcome], index=batch.index, dtype=object),
            )

    spread = prompts.repartition(tasks) if tasks else prompts
    return spread.mapInPandas(answer, schema)


#: What is stored of each call: whose it was, what came of it, and in which run.
_STORED = "digest string, answer string, error string, run long"
PROMPTS_AT_A_TIME = 1000


def prompt_digest(settings: CompletionSettings) -> Column:
    """What a prompt's answer is stored under: the prompt and all settings."""
    told = [F.lit(f"{name}={value}") for name, value in asdict(settings).items()]
    return F.sha2(F.to_json(F.array(*told, F.col("prompt"))).cast("binary"), 256)


def _stored_answers(prompts: DataFrame, store: str) -> DataFrame:
    spark = prompts.sparkSession
    try:
        return spark.read.schema(_STORED).parquet(store)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _STORED)


def answer_once(
    prompts: DataFrame,
    connect: Callable[[], Callable[..., str]],
    store: str,
    settings: CompletionSettings = CompletionSettings(),
    tasks: int | None = None,
    at_a_time: int = PROMPTS_AT_A_TIME,
) -> DataFrame:
    """``answer_prompts`` that asks for each distinct prompt once, also over several runs.

    ``store`` is a folder of answers by the digest of prompt and settings. What it holds is not
    asked again; what is missing is asked ``at_a_time`` distinct prompts a job, and each job's
    answers are committed to the folder before the next one begins. A run that is killed loses
    no more than the job that it was in, and the next run goes on from there. Calls that
    failed are stored with their ``error`` and asked again by the next run. One run at a time may use
    a folder.
    """
    digest = prompt_digest(settings)
    keyed = prompts.withColumn("_digest", digest)
    before = _stored_answers(prompts, store)
    run = (before.agg(F.max("run")).first()[0] or 0) + 1
    distinct = keyed.groupBy(F.col("_digest").alias("digest")).agg(F.any_value("prompt").alias("prompt"))
    missing = distinct.join(before.filter("error IS NULL").select("digest"), "digest", "left_anti")
    missing = materialize(missing.filter("prompt IS NOT NULL"), "prompts")
    jobs = -(-missing.count() // at_a_time)
    job_of = F.pmod(F.xxhash64("digest"), F.lit(max(1, jobs)))
    for job in range(jobs):
        answered = answer_prompts(missing.filter(job_of == job), connect, settings, tasks)
        found = answered.select("digest", "answer", "error", F.lit(run).cast("long").alias("run"))
        found.write.mode("append").parquet(store)
    # Of a prompt that was asked more than once the last call counts, which is the one that succeeded, if any.
    known = _stored_answers(prompts, store).groupBy(F.col("digest").alias("_digest"))
    last = known.agg(F.max_by(F.struct("answer", "error"), "run").alias("_last"))
    return keyed.join(last, "_digest", "left").select(
        *prompts.columns, F.col("_last.answer").alias("answer"), F.col("_last.error").alias("error")
    )
