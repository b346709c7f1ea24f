import pytest

from logrisk.operators import alerts

SCHEMA = (
    "date_hour string, error_type string, source string, error_frequency double, "
    "error_distribution double, rate_of_change double, high_error_flag int, prediction double, risk double"
)


@pytest.fixture
def table(spark):
    rows = [
        ("d1", "E", "HDFS", 12345678.0, 0.12345, 0.5, 1, 0.0, 0.1),
        ("d2", "E", "HDFS", 5.0, 0.4, -0.25, 1, 1.0, 0.9),
        ("d1", "F", "HDFS", 5.0, 1.0, 0.0, 1, 1.0, 0.6),
        ("d1", "E", "BGL", 5.0, 0.0, None, 1, 0.0, 0.2),
        ("d3", "E", "BGL", 99999.0, 0.5, 0.0, 0, 1.0, 0.7),
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def keys(df):
    return [(r.date_hour, r.error_type, r.source) for r in df.collect()]


def test_strongest_alerts_in_a_total_order(table):
    assert keys(alerts.top_alerts(table, 3)) == [("d1", "E", "HDFS"), ("d1", "E", "BGL"), ("d1", "F", "HDFS")]


def test_strongest_alerts_of_each_source(table):
    found = alerts.top_alerts(table, 1, per_source=True)
    assert sorted(keys(found)) == [("d1", "E", "BGL"), ("d1", "E", "HDFS")]


def test_alerts_of_the_model_by_risk(table):
    assert keys(alerts.top_alerts(table, 2, by="model")) == [("d2", "E", "HDFS"), ("d3", "E", "BGL")]
    with pytest.raises(ValueError):
        alerts.top_alerts(table, by="x")


def test_top_k_is_cut_before_the_shuffle(table, tmp_path):
    overall = alerts.top_alerts(table)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in overall
    per_source = alerts.top_alerts(table, per_source=True)._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in per_source and per_source.count("WindowGroupLimit") == 2


def test_alert_filter_reaches_the_parquet_scan(spark, table, tmp_path):
    table.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    plan = alerts.display_alerts(alerts.raised_alerts(stored))._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(high_error_flag,1)" in plan
    assert "rate_of_change" not in plan


def test_display(table):
    shown = alerts.display_alerts(alerts.top_alerts(table, 1)).head()
    assert (shown.frequency, shown.distribution) == ("12345678.0 hits/hr", "12.35%")
    assert (shown.source, shown.error_pattern) == ("HDFS", "E")


def test_prompts_bind_the_alert(table):
    prompt = alerts.build_prompts(alerts.top_alerts(table, 1)).head().prompt
    assert prompt.count("HDFS") == 2
    assert '"E"' in prompt and "12345678.0" in prompt and "0.5" not in prompt
    rows = alerts.build_prompts(alerts.raised_alerts(table), alerts.PROMPT_WITH_VELOCITY).collect()
    by_key = {(r.date_hour, r.error_type, r.source): r.prompt for r in rows}
    assert "-0.2500" in by_key["d2", "E", "HDFS"]
    assert "previous window: \n" in by_key["d1", "E", "BGL"]


def test_own_templates(table):
    bound = alerts.build_prompts(alerts.top_alerts(table, 1), "{{{source}}} {frequency}").head()
    assert bound.prompt == "{HDFS} 12345678.0"
    with pytest.raises(KeyError):
        alerts.build_prompts(table, "{nothing}")


@pytest.mark.parametrize("tasks", [None, 3])
def test_one_failure_does_not_affect_the_others(table, tasks):
    def connect():
        def complete(prompt, model, temperature, max_tokens):
            if "BGL" in prompt:
                raise RuntimeError("no service")
            return f"{model} {temperature} {max_tokens}"

        return complete

    prompts = alerts.build_prompts(alerts.raised_alerts(table))
    settings = alerts.CompletionSettings(model="m")
    rows = alerts.answer_prompts(prompts, connect, settings, tasks).collect()
    assert len(rows) == 4
    for row in rows:
        expected = (None, "RuntimeError: no service") if row.source == "BGL" else ("m 0.2 400", None)
        assert (row.answer, row.error) == expected


def test_no_alerts_give_no_answers(table):
    prompts = alerts.build_prompts(table.filter("source = 'none'"))
    answered = alerts.answer_prompts(prompts, lambda: lambda prompt, **told: prompt)
    assert answered.count() == 0
    assert answered.columns[-2:] == ["answer", "error"]


@pytest.fixture
def counted(tmp_path):
    """A completion that notes each call in a folder, which tasks can write to, and fails on demand."""
    calls = tmp_path / "calls"
    calls.mkdir()

    def connect():
        import uuid

        if (calls / "down").exists():
            raise SystemExit("killed")

        def complete(prompt, model, temperature, max_tokens):
            (calls / uuid.uuid4().hex).write_text(prompt)
            if "BGL" in prompt and not (calls / "up").exists():
                raise RuntimeError("no service")
            return f"{model}: {prompt}"

        return complete

    def seen():
        return sorted(p.read_text() for p in calls.iterdir() if len(p.name) == 32)

    return connect, seen, calls


def prompts_of(spark, texts):
    return spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "id int, prompt string")


def test_each_prompt_is_asked_once(spark, counted, tmp_path):
    connect, seen, calls = counted
    texts = [f"prompt {i % 10}" for i in range(50)] + [None]
    store = str(tmp_path / "store")
    settings = alerts.CompletionSettings(model="m")
    first = alerts.answer_once(prompts_of(spark, texts), connect, store, settings, tasks=3, at_a_time=4)
    assert {(r.id, r.answer, r.error) for r in first.collect()} == {
        (i, text and f"m: {text}", None) for i, text in enumerate(texts)
    }
    assert first.columns == ["id", "prompt", "answer", "error"]
    assert seen() == sorted({f"prompt {i}" for i in range(10)})
    # Another run asks for what is new, other settings ask again.
    more = alerts.answer_once(prompts_of(spark, [*texts, "new"]), connect, store, settings)
    assert more.filter("answer = 'm: new'").count() == 1 and len(seen()) == 11
    alerts.answer_once(prompts_of(spark, texts), connect, store, alerts.CompletionSettings(model="n")).collect()
    assert len(seen()) == 21


def test_a_killed_run_goes_on_where_it_was(spark, counted, tmp_path):
    connect, seen, calls = counted
    texts, store = [f"prompt {i}" for i in range(30)], str(tmp_path / "store")

    def dying():
        complete = connect()

        def answer(prompt, **told):
            if len(list(calls.iterdir())) >= 12:
                (calls / "down").write_text("")
            return complete(prompt, **told)

        return answer

    with pytest.raises(Exception):
        alerts.answer_once(prompts_of(spark, texts), dying, store, at_a_time=5).collect()
    killed = seen()
    assert 0 < len(killed) < 30 and len(set(killed)) == len(killed)
    assert spark.read.parquet(store).count() == len(killed)
    (calls / "down").unlink()
    rows = alerts.answer_once(prompts_of(spark, texts), connect, store, at_a_time=5).collect()
    assert len(rows) == 30 and all(r.answer == f": {r.prompt}" for r in rows)
    assert seen() == sorted(texts)


def test_failed_calls_are_asked_again_and_others_are_not(spark, counted, tmp_path):
    connect, seen, calls = counted
    texts, store = ["a", "a BGL", "b"], str(tmp_path / "store")
    first = {r.prompt: (r.answer, r.error) for r in alerts.answer_once(prompts_of(spark, texts), connect, store).collect()}
    assert first["a BGL"] == (None, "RuntimeError: no service") and first["a"] == (": a", None)
    (calls / "up").write_text("")
    second = {r.prompt: (r.answer, r.error) for r in alerts.answer_once(prompts_of(spark, texts), connect, store).collect()}
    assert second == {text: (f": {text}", None) for text in texts}
    assert seen() == ["a", "a BGL", "a BGL", "b"]


def test_no_prompts_leave_no_store(spark, counted, tmp_path):
    connect, seen, _ = counted
    empty = prompts_of(spark, ["a"]).filter("id < 0")
    assert alerts.answer_once(empty, connect, str(tmp_path / "store")).collect() == [] and seen() == []
