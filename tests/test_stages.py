"""Files, scratch tables and the stored stages from end to end."""

import answers_for_tests
import duck
import pytest
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from logrisk import __main__ as command
from logrisk.operators import counts, raw_logs
from logrisk.operators.risk_model import ModelParams
from logrisk.plans import event_logs as logs
from logrisk.plans import registry, stages
from logrisk.sources import headers, readers, scratch, writers


@pytest.fixture(scope="module")
def events(spark, sf_dir):
    return logs.read_events(spark, sf_dir)


@pytest.fixture(scope="module")
def files(spark, events, tmp_path_factory):
    """Raw and structured files rendered from the events."""
    base = str(tmp_path_factory.mktemp("files"))
    logs.hdfs_lines(events).write.text(f"{base}/raw_hdfs")
    logs.bgl_lines(events).write.text(f"{base}/raw_bgl")
    logs.mixed_rows(events).write.partitionBy("folder").text(f"{base}/structured")
    return base


def same_rows(left, right):
    columns = sorted(left.columns)
    left, right = left.select(columns), right.select(columns)
    return left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def test_lines_break_at_carriage_returns_but_not_at_vertical_tabs(spark, tmp_path):
    (tmp_path / "a.log").write_bytes(b"a\rb\r\nc\nd\x0be\n")
    found = readers.read_lines(spark, str(tmp_path / "a.log"))
    assert [r.value for r in found.collect()] == ["a", "b", "c", "d\x0be"]


def test_paths_may_be_listed_in_one_text(spark, tmp_path):
    for name in ("hdfs_logs", "bgl_logs"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "f.csv").write_text(name + "\n")
    found = readers.read_rows(spark, f"{tmp_path}/hdfs_logs/f.csv, {tmp_path}/bgl_logs")
    rows = {r.value: r.source for r in found.select("value", counts.source_of(F.col("file_path")).alias("source")).collect()}
    assert rows == {"hdfs_logs": "HDFS", "bgl_logs": "BGL"}


def test_raw_lines_are_read_without_their_path(spark, files):
    plan = readers.read_lines(spark, f"{files}/raw_hdfs")
    assert "file_path" not in plan._jdf.queryExecution().executedPlan().toString()


def test_parse_stage_stores_records_and_rejects(spark, files, events, tmp_path):
    output = str(tmp_path / "parsed")
    stages.parse_stage(spark, f"{files}/raw_hdfs", "HDFS", output)
    records = stages.stored_records(spark, output, "HDFS")
    assert same_rows(records, raw_logs.parsed_records(logs.hdfs_lines(events), raw_logs.HDFS))
    stored = readers.read_table(spark, output)
    assert stored.count() == 2 * events.count()
    assert {r.status for r in stored.select("status").distinct().collect()} == {"parsed", "blank", "malformed"}
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(status" in plan


def test_counts_are_not_overwritten(spark, events, tmp_path):
    table = counts.count_keys(logs.event_keys(events))
    path = str(tmp_path / "counts")
    writers.write_counts(table, path)
    with pytest.raises(AnalysisException):
        writers.write_counts(table, path)
    back = counts.parse_wire(readers.read_lines(spark, f"{path}/part-*"))
    assert same_rows(back, table.withColumn("total_count", F.col("total_count").cast("double")))


def test_count_files_are_in_key_order(spark, events, tmp_path):
    path = tmp_path / "counts"
    writers.write_counts(counts.count_keys(logs.event_keys(events)), str(path))
    found = []
    for part in sorted(path.glob("part-*")):
        found += part.read_text().splitlines()
    keys = [line.rpartition(",")[0] for line in found]
    assert keys == sorted(keys) and len(keys) > 20


def test_records_as_text_keep_empty_fields(spark, tmp_path):
    df = spark.createDataFrame([("a", "", None), ("b,c", "d", "e")], "x string, y string, z string")
    writers.write_delimited(df, str(tmp_path / "t"))
    writers.write_delimited(df, str(tmp_path / "t"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "t")).collect()) == ["a,,", "b,c,d,e"]


def test_tables_are_snappy_and_failures_raise(spark, events, tmp_path):
    writers.write_table(events, str(tmp_path / "t"))
    assert any(p.name.endswith(".snappy.parquet") for p in (tmp_path / "t").iterdir())
    (tmp_path / "file").write_text("")
    with pytest.raises(Exception):
        writers.write_table(events, str(tmp_path / "file" / "t"))


def test_first_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("LineId,Date,Time\n1,2,3\n")
    assert readers.first_header(spark, str(tmp_path)) == "LineId,Date,Time"
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "b.csv").write_text("1,2,3\n")
    with pytest.raises(ValueError):
        readers.first_header(spark, str(tmp_path / "none"))


def test_first_lines_of_files(spark, tmp_path):
    """Leading blank lines do not count, and large files are not read to their end."""
    (tmp_path / "a.csv").write_text("\n \t\nLineId,x\n" + "1,2\n" * 1000)
    (tmp_path / "b.csv").write_text("7,8\nLineId,y\n")
    (tmp_path / "c.csv").write_text("\n\n")
    (tmp_path / "d.csv").write_text("LineId,z\r1\r")
    (tmp_path / "e.csv").write_text("LineId,e\n" + "9,9,9,9\n" * 3_000_000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    found = {r.file_path.rpartition("/")[2]: r.value for r in headers.read_first_lines(spark, str(tmp_path)).collect()}
    assert found == {"a.csv": "LineId,x", "b.csv": "7,8", "d.csv": "LineId,z", "e.csv": "LineId,e"}
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_first_lines_where_a_task_holds_several_files(spark, tmp_path, monkeypatch):
    """The settings are not taken, so that small files share a task and large ones are split."""
    for i in range(30):
        (tmp_path / f"{i}.csv").write_text("\n" * (i % 3) + f"LineId,{i}\n" + "1,2\n" * (10 * i))
    (tmp_path / "large.csv").write_text("LineId,large\n" + "1,2,3,4,5,6,7,8\n" * 5000)
    monkeypatch.setattr(headers, "_FILES_TO_TASKS", ("spark.sql.files.maxPartitionBytes",))
    monkeypatch.setattr(headers, "_WHOLE_FILE", 20_000)
    conf = type(spark.conf)
    get = conf.get
    monkeypatch.setattr(conf, "get", lambda self, name, *default: "0" if name in headers._FILES_TO_TASKS else get(self, name, *default))
    found = {r.file_path.rpartition("/")[2]: r.value for r in headers.read_first_lines(spark, str(tmp_path)).collect()}
    assert found == {**{f"{i}.csv": f"LineId,{i}" for i in range(30)}, "large.csv": "LineId,large"}


def test_rejects_tell_file_and_line(spark, tmp_path):
    """Also where a file is read in several blocks, and several files in one task."""
    raw = tmp_path / "raw"
    raw.mkdir()
    expected = set()
    for name, size in (("a", 700), ("b", 3), ("c", 1200), ("d", 1)):
        written = []
        for i in range(1, size + 1):
            bad = i % 7 == 0 or size == 1
            written.append(f"bad {name} {i}" if bad else "" if i % 11 == 0 else f"1 2 3 INFO c: {'m' * (i % 50)}")
            if bad or i % 11 == 0:
                expected.add((f"{name}.log", i, written[-1], "malformed" if bad else "blank"))
        (raw / f"{name}.log").write_text("\n".join(written) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        stages.parse_stage(spark, str(raw), "HDFS", str(tmp_path / "out"))
        stored = readers.read_table(spark, str(tmp_path / "out"))
        assert stored.select("file_path", "block_start").distinct().count() > 15
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    found = stages.stored_rejects(spark, str(tmp_path / "out")).collect()
    assert {(r.file_path.rpartition("/")[2], r.line_no, r.value, r.reason) for r in found} == expected
    assert len(found) == len(expected)


def test_parsing_with_places_is_one_stage(spark, files):
    lines = readers.read_placed_lines(spark, f"{files}/raw_hdfs")
    plan = raw_logs.classify_lines(lines, raw_logs.HDFS)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("FileScan") == 1


def test_scratch_follows_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    path = scratch.scratch_path(spark, "x")
    assert path.startswith(folder) and path != scratch.scratch_path(spark, "x")


def test_scratch_without_the_setting_is_below_the_warehouse(spark):
    class Conf:
        def get(self, key, *default):
            return default[0] if key == "spark.checkpoint.dir" else spark.conf.get(key)

    class Session:
        conf, _jvm, _jsparkSession = Conf(), spark._jvm, spark._jsparkSession

    path = scratch.scratch_path(Session(), "x")
    assert path.startswith(spark.conf.get("spark.sql.warehouse.dir"))


def test_all_stages(spark, files, sf_dir, tmp_path):
    out = lambda name: str(tmp_path / name)
    stages.count_stage(spark, f"{files}/structured", out("counts"))
    stages.feature_stage(spark, f"{out('counts')}/part-*", out("features"))
    features = readers.read_table(spark, out("features"))
    assert features.agg(F.sum("error_frequency")).head()[0] == readers.read_lines(spark, f"{files}/structured").count()

    stages.feature_stage(spark, _hourly_counts(spark, sf_dir, out("hourly")), out("hourly_features"))
    hourly = readers.read_table(spark, out("hourly_features"))
    assert same_rows(hourly, registry.event_features(spark, sf_dir))
    metrics = stages.model_stage(
        spark, out("hourly_features"), out("model"), out("predictions"), ModelParams(trees=5, depth=3)
    ).head()
    assert 0.9 < metrics.accuracy <= 1.0

    def connect():
        return lambda prompt, **told: prompt.splitlines()[1]

    stages.alert_stage(spark, out("hourly_features"), out("alerts"), connect=connect)
    rows = readers.read_table(spark, out("alerts")).collect()
    assert len(rows) == 3 and all(r.frequency.endswith(" hits/hr") and r.distribution.endswith("%") for r in rows)
    assert readers.read_table(spark, out("predictions-metrics")).head() == metrics
    assert all(r.answer == f"Log source: {r.source}" and r.error is None for r in rows)
    stages.alert_stage(spark, out("predictions"), out("model_alerts"), by="model", per_source=True)
    assert readers.read_table(spark, out("model_alerts")).count() == 6


def _hourly_counts(spark, sf_dir, path):
    writers.write_counts(registry.event_counts(spark, sf_dir), path)
    return f"{path}/part-*"


def test_records_to_counts(spark, files, sf_dir, tmp_path):
    out = lambda name: str(tmp_path / name)
    stages.parse_stage(spark, f"{files}/raw_hdfs", "HDFS", out("hdfs"))
    stages.parse_stage(spark, f"{files}/raw_bgl", "BGL", out("bgl"))
    stages.count_records_stage(spark, {"HDFS": out("hdfs"), "BGL": out("bgl")}, out("counts"))
    found = counts.parse_wire(readers.read_lines(spark, f"{out('counts')}/part-*"))
    expected = registry.QUERIES["counts_from_records"](spark, sf_dir)
    assert same_rows(found, expected.withColumn("total_count", F.col("total_count").cast("double")))


def test_model_stage_by_time_with_sql(spark, sf_dir, tmp_path):
    out = lambda name: str(tmp_path / name)
    writers.write_table(registry.QUERIES["label_horizon_as_of"](spark, sf_dir), out("features"))
    small = ModelParams(trees=3, depth=3, partitions=2, split="time")
    stages.model_stage(spark, out("features"), out("model"), out("predictions"), small, out("sql"))
    query = "\n".join(r.value for r in readers.read_lines(spark, out("sql")).collect())
    predictions = readers.read_table(spark, out("predictions"))
    con = duck.duckdb.connect()
    con.execute(f"CREATE VIEW features AS SELECT * FROM '{out('features')}/*.parquet'")
    theirs = {tuple(r[:3]): r[3:] for r in con.execute(f"SELECT date_hour, error_type, source, risk, prediction FROM ({query})").fetchall()}
    for r in predictions.collect():
        assert theirs[r.date_hour, r.error_type, r.source] == (r.risk, r.prediction)


def test_answers_are_spread_over_tasks(spark, sf_dir, tmp_path):
    writers.write_table(registry.event_features(spark, sf_dir), str(tmp_path / "features"))

    def connect():
        from pyspark import TaskContext

        return lambda prompt, **told: str(TaskContext.get().partitionId())

    stages.alert_stage(spark, str(tmp_path / "features"), str(tmp_path / "alerts"), limit=60, connect=connect, tasks=6)
    answers = [r.answer for r in readers.read_table(spark, str(tmp_path / "alerts")).collect()]
    assert len(answers) == 60 and len(set(answers)) == 6


def test_rejects_are_stored_and_nothing_is_lost(spark, tmp_path):
    out = lambda name: str(tmp_path / name)
    (tmp_path / "hdfs_logs").mkdir()
    rows = ['1,081109,1,p,x,"a,b"'] * 5 + ["1,081109,1,p,x,INFO"] * 3 + ["1,2", "1,2", "", "LineId,x"]
    (tmp_path / "hdfs_logs" / "a.csv").write_text("\n".join(rows) + "\n")
    stages.count_stage(spark, out("hdfs_logs"), out("counts"))
    rejects = {(r.value, r.reason, r.total_lines) for r in readers.read_table(spark, out("counts-rejects")).collect()}
    assert rejects == {("1,2", "short", 2), ("", "blank", 1), ("LineId,x", "header", 1)}
    lines = readers.read_lines(spark, out("counts")).union(spark.createDataFrame([("d,E,H,NaN",), ("x",)], "value string"))
    lines.write.text(out("more"))
    stages.feature_stage(spark, out("more"), out("features"), rejects=out("bad"))
    assert {(r.value, r.reason) for r in readers.read_table(spark, out("bad")).collect()} == {("d,E,H,NaN", "bad_count"), ("x", "short")}
    kept = {r.error_type: r.error_frequency for r in readers.read_table(spark, out("features")).collect()}
    assert kept == {'"a,b"': 5.0, "INFO": 3.0}


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_features_of_text_scan_the_text_once(spark, sf_dir, tmp_path):
    """Without a table between: every branch starts from one shuffle of the rows."""
    lines = readers.read_lines(spark, _hourly_counts(spark, sf_dir, str(tmp_path / "counts")))
    from logrisk.operators.features import engineer_features

    assert executed(engineer_features(counts.parse_wire(lines))).count("FileScan") == 1


def test_command_line(spark, files, sf_dir, tmp_path, capsys):
    out = lambda name: str(tmp_path / name)
    command.main(["parse", "HDFS", f"{files}/raw_hdfs", out("parsed")])
    command.main(["count-records", out("record_counts"), "--hdfs", out("parsed")])
    assert readers.read_lines(spark, out("record_counts")).count() > 0
    with pytest.raises(SystemExit):
        command.main(["count-records", out("none")])
    command.main(["count", f"{files}/structured", out("counts"), "--hourly-hdfs", "--rejects", out("bad")])
    assert readers.read_table(spark, out("bad")).columns == ["value", "source", "reason", "total_lines"]
    options = ["--label-share", "0.3", "--horizon-hours", "3", "--slice-chars", "7,4", "--bucket-parts", "4"]
    command.main(["features", f"{out('counts')}/part-*", out("features"), *options])
    small = ["--trees", "3", "--depth", "3", "--seed", "1", "--partitions", "2", "--train-tenths", "7", "--split", "key"]
    command.main(["model", out("features"), out("model"), out("predictions"), *small])
    command.main(["alerts", out("features"), out("alerts"), "--limit", "2", "--velocity"])
    assert "accuracy" in capsys.readouterr().out
    rows = readers.read_table(spark, out("alerts")).collect()
    assert len(rows) == 2 and all("previous window" in r.prompt for r in rows)
    cloudpickle.register_pickle_by_value(answers_for_tests)  # the workers do not see this folder
    told = ["--connect", "answers_for_tests:connect", "--temperature", "0.5", "--max-tokens", "7", "--model-name", "m", "--tasks", "2"]
    command.main(["alerts", out("features"), out("answers"), *told])
    assert {r.answer for r in readers.read_table(spark, out("answers")).collect()} == {"m 0.5 7"}
    command.main(["alerts", out("features"), out("once"), *told, "--answers", out("store")])
    assert {r.answer for r in readers.read_table(spark, out("once")).collect()} == {"m 0.5 7"}
    assert readers.read_table(spark, out("store")).columns == ["digest", "answer", "error", "run"]
    other = ["--level-of", "as_of", "--slices", "range", "--label-by", "horizon"]
    command.main(["features", f"{out('counts')}/part-*", out("as_of"), *other])
    assert readers.read_table(spark, out("as_of")).count() == readers.read_table(spark, out("features")).count()


@pytest.mark.parametrize("which", ["hdfs", "bgl"])
def test_each_header_option_works_alone(spark, tmp_path, which):
    for name, header, row in (
        ("hdfs", "LineId,Level,Date,Time", "1,WARN,81109,3518"),
        ("bgl", "LineId,Time,Level", "1,2005-06-03-15.42,FATAL"),
    ):
        (tmp_path / f"{name}_logs").mkdir()
        (tmp_path / f"{name}_logs" / "a.csv").write_text(f"{header}\n{row}\n")
    paths = f"{tmp_path}/hdfs_logs,{tmp_path}/bgl_logs"
    command.main(["count", paths, str(tmp_path / "out"), f"--{which}-header-of", str(tmp_path / f"{which}_logs")])
    expected = {"hdfs": "2008-11-09,WARN,HDFS,1", "bgl": "2005-06-03 15,FATAL,BGL,1"}
    assert [r.value for r in readers.read_lines(spark, str(tmp_path / "out")).collect()] == [expected[which]]
    command.main(["count", paths, str(tmp_path / "own"), "--own-headers"])
    assert {r.value for r in readers.read_lines(spark, str(tmp_path / "own")).collect()} == set(expected.values())


def test_command_line_with_headers(spark, events, sf_dir, tmp_path):
    """Columns found by the headers of the files themselves."""
    rows = logs.header_rows(events)
    folders = {"hdfs_logs": logs.HDFS_HEADER, "bgl_logs": logs.BGL_HEADER}
    for folder, header in folders.items():
        heading = spark.createDataFrame([(header,)], "value string")
        body = rows.filter(F.col("file_path").contains(folder)).select("value")
        heading.unionByName(body).coalesce(1).write.text(str(tmp_path / folder))
    paths = [str(tmp_path / folder) for folder in folders]
    headers = ["--hdfs-header-of", paths[0], "--bgl-header-of", paths[1]]
    command.main(["count", ",".join(paths), str(tmp_path / "counts"), "--hourly-hdfs", *headers])
    found = counts.parse_wire(readers.read_lines(spark, f"{tmp_path}/counts/part-*"))
    expected = registry.event_counts(spark, sf_dir)
    assert same_rows(found, expected.withColumn("total_count", F.col("total_count").cast("double")))
