import re

import pytest
from pyspark.sql import functions as F

from logrisk.functions.buckets import BucketStyle, bucket_hour_number, bucket_timestamp
from logrisk.operators import counts
from logrisk.sources.headers import read_first_lines
from logrisk.sources.readers import read_rows

HDFS_PATH, BGL_PATH = "hdfs://x/HDFS_logs/a.csv", "/data/bgl_logs/b.csv"


@pytest.fixture
def rows(spark):
    def make(*pairs):
        return spark.createDataFrame(list(pairs), "value string, file_path string")

    return make


def keys(df):
    return [(r.status, r.date_hour, r.error_type, r.source) for r in df.collect()]


@pytest.mark.parametrize(
    "path, source",
    [
        (HDFS_PATH, "HDFS"),
        (BGL_PATH, "BGL"),
        ("/bgl_logs/hdfs_logs/x", "HDFS"),
        ("/hdfs_logs/bgl_logs/x", "HDFS"),
        ("/logs/x", "UNKNOWN"),
    ],
)
def test_source_of_path(spark, path, source):
    assert spark.range(1).select(counts.source_of(F.lit(path))).head()[0] == source


@pytest.mark.parametrize(
    "day, bucket",
    [("081109", "2008-11-09"), ("81109", "81109"), ("2015-11-09", "2020-15--1"), ("", "")],
)
def test_hdfs_buckets(rows, day, bucket):
    df = counts.classify_rows(rows((f"1,{day},203518,p,x, WARN ,m", HDFS_PATH)))
    assert keys(df) == [("counted", bucket, "WARN", "HDFS")]


@pytest.mark.parametrize(
    "time, bucket",
    [("2005-06-03-15.42.50", "2005-06-03 15"), ("2005-06-03", "2005-06-03"), ("R02-M1-N0-C:J12", "R02-M1-N0- :J")],
)
def test_bgl_buckets(rows, time, bucket):
    df = counts.classify_rows(rows((f"1,\tFATAL ,x,y,{time},m", BGL_PATH)))
    assert keys(df) == [("counted", bucket, "FATAL", "BGL")]


def test_status_of_rows(rows):
    df = counts.classify_rows(
        rows(
            ("LineId,Date", HDFS_PATH),
            (" LineId,a,b,c,d,e", HDFS_PATH),
            ("\t", BGL_PATH),
            ("1,2,3,4,5", HDFS_PATH),
            ("1,2,3,4,,,,,", BGL_PATH),
            ("1,2,3,4,,x", BGL_PATH),
            ("anything", "/other"),
            (" ", "/other"),
        )
    )
    assert [k[0] for k in keys(df)] == [
        "header", "counted", "blank", "short", "short", "counted", "counted", "blank",
    ]
    assert keys(df)[5] == ("counted", "", "2", "BGL")
    assert keys(df)[6] == ("counted", "UNKNOWN", "UNKNOWN", "UNKNOWN")


def test_counts_and_rejects_cover_all_rows(rows):
    df = rows(*[(f"{i},081109,1,p,x,INFO", HDFS_PATH) for i in range(30)], ("1,2", HDFS_PATH), ("", BGL_PATH))
    total = counts.count_errors(df).agg(F.sum("total_count")).head()[0]
    assert total + counts.rejected_rows(df).count() == df.count()


def test_header_layout_finds_columns_and_restores_zeros(rows):
    layout = counts.header_layout(
        "LineId,Date,Time,Pid,Level,Component,Content",
        "LineId,Label,Timestamp,Date,Node,Time,NodeRepeat,Type,Component,Level,Content",
    )
    df = rows(
        ("1,81109,3518,148,INFO,dfs.X,m", HDFS_PATH),
        ('1,-,1117838570,2005.06.03,R02,2005-06-03-15.42.50.6,R02,RAS,KERNEL,INFO,"a, b"', BGL_PATH),
    )
    hourly = counts.classify_rows(df, layout, BucketStyle(hourly_hdfs=True, separator="-"))
    assert keys(hourly) == [
        ("counted", "2008-11-09-00", "INFO", "HDFS"),
        ("counted", "2005-06-03-15", "INFO", "BGL"),
    ]
    daily = counts.classify_rows(df, layout)
    assert keys(daily)[0][1] == "2008-11-09"


@pytest.mark.parametrize(
    "layout, day, clock, bucket",
    [
        ("header", "", "203518", ""),
        ("header", "n/a", "203518", "n/a"),
        ("header", "81109", "", "081109"),
        ("header", "81109", "7", "2008-11-09 00"),
        ("header", "81109", "x", "081109"),
        ("positional", "81109", "203518", "81109"),
        ("positional", "081109", "3518", "081109"),
        ("positional", "081109", "203518", "2008-11-09 20"),
    ],
)
def test_only_digits_of_numeric_columns_are_padded(rows, layout, day, clock, bucket):
    header = counts.header_layout("LineId,Date,Time,Pid,x,Level")
    df = rows((f"1,{day},{clock},p,x,WARN", HDFS_PATH))
    found = counts.classify_rows(df, header if layout == "header" else counts.POSITIONAL, BucketStyle(hourly_hdfs=True))
    assert keys(found)[0][1] == bucket


def test_columns_follow_the_header_of_each_file(rows):
    df = rows(
        ("LineId,Level,Date", "/hdfs_logs/a"),
        ("1,WARN,81109", "/hdfs_logs/a"),
        ("LineId,Date,Level", "/hdfs_logs/b"),
        ("1,081110,INFO", "/hdfs_logs/b"),
        ("1,081111,1,p,x,ERROR", "/hdfs_logs/c"),
    )
    found = counts.count_errors(df, counts.file_layouts(df)).collect()
    assert {(r.date_hour, r.error_type) for r in found} == {
        ("2008-11-09", "WARN"), ("2008-11-10", "INFO"), ("2008-11-11", "ERROR"),
    }


def test_the_first_header_of_a_file_counts(rows):
    """Not the least one, and none that stands in another file."""
    df = rows(
        ("LineId,Level,Date", "/hdfs_logs/a"),
        ("1,WARN,81109", "/hdfs_logs/a"),
        ("LineId,Date,Level", "/hdfs_logs/a"),
        ("2,INFO,81110", "/hdfs_logs/a"),
    ).coalesce(1)
    found = counts.count_errors(df, counts.file_layouts(df)).collect()
    assert {(r.date_hour, r.error_type) for r in found} == {("2008-11-09", "WARN"), ("2008-11-10", "INFO")}


def test_layouts_are_looked_up_where_lines_are_read(spark, rows, tmp_path):
    """No shuffle of lines, one read of them, although one file holds nine tenths."""
    for name, header, body in (("a", "LineId,Level,Date", "1,WARN,81109"), ("b", "LineId,Date,Level", "1,81110,INFO")):
        (tmp_path / "hdfs_logs").mkdir(exist_ok=True)
        (tmp_path / "hdfs_logs" / f"{name}.csv").write_text("\n".join([header] + [body] * (9000 if name == "a" else 1000)) + "\n")
    layouts = counts.file_layouts(read_first_lines(spark, str(tmp_path / "hdfs_logs")))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        found = counts.count_errors(read_rows(spark, str(tmp_path / "hdfs_logs")), layouts)
        assert {(r.date_hour, r.error_type, r.total_count) for r in found.collect()} == {
            ("2008-11-09", "WARN", 9000), ("2008-11-10", "INFO", 1000),
        }
        plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("FileScan text") == 1
        # From the top down: the counts' shuffle, the lookup, the lines.
        shuffles = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
        assert all("date_hour" in keys or "file_path" in keys and "value" not in keys for keys in shuffles)
        lookup = plan.index("BroadcastHashJoin")
        assert plan.index("partial_count") < lookup < plan.index("FileScan text")
        between = plan[lookup : plan.index("FileScan text")]
        assert "Exchange hashpartitioning" not in between
        lines = found._jdf.queryExecution().optimizedPlan().toString()
        assert lines.count("Repartition") == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_too_many_files_for_a_lookup(rows, monkeypatch):
    df = rows(
        *[("LineId,Level,Date", "/hdfs_logs/a")],
        *[(f"{i},WARN,81109", "/hdfs_logs/a") for i in range(200)],
        ("LineId,Date,Level", "/hdfs_logs/b"),
        ("1,081110,INFO", "/hdfs_logs/b"),
        ("1,081111,1,p,x,ERROR", "/hdfs_logs/c"),
        ("1,x", None),
    )
    expected = sorted(map(tuple, counts.classify_rows(df, counts.file_layouts(df)).collect()), key=repr)
    monkeypatch.setattr(counts, "MOST_LAYOUTS", 0)
    dealt = counts.classify_rows(df, counts.file_layouts(df))
    assert sorted(map(tuple, dealt.collect()), key=repr) == expected and len(expected) == df.count()


def test_wire_lines(lines):
    df = counts.classify_wire(lines("d,ERROR,HDFS,12", "d,ERROR,HDFS", "d,E,H,x", "d,E,H,3,4", "", "d,,S,1"))
    found = [(r.status, r.error_type, r.source, r.total_count) for r in df.collect()]
    assert found == [
        ("counted", "ERROR", "HDFS", 12.0),
        ("short", None, None, None),
        ("bad_count", "E", "H", None),
        ("counted", "E,H", "3", 4.0),
        ("short", None, None, None),
        ("counted", "", "S", 1.0),
    ]


@pytest.mark.parametrize("count", ["NaN", "Infinity", "-Infinity", "-1", "2.5", "", " ", "1e400", "x1", "12d", "12f", "0x1p3", "1e3", "-0", "+1", "1 ", "1\u0660", "9223372036854775808"])
def test_counts_must_be_whole_numbers(lines, count):
    assert [r.status for r in counts.classify_wire(lines(f"d,E,H,{count}")).collect()] == ["bad_count"]


def test_counts_are_exact(lines):
    large = [(1 << 53) + 1, (1 << 63) - 1, 7]
    found = counts.parse_wire(lines(*[f"d{i},E,H,{n}" for i, n in enumerate(large)], "d9,E,H,007"))
    assert dict(found.dtypes)["total_count"] == "bigint"
    assert [r.total_count for r in found.orderBy("date_hour").collect()] == [*large, 7]


def test_a_key_must_not_be_empty_altogether(lines):
    found = counts.classify_wire(lines(",,,3", ",,,,3", "d,,,3", ",E,,3", ",,S,3", ",,,x", ",,3")).collect()
    assert [r.status for r in found] == [
        "empty_key", "counted", "counted", "counted", "counted", "bad_count", "short",
    ]


def test_types_with_commas_survive_the_wire(spark):
    keys = [("d", '"a,b"', "H"), ("d", ",", "H"), ("d", "a,,b,", "H"), ("d", "", "H"), ("", "x", "")]
    df = spark.createDataFrame([(*key, 3) for key in keys], "date_hour string, error_type string, source string, total_count long")
    back = counts.parse_wire(df.select(counts.wire_text())).collect()
    assert sorted((r.date_hour, r.error_type, r.source) for r in back) == sorted(keys)
    null = spark.createDataFrame([("d", None, "H", 3)], df.schema).select(counts.wire_text()).head().value
    assert null == "d,UNKNOWN,H,3"


def test_wire_order_is_the_order_of_the_joined_text(spark):
    df = spark.createDataFrame(
        [("2005-06-03", "A", "S", 1), ("2005-06-03 15", "A", "S", 2)],
        "date_hour string, error_type string, source string, total_count long",
    )
    assert [r.total_count for r in counts.first_counts(df).collect()] == [2, 1]


def test_counting_combines_before_its_only_shuffle(rows):
    plan = counts.count_errors(rows(("1,2", HDFS_PATH)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert plan.index("Exchange") < plan.index("partial_count")
    assert plan.count("regexp_replace") == 1


def test_bucket_times(lines):
    df = lines("2008-11-09", "2005-06-03 15", "2005-06-03-15", "81109", "2020-15--1", "2005-13-01 00")
    found = df.select(
        bucket_timestamp(F.col("value")).cast("string").alias("t"),
        bucket_hour_number(F.col("value")).alias("h"),
    )
    assert [r.t for r in found.collect()] == [
        "2008-11-09 00:00:00", "2005-06-03 15:00:00", "2005-06-03 15:00:00", None, None, None,
    ]
    assert [r.h for r in found.collect()][1:4] == [310503, 310503, None]
