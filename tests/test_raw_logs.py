import random
import re

import pytest

from logrisk.operators.raw_logs import BGL, HDFS, classify_lines, parse_logs, with_bgl_details

BGL_LINE = (
    "- 1117838570 2005.06.03 R02-M1 2005-06-03-15.42.50.675872 R02-M1 RAS KERNEL INFO cache error"
)


def fields(spark, grammar, line):
    row = classify_lines(spark.createDataFrame([(line,)], "value string"), grammar).head()
    return row.status, [row[name] for name in grammar.fields]


@pytest.mark.parametrize(
    "line, expected",
    [
        ("081109 203518 143 INFO dfs.X: a: b ", ["081109", "203518", "143", "INFO", "dfs.X", "a: b "]),
        ("1 2 3 INFO a b c d: m: n", ["1", "2", "3", "INFO", "a b c d", "m: n"]),
        ("1 2 3 INFO  : msg", ["1", "2", "3", "INFO", " ", "msg"]),
        ("1\t2  3 INFO c:", ["1", "2", "3", "INFO", "c", ""]),
    ],
)
def test_hdfs_lines_that_parse(spark, line, expected):
    assert fields(spark, HDFS, line) == ("parsed", expected)


@pytest.mark.parametrize(
    "line",
    [
        "1 2 3 INFO no colon",
        " 1 2 3 INFO c: m",
        "1 2 3 INFO c: m\u0085",
        "1 2 3 INFO : msg",
        "1 2 3 INFO:",
        "1 2 3 INFO   ",
        "1 2 3 INFO c: m\n4 5 6 WARN d: n",
        "a\nb\nc\nd\ne\nf",
    ],
)
def test_hdfs_lines_that_do_not_parse(spark, line):
    assert fields(spark, HDFS, line) == ("malformed", [None] * 6)


@pytest.mark.parametrize("line", ["", " \t ", "\x00\x1f", None])
def test_blank_lines(spark, line):
    assert fields(spark, HDFS, line) == ("blank", [None] * 6)


def test_bgl_lines(spark):
    status, found = fields(spark, BGL, BGL_LINE)
    assert status == "parsed"
    assert found == [
        "-",
        "1117838570",
        "2005.06.03 R02-M1 2005-06-03-15.42.50.675872 R02-M1 RAS",
        "KERNEL",
        "INFO",
        "cache error",
    ]
    assert fields(spark, BGL, "1 2 3 4 5 6 7 8 9")[1][-1] == ""
    assert fields(spark, BGL, "1 2 3 4 5 6 7 8")[0] == "malformed"


def test_bgl_details(lines):
    row = with_bgl_details(parse_logs(lines(BGL_LINE), BGL).records).head()
    assert (row.severity, row.facility) == ("INFO", "KERNEL")
    assert (row.node_id, row.event_time) == ("R02-M1", "2005-06-03-15.42.50.675872")


# The same grammars with ordinary quantifiers, for Python's own engine.
W, S, REST = r"[ \t\n\x0b\f\r]", r"[^ \t\n\x0b\f\r]", "([^\n\r\x85\u2028\u2029]*)"
PLAIN = {
    "HDFS": re.compile(rf"({S}+){W}+({S}+){W}+({S}+){W}+({S}+){W}+([^:]+):{W}*{REST}"),
    "BGL": re.compile(
        rf"({S}+){W}+({S}+){W}+({S}+{W}+{S}+{W}+{S}+{W}+{S}+{W}+{S}+){W}+({S}+){W}+({S}+){W}*{REST}"
    ),
}


@pytest.mark.parametrize("grammar", [HDFS, BGL], ids=lambda g: g.name)
def test_grammars_equal_plain_patterns(spark, grammar):
    draw = random.Random(7)
    tokens = ["a", "b:", ":", ":c", "é", "\x85", "x:y"]
    gaps = [" ", "  ", "\t", "", "\x0b "]
    texts = [
        "".join(draw.choice(tokens) + draw.choice(gaps) for _ in range(draw.randint(3, 13)))
        for _ in range(5000)
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, value string")
    rows = classify_lines(df, grammar).collect()
    assert {row.status for row in rows} >= {"parsed", "malformed"}
    for row in rows:
        match = PLAIN[grammar.name].fullmatch(row.value)
        found = [row[name] for name in grammar.fields]
        assert (list(match.groups()) if match else [None] * 6) == found, repr(row.value)


def test_records_and_rejects_cover_all_lines(lines):
    parsed = parse_logs(lines("1 2 3 INFO c: m", "", "bad", None), HDFS)
    assert parsed.records.count() == 1
    reasons = sorted((r.value or "", r.reason) for r in parsed.rejects.collect())
    assert reasons == [("", "blank"), ("", "blank"), ("bad", "malformed")]


def test_parsing_needs_no_shuffle_and_matches_once(lines):
    plan = parse_logs(lines("x"), HDFS).records._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert plan.count("regexp_replace") == 1


@pytest.mark.parametrize("middle", [" " * 200_000 + "x", " " * 200_000 + "x:\u0085", "x" * 200_000])
def test_long_lines_that_do_not_parse_stay_cheap(spark, middle):
    assert fields(spark, HDFS, "a b c d" + middle)[0] == "malformed"
