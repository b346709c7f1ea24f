import random
import re

import pytest
from pyspark.sql import functions as F

from logrisk.functions.text import as_wire_number, csv_tokens, evaluate_once, is_blank, trim_text


def expected_tokens(line):
    """Split before every even number of remaining quotes, drop empty tokens at the end."""
    tokens, current = [], ""
    for i, char in enumerate(line):
        if char == "," and line.count('"', i + 1) % 2 == 0:
            tokens.append(current)
            current = ""
        else:
            current += char
    tokens.append(current)
    while len(tokens) > 1 and tokens[-1] == "":
        tokens.pop()
    return tokens


def split(spark, lines):
    rows = spark.createDataFrame(list(enumerate(lines)), "i int, value string")
    found = rows.select("i", evaluate_once(csv_tokens(F.col("value"))).alias("t")).orderBy("i")
    return [list(row.t) for row in found.collect()]


@pytest.mark.parametrize(
    "line, tokens",
    [
        ('1,2,"a,b",4,,', ["1", "2", '"a,b"', "4"]),
        ('1,"2,3', ['1,"2', "3"]),
        ("1,,2", ["1", "", "2"]),
        (",1", ["", "1"]),
        ('"a""b,c",d', ['"a""b,c"', "d"]),
    ],
)
def test_csv_tokens(spark, line, tokens):
    assert expected_tokens(line) == tokens
    assert split(spark, [line]) == [tokens]


def test_csv_tokens_equal_brute_force(spark):
    draw = random.Random(7)
    lines = ["".join(draw.choices('ab,," ', k=draw.randint(0, 14))) for _ in range(5000)]
    assert split(spark, lines) == [expected_tokens(line) for line in lines]


@pytest.mark.parametrize(
    "piece, count", [('a,"b,c",', 2), (",", 0), ('"', 0), (" ", 0), ("a,", 1)]
)
def test_long_lines_are_split_whole(spark, piece, count):
    repeats = 200_000
    line = spark.range(1).select(F.repeat(F.lit(piece), repeats).alias("value"))
    size = line.select(F.size(csv_tokens(F.col("value"))).alias("n")).head().n
    assert size == max(1, count * repeats)


def test_blank_and_trim(lines):
    df = lines("\t \x0b", " \ta b\x1f ", "", None)
    found = df.select(is_blank(F.col("value")).alias("b"), trim_text(F.col("value")).alias("t"))
    rows = [tuple(r) for r in found.collect()]
    assert rows == [(True, ""), (False, "a b"), (True, ""), (True, None)]


def test_numbers_have_no_exponent(spark):
    df = spark.createDataFrame([(12345678.0,), (0.0,), (1e15,)], "f double")
    shown = [r[0] for r in df.select(as_wire_number(F.col("f"))).collect()]
    assert shown == ["12345678.0", "0.0", "1000000000000000.0"]


def test_expected_tokens_match_a_look_ahead_split():
    line = 'x,"y,z",,w'
    assert re.split(r',(?=(?:[^"]*"[^"]*")*[^"]*$)', line) == expected_tokens(line)
