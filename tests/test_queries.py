"""Every registered query against its SQL on the same tables."""

import duck
import pytest

import __spark_entry__ as contract

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert duck.difference(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", ["hourly_counts", "features_full", "alerts_topk", "label_horizon"])
@pytest.mark.parametrize("scale", ["0.01", "0.1"])
def test_query_equals_sql_at_larger_scale(spark, name, scale):
    folder = f"/root/testdata/sf{scale}"
    assert duck.difference(QUERIES[name](spark, folder), duck.connect(folder), ORACLES[name]) is None


PARSING = [
    "hdfs_parse", "hdfs_rejects", "bgl_parse", "bgl_details", "parse_rejects", "document_lines", "csv_split",
    "counts_hdfs_csv", "counts_bgl_csv", "csv_rejects", "counts_by_path", "counts_by_header", "counts_from_records",
]


@pytest.mark.parametrize("name", PARSING)
def test_lines_are_parsed_where_they_are_read(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobin" not in plan and "REPARTITION" not in plan


def test_sql_belongs_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows_and_the_feature_schema(spark):
    df = contract.entry(spark)
    assert dict(df.dtypes) == {
        "date_hour": "string",
        "error_type": "string",
        "source": "string",
        "error_frequency": "double",
        "error_distribution": "double",
        "rate_of_change": "double",
        "high_error_flag": "int",
        "label": "int",
    }
    assert df.count() > 0
