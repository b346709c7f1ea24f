"""The forest as columns and as SQL against the model itself."""

import duck
import pytest
from pyspark.sql import functions as F

from logrisk.operators import forest_columns, risk_model
from logrisk.plans.registry import event_features
from logrisk.sources.scratch import materialize, scratch_path


@pytest.fixture(scope="module")
def features(spark, sf_dir):
    return materialize(event_features(spark, sf_dir), "test-features")


@pytest.fixture(scope="module", params=[(20, 5, True), (5, 3, False), (1, 1, True)], ids=str)
def fitted(request, features):
    """A model of the rule label, and one of a label that the features hardly tell."""
    trees, depth, rule = request.param
    noise = (F.conv(F.substring(F.md5("date_hour"), 1, 2), 16, 10).cast("int") % 3 == 0).cast("int")
    rows = features if rule else features.withColumn("label", noise)
    rows = rows.withColumn("source", F.when(F.col("error_type") == "WARN", "it's").otherwise(F.col("source")))
    return risk_model.train_risk_model(rows, risk_model.ModelParams(trees=trees, depth=depth, partitions=4)), rows


def odd_rows(rows):
    """Unseen sources, no source, unknown inputs, large and negative numbers."""
    other = rows.limit(40).withColumns(
        {
            "source": F.when(F.col("error_frequency") % 2 == 0, "unseen"),
            "error_distribution": F.when(F.col("error_frequency") % 3 == 0, None).otherwise(F.col("error_distribution")),
            "error_frequency": F.col("error_frequency") * 1e9,
            "rate_of_change": -F.col("rate_of_change"),
        }
    )
    nan = rows.limit(3).withColumn("rate_of_change", F.lit(float("nan")))
    return rows.unionByName(other).unionByName(nan)


def test_columns_equal_the_model(fitted):
    model, rows = fitted
    given = odd_rows(rows).withColumn("row_no", F.monotonically_increasing_id())
    given = materialize(given, "test-odd-rows")
    forest = forest_columns.forest_of(model)
    ours = {r.row_no: (r.prediction, r.risk) for r in forest_columns.score_by_columns(forest, given).collect()}
    theirs = {r.row_no: (r.prediction, r.risk) for r in risk_model.score_risk(model, given).collect()}
    assert ours == theirs and len(ours) == given.count()
    assert None in {prediction for prediction, _ in ours.values()}
    assert forest_columns.score_by_columns(forest, given).columns == [*given.columns, "prediction", "risk"]


def test_sql_equals_the_model(spark, fitted):
    model, rows = fitted
    given = odd_rows(rows).filter("not isnan(rate_of_change)").withColumn("row_no", F.monotonically_increasing_id())
    path = scratch_path(spark, "given")
    given.write.parquet(path)
    given = spark.read.parquet(path)
    con = duck.duckdb.connect()
    con.execute(f"CREATE VIEW features AS SELECT * FROM '{path.removeprefix('file:')}/*.parquet'")
    query = forest_columns.forest_sql(forest_columns.forest_of(model), "features")
    ours = dict((r[0], r[1:]) for r in con.execute(f"SELECT row_no, prediction, risk FROM ({query})").fetchall())
    theirs = {r.row_no: (r.prediction, r.risk) for r in risk_model.score_risk(model, given).collect()}
    assert ours == theirs


def test_no_vectors_on_the_way(fitted):
    model, rows = fitted
    scored = forest_columns.score_by_columns(forest_columns.forest_of(model), rows).filter("risk > 0.5")
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "UDF" not in plan and "VectorUDT" not in plan and "Python" not in plan


def test_all_features_are_read_from_their_places():
    split = forest_columns.Split("high_error_flag", 0.5, (), forest_columns.Leaf((1.0, 0.0)), forest_columns.Leaf((0.25, 0.75)))
    query = forest_columns.forest_sql(forest_columns.Forest((), (split, split)), "t")
    con = duck.duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT 1.0 AS error_frequency, 0.5 AS error_distribution, 0.0 AS rate_of_change, f AS high_error_flag, 's' AS source FROM range(2) r(f)")
    assert con.execute(f"SELECT high_error_flag, prediction, risk FROM ({query}) ORDER BY 1").fetchall() == [(0, 0.0, 0.0), (1, 1.0, 0.75)]
