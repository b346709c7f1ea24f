import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from logrisk.operators import risk_model
from logrisk.plans.registry import event_features
from logrisk.sources.scratch import materialize

PARAMS = risk_model.ModelParams(trees=5, depth=3, partitions=4)


@pytest.fixture(scope="module")
def features(spark, sf_dir):
    return materialize(event_features(spark, sf_dir), "test-features")


def scores(model, df):
    scored = risk_model.score_risk(model, df).orderBy("date_hour", "error_type", "source")
    return [(r.prediction, r.risk) for r in scored.collect()]


def test_source_index(spark):
    df = spark.createDataFrame([("b",), ("b",), ("c",), ("a",)], "source string")
    model = risk_model.source_indexer().fit(df)
    unseen = df.union(spark.createDataFrame([("z",), (None,)], "source string"))
    found = {r.source: r.source_index for r in model.transform(unseen).collect()}
    assert found == {"b": 0.0, "a": 1.0, "c": 2.0, "z": 3.0, None: 3.0}


def test_split_covers_all_rows_and_ignores_layout(features):
    train, test = risk_model.split_features(features)
    assert train.count() + test.count() == features.count()
    assert 0.7 < train.count() / features.count() < 0.9
    again, _ = risk_model.split_features(features.repartition(5))
    assert train.exceptAll(again).count() == 0


def test_random_split_covers_all_rows(features):
    train, test = risk_model.split_features(features, risk_model.ModelParams(split="random"))
    assert train.count() + test.count() == features.count()
    assert train.intersectAll(test).count() == 0


def test_training_does_not_depend_on_the_layout(features):
    train, test = risk_model.split_features(features)
    expected = scores(risk_model.train_risk_model(train, PARAMS), test)
    for layout in (train.repartition(1), train.repartition(6, "error_type"), train.orderBy(F.rand(1))):
        assert scores(risk_model.train_risk_model(layout, PARAMS), test) == expected


def test_the_number_of_rows_does_not_change_the_layout(spark, features, monkeypatch):
    seen = []
    fit = risk_model.Pipeline.fit
    monkeypatch.setattr(risk_model.Pipeline, "fit", lambda self, df: seen.append(df.rdd.getNumPartitions()) or fit(self, df))
    train, _ = risk_model.split_features(features)
    for df in (train, train.union(train), train.limit(300)):
        risk_model.train_risk_model(df, PARAMS)
    assert seen == [PARAMS.partitions] * 3


def test_split_by_time_does_not_look_ahead(spark):
    rows = [(f"2024-01-{d:02} {h:02}", "E", "S", 0) for d in range(1, 11) for h in range(24)]
    rows += [("free", "E", "S", 0), ("2024-01-08", "D", "S", 0), ("2024-01-03", "D", "S", 0)]
    table = spark.createDataFrame(rows, "date_hour string, error_type string, source string, label int")
    train, test = risk_model.split_features(table, risk_model.ModelParams(split="time", gap_hours=5))
    last, first = train.agg(F.max("date_hour")).first()[0], test.agg(F.min("date_hour")).first()[0]
    assert (last, first) == ("2024-01-08 18", "2024-01-09 00")
    # A day ends after 24 hours, and a bucket that is no time is on neither side.
    assert {r.date_hour for r in train.filter("error_type = 'D'").collect()} == {"2024-01-03"}
    assert train.unionByName(test).filter("date_hour = 'free'").count() == 0
    assert (train.count(), test.count()) == (8 * 24 - 5 + 1, 48)
    with pytest.raises(ValueError):
        risk_model.split_features(table.filter("date_hour = 'free'"), risk_model.ModelParams(split="time"))


@pytest.mark.parametrize("wrong", [{"split": "x"}, {"train_tenths": 10}, {"partitions": 0}, {"gap_hours": -1}])
def test_wrong_settings_raise(wrong):
    with pytest.raises(ValueError):
        risk_model.ModelParams(**wrong)


def test_rows_that_are_no_numbers_are_incomplete(features):
    odd = features.limit(1).withColumn("rate_of_change", F.lit(float("nan")))
    assert odd.filter(risk_model.is_complete()).count() == 0


def test_one_class_raises(features):
    with pytest.raises(ValueError, match="both labels"):
        risk_model.train_risk_model(features.filter("label = 0"), PARAMS)
    with pytest.raises(ValueError, match="both labels"):
        risk_model.train_risk_model(features.filter("label = 7"), PARAMS)


def test_rows_with_unknown_inputs_are_kept_without_a_score(features):
    train, test = risk_model.split_features(features)
    gap = F.lit(None).cast("double")
    incomplete = test.orderBy("date_hour", "error_type", "source").limit(1).withColumn("error_distribution", gap)
    model = risk_model.train_risk_model(train.unionByName(incomplete), PARAMS)
    assert scores(model, test) == scores(risk_model.train_risk_model(train, PARAMS), test)
    scored = risk_model.score_risk(model, test.unionByName(incomplete))
    assert scored.count() == test.count() + 1
    unscored = scored.filter("prediction IS NULL").collect()
    assert [(r.risk, r.probability, r.error_distribution) for r in unscored] == [(None, None, None)]
    assert risk_model.evaluate_risk(scored).head() == risk_model.evaluate_risk(risk_model.score_risk(model, test)).head()


def test_saved_model_scores_alike(features, tmp_path):
    train, test = risk_model.split_features(features)
    model = risk_model.train_risk_model(train, PARAMS)
    model.write().save(str(tmp_path / "model"))
    assert scores(PipelineModel.load(str(tmp_path / "model")), test) == scores(model, test)


def test_scores_keep_the_key_and_are_probabilities(features):
    train, test = risk_model.split_features(features)
    scored = risk_model.score_risk(risk_model.train_risk_model(train, PARAMS), test)
    needed = {"date_hour", "error_type", "source", "features", "label", "prediction", "probability"}
    assert needed <= set(scored.columns)
    assert scored.filter("risk < 0 or risk > 1 or (risk > 0.5) <> (prediction = 1)").count() == 0


@pytest.mark.parametrize(
    "pairs",
    [
        [(0, 0, 50), (0, 1, 7), (1, 0, 3), (1, 1, 9)],
        [(0, 0, 5), (1, 0, 5)],
        [(0, 1, 2), (1, 1, 3), (2, 0, 4), (2, 2, 5)],
        [(1, 1, 4)],
    ],
)
def test_metrics_equal_the_evaluator(spark, pairs):
    rows = [(float(a), float(p)) for a, p, n in pairs for _ in range(n)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    found = risk_model.evaluate_risk(df).head()
    names = {"accuracy": "accuracy", "weightedPrecision": "weighted_precision", "weightedRecall": "weighted_recall", "f1": "f1"}
    for theirs, ours in names.items():
        expected = MulticlassClassificationEvaluator(metricName=theirs).evaluate(df)
        assert found[ours] == pytest.approx(expected, abs=1e-12)


def test_model_learns_the_rule(features):
    train, test = risk_model.split_features(features)
    metrics = risk_model.evaluate_risk(risk_model.score_risk(risk_model.train_risk_model(train), test)).head()
    assert metrics.accuracy > 0.95
    assert metrics.weighted_recall == pytest.approx(metrics.accuracy)
