import numpy as np
import pytest
from pyspark import StorageLevel
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from riskflow.contract import SEED
from riskflow.models.scorers import ExternalScorer, LinearScorer, MlScorer, default_metadata, load_scorer, path_exists
from riskflow.models.training import model_card, spread, train_forest, train_logistic, weighted
from riskflow.operators.evaluate import evaluate
from riskflow.session import kept


def vectors(spark, n=400, width=6, seed=1):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, width))
    y = (x[:, 0] - 0.5 * x[:, 1] + r.normal(scale=0.7, size=n) > 0.8).astype(int)
    df = spark.createDataFrame([(int(a), b.tolist(), i) for i, (a, b) in enumerate(zip(y, x))], "label int, a array<double>, i int")
    return df.select("i", "label", array_to_vector("a").alias("features")), x, y


@pytest.fixture(scope="module")
def data(spark):
    df, x, y = vectors(spark)
    return df.cache(), x, y


@pytest.fixture(scope="module")
def forest(data):
    return train_forest(data[0], trees=10, depth=5)


def probabilities(df):
    return [r.probability for r in df.orderBy("i").collect()]


def test_balanced_weights(data):
    df, _, y = data
    out, n = weighted(df)
    assert n == 400 and out.agg(F.sum("weight")).first()[0] == pytest.approx(400)
    per_class = {r.label: r.w for r in out.groupBy("label").agg(F.sum("weight").alias("w")).collect()}
    assert per_class == {0: pytest.approx(200), 1: pytest.approx(200)}


def test_logistic_matches_its_objective(data):
    df, x, y = data
    model = train_logistic(df)
    w = np.where(y == 1, 400 / (2 * y.sum()), 400 / (2 * (400 - y.sum())))
    # gradient of the summed weighted loss plus a unit penalty vanishes at the optimum
    beta, b0 = model.classifier.coefficients.toArray(), model.classifier.intercept
    p = 1 / (1 + np.exp(-(x @ beta + b0)))
    assert np.abs(x.T @ (w * (p - y)) + beta).max() < 0.05 and abs((w * (p - y)).sum()) < 0.05
    assert probabilities(model.score(df)) == pytest.approx(list(p), abs=1e-9)


def test_forest_learns(data, forest):
    df, _, y = data
    row = evaluate(forest.score(df)).first()
    assert row.roc_auc > 0.85
    p = forest.probability_matrix(df).select("probabilities").collect()
    assert all(0 <= r[0][1] <= 1 and sum(r[0]) == pytest.approx(1) for r in p)
    assert {r.prediction for r in forest.predict(df).collect()} <= {0, 1}
    assert forest.score(df).columns == df.columns + ["probability"]


def test_a_level_costs_the_forest_one_step(data, forest):
    from pyspark.ml.classification import RandomForestClassifier

    assert forest.classifier.getCacheNodeIds() and forest.classifier.getCheckpointInterval() == -1
    rows, _ = weighted(spread(data[0]))
    walked = RandomForestClassifier(labelCol="label", weightCol="weight", numTrees=10, maxDepth=5, featureSubsetStrategy="sqrt",
                                    seed=SEED, maxMemoryInMB=1024).fit(rows)  # each level from the root
    splits = [[t.toDebugString.split("\n", 1)[1] for t in model.trees] for model in (walked, forest.classifier)]  # without the trees' ids
    assert splits[0] == splits[1]


def test_scores_do_not_depend_on_layout(data, forest):
    df = data[0]
    assert probabilities(forest.score(df)) == probabilities(forest.score(df.repartition(7).orderBy(F.desc("i"))))


def test_importances(data, forest, spark):
    names = [f"n{i}" for i in range(6)]
    ranked = forest.importances(names)
    assert list(ranked)[0] == "n0" and sorted(ranked.values(), reverse=True) == list(ranked.values())
    assert list(forest.importances(["too", "few"])) == [f"feature_{i}" for i in range(6)]
    coefficients = train_logistic(data[0]).importances(names)
    assert list(coefficients)[:2] == ["n0", "n1"] and min(coefficients.values()) >= 0
    assert forest.importance_frame(spark, names).first().feature == "n0"


def test_save_and_load(data, forest, tmp_path, spark):
    df, path = data[0], str(tmp_path / "m")
    forest.threshold = 0.35
    forest.save(path)
    back = MlScorer.load(path)
    assert probabilities(back.score(df)) == probabilities(forest.score(df))
    for key in ("model_family", "version", "classification_threshold"):
        assert key in back.metadata
    bare = str(tmp_path / "bare")
    forest.model.write().save(f"{bare}/model")
    loaded = MlScorer.load(bare)
    assert loaded.metadata == default_metadata("RandomForestClassificationModel") and loaded.threshold == 0.35
    assert not path_exists(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        MlScorer.load(str(tmp_path / "none"))


def test_margin_only_model(data):
    df = data[0]
    svc = MlScorer(LinearSVC(maxIter=5).fit(df))
    raw = [r.rawPrediction[1] for r in svc.model.transform(df).orderBy("i").collect()]
    assert probabilities(svc.score(df)) == pytest.approx([1 / (1 + np.exp(-z)) for z in raw])


def halves():
    class Halves:  # local, so that it travels with the pickled model
        feature_importances_ = [0.1, 0.6, 0.3]

        def predict_proba(self, x):
            p = 1 / (1 + np.exp(-x[:, 0]))
            return np.column_stack([1 - p, p])

    return Halves()


def labels():
    class Labels:
        def predict(self, x):
            return (x[:, 0] > 0).astype(int)

    return Labels()


def test_external_model(data, tmp_path):
    df, x, _ = data
    e = ExternalScorer(halves(), author="Jane Doe", model_name="experiment", version="0.9.1")
    p = 1 / (1 + np.exp(-x[:, 0]))
    assert probabilities(e.score(df)) == pytest.approx(list(p))
    assert [r.prediction for r in e.predict(df).orderBy("i").collect()] == list((p >= 0.35).astype(int))
    assert e.metadata["is_external"] is True and e.metadata["author"] == "Jane Doe"
    assert list(e.importances(["a", "b", "c"])) == ["b", "c", "a"]
    back = ExternalScorer.load(e.save(str(tmp_path / "e")))
    assert back.metadata == e.metadata and probabilities(back.score(df)) == probabilities(e.score(df))
    with pytest.raises(FileNotFoundError):
        ExternalScorer.load(str(tmp_path / "none"))


def test_external_labels_only(data):
    df, x, _ = data
    e = ExternalScorer(labels(), threshold=2.0)  # a threshold means nothing without probabilities
    assert [r.prediction for r in e.predict(df).orderBy("i").collect()] == list((x[:, 0] > 0).astype(int))
    assert [r.probabilities for r in e.probability_matrix(df).orderBy("i").limit(2).collect()] == [
        [1.0 - v, float(v)] for v in (x[:2, 0] > 0).astype(int)]
    assert e.importances() == {}


def test_linear_scorer(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0)], "a double, b double, i int")
    s = LinearScorer(-1.0, {"a": 2.0, "b": -0.5})
    assert probabilities(s.score(df)) == [pytest.approx(0.5)]
    assert s.predict(df).first().prediction == 1 and s.importances() == {"a": 2.0, "b": 0.5}


def test_spread(spark):
    df, _, _ = vectors(spark)

    def layout(table):
        return spread(table).select("i", F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("at")).orderBy("i").collect()

    want = layout(df.coalesce(1))
    assert len({r.p for r in want}) > 8 and layout(df.repartition(7)) == want


def test_rows_are_dealt_once(data, spark):
    df, _, _ = data
    read = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def seen(label):
        read.add(1)
        return label

    once = df.withColumn("label", seen("label"))
    with kept(spread(once)) as dealt:
        for train in (lambda t: train_logistic(t, iterations=3), lambda t: train_forest(t, trees=3, depth=3)):
            train(once)
            assert read.value == 400  # neither a solver's own passes nor the next solver deal again
    assert dealt.storageLevel == StorageLevel.NONE


def test_forest_depends_on_the_rows_alone(data):
    df = data[0]
    one, many = (probabilities(train_forest(df.repartition(n), trees=5, depth=4).score(df)) for n in (2, 9))
    assert one == many


def test_failed_rows_are_not_shown_to_the_model(spark):
    df, _, _ = vectors(spark, n=20)

    class Picky:
        def predict_proba(self, x):
            assert np.isfinite(x).all() and (x != -99).all()
            return np.column_stack([1 - x[:, 0], x[:, 0]])

    bad = df.withColumn("good", F.col("i") % 3 > 0).withColumn("features", F.when(F.col("good"), F.col("features")).otherwise(array_to_vector(F.array_repeat(F.lit(-99.0), 6))))
    out = ExternalScorer(Picky()).score(bad, F.col("good")).collect()
    assert all((r.probability is None) == (not r.good) for r in out)


def test_own_labels_without_probabilities(data):
    df = data[0]
    fitted = LinearSVC(maxIter=20).fit(df.withColumn("label", F.col("label").cast("double")))
    own = {r.i: r.prediction for r in fitted.transform(df).collect()}
    assert {r.i: r.prediction for r in MlScorer(fitted).predict(df).collect()} == own


def test_any_saved_model_loads(spark, tmp_path):
    ExternalScorer(_Constant()).save(str(tmp_path / "x"))
    assert isinstance(load_scorer(spark, str(tmp_path / "x")), ExternalScorer)


class _Constant:
    def predict(self, x):
        return np.zeros(len(x))


def test_card():
    a = {"roc_auc": 0.6649, "f1_score": 0.3864}
    card = model_card(a, {"roc_auc": 0.6693, "f1_score": 0.373}, 9600, 2400, 60)
    assert card["baseline_comparison"]["improvement_roc_auc"] == -0.0044
    assert card["train_samples"] == 9600 and card["features_count"] == 60 and card["metrics"] is a
    assert model_card({**a, "roc_auc": None}, a, 1, 1, 1)["baseline_comparison"]["improvement_roc_auc"] is None
