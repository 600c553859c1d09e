import os

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from riskflow.models import certify
from riskflow.models.scorers import ExternalScorer, MlScorer
from riskflow.models.training import train_forest, train_logistic


@pytest.fixture(scope="module")
def data(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(300, 4))
    x[:, 3] = 0  # a feature that no row has
    y = (x[:, 0] - x[:, 1] > 0.4).astype(int)
    rows = [(int(a), b.tolist(), i) for i, (a, b) in enumerate(zip(y, x))]
    return spark.createDataFrame(rows, "label int, a array<double>, i int").select("i", "label", array_to_vector("a").alias("features")).cache()


def test_gradient_vanishes_at_the_solution_only(data):
    found = {r.position: r.gradient for r in certify.logistic_gradient(train_logistic(data), data).collect()}
    assert sorted(found) == [-1, 0, 1, 2, 3] and max(map(abs, found.values())) < 1e-4 and found[3] == 0
    early = MlScorer(LogisticRegression(labelCol="label", maxIter=1, regParam=0.5).fit(data))
    assert max(abs(r.gradient) for r in certify.logistic_gradient(early, data).collect()) > 0.01


def test_walk_by_joins_gives_the_forests_scores_and_weights(data, monkeypatch):
    model = train_forest(data, trees=7, depth=4)
    nodes = certify.forest_nodes(model)
    assert nodes.count() == model.classifier.totalNumNodes
    want = {r.i: r.probability for r in model.score(data).collect()}
    assert {r.i: r.probability for r in certify.walk(model, nodes, data, "i").collect()} == pytest.approx(want, abs=1e-12)
    monkeypatch.setattr(certify, "SENT_NODES", 0)
    assert {r.i: r.probability for r in certify.walk(model, nodes, data, "i").collect()} == pytest.approx(want, abs=1e-12)
    weights = {r.feature: r.importance for r in certify.forest_importances(nodes).collect()}
    own = {i: w for i, w in enumerate(model.classifier.featureImportances.toArray()) if w}
    assert weights == pytest.approx(own, abs=1e-12)
    assert certify.walk(model, nodes, data.limit(0), "i").collect() == []


def test_walk_deals_few_files_to_all_cores_and_keeps_steps_short(data):
    model = train_forest(data, trees=3, depth=3)
    walked = certify.walk(model, certify.forest_nodes(model), data.coalesce(1), "i")
    plan = walked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression [key") == 1 and "array_contains" not in plan
    assert plan.index("Generate explode") < plan.index("RepartitionByExpression")  # rows are dealt, not their states


def test_walk_goes_down_two_levels_a_join(data, monkeypatch):
    monkeypatch.setattr(certify, "SENT_NODES", 0)
    for depth, joins in ((2, 1), (3, 2), (4, 2)):  # and one that finds the leaves
        model = train_forest(data, trees=3, depth=depth)
        walked = certify.walk(model, certify.forest_nodes(model), data, "i")
        assert walked._jdf.queryExecution().optimizedPlan().toString().count("Join Inner") == joins + 1
        want = {r.i: r.probability for r in model.score(data).collect()}
        assert {r.i: r.probability for r in walked.collect()} == pytest.approx(want, abs=1e-12)


def test_walk_takes_categories(spark):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorIndexer

    rows = [(i, float(i % 3 == 1), [float(i % 3), float(i % 7)]) for i in range(210)]
    df = spark.createDataFrame(rows, "i int, label double, a array<double>").select("i", "label", array_to_vector("a").alias("v"))
    df = VectorIndexer(inputCol="v", outputCol="features", maxCategories=7).fit(df).transform(df)
    model = MlScorer(RandomForestClassifier(numTrees=3, maxDepth=3, seed=1).fit(df))
    nodes = certify.forest_nodes(model)
    assert nodes.where("categories >= 0 and left >= 0").count() > 0
    want = {r.i: r.probability for r in model.score(df).collect()}
    assert {r.i: r.probability for r in certify.walk(model, nodes, df, "i").collect()} == pytest.approx(want, abs=1e-12)


def test_a_worker_reads_a_model_once(data, tmp_path):
    log = tmp_path / "loads"

    class Noted:
        def __setstate__(self, state):
            self.__dict__ = state
            with open(self.log, "a") as f:
                f.write(f"{os.getpid()}\n")

        def predict(self, x):
            return (np.asarray(x)[:, 0] > 0).astype(float)

    model = Noted()
    model.log = str(log)
    rows = data.repartition(16)
    for _ in range(2):  # tasks of the second job find the model in their worker
        got = ExternalScorer(model).score(rows).agg(F.sum("probability")).first()[0]
    assert 0 < got < 300
    loads = log.read_text().split()
    assert loads and len(loads) == len(set(loads)) < 32
