"""Training: gate, features fitted on train rows, two models, one governance record."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from riskflow.artifacts import publish
from riskflow.contract import CONTRACT, REVIEW_THRESHOLD, Contract
from riskflow.models.scorers import MlScorer, write_json
from riskflow.models.training import RF_DEPTH, RF_TREES, model_card, spread, train_forest, train_logistic
from riskflow.operators.clean import with_label
from riskflow.operators.evaluate import metrics
from riskflow.operators.features import FeaturePreparer
from riskflow.operators.quality import REJECT
from riskflow.plans.validate import validate
from riskflow.session import kept, remove, scratch_path, split_methods
from riskflow.sinks import write_table


@dataclass
class Trained:
    """What training gives: both models, the fitted features, and the records."""

    model: MlScorer
    baseline: MlScorer
    features: FeaturePreparer
    metrics: dict
    baseline_metrics: dict
    card: dict
    importances: dict[str, float]


def _record(scored: DataFrame, threshold: float) -> dict:
    """Metrics of one model."""
    return metrics(scored.select("label", "probability"), threshold=threshold).first().asDict(True)


def run_training(train: DataFrame, test: DataFrame, out: str | None = None, contract: Contract = CONTRACT,
                 trees: int = RF_TREES, depth: int = RF_DEPTH, threshold: float = REVIEW_THRESHOLD, versioned: bool = False) -> Trained:
    """Train and compare both models on prepared parts; save everything under ``out``.

    ``versioned``: as a new version there, which readers see when it is whole; else in place, over what there is.
    """
    spark = train.sparkSession
    for name, part in (("train", train), ("test", test)):
        # lenient: bad values are reported, a table that cannot be used stops the job
        found = validate(part, contract, "enriched", training=True, strict=False)
        if found["action_taken"] == REJECT:
            raise RuntimeError(f"validation rejected the {name} table: {found['errors'][0]['message']}")
    with split_methods(spark):
        features = FeaturePreparer(contract).fit(train)

    # every pass of both solvers reads these vectors: a written table spares them the features
    # and does not go with a lost executor
    path = scratch_path(spark, "vectors")
    try:
        with split_methods(spark):
            for name, part in (("train", train), ("test", test)):
                labelled = with_label(features.transform(part), "label", contract, unmapped="zero")
                write_table(labelled.select("label", "features"), f"{path}/{name}")
        train_x, test_x = (spark.read.parquet(f"{path}/{name}") for name in ("train", "test"))
        with kept(spread(train_x)):  # both solvers find the same dealt rows
            baseline = train_logistic(train_x, threshold=threshold)
            model = train_forest(train_x, trees=trees, depth=depth, threshold=threshold)
        baseline_metrics, found = (_record(m.score(test_x), threshold) for m in (baseline, model))
        names = features.params.names()
        card = model_card(found, baseline_metrics, train_x.count(), test_x.count(), len(names), threshold)
    finally:
        remove(spark, path)
    model.metadata = card
    if out:
        save_training(spark, out, model, features, found, versioned)
    return Trained(model, baseline, features, found, baseline_metrics, card, model.importances(names))


def save_training(spark: SparkSession, out: str, model: MlScorer, features: FeaturePreparer, found: dict, versioned: bool = False) -> str:
    """Features, model and metrics; gives the folder they are in."""
    parts = {"features": lambda path: features.save(spark, path), "classifier": model.save, "metrics": lambda path: write_json(spark, path, found)}
    if versioned:
        return publish(spark, out, parts, {"model_version": model.metadata.get("version")})
    for name, write in parts.items():
        write(f"{out}/{name}")
    return out
