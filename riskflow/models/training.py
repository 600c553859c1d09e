"""The two classifiers, with balanced class weights."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from riskflow.contract import REVIEW_THRESHOLD, SEED
from riskflow.models.scorers import MlScorer
from riskflow.operators.evaluate import class_weights
from riskflow.session import kept

# --- fixed values: hyperparameters and model descriptions ---
LR_ITERATIONS = 1000
RF_TREES = 100
RF_DEPTH = 12
BASELINE_NAME = "LogisticRegression"
PRODUCTION_FAMILY = "RandomForestClassifier"
DATASET_VERSION = "enriched_v1_customer_joined"
PRODUCTION_VERSION = "2.0.0-week3"
# --- end of fixed values ---

PARTITIONS, PARTITION_ROWS = 16, 500_000


def weighted(train: DataFrame, label: str = "label") -> tuple[DataFrame, int]:
    """Add the balanced class weight; also the number of rows."""
    rows = class_weights(train, label).collect()  # one row per class
    weight = F.lit(None).cast("double")
    for r in rows:
        weight = F.when(F.col(label) == r[label], F.lit(float(r["weight"]))).otherwise(weight)
    return train.withColumn("weight", weight), sum(r["n"] for r in rows)


def spread(train: DataFrame, label: str = "label", partitions: int | None = None) -> DataFrame:
    """Deal rows by a hash of their features, in its order, into as many partitions as the rows call for.

    Bagging draws by partition and place, so a model must depend on the data alone, not on cores or files. A solver reads
    the dealt rows several times before its own passes, so they are kept while it runs (``kept``).
    """
    n = partitions or max(PARTITIONS, -(-train.count() // PARTITION_ROWS))
    keyed = train.withColumn("_hash", F.xxhash64(vector_to_array("features"), F.col(label)))
    return keyed.repartition(n, "_hash").sortWithinPartitions("_hash").drop("_hash")


def train_logistic(train: DataFrame, label: str = "label", iterations: int = LR_ITERATIONS,
                   threshold: float = REVIEW_THRESHOLD) -> MlScorer:
    """Logistic regression with an L2 penalty of unit strength.

    The balanced weights add up to the number of rows and Spark averages the loss,
    so a unit penalty on the summed loss is ``1/n`` here.
    """
    with kept(spread(train, label)) as dealt:
        data, n = weighted(dealt, label)
        fitted = LogisticRegression(labelCol=label, weightCol="weight", maxIter=iterations, regParam=1 / max(n, 1),
                                    elasticNetParam=0.0, standardization=False).fit(data)
    return MlScorer(fitted, threshold=threshold)


def train_forest(train: DataFrame, label: str = "label", trees: int = RF_TREES, depth: int = RF_DEPTH,
                 seed: int = SEED, threshold: float = REVIEW_THRESHOLD) -> MlScorer:
    """Random forest; a node looks at the square root of the number of features.

    A row keeps its node in each tree from level to level, so a level costs one step and not the walk from the root;
    this changes no split. These ids are not checkpointed: a lost block is made again from the vectors.
    """
    with kept(spread(train, label)) as dealt:
        data, _ = weighted(dealt, label)
        fitted = RandomForestClassifier(labelCol=label, weightCol="weight", numTrees=trees, maxDepth=depth,
                                        featureSubsetStrategy="sqrt", seed=seed, maxMemoryInMB=1024,
                                        cacheNodeIds=True, checkpointInterval=-1).fit(data)
    return MlScorer(fitted, threshold=threshold)


def model_card(candidate: dict, baseline: dict, train_rows: int, test_rows: int, features: int,
               threshold: float = REVIEW_THRESHOLD) -> dict:
    """The governance record of the candidate, compared with the baseline."""
    return {
        "model_name": "Enriched random forest risk classifier",
        "model_family": PRODUCTION_FAMILY,
        "version": PRODUCTION_VERSION,
        "author": "riskflow",
        "dataset_version": DATASET_VERSION,
        "train_samples": train_rows,
        "test_samples": test_rows,
        "features_count": features,
        "classification_threshold": threshold,
        "metrics": candidate,
        "baseline_comparison": {
            "baseline_model": BASELINE_NAME,
            "baseline_roc_auc": baseline["roc_auc"],
            "baseline_f1": baseline["f1_score"],
            "improvement_roc_auc": None if None in (candidate["roc_auc"], baseline["roc_auc"])
            else round(candidate["roc_auc"] - baseline["roc_auc"], 4),
        },
    }
