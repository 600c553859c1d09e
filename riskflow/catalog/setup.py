"""Shared inputs of the registered queries: views, frozen statistics, fixed linear models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskflow.contract import CONTRACT, DOMAINS, MISSING_LEVEL
from riskflow.functions.time import time_to_serial
from riskflow.models.scorers import LinearScorer
from riskflow.operators.clean import with_label
from riskflow.operators.features import FeatureParams
from riskflow.operators.lookup import enrich_lookup
from riskflow.plans.prepare import enriched, prepared
from riskflow.plans.score import ScoringJob, with_features
from riskflow.sources import testviews as views

# Statistics as a scoring job would load them; the queries and the SQL twins share them.
FROZEN = FeatureParams(
    median={"Amount_NGN": 35000.0, "Age": 48.0, "Tenure_Months": 59.0, "Digital_Engagement_Score": 49.0,
            "Transaction_Hour": 12.0, "Transaction_DayOfWeek": 3.0, "Is_Weekend": 0.0},
    mean={"Amount_NGN": 50000.0, "Age": 48.5, "Tenure_Months": 59.5, "Digital_Engagement_Score": 50.0,
          "Transaction_Hour": 11.5, "Transaction_DayOfWeek": 2.75, "Is_Weekend": 0.25},
    scale={"Amount_NGN": 50000.0, "Age": 18.0, "Tenure_Months": 34.5, "Digital_Engagement_Score": 28.5,
           "Transaction_Hour": 7.0, "Transaction_DayOfWeek": 2.0, "Is_Weekend": 0.45},
    levels={c: sorted(DOMAINS[c] + ((MISSING_LEVEL,) if c in ("Device_Type", "Location") else ()))
            for c in CONTRACT.categorical},
)
INTERCEPT = -0.8
WEIGHTS = {"Amount_NGN": 1.1, "Age": 0.1, "Tenure_Months": -0.05, "Digital_Engagement_Score": -0.2,
           "Transaction_Hour": -0.15, "Transaction_DayOfWeek": 0.05, "Is_Weekend": 0.2}
ABROAD = 0.6
BASELINE_WEIGHTS = {"Amount_NGN": 0.5, "Transaction_Hour": 0.3}


def linear(weights: dict[str, float] = WEIGHTS) -> LinearScorer:
    terms = {f"_num_{c}": w for c, w in weights.items()}
    terms["cast(coalesce(International_Transaction = 'Yes', false) as double)"] = ABROAD
    return LinearScorer(INTERCEPT, terms, {"model_family": "LinearScorer", "version": "2.0.0-week3"})


def clean_enriched(spark: SparkSession, sf: str) -> DataFrame:
    return enriched(views.transactions(spark, sf), views.customers(spark, sf))


def split_table(spark: SparkSession, sf: str) -> DataFrame:
    return prepared(views.transactions(spark, sf), views.customers(spark, sf))


def part(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return split_table(spark, sf).where(F.col("split") == name).drop("split")


def dirty_enriched(spark: SparkSession, sf: str) -> DataFrame:
    return enrich_lookup(views.dirty_transactions(spark, sf), views.dirty_customers(spark, sf), order_by=["_seq"])


def linear_scored(spark: SparkSession, sf: str, weights: dict[str, float] = WEIGHTS) -> DataFrame:
    """Clean enriched rows with the label and the linear probability."""
    df = with_label(clean_enriched(spark, sf))
    return linear(weights).score(with_features(df, FROZEN, linear(weights)))


def scoring_job(spark: SparkSession, sf: str) -> ScoringJob:
    return ScoringJob(FROZEN, linear(), views.dirty_customers(spark, sf), mode="quarantine", customer_order=["_seq"])


# Request payloads, made from the events: some fields left out, some null, some wrong.
REQUEST = ["Transaction_ID", "Customer_ID", "Transaction_DateTime", "Transaction_Type", "Amount_NGN", "Channel",
           "Device_Type", "Location", "International_Transaction", "Transaction_Status"]
OPTIONAL = REQUEST[6:]


def as_payloads(txn: DataFrame) -> DataFrame:
    """``_row`` and ``payload`` of transactions that carry ``_row``; works on a stream too."""
    r = F.col("_row")
    src = txn.withColumns({
        "Transaction_DateTime": time_to_serial("Transaction_DateTime"),
        "Amount_NGN": F.when(r % 97 == 0, -F.col("Amount_NGN")).otherwise(F.col("Amount_NGN")),
        "Transaction_ID": F.when(r % 107 == 0, F.lit(None)).otherwise(F.col("Transaction_ID")),
        "International_Transaction": F.when(r % 109 == 0, F.lit(None)).otherwise(F.col("International_Transaction")),
    })
    keep_null = {"ignoreNullFields": "false"}
    whole = F.to_json(F.struct(*REQUEST), keep_null)
    short = F.to_json(F.struct(*REQUEST[:6]), keep_null)
    payload = F.when(r % 7 == 0, short).otherwise(whole)
    worded = F.regexp_replace(payload, '"Amount_NGN":[^,]+', '"Amount_NGN":"fifty"')
    payload = F.when(r % 103 == 0, worded).otherwise(payload)
    return src.select("_row", F.when(r % 127 == 0, F.substring(payload, 1, 20)).otherwise(payload).alias("payload"))


def payloads(spark: SparkSession, sf: str) -> DataFrame:
    return as_payloads(views.transactions(spark, sf, row=True))
