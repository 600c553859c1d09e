"""From probability to decision rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskflow.contract import CONTRACT, DEFAULT_MODEL_VERSION, REVIEW_THRESHOLD, Contract
from riskflow.functions.probability import known, recommended_action, review_flag, risk_tier

# --- fixed values: the decision columns, in output order ---
DECISION_COLUMNS = ("Predicted_Risk_Flag", "Risk_Probability", "Risk_Tier", "Operational_Action",
                    "Model_Version", "Scored_At")
# --- end of fixed values ---


def decide(scored: DataFrame, probability: str = "probability", threshold: float = REVIEW_THRESHOLD,
           version: str = DEFAULT_MODEL_VERSION) -> DataFrame:
    """Replace the probability by the decision columns.

    Flag and tier look at the unrounded probability; without one (NULL or NaN) nothing is decided and
    those columns are NULL. ``Scored_At`` is one UTC time per query.
    """
    p = F.col(probability)
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return scored.withColumns(dict(zip(DECISION_COLUMNS, (
        review_flag(p, threshold), F.bround(F.when(known(p), p), 4), risk_tier(p), recommended_action(p), F.lit(version),
        F.concat(F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00")),
    )))).drop(probability)


def response(decided: DataFrame, contract: Contract = CONTRACT) -> DataFrame:
    """The eight columns a caller gets back."""
    return decided.select(*contract.ids, *DECISION_COLUMNS)


def tier_mix(decided: DataFrame, amount: str = "Amount_NGN") -> DataFrame:
    """Rows and amounts per tier."""
    return decided.groupBy("Risk_Tier").agg(
        F.count(F.lit(1)).alias("n"), F.sum(amount).alias("amount"), F.avg("Risk_Probability").alias("mean_probability"))
