"""Turning model output into probabilities, decisions and labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from riskflow.contract import CONTRACT, HIGH_THRESHOLD, MEDIUM_THRESHOLD, REVIEW_THRESHOLD, Contract


def sigmoid(margin: Column) -> Column:
    """Probability of a margin-only model."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def hard_label_probability(label: Column) -> Column:
    """Probability of a model that only gives labels."""
    return label.cast("double")


def at_threshold(probability: Column, threshold: float = REVIEW_THRESHOLD) -> Column:
    """0/1 prediction; NULL without a probability."""
    return F.when(known(probability), (probability >= F.lit(threshold)).cast("int"))


def known(probability: Column) -> Column:
    """Whether there is a probability to decide on: neither NULL nor NaN."""
    return probability.isNotNull() & ~F.isnan(probability)


def review_flag(probability: Column, threshold: float = REVIEW_THRESHOLD) -> Column:
    return F.when(known(probability), F.when(probability >= F.lit(threshold), "Yes").otherwise("No"))


def risk_tier(probability: Column) -> Column:
    """Tier from the unrounded probability; independent of the review threshold."""
    return F.when(known(probability), F.when(probability >= F.lit(HIGH_THRESHOLD), "High")
                  .when(probability >= F.lit(MEDIUM_THRESHOLD), "Medium").otherwise("Low"))


def recommended_action(probability: Column) -> Column:
    return F.when(known(probability), F.when(probability >= F.lit(HIGH_THRESHOLD), "Immediate Review / Payment Hold")
                  .when(probability >= F.lit(MEDIUM_THRESHOLD), "Secondary Verification (SMS/OTP)")
                  .otherwise("Auto-Approve"))


def label_number(col: Column, contract: Contract = CONTRACT, unmapped: str = "error") -> Column:
    """Target text as 1/0. Other values fail the job, or count as 0 when ``unmapped='zero'``."""
    if unmapped not in ("error", "zero"):
        raise ValueError("unmapped must be 'error' or 'zero'")
    if unmapped == "zero":
        return F.when(col == contract.positive, 1).otherwise(0)
    shown = F.coalesce(col.cast("string"), F.lit("NULL"))
    return (
        F.when(col == contract.positive, 1)
        .when(col == contract.negative, 0)
        .otherwise(F.raise_error(F.concat(F.lit("unmapped target value: "), shown)).cast("int"))
    )
