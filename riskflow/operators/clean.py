"""Projections: personal data, keys, feature selection, labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from riskflow.contract import CONTRACT, Contract
from riskflow.functions.probability import label_number


def redact_pii(df: DataFrame, contract: Contract = CONTRACT) -> DataFrame:
    """Drop personal columns; nothing happens where they are absent."""
    return df.drop(*contract.pii)


def clean_key(df: DataFrame, key: str = CONTRACT.customer_id) -> DataFrame:
    """Key as trimmed text. NULL stays NULL and so never matches anything."""
    return df.withColumn(key, F.trim(F.col(key).cast("string")))


def select_features(df: DataFrame, contract: Contract = CONTRACT) -> DataFrame:
    """Model inputs only, in contract order; ids, target and extras are dropped."""
    return df.select(*contract.model_numeric, *contract.categorical)


def with_label(df: DataFrame, name: str = "label", contract: Contract = CONTRACT,
               unmapped: str = "error") -> DataFrame:
    """Add the numeric target; an already numeric target passes through."""
    col = F.col(contract.target)
    if isinstance(df.schema[contract.target].dataType, T.NumericType):
        return df.withColumn(name, col.cast("int"))
    return df.withColumn(name, label_number(col, contract, unmapped))
