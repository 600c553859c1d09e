"""Preparation: clean, join, split, and one partitioned write."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskflow.contract import CONTRACT, SEED, TEST_FRACTION, Contract
from riskflow.operators.clean import clean_key, redact_pii, with_label
from riskflow.operators.lookup import enrich_strict
from riskflow.operators.split import stratified_split
from riskflow.sinks import write_table
from riskflow.sources.tables import read_any


def enriched(txn: DataFrame, cust: DataFrame, contract: Contract = CONTRACT) -> DataFrame:
    """Transactions with their customer columns, without personal data."""
    key = contract.customer_id
    return enrich_strict(clean_key(txn, key), clean_key(redact_pii(cust, contract), key), contract)


def prepared(txn: DataFrame, cust: DataFrame, contract: Contract = CONTRACT,
             fraction: float = TEST_FRACTION, seed: int = SEED) -> DataFrame:
    """The enriched table with its ``split``.

    The cut is found on the table before the join. A target outside the mapping fails.
    """
    df = enriched(txn, cust, contract)
    if contract.target not in txn.columns:
        return stratified_split(df, contract.target)
    out = stratified_split(with_label(df, "_class", contract), "_class", contract.transaction_id, fraction, seed,
                           narrow=with_label(txn, "_class", contract))
    return out.drop("_class")


def summary(split: DataFrame) -> DataFrame:
    """Row counts of the whole table and of its parts."""
    return split.agg(
        F.count(F.lit(1)).alias("total_enriched_records"),
        F.count_if(F.col("split") == "train").alias("train_records"),
        F.count_if(F.col("split") == "test").alias("test_records"),
    )


@dataclass(frozen=True)
class Prepared:
    """Where preparation wrote what, and how much."""

    total_enriched_records: int
    train_records: int
    test_records: int
    columns: list[str]
    enriched_path: str
    customers_path: str


def run_prepare(txn: DataFrame, cust: DataFrame, out: str, contract: Contract = CONTRACT,
                fraction: float = TEST_FRACTION, seed: int = SEED, fmt: str = "parquet") -> Prepared:
    """Write the cleaned customers and the enriched table, partitioned by ``split``.

    The two parts are partitions of the one enriched table, so every row is written once.
    """
    spark = txn.sparkSession
    customers = write_table(clean_key(redact_pii(cust, contract), contract.customer_id), f"{out}/customers", fmt)
    df = prepared(txn, cust, contract, fraction, seed)
    path = write_table(df, f"{out}/enriched", fmt, ("split",))
    row = summary(_read(spark, path, fmt).select("split")).first()
    return Prepared(row[0], row[1], row[2], [c for c in df.columns if c != "split"], path, customers)


def _read(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    reader = spark.read.format(fmt)
    return (reader.option("header", True) if fmt == "csv" else reader).load(path)


def load_parts(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; only the partition asked for is read."""
    df = read_any(spark, path)
    return tuple(df.where(F.col("split") == part).drop("split") for part in ("train", "test"))


def load_or_prepare(spark: SparkSession, out: str, raw=None, contract: Contract = CONTRACT) -> tuple[DataFrame, DataFrame]:
    """The prepared parts; where they are missing, ``raw()`` gives the two raw tables first."""
    from riskflow.models.scorers import path_exists

    if not path_exists(spark, f"{out}/enriched"):
        if raw is None:
            raise FileNotFoundError(f"no prepared table at {out}")
        run_prepare(*raw(), out, contract)
    return load_parts(spark, f"{out}/enriched")
