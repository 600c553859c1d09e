"""Tables laid out by their join key, so that repeated joins don't shuffle them.

Fact and dimension are written once, in buckets of the key and a salt: rows of hot keys and rows without a key are dealt into
pieces as in ``lookup_join``, and a hot key's dimension rows are copied to each piece. Joins then meet bucket by bucket. The
bucketing is known to the session's catalog, so a metastore keeps it; the files alone are plain Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskflow.operators.lookup import HOT_SHARE, hot_keys, salted

BUCKETS = 64


def write_colocated(fact: DataFrame, dim: DataFrame, key: str, name: str, out: str, buckets: int = BUCKETS, share: float = HOT_SHARE) -> None:
    """Write both tables under ``out`` as ``<name>_fact`` and ``<name>_dim``; a bucket is one sorted file.

    The dimension's keys must be unique; its rows without a key match nothing and aren't written.
    """
    parts = salted(fact, dim.where(F.col(key).isNotNull()), key, hot_keys(fact, key, share))
    for part, rows in zip(("fact", "dim"), parts):
        (rows.repartition(buckets, key, "_salt").write.mode("overwrite").bucketBy(buckets, key, "_salt").sortBy(key, "_salt")
         .option("path", f"{out.rstrip('/')}/{part}").saveAsTable(f"{name}_{part}"))


def join_colocated(spark: SparkSession, key: str, name: str, how: str = "left") -> DataFrame:
    """The written fact with its dimension columns (``left``), or without a partner (``left_anti``); nothing is shuffled."""
    fact, dim = spark.table(f"{name}_fact"), spark.table(f"{name}_dim")
    return fact.join(dim.hint("merge"), [key, "_salt"], how).drop("_salt")
