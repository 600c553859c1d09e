"""Joining transactions to the customer dimension.

The dimension is broadcast only after its bytes were measured. With a larger one
both sides are shuffled, and the few keys that hold a large share of the fact rows
are salted: one counting pass of the key column finds them, and the fact is then read once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F, types as T

from riskflow.contract import CONTRACT, Contract
from riskflow.functions.numeric import quoted
from riskflow.operators.clean import clean_key

BROADCAST_BYTES = 64 << 20
HOT_SHARE = 1 / 1000  # a key at or above this share of all rows is hot; at most 1000 keys can be
SALTS = 64  # pieces a hot key's rows are dealt into
FIXED = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType, T.TimestampType,
         T.TimestampNTZType, T.DayTimeIntervalType, T.YearMonthIntervalType, T.NullType)


def row_bytes(df: DataFrame) -> str:
    """SQL of the size of a row, a little above its unpacked form."""
    parts = []
    for f in df.schema:
        c = quoted(f.name)
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(f"coalesce(octet_length({c}), 0) + 16")
        elif isinstance(f.dataType, T.VariantType):
            parts.append(f"coalesce(octet_length(to_json({c})), 0) + 16")
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            parts.append(f"octet_length(to_json(struct({c}))) + 16")
        elif isinstance(f.dataType, T.DecimalType):
            parts.append("32")
        elif isinstance(f.dataType, FIXED):
            parts.append("8")
        else:
            raise TypeError(f"the size of {f.name} ({f.dataType.simpleString()}) can't be measured")
    return f"bigint({' + '.join(parts) or '0'})"


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows of a frame, from one shuffle-free aggregate."""
    return df.agg(F.expr(f"coalesce(sum({row_bytes(df)}), 0)")).first()[0]


def hot_keys(fact: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Keys holding at least ``share`` of the rows: at most ``1/share`` values."""
    # the total is one more group of the same pass, and the largest; a key that is NULL may be among the others
    counts = fact.select(key).rollup(key).agg(F.count(F.lit(1)).alias("n"), F.grouping(key).alias("whole"))
    top = counts.orderBy(F.desc("n"), F.desc("whole")).limit(int(1 / share) + 2).collect()
    total = next((r["n"] for r in top if r["whole"]), 0)
    return [r[0] for r in top if not r["whole"] and r[0] is not None and r["n"] >= max(2, total * share)]


def lookup_join(fact: DataFrame, dim: DataFrame, key: str, broadcast_bytes: int = BROADCAST_BYTES,
                share: float = HOT_SHARE, dim_bytes: int | None = None) -> DataFrame:
    """Left join to a dimension whose keys are unique.

    ``dim_bytes`` is the size of the dimension where the caller has measured it.
    """
    if (measured_bytes(dim) if dim_bytes is None else dim_bytes) <= broadcast_bytes:
        return fact.join(F.broadcast(dim), key, "left")
    if fact.isStreaming:  # a micro-batch cannot be counted ahead; AQE splits its skewed partitions
        return fact.join(dim, key, "left")
    left, right = salted(fact, dim, key, hot_keys(fact, key, share))
    return left.join(right, [key, "_salt"], "left").drop("_salt")


def salted(fact: DataFrame, dim: DataFrame, key: str, hot: list) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_salt``, for a join over it and the key that spreads the rows of hot keys."""
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    # rows of hot keys, and those without a key, are dealt into pieces; a hot key has one dimension row, copied to each piece
    piece = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
    left = fact.withColumn("_salt", F.when(F.col(key).isNull() | is_hot, piece).otherwise(0))
    pieces = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return left, dim.withColumn("_salt", F.explode(pieces))


def duplicate_keys(dim: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    return dim.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def checked_bytes(fact: DataFrame, dim: DataFrame, key: str) -> int:
    """Size of the dimension; raises where the join would multiply fact rows.

    One aggregate over the dimension answers both, without running the join. Only if a
    key is repeated are the fact keys looked at, for one that refers to it.
    """
    per_key = dim.groupBy(key).agg(F.expr("count(1) as n"), F.expr(f"sum({row_bytes(dim)}) as b"))
    most, size = per_key.agg(F.expr(f"max(if({quoted(key)} is null, 1, n))"), F.expr("coalesce(sum(b), 0)")).first()
    if (most or 0) > 1:
        hit = fact.select(key).join(duplicate_keys(dim, key).select(key), key, "left_semi").limit(1).collect()
        if hit:
            raise ValueError(f"join integrity: dimension key {hit[0][0]!r} occurs more than once")
    return size


def first_per_key(dim: DataFrame, key: str, order_by: list[str] | None = None) -> DataFrame:
    """One row per key: the first in the given order, by default that of the other columns.

    The row-number filter becomes a group limit before the shuffle, so a key with
    very many copies leaves each task as a single row.
    """
    order = order_by or [c for c in dim.columns if c != key] or [key]
    w = Window.partitionBy(key).orderBy(*order)
    return (
        dim.where(F.col(key).isNotNull())
        .withColumn("_first", F.row_number().over(w)).where("_first = 1").drop("_first")
    )


def enrich_strict(txn: DataFrame, cust: DataFrame, contract: Contract = CONTRACT, suffix: str = "_cust",
                  broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Left join for preparation; a dimension that would multiply rows is an error."""
    key = contract.customer_id
    size = checked_bytes(txn, cust, key)
    clash = [c for c in cust.columns if c in txn.columns and c != key]
    # a NULL key cannot match, and repeated keys that no transaction refers to play no part either
    dim = cust.withColumnsRenamed({c: c + suffix for c in clash}).where(F.col(key).isNotNull())
    return lookup_join(txn, dim, key, broadcast_bytes, dim_bytes=size)


def enrich_lookup(df: DataFrame, cust: DataFrame | None, contract: Contract = CONTRACT,
                  order_by: list[str] | None = None, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Attach missing customer columns when scoring.

    Nothing is joined where there is no dimension, no key, or nothing missing.
    Columns the input already has are kept and only their gaps are filled.
    """
    key = contract.customer_id
    absent = [c for c in contract.customer_features if c not in df.columns]
    if cust is None or key not in df.columns or not absent:
        return df
    given = [c for c in contract.customer_features if c in df.columns and c in cust.columns]
    offered = [c for c in contract.customer_features if c in cust.columns]
    extra = [c for c in order_by or [] if c not in (key, *offered)]
    dim = first_per_key(clean_key(cust, key).select(key, *offered, *extra), key, order_by)
    dim = dim.select(key, *offered).withColumnsRenamed({c: f"_lookup_{c}" for c in given})
    out = lookup_join(clean_key(df, key), dim, key, broadcast_bytes,
                      dim_bytes=measured_bytes(cust.select(key, *offered)))
    filled = {c: F.coalesce(F.col(c), F.col(f"_lookup_{c}")) for c in given}
    return out.withColumns(filled).drop(*[f"_lookup_{c}" for c in given]) if given else out


def match_rate(txn: DataFrame, cust: DataFrame, contract: Contract = CONTRACT,
               broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Share of transactions that found a customer, in percent.

    ``match_rate`` counts matched rows; ``proxy_rate`` counts non-null account types,
    which also misses matched customers without one.
    """
    key = contract.customer_id
    source = cust.select(key, "Account_Type")
    dim = first_per_key(source, key).withColumn("_matched", F.lit(1))
    joined = lookup_join(txn.select(key), dim, key, broadcast_bytes, dim_bytes=measured_bytes(source))
    return joined.agg(
        F.count(F.lit(1)).alias("total"),
        F.count("_matched").alias("matched"),
        (F.avg(F.coalesce("_matched", F.lit(0))) * 100).alias("match_rate"),
        (F.avg(F.col("Account_Type").isNotNull().cast("int")) * 100).alias("proxy_rate"),
    )


def orphans(txn: DataFrame, cust: DataFrame, contract: Contract = CONTRACT,
            broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Transactions without a customer."""
    key = contract.customer_id
    source = cust.select(key)
    dim = source.where(F.col(key).isNotNull()).distinct().withColumn("_matched", F.lit(1))
    return lookup_join(txn, dim, key, broadcast_bytes, dim_bytes=measured_bytes(source)).where(F.col("_matched").isNull()).drop("_matched")
