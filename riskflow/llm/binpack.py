"""Sharding by vector bin packing: bytes, tokens and rows balanced jointly, equal texts kept together.

Each group of equal texts is a vector (bytes, tokens, rows) of shares of the whole. Vectors go, large ones first, to the
shard where the dot product with the shard's residual capacity is highest. Groups beyond 1/512 of the whole in any
measure (so at most 3 * 512 of them) are placed one by one. All others travel in cells: a hash of the text puts a group
on a level, eight times fewer groups on each further one, and into one of a level's cells. The cells of the last levels
hold next to nothing, so what they even out stays even. So the number of vectors is bounded, whatever the rows, and no row meets
the driver. A group beyond half a shard's capacity can't stay whole in any balanced result: it is split by doc_id.

Null texts are as empty ones, of no bytes and no tokens. Repeated rows are one group; each gets a slot of its own. Null
ids are kept. An empty table gives no rows. Other columns of the input are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.tables import numbered, stored

SHARDS, CELLS, LEVELS = 8, 1024, 7
#: Groups above this share are placed on their own; pieces of split groups have about this share.
LARGE = 1 / 512
#: Weights of bytes, tokens and rows in the dot product; the first is the law's.
WEIGHTS = (4.0, 1.0, 1.0)


def profile(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One written row per document without its text: doc_id, size, tokens, text_crc32, key (a digest of the text)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    # Words: places where a space-separated run begins.
    tokens = F.length(F.regexp_replace(F.concat(F.lit(" "), text), r"[\x20\x09-\x0D]+(?:[^\x20\x09-\x0D]+|$)", "w")) - \
        F.when(text.rlike(r"[\x20\x09-\x0D]\z") | (text == ""), 1).otherwise(0)
    return stored(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), tokens.cast("long").alias("tokens"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.sha2(F.encode(text, "UTF-8"), 256).alias("key")), "sizes")


def _cell(key: Column, levels: int, cells: int) -> Column:
    """The cell of a digest: level by leading octal zeros of 33 of its bits, place by 24 others."""
    head, tail = F.conv(F.substring(key, 1, 8), 16, 10).cast("long"), F.conv(F.substring(key, 9, 6), 16, 10).cast("long")
    level = sum((head < 2 ** (32 - 3 * i)).cast("int") for i in range(1, levels))
    return (level * cells + F.pmod(tail, F.lit(cells))).cast("long")


def place(vectors: dict[int, tuple[float, ...]], shards: int, weights: tuple[float, ...]) -> dict[int, int]:
    """unit -> shard; ``vectors`` are shares of the whole. Ties: the lower shard, the lower unit first."""
    residual = [[1 / shards] * len(weights) for _ in range(shards)]
    out = {}
    for unit, vector in sorted(vectors.items(), key=lambda x: (-max(x[1]), x[0])):
        heavy = [v * w for v, w in zip(vector, weights)]
        best = max(range(shards), key=lambda s: (sum(h * r for h, r in zip(heavy, residual[s])), -s))
        out[unit] = best
        residual[best] = [r - v for r, v in zip(residual[best], vector)]
    return out


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shards: int = SHARDS, cells: int = CELLS, levels: int = LEVELS,
          large: float = LARGE, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """doc_id, size, tokens, text_crc32, law (``bytes``), shard, slot, grown_shard (null: the law isn't ``key``)."""
    spark, rows = docs.sparkSession, profile(docs, id_col, text_col)
    totals = rows.agg(F.sum("size"), F.sum("tokens"), F.count(F.lit(1))).first()
    whole = [max(1, x or 0) for x in totals]
    sums = (F.sum("size").alias("a"), F.sum("tokens").alias("b"), F.count(F.lit(1)).alias("c"))
    share = F.greatest(*(F.col(c) / F.lit(float(w)) for c, w in zip("abc", whole)))
    big = rows.groupBy("key").agg(*sums).withColumn("share", share).where(F.col("share") > large).collect()  # 3 / large at most
    parts = [(r.key, i, int(r.share / large) + 1 if r.share > 0.5 / shards else 1) for i, r in enumerate(sorted(big, key=lambda r: r.key))]
    listed = spark.createDataFrame(parts, "big_key string, number long, pieces long")
    step = int(1 / large) + 2
    piece = F.pmod(F.xxhash64("doc_id"), F.col("pieces"))
    unit = F.when(F.col("number").isNull(), _cell(F.col("key"), levels, cells)).otherwise(levels * cells + F.col("number") * step + piece)
    dealt = rows.join(F.broadcast(listed), F.col("key") == F.col("big_key"), "left").withColumn("unit", unit)
    vectors = {r.unit: tuple(x / w for x, w in zip((r.a, r.b, r.c), whole)) for r in dealt.groupBy("unit").agg(*sums).collect()}  # cells and pieces
    placed = spark.createDataFrame(list(place(vectors, shards, weights).items()), "placed_unit long, shard int")
    out = dealt.join(F.broadcast(placed), F.col("unit") == F.col("placed_unit")).select("doc_id", "size", "tokens", "text_crc32", "shard")
    return numbered(out, ["shard"], ["doc_id", "text_crc32"], "slot", totals[2]).select(
        "doc_id", "size", "tokens", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
