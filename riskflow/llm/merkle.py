"""Merkle manifest of a dataset by lag and lead windows.

Every row is a leaf: the digest of its columns. The leaves of a group stand in the order of their ids and are joined run by
run, ``ARITY`` neighbours to a parent, until one is left (the subroot); the subroots of all groups, in the order of the groups,
are joined likewise to the root.

A level is one window: the siblings of a node lie at fixed offsets, ``ARITY ** level`` rows and twice that to either side,
and are masked by the node's slot in its run and by the length of the run; the row of a run's first child hashes the parent.
Rows of a block of ``ARITY ** LEVELS`` positions share a window, so a group of any size is many small windows and one
shuffle serves all levels of a round. The next round has one row for each block; log(rows) / log(729) rounds end at the subroots.

Positions come from a range partitioning by (group, id, digest) and the counts of its ranges; rows that are alike in all columns
are spread by their place in the input, as it doesn't matter which is which. On the way down a node's siblings reach the leaves
below it by a running ``last`` within the block, and those of higher rounds by a join on (group, block).

Nulls: a null column counts as ``-`` in the digest, a null group is a group of its own and comes first, null ids come first in
their group. Empty texts are values of no bytes. Repeated rows are leaves of their own. An empty table has no leaves and a null
root. Other columns of the input are left alone, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm.tables import stored

#: Children of a node, and levels that one round joins within a block.
ARITY, LEVELS = 3, 6
STEPS = "array<struct<left:string,right:string>>"
_PART = 33  # monotonically_increasing_id keeps the partition above these bits


def digest(*parts: Column) -> Column:
    """Bare lower-case hex SHA-256 of the parts in a row, in UTF-8."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value as it enters a leaf: its length in bytes, a colon and itself; null is a dash."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf leads to by the siblings of its path."""
    return F.aggregate(path, leaf, lambda node, step: digest(step["left"], node, step["right"]))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level from the leaf, left to right."""
    return digest(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""))


@dataclass
class Manifest:
    """``proofs``: per row the kept columns, ``leaf``, ``subroot`` and ``path``; ``subroots``: per group; ``root``: null of no rows."""

    proofs: DataFrame
    subroots: DataFrame
    root: str | None


def _positions(units: DataFrame, order: list[str]) -> DataFrame:
    """Add ``pos`` (0, 1 ... within each ``key`` by ``order``) and ``n``, the rows of the key."""
    table = units.withColumn("tie", F.monotonically_increasing_id())
    ranged = table.repartitionByRange("key", *order, "tie").sortWithinPartitions("key", *order, "tie").drop("tie")
    placed = stored(ranged.withColumn("place", F.monotonically_increasing_id()), "merkle_places")
    part = F.shiftright("place", _PART)
    counts = placed.groupBy("key", part.alias("part")).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows"))
    own = Window.partitionBy("key")
    before = own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("key", "part", "first", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"), F.sum("rows").over(own).alias("n"))
    return placed.withColumn("part", part).join(starts, ["key", "part"]).withColumn("pos", F.col("before") + F.col("place") - F.col("first")).drop("part", "place", "first", "before")


def _joined(units: DataFrame) -> DataFrame:
    """One round: add ``block``, for each level the siblings at the rows of its nodes, and ``top`` at each block's first row."""
    pos, n = F.col("pos"), F.col("n")
    window = Window.partitionBy("key", "block").orderBy("pos")
    found = units.withColumn("block", F.expr(f"pos div {ARITY ** LEVELS}")).withColumn("top", F.col("digest"))
    for level in range(LEVELS):
        offset = ARITY ** level
        near = {f"{side.__name__}{i}": side("top", i * offset).over(window) for side in (F.lag, F.lead) for i in range(1, ARITY)}
        found = found.withColumns(near)
        nodes, index = F.expr(f"(n + {offset - 1}) div {offset}"), F.expr(f"pos div {offset}")
        slot = index % ARITY
        length = F.least(F.lit(ARITY), nodes - (index - slot))
        is_node, joins = pos % offset == 0, nodes > 1
        left = F.concat(*(F.when(slot >= i, F.col(f"lag{i}")).otherwise("") for i in range(ARITY - 1, 0, -1)))
        right = F.concat(*(F.when(slot + i < length, F.col(f"lead{i}")).otherwise("") for i in range(1, ARITY)))
        step = F.when(is_node & joins, F.struct(left.alias("left"), right.alias("right")))
        found = found.withColumn(f"step{level}", step)
        parent = F.when(~is_node, F.lit(None)).when(~joins, F.col("top")).when(slot == 0, digest(F.col("top"), F.col(f"step{level}.right")))
        found = found.withColumn("top", parent).drop(*near)
    return found


def _grow(units: DataFrame) -> list[DataFrame]:
    """Rounds of one forest: ``key, pos, n, digest`` and further columns as units; each round's tops are the next one's units."""
    rounds = []
    largest = units.agg(F.max("n")).head()[0] or 0
    while not rounds or largest > 1:
        rounds.append(stored(_joined(units), "merkle_nodes"))
        units = _tops(rounds[-1]).where("n > 1")
        largest = -(-largest // ARITY ** LEVELS)
    return rounds


def _tops(nodes: DataFrame) -> DataFrame:
    size = ARITY ** LEVELS
    return nodes.where(F.col("pos") % size == 0).select("key", F.col("block").alias("pos"), F.expr(f"(n + {size - 1}) div {size}").alias("n"), F.col("top").alias("digest"))


def _ends(rounds: list[DataFrame]) -> DataFrame:
    """The one node that is left of each key: ``key, digest``."""
    found = None
    for nodes in rounds:
        done = _tops(nodes).where("n = 1").select("key", "digest")
        found = done if found is None else found.union(done)
    return found


def _paths(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """The first round's units with ``path``, all steps up to the end of ``above`` (``key, subroot, path`` of each key's end)."""
    above = above.withColumnRenamed("key", "of").withColumnRenamed("path", "rest")
    lower = None
    for nodes in reversed(rounds):
        ends = _tops(nodes).where("n = 1").join(above, F.col("key") == F.col("of")).select("key", F.col("pos").alias("block"), "subroot", "rest")
        if lower is not None:
            ends = ends.union(lower.select("key", F.col("pos").alias("block"), "subroot", F.col("path").alias("rest")))
        running = Window.partitionBy("key", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
        steps = [f"step{i}" for i in range(LEVELS)]
        down = nodes.join(ends, ["key", "block"]).withColumns({s: F.last(s, ignorenulls=True).over(running) for s in steps})
        path = F.concat(F.filter(F.array(*steps), lambda step: step.isNotNull()), "rest")
        lower = down.withColumn("path", path).drop("rest", *steps)
    return lower


def manifest(docs: DataFrame, columns: list[str], *, group_col: str = "source", order_col: str = "doc_id", keep: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``docs``: a leaf of ``columns`` for each row, a subroot for each ``group_col``, one root.

    ``keep`` names what each row carries along beside its order column, such as the digest of another version of the row; keep it small.
    """
    keep = keep or {}
    own = {f"kept_{i}": c for i, c in enumerate(keep.values())}
    group = F.col(group_col).cast("string")
    key = F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), group))  # bytewise order, null first
    leaves = docs.select(key.alias("key"), F.col(order_col).alias("id"), digest(*(field(F.col(c)) for c in columns)).alias("digest"), *(c.alias(k) for k, c in own.items()))
    rounds = _grow(_positions(leaves, ["id", "digest"]))

    groups = stored(_ends(rounds), "merkle_subroots")
    top = _grow(_positions(groups.select(F.lit("").alias("key"), F.col("key").alias("group"), "digest"), ["group"]))
    last = _ends(top).select("digest").head()
    one = groups.sparkSession.range(1).select(F.lit("").alias("key"), F.lit(None).cast("string").alias("subroot"), F.array().cast(STEPS).alias("path"))
    above = stored(_paths(top, one).select(F.col("group").alias("key"), F.col("digest").alias("subroot"), "path"), "merkle_above")

    proofs = _paths(rounds, above).select(F.col("id").alias(order_col), *(F.col(k).alias(name) for k, name in zip(own, keep)), F.col("digest").alias("leaf"), "subroot", "path")
    subroots = groups.select(F.when(F.col("key") != "", F.expr("substring(key, 2)")).alias(group_col), F.col("digest").alias("subroot"))
    return Manifest(proofs, subroots, last[0] if last else None)


def audit(docs: DataFrame, tampered: Column, columns: list[str], text_col: str = "text", *, group_col: str = "source", order_col: str = "doc_id") -> DataFrame:
    """Per row: leaf, subroot, root and proof_sha256 of ``docs``, and whether the row with ``tampered`` as its text still leads to the root.

    ``folded_root`` is computed from the leaf of the tampered row and the siblings of the manifest.
    """
    changed = digest(*(field(tampered if c == text_col else F.col(c)) for c in columns))
    found = manifest(docs, columns, group_col=group_col, order_col=order_col, keep={"changed": changed})
    root = F.lit(found.root).cast("string")
    out = found.proofs.select(order_col, "leaf", "subroot", root.alias("root"), proof_digest(F.col("path")).alias("proof_sha256"), fold(F.col("changed"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
