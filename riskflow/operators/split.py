"""Exact stratified splitting without ordering or moving the table.

A row goes to the test part when the md5 of its id and the seed is among the
smallest of its class. The cut is found by counting hash prefixes, which are few,
so the wide rows are only filtered: no window, no shuffle, no sort of the table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskflow.contract import CONTRACT, SEED, TEST_FRACTION, Contract
from riskflow.session import checkpointed

PREFIX_STEP = 4         # hex digits resolved per counting pass: 65,536 counters per class
RANKED_ROWS = 100_000   # largest boundary that is resolved by full hash instead of one more prefix


def split_hash(id_column: str, seed: int = SEED) -> Column:
    """The rank of a row: hex md5 of id and seed."""
    return F.md5(F.concat(F.coalesce(F.col(id_column).cast("string"), F.lit("")), F.lit(f"|{seed}")))


@dataclass(frozen=True)
class Cut:
    """Where one class is cut: hashes below ``hash`` are test rows, and ``take`` of the ``ties`` equal to it."""

    label: object
    hash: str
    take: int
    ties: int


def test_rows(rows: dict, fraction: float) -> dict:
    """Test rows of each class: the whole part has its size rounded up, shared out by largest remainder.

    Ties go by the class as text, NULL first. A class of a single row can't be in both parts.
    """
    if 0 < fraction < 1 and any(n < 2 for n in rows.values()):
        raise ValueError(f"a class has a single row: {sorted(str(y) for y, n in rows.items() if n < 2)}")
    total = sum(rows.values())
    wanted = min(total, math.ceil(round(total * fraction, 9)))
    whole = {y: n * wanted // total for y, n in rows.items()}
    rest = sorted(rows, key=lambda y: (-(rows[y] * wanted % total), y is not None, str(y)))
    return {y: whole[y] + (y in rest[:wanted - sum(whole.values())]) for y in rows}


def find_cuts(df: DataFrame, label: str, id_column: str, fraction: float = TEST_FRACTION,
              seed: int = SEED, ranked_rows: int = RANKED_ROWS) -> list[Cut]:
    """The cut of every class, from the label and id columns only."""
    hashed = df.select(F.col(label).alias("label"), split_hash(id_column, seed).alias("h"))
    by_class = Window.partitionBy("label")
    running = by_class.orderBy("p").rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def boundary(rows: DataFrame, prefix: Column, need: Column) -> list:
        # the counters of a class: at most 16**PREFIX_STEP rows, or RANKED_ROWS hashes
        counts = rows.groupBy("label", prefix.alias("p")).agg(F.count(F.lit(1)).alias("n"))
        return (
            counts.withColumns({"upto": F.sum("n").over(running), "total": F.sum("n").over(by_class)})
            .withColumn("need", need.cast("bigint"))
            .where((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n") < F.col("need")))
            .select("label", "p", "n", (F.col("need") - F.col("upto") + F.col("n")).alias("take"))
            .collect()
        )

    cuts = []
    length = PREFIX_STEP
    takes = test_rows({r["label"]: r["n"] for r in hashed.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}, fraction)
    need = F.lit(0)
    for y, take in takes.items():  # one entry per class
        need = F.when(F.col("label").eqNullSafe(F.lit(y)), F.lit(take)).otherwise(need)
    found = boundary(hashed, F.substring("h", 1, length), need)
    while found:
        cuts += [Cut(r["label"], r["p"], r["take"], r["n"]) for r in found if length == 32]
        # a prefix taken whole needs no further digits
        cuts += [Cut(r["label"], r["p"] + "g", 0, 0) for r in found if length < 32 and r["take"] == r["n"]]
        open_ = [r for r in found if length < 32 and r["take"] < r["n"]]
        if not open_:
            break
        inside = F.lit(False)
        need = F.lit(None).cast("bigint")
        for r in open_:  # one entry per class
            same = F.col("label").eqNullSafe(F.lit(r["label"]))
            inside = inside | (same & F.col("h").startswith(r["p"]))
            need = F.when(same, F.lit(r["take"])).otherwise(need)
        length = 32 if max(r["n"] for r in open_) <= ranked_rows else min(32, length + PREFIX_STEP)
        found = boundary(hashed.where(inside), F.substring("h", 1, length), need)
    return cuts


def _is_test(label: str, id_column: str, seed: int, cuts: list[Cut]) -> Column:
    h = split_hash(id_column, seed)
    test = F.lit(False)
    for c in cuts:
        below = (h <= c.hash) if c.take == c.ties else (h < c.hash)
        test = F.when(F.col(label).eqNullSafe(F.lit(c.label)), below).otherwise(test)
    return test


def stratified_split(df: DataFrame, label: str = CONTRACT.target, id_column: str = CONTRACT.transaction_id,
                     fraction: float = TEST_FRACTION, seed: int = SEED,
                     ranked_rows: int = RANKED_ROWS, narrow: DataFrame | None = None) -> DataFrame:
    """Add ``split`` (train or test) with exact counts per class.

    ``narrow`` gives the same labels and ids from a cheaper plan, for instance the
    fact table before its join. A table without the label is all train.
    """
    if label not in df.columns:
        return df.withColumn("split", F.lit("train"))
    cuts = find_cuts(narrow if narrow is not None else df, label, id_column, fraction, seed, ranked_rows)
    name = F.when(_is_test(label, id_column, seed, cuts), "test").otherwise("train")
    divided = [c for c in cuts if 0 < c.take < c.ties]
    if not divided:
        return df.withColumn("split", name)
    # Rows sharing one id straddle the cut. They cannot be told apart by rank, so their
    # places are numbered: first row of each partition from the partition counts, then in order.
    h = split_hash(id_column, seed)
    tied = F.lit(False)
    for c in divided:
        tied = tied | (F.col(label).eqNullSafe(F.lit(c.label)) & (h == c.hash))
    rest = df.where(~tied).withColumn("split", name)
    parts = [rest]
    for c in divided:
        same = df.where(F.col(label).eqNullSafe(F.lit(c.label)) & (h == c.hash))
        parts.append(_take_some(checkpointed(same), c.take))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _take_some(rows: DataFrame, take: int) -> DataFrame:
    """Mark exactly ``take`` rows as test, without ordering them."""
    placed = rows.withColumn("_place", F.monotonically_increasing_id())
    part = F.shiftright("_place", 33)
    offset = F.col("_place").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n"))  # one row per partition
    before = sizes.select("_part", (F.sum("n").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")).alias("_before"))
    test = F.col("_before") + F.col("_offset") < take
    return (
        placed.withColumns({"_part": part, "_offset": offset})
        .join(F.broadcast(before), "_part")
        .withColumn("split", F.when(test, "test").otherwise("train"))
        .drop("_place", "_part", "_offset", "_before")
    )


def freeze_cuts(df: DataFrame, label: str = CONTRACT.target, id_column: str = CONTRACT.transaction_id,
                fraction: float = TEST_FRACTION, seed: int = SEED, ranked_rows: int = RANKED_ROWS) -> DataFrame:
    """The cuts of ``stratified_split`` as a table to be kept beside it: for each class the largest hash of its test rows.

    ``whole`` is false where rows with that hash (of one id) are in both parts. A class without test rows has no hash.
    """
    cuts = find_cuts(df, label, id_column, fraction, seed, ranked_rows)
    whole = F.lit(True)
    at_most = F.lit(False)
    for c in cuts:  # one entry per class
        same = F.col("label").eqNullSafe(F.lit(c.label))
        whole = F.when(same, F.lit(c.take == c.ties)).otherwise(whole)
        at_most = F.when(same, F.col("h") <= c.hash).otherwise(at_most)
    hashed = df.select(F.col(label).alias("label"), split_hash(id_column, seed).alias("h"))
    found = hashed.groupBy("label").agg(F.max(F.when(at_most, F.col("h"))).alias("hash"), F.count(F.lit(1)).alias("rows"))
    return found.withColumns({"whole": whole, "fraction": F.lit(float(fraction)), "seed": F.lit(int(seed))})


def append_split(df: DataFrame, cuts: DataFrame, label: str = CONTRACT.target, id_column: str = CONTRACT.transaction_id) -> DataFrame:
    """Add ``split`` to later rows by the frozen cuts: a filter, whatever came before, so no row ever changes side.

    Rows of an id that the cut divides are train rows. A class that the cuts don't have is cut at the fraction itself.
    """
    held = cuts.collect()  # one row per class
    if not held:
        raise ValueError("the cuts of an empty table don't say how to split")
    h = split_hash(id_column, held[0]["seed"])
    test = h < f"{min(int(held[0]['fraction'] * 2**128), 2**128 - 1):032x}"
    for c in held:
        inside = F.lit(False) if c["hash"] is None else (h <= c["hash"]) if c["whole"] else (h < c["hash"])
        test = F.when(F.col(label).eqNullSafe(F.lit(c["label"])), inside).otherwise(test)
    return df.withColumn("split", F.when(test, "test").otherwise("train"))


def split_drift(df: DataFrame, cuts: DataFrame, label: str = CONTRACT.target) -> DataFrame:
    """For each class of a split table its rows, test rows, and how many more or fewer test rows than a new cut would give.

    A class's share of a new cut is taken for itself, so it is within one row of what ``stratified_split`` deals out.
    """
    fraction = cuts.agg(F.first("fraction")).scalar()
    n, test = F.count(F.lit(1)), F.count_if(F.col("split") == "test")
    return df.groupBy(label).agg(n.alias("n"), test.alias("test")).withColumn(
        "off", F.col("test") - F.round(F.col("n") * fraction).cast("bigint"))


def needs_cut(drift: DataFrame, tolerance: float = 0.02) -> bool:
    """Whether the test part is off by more than ``tolerance`` of its rows, summed over the classes."""
    off, test = drift.agg(F.coalesce(F.sum(F.abs("off")), F.lit(0)), F.coalesce(F.sum("test"), F.lit(0))).first()
    return off > tolerance * max(test, 1)


def split_counts(df: DataFrame, contract: Contract = CONTRACT) -> DataFrame:
    """Rows per class and part."""
    return df.groupBy(contract.target, "split").agg(F.count(F.lit(1)).alias("n"))
