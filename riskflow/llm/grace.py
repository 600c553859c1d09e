"""Exact deduplication by Grace hashing.

Texts are equal when identical after each run of blanks, tabs and line ends becomes one space. First each task drops the
repeats among its own rows (so a content that a third of all rows share reaches the next step once per task) and
writes what is left, with a 64-bit hash of each content. Records are then partitioned by digits of that hash, and
every partition whose contents exceed the memory of a table is partitioned again by the next digit, until all fit;
sizes come from sums over the written records, and the partitions are Spark's shuffle files. A partition is loaded into an
open-addressing table that compares complete contents, so equal hashes alone never join two texts.
A partition whose digits are used up has one hash only; it is compared in full however large it is.

Null counts as empty; empty texts are equal. Of rows that share the smallest id of a group (repeated rows) the first stays;
null ids come last, so they stay only in groups without any id. An empty table gives no rows. Other columns are kept by
``deduplicated`` and left out by ``decisions``.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from riskflow.llm.tables import fresh, slices, stored, texts_of

#: Bytes of distinct contents a table may hold, and partitions made of one by each digit of the hash.
TABLE_BYTES, FAN_OUT, DIGITS = 32 << 20, 16, 16
#: Bytes after which a scanning task empties its own table.
COMBINE_BYTES = 32 << 20
_NO_ID = 2**63 - 1
_RUNS = re.compile(r"[ \t-\r]{2,}|[\t-\r]")


def normalised(text: str) -> str:
    """Each run of white space (space, tab to carriage return) as one space."""
    return _RUNS.sub(" ", text)


class Table:
    """Open addressing with linear probing; a slot is taken only by an equal hash and an equal complete content."""

    def __init__(self, slots: int = 1024):
        self.slots = np.full(slots, -1, np.int64)
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.bytes = 0

    def put(self, key: int, content: bytes) -> tuple[int, bool]:
        """The content's number, and whether it is new."""
        mask = len(self.slots) - 1
        at = (key ^ key >> 32) & mask
        slots, hashes, contents = self.slots, self.hashes, self.contents
        while (held := int(slots[at])) >= 0:
            if hashes[held] == key and contents[held] == content:
                return held, False
            at = (at + 1) & mask
        slots[at] = len(contents)
        hashes.append(key)
        contents.append(content)
        self.bytes += len(content) + 120
        if 2 * len(contents) > len(slots):
            self._grow()
        return len(contents) - 1, True

    def _grow(self) -> None:
        self.slots = np.full(4 * len(self.slots), -1, np.int64)
        mask = len(self.slots) - 1
        for number, key in enumerate(self.hashes):
            at = (key ^ key >> 32) & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = number


#: What a scanning task leaves: rows (with their group) and groups (with content, least id, its row, members).
_RECORD = StructType([StructField("part", StringType()), StructField("row", LongType()), StructField("id", LongType()), StructField("grp", LongType()),
                      StructField("n", LongType()), StructField("hash", LongType()), StructField("bytes", LongType()),
                      StructField("content", BinaryType()), StructField("sha", StringType())])


def _combined(docs: DataFrame, id_col: str, text_col: str, row_col: str | None) -> DataFrame:
    """Written records of both kinds, apart by ``part``: ``row`` and ``group``."""

    def scan(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 40
        table, first, rows = Table(), number, []
        least: list[tuple[int, int]] = []
        members: list[int] = []

        def flush():
            kinds = [pa.string(), *[pa.int64()] * 6, pa.binary(), pa.string()]
            groups = [("group", least[g][1], least[g][0], first + g, members[g], key, len(content), content, hashlib.sha256(content).hexdigest())
                      for g, (key, content) in enumerate(zip(table.hashes, table.contents))]
            plain = [("row", row, i, first + g, 1, None, None, None, None) for row, i, g in rows]
            for part in (groups, plain):
                for at in range(0, len(part), 2000):
                    chunk = part[at:at + 2000]
                    yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in chunk], t) for j, t in enumerate(kinds)], names=_RECORD.names)

        for batch in slices(batches):
            given = batch.column(2).to_pylist() if row_col else [None] * batch.num_rows
            for doc_id, text, row in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), given):
                content = normalised(text).encode("utf-8", "surrogatepass")
                group, new = table.put(xxhash.xxh3_64_intdigest(content) - 2**63, content)
                row, rank = number if row is None else row, _NO_ID if doc_id is None else doc_id
                if new:
                    least.append((rank, row))
                    members.append(1)
                else:
                    least[group] = min(least[group], (rank, row))
                    members[group] += 1
                rows.append((row, rank, group))
                number += 1
            if table.bytes + 100 * len(rows) > COMBINE_BYTES:
                yield from flush()
                table, first, rows, least, members = Table(), first + len(table.contents), [], [], []
        yield from flush()

    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), *([F.col(row_col).alias("row")] if row_col else []))
    return stored(own.mapInArrow(scan, _RECORD), "grace_records")


def _partition(records: DataFrame, table_bytes: int) -> DataFrame:
    """Add ``leaf``: the digits of the hash that name a record's partition, as few as make it fit a table."""
    digit = lambda level: F.shiftrightunsigned(F.col("hash"), 4 * level).bitwiseAND(15).cast("string")
    whole = records.agg(F.sum("bytes")).first()[0] or 0
    depth = 1
    while FAN_OUT ** depth * table_bytes < 2 * whole and depth < DIGITS:
        depth += 1
    dealt = records.withColumn("leaf", F.concat_ws(".", *(digit(i) for i in range(depth))))
    while depth < DIGITS:
        sums = dealt.groupBy("leaf").agg(F.sum("bytes").alias("b"), F.min("hash").alias("low"), F.max("hash").alias("high"))
        # Partitions of one hash can't be cut; the others are fewer than the whole's bytes over a table's.
        large = sums.where((F.col("b") > table_bytes) & (F.col("low") < F.col("high"))).select(F.col("leaf").alias("large")).collect()
        if not large:
            break
        # Spark knows the list's size and broadcasts it only if it is small.
        listed = records.sparkSession.createDataFrame(large, "large string")
        dealt = dealt.join(listed, F.col("leaf") == F.col("large"), "left").withColumn(
            "leaf", F.when(F.col("large").isNull(), F.col("leaf")).otherwise(F.concat_ws(".", "leaf", digit(depth)))).drop("large")
        depth += 1
    return dealt


def _matched(groups: DataFrame, table_bytes: int) -> DataFrame:
    """For each record its group over all tasks: grp, keep_row, keep_id, group_size, sha."""

    def match(part: pa.Table) -> pa.Table:
        table, of, keep, size = Table(), [], [], []
        hashes, contents = part.column("hash").to_pylist(), part.column("content")
        ids, rows, counts = (part.column(c).to_pylist() for c in ("id", "row", "n"))
        for i, key in enumerate(hashes):
            number, new = table.put(key, contents[i].as_py())
            of.append(number)
            if new:
                keep.append((ids[i], rows[i]))
                size.append(counts[i])
            else:
                keep[number] = min(keep[number], (ids[i], rows[i]))
                size[number] += counts[i]
        return pa.table({"grp": part.column("grp"), "keep_row": pa.array([keep[g][1] for g in of], pa.int64()), "keep_id": pa.array([keep[g][0] for g in of], pa.int64()),
                         "group_size": pa.array([size[g] for g in of], pa.int64()), "sha": part.column("sha")})

    dealt = _partition(groups, table_bytes)
    return dealt.select("leaf", "grp", "row", "id", "n", "hash", "content", "sha").groupBy("leaf").applyInArrow(
        match, "grp long, keep_row long, keep_id long, group_size long, sha string")


def _decided(docs: DataFrame, id_col: str, text_col: str, row_col: str | None, table_bytes: int) -> DataFrame:
    records = _combined(docs, id_col, text_col, row_col)
    matched = _matched(records.where("part = 'group'"), table_bytes).withColumnRenamed("grp", "g")
    # Rows meet their task's group: no group here has more rows than one task scans.
    rows = records.where("part = 'row'").select("row", "id", "grp")
    real = lambda c: F.when(F.col(c) != _NO_ID, F.col(c))
    return rows.join(matched, F.col("grp") == F.col("g")).select(
        "row", real("id").alias("doc_id"), real("keep_id").alias("keep_id"), "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), F.col("sha").alias("text_sha256"))


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text)."""
    return _decided(docs, id_col, text_col, None, table_bytes).drop("row")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The rows that stay, with all their columns as they came."""
    row, kept_row = fresh(docs, "row_number", "kept_row")
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    kept = _decided(numbered, id_col, text_col, row, table_bytes).where("kept").select(F.col("row").alias(kept_row))
    return numbered.join(kept, F.col(row) == F.col(kept_row), "left_semi").select(*docs.columns)
