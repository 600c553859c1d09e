"""Best-fit packing planned on a histogram of lengths.

Documents become pieces of at most ``size`` ids: only longer documents are cut, the first piece is the shorter one. The
plan is made on counts: lengths go from long to short, and all pieces of one length are dealt to the open sequences with
the least room that still takes them, whole runs of like sequences at a time. So the plan has a few rows for each
length, however many documents there are; pieces then take its slots by joining on their rank within their length.

Null texts count as empty (one piece of the end id only). Repeated rows are packed as often as they occur; their ranks
tie in any order. Null doc_ids stay null. An empty table gives no rows. Other columns of the input are left alone.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.encode import encoder, tokenizer_path
from riskflow.llm.tables import numbered, slices, stored

SIZE, END_ID = 1024, 2
PIECE = "doc_id long, row long, piece int, start long, length long, ids_crc32 long"


def cuts(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: full ones, after a first one with what is over."""
    first = n % size or min(n, size)
    return [(0, first)] + [(at, size) for at in range(first, n, size)]


def plan(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank, first sequence, offset): ranks of a run sit in sequences that follow each other."""
    room: dict[int, list[tuple[int, int]]] = {}  # room left -> runs (first sequence, sequences)
    rooms: list[int] = []
    slots, made = [], 0

    def leave(left: int, run: tuple[int, int]) -> None:
        if left:
            if left not in room:
                insort(rooms, left)
            room.setdefault(left, []).append(run)

    for length in sorted(histogram, reverse=True):
        rank, count = 0, histogram[length]
        while rank < count:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                left = rooms[at]
                first, n = room[left].pop()
                if not room[left]:
                    del room[left], rooms[at]
            else:  # a run of new sequences; each takes as many of this length as fit
                left, first, n = size, made, -(-(count - rank) // max(1, size // length))
                made += n
            take = min(n, count - rank)
            slots.append((length, rank, rank + take - 1, first, size - left))
            rank += take
            leave(left - length, (first, take))
            if take < n:
                leave(left, (first + take, n - take))
    return slots


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, tokenizer: str = "byte_bpe_50k.json", spaced: bool = True,
           end_id: int = END_ID, size: int = SIZE) -> DataFrame:
    """Encode every text once and return its pieces: doc_id, row, piece, start, length, ids_crc32 (a written table).

    ``row`` numbers the input's rows, so that repeated doc_ids stay apart.
    """

    def cut(batches):
        from pyspark import TaskContext

        enc, row, end = encoder(tokenizer_path(tokenizer), spaced), TaskContext.get().partitionId() << 40, struct.pack("<I", end_id)
        for batch in slices(batches):
            out = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), enc.ids(batch.column(1))):
                ids += end
                for k, (at, n) in enumerate(cuts(len(ids) // 4, size)):
                    out.append((doc_id, row, k, at, n, zlib.crc32(ids[4 * at:4 * (at + n)])))
                row += 1
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)],
                                             names=["doc_id", "row", "piece", "start", "length", "ids_crc32"])

    return stored(docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(cut, PIECE), "pieces")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, size: int = SIZE, **encoding) -> DataFrame:
    """Every piece with its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    cut = pieces(docs, id_col, text_col, size=size, **encoding)
    # At most ``size`` lengths, each with a count.
    histogram = {r.length: r.n for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = spark.createDataFrame(plan(histogram, size), "len int, first_rank long, last_rank long, first_sequence long, offset long")
    # The plan grows with the number of lengths, not with the rows.
    ranked = numbered(cut, ["length"], ["row", "piece"], "rank", sum(histogram.values()))
    fits = (F.col("length") == F.col("len")) & F.col("rank").between(F.col("first_rank"), F.col("last_rank"))
    return ranked.join(F.broadcast(slots), fits).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first_sequence") + F.col("rank") - F.col("first_rank")).alias("sequence_id"), "offset")
