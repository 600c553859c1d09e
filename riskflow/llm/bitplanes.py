"""Token files in bit planes: ids in fixed-size blocks, each block's bit (or byte) planes compressed on their own.

A file holds consecutive documents. Its ids run on through blocks of ``block`` ids; a block is turned into
planes (plane j has bit or byte j of every id) and each plane is compressed by zstandard. Layout::

    magic  planes of all blocks  documents  chunk index  footer

The chunk index has, for each block, its ids and each plane's first byte and length (length 0: a plane without
any set bit). ``documents`` has each document's id (with a null flag) and number of ids. The footer gives the
places of both. Any block can so be read alone.

Null texts count as empty: such a document has the end id only. Equal doc_ids follow each other in any order; null
doc_ids come first. An empty table gives no file and no row. Other columns of the input are left alone.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm.encode import encoder, tokenizer_path
from riskflow.llm.tables import Output, fresh, open_input, scratch, slices, stored

MAGIC = b"IDPLANE1"
FOOTER = struct.Struct("<QQQQBBH")  # place of documents, place of chunk index, documents, ids, plane bits, zstd level, -
END_ID = 2
#: Ids of a block, bits of a plane, ids after which a file ends.
BLOCK, PLANE_BITS, FILE_IDS = 16_384, 1, 64_000_000
LEVEL = 1


def planes_of(ids: np.ndarray, bits: int) -> list[bytes]:
    """The planes of a block, lowest first; planes beyond the highest set bit are left out."""
    top = int(ids.max()).bit_length() if len(ids) else 0
    small = ids.astype(np.uint16) if top <= 16 else ids
    if bits == 8:
        return [(ids >> (8 * j)).astype(np.uint8).tobytes() for j in range(-(-top // 8))]
    one = small.dtype.type(1)
    return [np.packbits(((small >> small.dtype.type(j)) & one).astype(np.uint8)).tobytes() for j in range(top)]


def ids_of(planes: list[bytes], n: int, bits: int) -> np.ndarray:
    """The block that ``planes_of`` took apart."""
    ids = np.zeros(n, np.uint32)
    for j, plane in enumerate(planes):
        if plane:
            raw = np.frombuffer(plane, np.uint8)
            ids |= (raw if bits == 8 else np.unpackbits(raw, count=n)).astype(np.uint32) << np.uint32(j * bits)
    return ids


class Writer:
    """One file: ``add`` documents in order, then ``close``."""

    def __init__(self, folder: str, block: int = BLOCK, bits: int = PLANE_BITS, level: int = LEVEL):
        self.out, self.block, self.bits, self.level = Output(folder, ".planes"), block, bits, level
        self.out.write(MAGIC)
        self.pack = zstandard.ZstdCompressor(level=level)
        self.waiting: list[bytes] = []
        self.bytes, self.n_ids = 0, 0
        self.docs: list[tuple[int, int, int]] = []
        self.index: list[bytes] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id is None, doc_id or 0, len(ids) // 4))
        self.waiting.append(ids)
        self.bytes += len(ids)
        self.n_ids += len(ids) // 4
        if self.bytes >= 4 * self.block:
            data = b"".join(self.waiting)
            whole = len(data) // (4 * self.block) * 4 * self.block
            for at in range(0, whole, 4 * self.block):
                self._block(data[at:at + 4 * self.block])
            self.waiting, self.bytes = [data[whole:]], len(data) - whole

    def _block(self, data: bytes) -> None:
        ids, entry = np.frombuffer(data, "<u4"), []
        for plane in planes_of(ids, self.bits):
            done = self.pack.compress(plane) if any(plane) else b""
            entry.append(struct.pack("<QI", self.out.write(done), len(done)))
        self.index.append(struct.pack("<IB", len(ids), len(entry)) + b"".join(entry))

    def close(self) -> dict:
        if self.bytes:
            self._block(b"".join(self.waiting))
        docs = np.array(self.docs, dtype=[("null", "u1"), ("id", "<i8"), ("n", "<u8")])
        at_docs = self.out.write(self.pack.compress(docs.tobytes()))
        at_index = self.out.write(self.pack.compress(b"".join(self.index)))
        self.out.write(FOOTER.pack(at_docs, at_index, len(docs), self.n_ids, self.bits, self.level, 0))
        self.out.close()
        return {"file": self.out.uri, "bytes": self.out.size, "documents": len(docs), "ids": self.n_ids, "blocks": len(self.index)}


class Reader:
    """A file's chunk index and documents; blocks are read when asked for."""

    def __init__(self, uri: str):
        self.file = open_input(uri)
        size = self.file.size()
        if self.file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{uri} is no file of bit planes")
        at_docs, at_index, _, self.n_ids, self.bits, _, _ = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        unpack = zstandard.ZstdDecompressor().decompress
        self.docs = np.frombuffer(unpack(self.file.read_at(at_index - at_docs, at_docs)), dtype=[("null", "u1"), ("id", "<i8"), ("n", "<u8")])
        raw, at, self.index = unpack(self.file.read_at(size - FOOTER.size - at_index, at_index)), 0, []
        while at < len(raw):
            n, planes = struct.unpack_from("<IB", raw, at)
            self.index.append((n, [struct.unpack_from("<QI", raw, at + 5 + 12 * j) for j in range(planes)]))
            at += 5 + 12 * planes
        self.unpack = unpack

    def block(self, i: int) -> np.ndarray:
        n, places = self.index[i]
        return ids_of([self.unpack(self.file.read_at(size, at)) if size else b"" for at, size in places], n, self.bits)

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, ids before it in this file, its ids), one block in memory besides the document."""
        have, held, i, before = [], 0, 0, 0
        for null, doc_id, n in self.docs.tolist():
            while held < n:
                have.append(self.block(i))
                held, i = held + len(have[-1]), i + 1
            data = have[0] if len(have) == 1 else np.concatenate(have) if have else np.empty(0, np.uint32)
            yield None if null else doc_id, before, data[:n]
            have, held, before = [data[n:]], held - n, before + n

    def close(self) -> None:
        self.file.close()


WRITTEN = "part int, seq int, file string, bytes long, documents long, ids long, blocks long"


def write_ids(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, tokenizer: str = "word_bpe_49k.json", spaced: bool = False,
              end_id: int = END_ID, block: int = BLOCK, plane_bits: int = PLANE_BITS, file_ids: int = FILE_IDS) -> DataFrame:
    """Encode all texts into files in ascending ``id_col`` order; returns the table of files with the ids before each.

    Rows are dealt by ranges of the id and sorted there, so files follow each other as tasks do. The returned
    table (``part``, ``seq``, ``file``, ``bytes``, ``documents``, ``ids``, ``blocks``, ``start``) has a row for each finished
    file: files of a repeated task aren't in it.
    """
    spark = docs.sparkSession
    folder, own = scratch(spark, "planes"), docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())
    dealt = own.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id")

    def write(batches):
        from pyspark import TaskContext

        enc, part, seq, to, end = encoder(tokenizer_path(tokenizer), spaced), TaskContext.get().partitionId(), 0, None, struct.pack("<I", end_id)
        done = []
        for batch in slices(batches, 1000, 4 << 20):  # the more texts at once, the fewer distinct pieces
            for doc_id, ids in zip(batch.column(0).to_pylist(), enc.ids(batch.column(1))):
                to = to or Writer(folder, block, plane_bits)
                to.add(doc_id, ids + end)
                if to.n_ids >= file_ids:
                    done.append({"part": part, "seq": seq, **to.close()})
                    to, seq = None, seq + 1
        if to:
            done.append({"part": part, "seq": seq, **to.close()})
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("file", pa.string()), *((c, pa.int64()) for c in ("bytes", "documents", "ids", "blocks"))]))

    files = stored(dealt.mapInArrow(write, WRITTEN), "plane_files")
    # One row per file of up to 64 million ids: their running sum is small work for one task.
    earlier = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("ids").over(earlier), F.lit(0)))


def read_documents(files: DataFrame) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32, file."""

    def read(batches):
        for batch in batches:
            for uri, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                source, rows = Reader(uri), []
                for doc_id, before, ids in source.documents():
                    rows.append((doc_id, start + before, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), uri))
                    if len(rows) == 10_000:
                        yield _rows(rows)
                        rows = []
                source.close()
                yield _rows(rows)

    def _rows(rows):
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        names = ("doc_id", "start", "n_tokens", "ids_crc32", "file")
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(5)], names=names)

    listed = files.select("file", "start")
    spread = listed.repartition(max(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1), "file")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, file string")
