"""Helpers of the corpus operators: written tables, files in the shared folder, column names, numbering."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskflow import session
from riskflow.session import scratch_path

_SCRATCH: list[tuple[SparkSession, str]] = []
_SHIPPED: set[str] = set()
BATCH_ROWS = 1000


def ship(spark: SparkSession) -> None:
    """Give the executors' Python this package, once a session; needed where it isn't installed there.

    Texts have no bound on their length, so batches on the way to Python are made smaller than Spark's 10,000 rows.
    """
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        top = Path(__file__).resolve().parents[1]
        place = Path(tempfile.mkdtemp(prefix="ship-")) / f"{top.name}.zip"  # Spark's file server sends it on from here
        with zipfile.ZipFile(place, "w") as z:
            for p in sorted(top.rglob("*.py")):
                z.write(p, f"{top.name}/{p.relative_to(top)}")
        spark.sparkContext.addPyFile(str(place))
        _SHIPPED.add(app)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared one; it is removed when the driver's process ends."""
    path = scratch_path(spark, name)
    if not _SCRATCH:
        atexit.register(_sweep)
    _SCRATCH.append((spark, path))
    return path


def _sweep() -> None:
    for spark, path in _SCRATCH:
        try:
            remove(spark, path)
        except Exception:  # the session may be gone by now; then the cluster's own clean-up has the folder
            return


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder through Hadoop's file system."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


class Scratch:
    """The scratch folders made while it is entered; ``free`` deletes them when what was made from them has been written."""

    def __enter__(self) -> Scratch:
        self._before, self.paths = set(session._SCRATCH), []
        return self

    def __exit__(self, *failed) -> None:
        self.paths = [p for p in session._SCRATCH if p not in self._before]

    def free(self, spark: SparkSession) -> None:
        gone = set(self.paths)
        for path in self.paths:
            session.remove(spark, path)
        _SCRATCH[:] = [(s, p) for s, p in _SCRATCH if p not in gone]
        self.paths = []


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cut lineage that outlives executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have yet (Spark compares without case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


# --- files in the shared folder, from Python tasks ---------------------------------------------

def file_system(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """The Arrow file system of ``uri`` (file, hdfs, s3, gs ...) and the path in it."""
    return arrow_fs.FileSystem.from_uri(uri) if ":/" in uri else (arrow_fs.LocalFileSystem(), uri)


def new_file(folder: str, suffix: str) -> str:
    """A name no other attempt of this or another task uses: a repeated task never touches a finished file.

    Which files count is what the table of a job's output rows says, and Spark commits that table once.
    """
    return f"{folder.rstrip('/')}/{uuid.uuid4().hex}{suffix}"


class Output:
    """A new file in the shared folder that counts its bytes."""

    def __init__(self, folder: str, suffix: str):
        self.uri = new_file(folder, suffix)
        system, path = file_system(self.uri)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        self._to, self.size = system.open_output_stream(path, compression=None), 0

    def write(self, data: bytes) -> int:
        at, self.size = self.size, self.size + len(data)
        self._to.write(data)
        return at

    def close(self) -> None:
        self._to.close()


def open_input(uri: str) -> pa.NativeFile:
    """A file of the shared folder for reading at any place."""
    system, path = file_system(uri)
    return system.open_input_file(path)


# --- columns ----------------------------------------------------------------------------------

def texts_of(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """The texts of an Arrow column; null counts as empty."""
    return [x or "" for x in column.to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows`` and ``size`` bytes of text (or one row), so that working memory stays small."""
    kinds = (pa.types.is_string, pa.types.is_large_string, pa.types.is_binary, pa.types.is_large_binary)
    for batch in batches:
        n, at, ends = batch.num_rows, 0, np.zeros(batch.num_rows, np.int64)
        for column in batch.columns:
            if any(kind(column.type) for kind in kinds):
                ends += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(ends)
        while at < n:
            before = ends[at - 1] if at else 0
            stop = min(n, at + rows, max(at + 1, int(np.searchsorted(ends, before + size, side="right"))))
            yield batch.slice(at, stop - at)
            at = stop


def numbered(table: DataFrame, group: list[str], order: list[str], name: str, rows: int, bucket_rows: int = 100_000) -> DataFrame:
    """Add ``name``: 0, 1, 2 ... within each ``group``, in any order, without one task per group.

    Rows go to buckets by a hash of ``order``; buckets are numbered on their own and start where the
    counts of those before end. ``table`` must be a written one, as it is read twice.
    """
    b, first, n, *keys = fresh(table, "bucket", "first", "n", *(f"g_{g}" for g in [*group, "bucket"]))
    buckets = max(1, -(-rows // bucket_rows))
    dealt = table.withColumn(b, F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    counts = dealt.groupBy(*group, b).agg(F.count(F.lit(1)).alias(n))
    before = Window.partitionBy(*group).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*(F.col(g).alias(k) for g, k in zip([*group, b], keys)), F.coalesce(F.sum(n).over(before), F.lit(0)).alias(first))
    own = Window.partitionBy(*group, b).orderBy(*order)
    ranked = dealt.withColumn(name, F.row_number().over(own) - 1)
    match = [F.col(g).eqNullSafe(F.col(k)) for g, k in zip([*group, b], keys)]
    return ranked.join(starts, match).select(*table.columns, (F.col(first) + F.col(name)).alias(name))
