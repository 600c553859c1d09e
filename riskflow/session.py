"""Session helpers: a local session for tests and benches, and the shared folder."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


# Wide projections make generated methods that the JVM would only interpret; beyond this
# size Spark splits them instead. A cluster's session should set it too.
CODEGEN = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def local_session(name: str = "riskflow", cpus: int | str = "*", shuffle_partitions: int = 8,
                  **conf: str) -> SparkSession:
    """A local session for tests and benches; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "12g"))
    )
    for key, value in {**CODEGEN, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def split_methods(spark: SparkSession) -> Iterator[None]:
    """What runs inside has its wide projections split, also in a session whose limit would leave them interpreted."""
    old = {k: spark.conf.get(k, None) for k in CODEGEN}
    for k, v in CODEGEN.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only where the setting is absent (a bare local test session) is one made up.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="riskflow-"))
    return sc.getCheckpointDir()


def checkpointed(df):
    """Cut the lineage of a frame through a reliable checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


_SCRATCH: dict[str, SparkSession] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table in the shared folder; it is removed at the latest when the process ends."""
    path = f"{shared_dir(spark)}/riskflow/{name}-{uuid.uuid4().hex}"
    if not _SCRATCH:
        atexit.register(_sweep)
    _SCRATCH[path] = spark
    return path


def stored(df, name: str, *by: str):
    """A frame as a written table in the shared folder, in partitions of ``by``, its last columns: what is read again comes from there."""
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """A frame that executors keep on their disks while it is read again and again, unless somebody keeps it already.

    What goes with a lost executor is made again.
    """
    own = df.storageLevel == StorageLevel.NONE
    if own:
        df.persist(StorageLevel.DISK_ONLY)
    try:
        yield df
    finally:
        if own:
            df.unpersist()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system Spark uses for it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    _SCRATCH.pop(path, None)


def _sweep() -> None:
    for path, spark in list(_SCRATCH.items()):
        try:
            remove(spark, path)
        except Exception:  # the session has ended before; its cluster cleans the folder up
            return
