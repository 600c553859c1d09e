"""Artifacts that appear as one: versioned folders whose manifest is written last.

A publication writes all its parts into a folder of its own and then the manifest, which Spark commits as a whole. Readers
take the newest folder that has one, so a job that fails between two parts leaves the last whole set in use, and a set that
is being read is never changed. Names of versions sort by time; of two at the same time either may count as the newer.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from riskflow.models.scorers import read_json, write_json

MANIFEST = "manifest"


def _path(spark: SparkSession, text: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(text)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def publish(spark: SparkSession, root: str, parts: dict[str, Callable[[str], object]], about: dict | None = None) -> str:
    """Write each part by its function, which is given the part's path, then the manifest; gives the folder of the version."""
    place = f"{root.rstrip('/')}/versions/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    for name, write in parts.items():
        write(f"{place}/{name}")
    made = datetime.now(timezone.utc).isoformat()
    write_json(spark, f"{place}/{MANIFEST}", {"parts": sorted(parts), "published": made, **(about or {})})
    return place


def versions(spark: SparkSession, root: str) -> list[str]:
    """Folders of whole versions, oldest first."""
    system, place = _path(spark, f"{root.rstrip('/')}/versions")
    if not system.exists(place):
        return []
    found = sorted(f.getPath().toString() for f in system.listStatus(place))
    return [p for p in found if system.exists(_path(spark, f"{p}/{MANIFEST}/_SUCCESS")[1])]


def newest(spark: SparkSession, root: str) -> str | None:
    """Folder of the newest whole version, if there is any."""
    found = versions(spark, root)
    return found[-1] if found else None


def manifest(spark: SparkSession, version: str) -> dict:
    return read_json(spark, f"{version}/{MANIFEST}")


def prune(spark: SparkSession, root: str, keep: int = 3) -> list[str]:
    """Delete all but the newest whole versions, and older folders that never became whole; gives what was deleted."""
    whole = versions(spark, root)[-max(1, keep):]
    if not whole:
        return []
    system, place = _path(spark, f"{root.rstrip('/')}/versions")
    old = [p for p in sorted(f.getPath().toString() for f in system.listStatus(place)) if p < whole[0]]
    for p in old:
        system.delete(_path(spark, p)[1], True)
    return old
