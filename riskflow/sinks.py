"""Writers; every target is a folder Spark overwrites as a whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> str:
    """Parquet, ORC, JSON lines, or CSV with a header. Nested columns go into CSV as JSON text."""
    if fmt == "csv":
        nested = [f.name for f in df.schema if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))]
        df = df.withColumns({c: F.to_json(c) for c in nested}) if nested else df
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path
