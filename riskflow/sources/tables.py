"""Scans with explicit schemas; NaN turns into NULL right behind the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from riskflow.contract import CONTRACT, Contract
from riskflow.functions.numeric import nan_to_null, number


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """Parquet, ORC, or CSV with a header. A missing path is an AnalysisException.

    CSV columns are found by name and read as text, without an inference pass. Numbers
    stay text, so that validation can report what is not a number; every later step
    coerces them. Times stay text too (a serial or a date, row by row), unless ``schema``
    asks for a timestamp.
    """
    if fmt != "csv":
        reader = spark.read.format(fmt)
        return nan_to_null((reader.schema(schema) if schema is not None else reader).load(path))
    df = spark.read.option("header", True).csv(path)
    times = {f.name: f.dataType for f in schema or () if f.name == CONTRACT.time and f.name in df.columns
             and isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))}
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in times.items()}) if times else df


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """A table in whichever of the formats its files are named for: Parquet, ORC or CSV."""
    names = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    kinds = ("csv", "orc")  # one file's name tells
    found = [k for k in kinds if not names.where(F.col("path").rlike(rf"\.{k}(\.[a-z0-9]+)?$")).isEmpty()]
    return read_table(spark, path, found[0] if found else "parquet")


def typed_numbers(df: DataFrame, contract: Contract = CONTRACT) -> DataFrame:
    """Declared numeric columns as doubles; what is not a number becomes NULL."""
    text = [c for c in contract.numeric if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)]
    return df.withColumns({c: F.expr(number(c, T.StringType())) for c in text}) if text else df


def read_raw(spark: SparkSession, transactions: str, customers: str, fmt: str = "parquet",
             contract: Contract = CONTRACT, time_type: T.DataType | None = None) -> tuple[DataFrame, DataFrame]:
    """The two raw tables."""
    csv = fmt == "csv"
    return (read_table(spark, transactions, fmt, contract.transaction_schema(time_type) if csv else None),
            read_table(spark, customers, fmt, contract.customer_schema() if csv else None))


def from_records(spark: SparkSession, data, contract: Contract = CONTRACT) -> DataFrame:
    """A record, a list of records, or a DataFrame. Only columns some record has are kept."""
    if isinstance(data, DataFrame):
        return nan_to_null(data)
    if isinstance(data, dict):
        data = [data]
    if not isinstance(data, list) or not all(isinstance(r, dict) for r in data):
        raise TypeError(f"unsupported input: {type(data).__name__}; give a dict, a list of dicts or a DataFrame")
    names = list(dict.fromkeys(k for r in data for k in r))
    rows = [tuple(_plain(r.get(c)) for c in names) for r in data]
    schema = T.StructType([T.StructField(c, _type_of([row[i] for row in rows], c, contract))
                           for i, c in enumerate(names)])
    fitted = [tuple(_fit(v, f.dataType) for v, f in zip(row, schema)) for row in rows]
    return nan_to_null(spark.createDataFrame(fitted, schema))


def _plain(value):
    return None if isinstance(value, float) and value != value else value


def _type_of(values: list, name: str, contract: Contract) -> T.DataType:
    """Double where all values are numbers, a timestamp where all are; otherwise text."""
    given = [v for v in values if v is not None]
    if all(isinstance(v, (int, float)) and not isinstance(v, bool) for v in given):
        known_text = contract.categorical + contract.ids + (contract.target,)
        return T.StringType() if not given and name in known_text else T.DoubleType()
    if all(hasattr(v, "isoformat") and hasattr(v, "hour") for v in given):
        return T.TimestampType()
    return T.StringType()


def _fit(value, kind: T.DataType):
    if value is None or isinstance(kind, T.TimestampType):
        return value
    return float(value) if isinstance(kind, T.DoubleType) else str(value)
