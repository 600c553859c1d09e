"""The transaction and customer contract on the driver's benchmark tables.

The expressions are plain SQL that Spark and DuckDB read alike, so that the same
text describes the input of a query and of its oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskflow.contract import DOMAINS
from riskflow.functions.time import time_to_serial

K = "cast(regexp_extract(props, '([0-9]+)', 1) as int)"  # selected as k below every events view


def pick(expression: str, column: str) -> str:
    """Choose a domain value by number."""
    whens = " ".join(f"when {i} then '{v}'" for i, v in enumerate(DOMAINS[column]))
    return f"case {expression} {whens} end"


TXN = {
    "Transaction_ID": "concat('FT-T', lpad(cast(event_id as varchar(20)), 9, '0'))",
    "Customer_ID": "concat('FT-C', lpad(cast(user_id as varchar(20)), 9, '0'))",
    "Transaction_DateTime": "ts",
    "Transaction_Type": pick("event_id % 6", "Transaction_Type"),
    "Amount_NGN": "round(value * 1000, 2)",
    "Channel": pick("k % 5", "Channel"),
    "Device_Type": f"case when event_id % 125 = 0 then null else {pick('(event_id + k) % 5', 'Device_Type')} end",
    "Location": f"case when event_id % 125 = 7 then null else {pick('user_id % 8', 'Location')} end",
    "International_Transaction": "case when k % 10 = 0 then 'Yes' else 'No' end",
    "Transaction_Status": pick("event_id % 4", "Transaction_Status"),
    "Risk_Review_Flag": "case when (event_type = 'error' and value >= 20) or (value >= 150 and k % 2 = 0) "
                        "then 'Yes' else 'No' end",
}

CUST = {
    "Customer_ID": "concat('FT-C', lpad(cast(c_custkey as varchar(20)), 9, '0'))",
    "Customer_Name": "c_name",
    "Age": "cast(18 + c_custkey % 63 as double)",
    "Gender": pick("c_nationkey % 3", "Gender"),
    "City": pick("c_nationkey % 8", "Location"),
    "Customer_Segment": pick("c_custkey % 4", "Customer_Segment"),
    "Account_Type": pick("c_custkey % 3", "Account_Type"),
    "Tenure_Months": "cast(c_custkey % 120 as double)",
    "Digital_Engagement_Score": "cast(floor((c_acctbal + 1000) / 1.1) as double) / cast(100 as double)",
    "Monthly_Income_Band": "case c_mktsegment when 'HOUSEHOLD' then 'Below 100k' when 'MACHINERY' then '100k-249k' "
                           "when 'FURNITURE' then '250k-499k' when 'BUILDING' then '500k-999k' else '1m+' end",
    "Preferred_Channel": pick("c_nationkey % 3", "Preferred_Channel"),
    "Account_Status": pick("c_custkey % 3", "Account_Status"),
}

# Changes laid over TXN to give every rule something to find.
DIRTY = {
    "Amount_NGN": "case when event_id % 103 = 0 then 'fifty' when event_id % 97 = 0 "
                  "then cast(-round(value * 1000, 2) as varchar(40)) else cast(round(value * 1000, 2) as varchar(40)) end",
    "Channel": f"case when event_id % 101 = 0 then 'Telepathy' else {TXN['Channel']} end",
    "Transaction_ID": "case when event_id % 107 = 0 then (case when event_id % 2 = 0 then ' ' else null end) "
                      f"else {TXN['Transaction_ID']} end",
    "Customer_ID": f"case when event_id % 113 = 0 then 'FT-C999999999' else {TXN['Customer_ID']} end",
}


def select_list(columns: dict[str, str]) -> str:
    return ", ".join(f"{e} as {c}" for c, e in columns.items())


def _view(spark: SparkSession, sf_dir: str, table: str, columns: dict[str, str]) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    if table == "events":
        df = df.selectExpr("*", f"{K} as k")
    return df.selectExpr(*[f"{e} as {c}" for c, e in columns.items()])


def transactions(spark: SparkSession, sf_dir: str, row: bool = False) -> DataFrame:
    """Clean transactions; ``row`` adds the ``_row`` order column."""
    return _view(spark, sf_dir, "events", {**TXN, **({"_row": "event_id"} if row else {})})


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "customer", CUST)


def dirty_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with faults; the amount is text here."""
    return _view(spark, sf_dir, "events", {**TXN, **DIRTY, "_row": "event_id"})


def dirty_customers(spark: SparkSession, sf_dir: str, repeated: bool = True) -> DataFrame:
    """Customers with some impossible ages and, when ``repeated``, one key twice."""
    columns = {**CUST, "Age": f"case when c_custkey % 211 = 0 then 12.0 else {CUST['Age']} end", "_seq": "0"}
    df = _view(spark, sf_dir, "customer", columns)
    if not repeated:
        return df
    again = _view(spark, sf_dir, "customer", {**columns, "Age": "cast(99 as double)", "_seq": "1", "_key": "c_custkey"})
    return df.unionByName(again.where("_key = 1").drop("_key"))


def serial_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions whose time is serial days."""
    txn = transactions(spark, sf_dir)
    return txn.withColumn("Transaction_DateTime", time_to_serial("Transaction_DateTime"))
