import json
import math

import pytest
from pyspark.sql import functions as F, types as T

from riskflow.contract import CONTRACT
from riskflow.plans.validate import validate
from riskflow.sinks import write_table
from riskflow.sources import requests as rq
from riskflow.sources.tables import from_records, read_raw, read_table, typed_numbers


def test_records(spark, txn):
    one = from_records(spark, txn)
    assert one.count() == 1 and one.schema["Amount_NGN"].dataType == T.DoubleType()
    assert from_records(spark, [txn, {**txn, "Age": 3}]).select("Age").collect()[1][0] == 3.0
    assert from_records(spark, one).columns == one.columns
    for bad in ("text", 5, None, [1, 2], ("a",)):
        with pytest.raises(TypeError):
            from_records(spark, bad)
    gaps = from_records(spark, {**txn, "Device_Type": None, "Amount_NGN": math.nan})
    assert gaps.schema["Device_Type"].dataType == T.StringType() and gaps.first().Amount_NGN is None


def test_csv_round_trip(spark, txn, profile, tmp_path):
    rows = [txn, {**txn, "Amount_NGN": "fifty", "Device_Type": None}, {**txn, "Amount_NGN": "20.5"}]
    write_table(from_records(spark, rows), str(tmp_path / "t"), "csv")
    write_table(from_records(spark, profile), str(tmp_path / "c"), "csv")
    t, c = read_raw(spark, str(tmp_path / "t"), str(tmp_path / "c"), "csv")
    assert t.schema["Transaction_DateTime"].dataType == T.StringType()  # a serial or a date, row by row
    assert t.where("Device_Type is null").count() == 1
    # text that is no number is still there to be reported
    found = validate(t, strict=False)["errors"]
    assert [(e["field"], e["sample_invalid_values"]) for e in found] == [("Amount_NGN", ["fifty"])]
    assert sorted(str(r.Amount_NGN) for r in typed_numbers(t).collect()) == ["20.5", "8125.25", "None"]
    assert c.first().Customer_Name == "N. N."


def test_csv_columns_by_name(spark, txn, tmp_path):
    df = from_records(spark, txn)
    write_table(df.select(*reversed(df.columns)), str(tmp_path / "t"), "csv")
    got = read_table(spark, str(tmp_path / "t"), "csv", CONTRACT.transaction_schema())
    assert got.first().Channel == txn["Channel"] and got.first().Transaction_DateTime == "46130.3"


def test_nested_columns_in_csv(spark, tmp_path):
    df = spark.range(1).select(F.array(F.struct(F.lit("a").alias("x"))).alias("n"))
    write_table(df, str(tmp_path / "n"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "n")).first()[0] is not None


def test_missing_path(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_table(spark, str(tmp_path / "no"))


def test_parquet_nan(spark, tmp_path):
    spark.createDataFrame([(math.nan,), (1.0,)], "Age double").write.parquet(str(tmp_path / "p"))
    assert read_table(spark, str(tmp_path / "p")).where("Age is null").count() == 1


def parse(spark, *payloads, **kw):
    text = [p if isinstance(p, str) else json.dumps(p) for p in payloads]
    df = spark.createDataFrame(list(enumerate(text)), "n int, payload string")
    return rq.parse_requests(df, **kw).orderBy("n").collect()


def without(record, *names):
    return {k: v for k, v in record.items() if k not in names}


def reasons(row):
    return {(r.field, r.reason) for r in row._reasons}


def test_good_request(spark, txn):
    row, = parse(spark, {**txn, "Unknown": [1, 2]})
    assert row._reasons == [] and row.Amount_NGN == 8125.25 and not hasattr(row, "Unknown")


def test_defaults_apply_to_absent_fields_only(spark, txn):
    absent, null = parse(spark, without(txn, "Device_Type", "Location", "International_Transaction", "Transaction_Status"),
                         {**txn, "Device_Type": None, "Location": None})
    assert (absent.Device_Type, absent.Location) == ("Android", "Lagos")
    assert (absent.International_Transaction, absent.Transaction_Status) == ("No", "Successful")
    assert null.Device_Type is None and null.Location is None and null._reasons == []
    refused, = parse(spark, {**txn, "International_Transaction": None})
    assert reasons(refused) == {("International_Transaction", "null")}


@pytest.mark.parametrize("change, reason", [
    ({"Amount_NGN": 0}, "not positive"), ({"Amount_NGN": -1.5}, "not positive"), ({"Amount_NGN": "x"}, "not a double"),
    ({"Amount_NGN": None}, "null"), ({"Amount_NGN": [1]}, "not a double"), ({"Channel": 5}, "not a string"),
    ({"Transaction_ID": None}, "null"), ({"Channel": {"a": 1}}, "not a string"),
])
def test_refused_fields(spark, txn, change, reason):
    row, = parse(spark, {**txn, **change})
    field = next(iter(change))
    assert reasons(row) == {(field, reason)}
    if reason != "not positive":
        assert row[field] is None


def test_required_fields(spark, txn):
    row, = parse(spark, without(txn, "Customer_ID", "Amount_NGN"))
    assert reasons(row) == {("Customer_ID", "missing"), ("Amount_NGN", "missing")}


def test_lenient_numbers(spark, txn):
    a, b, c = parse(spark, {**txn, "Amount_NGN": 7}, {**txn, "Amount_NGN": "12.5"}, {**txn, "Transaction_DateTime": 46023})
    assert (a.Amount_NGN, b.Amount_NGN, c.Transaction_DateTime) == (7.0, 12.5, 46023.0)
    assert not a._reasons and not b._reasons and not c._reasons


def test_payloads_that_are_no_object(spark):
    for row in parse(spark, "{", "[1]", "5", '"x"', "null", ""):
        assert reasons(row) == {("payload", "not a JSON object")} and row.Device_Type is None


def test_enriched_request_defaults(spark, txn):
    row, = parse(spark, {**txn, "Age": 50}, fields=rq.ENRICHED_FIELDS)
    assert row.Age == 50.0 and row.Gender == "Female" and row.Monthly_Income_Band == "250k-499k"
    assert row.Digital_Engagement_Score == 75.0 and row._reasons == []


def test_batches(spark, txn):
    good = json.dumps({"transactions": [txn, {**txn, "Amount_NGN": -1}, without(txn, "Location")]})
    df = spark.createDataFrame([(1, good), (2, "{}"), (3, "junk")], "n int, payload string")
    rows = rq.parse_batches(df).collect()
    assert sorted((r.n, len(r._reasons)) for r in rows) == [(1, 0), (1, 0), (1, 1), (2, 1), (3, 1)]
    assert {r._entry for r in rows if r.n == 1} == {0, 1, 2}


def test_accepted_and_refused(spark, txn):
    df = spark.createDataFrame([(json.dumps(txn),), ("junk",)], "payload string")
    parsed = rq.parse_requests(df)
    assert rq.accepted(parsed).count() == 1 and rq.refused(parsed).first().payload == "junk"
    # a filter on the outcome does not parse the text a second time
    plan = rq.accepted(parsed)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1
