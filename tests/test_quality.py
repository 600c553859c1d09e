import pytest
from pyspark.sql import functions as F

from riskflow.operators import quality as dq
from riskflow.plans.validate import DataValidationError, validate
from riskflow.sources.tables import from_records


def check(spark, records, **kw):
    kw.setdefault("strict", False)
    return validate(from_records(spark, records), **kw)


def found(report, kind="errors"):
    return {(e["field"], e["error_type"], e["invalid_rows_count"]) for e in report[kind]}


def test_valid(spark, txn, enriched):
    for record, kind in ((txn, "transaction"), (enriched, "enriched"), (txn, "auto"), (enriched, "auto")):
        r = check(spark, record, dataset_type=kind, strict=True)
        assert r["is_valid"] and r["action_taken"] == "PROCEED" and not r["errors"] and r["total_records"] == 1


def test_missing_feature_warns_missing_key_rejects(spark, txn):
    r = check(spark, {**txn, "Device_Type": None})
    assert r["is_valid"] and found(r, "warnings") == {("Device_Type", "MISSING_VALUES", 1)}
    assert "1 (100.00%) missing values" in r["warnings"][0]["message"]
    with pytest.raises(DataValidationError) as e:
        check(spark, {**txn, "Transaction_ID": None}, strict=True)
    assert found(e.value.report) == {("Transaction_ID", "NULL_PRIMARY_KEY", 1)}
    assert e.value.report["action_taken"] == "REJECT_ALL"
    r = check(spark, [{**txn, "Customer_ID": "  "}, {**txn, "Customer_ID": ""}, txn])
    assert found(r) == {("Customer_ID", "NULL_PRIMARY_KEY", 2)} and r["action_taken"] == "QUARANTINE_RECORDS"


def test_unexpected_categories(spark, txn, enriched):
    r = check(spark, [{**txn, "Channel": "Telepathy"}, {**txn, "Channel": "pos"}, {**txn, "Channel": "Telepathy"}],
              order=["Channel"])
    assert found(r) == {("Channel", "UNEXPECTED_CATEGORY", 3)}
    assert r["errors"][0]["sample_invalid_values"] == ["Telepathy", "pos"]
    assert r["errors"][0]["message"] == ("Column 'Channel' contains unexpected categories in 3 rows. "
                                         "Distinct values: 2 (bad_categories lists them).")
    r = check(spark, {**enriched, "Customer_Segment": "VIP"}, dataset_type="enriched")
    assert found(r) == {("Customer_Segment", "UNEXPECTED_CATEGORY", 1)}
    # rules apply to every column present, whatever the kind of table
    r = check(spark, {**enriched, "Gender": "?"}, dataset_type="transaction")
    assert ("Gender", "UNEXPECTED_CATEGORY", 1) in found(r)


@pytest.mark.parametrize("value, bad", [("Lagos ", True), ("lagos", True), ("", True), ("Lagos", False), (None, False)])
def test_categories_match_exactly(spark, txn, value, bad):
    assert bool(check(spark, {**txn, "Location": value})["errors"]) is bad


def test_wrong_type(spark, txn):
    r = check(spark, [{**txn, "Amount_NGN": v} for v in ("fifty", "1,000", "", "12", " 12 ", "nan", None)],
              order=["Amount_NGN"])
    assert ("Amount_NGN", "INCORRECT_DATA_TYPE", 4) in found(r)
    assert found(r, "warnings") == {("Amount_NGN", "MISSING_VALUES", 1)}
    e = [x for x in r["errors"] if x["error_type"] == "INCORRECT_DATA_TYPE"][0]
    assert set(e["sample_invalid_values"]) == {"fifty", "1,000", "", "nan"}


@pytest.mark.parametrize("column, values", [
    ("Amount_NGN", {0.0: True, 0.001: False, 0.01: False, 5e7: False, 50000000.01: True, -500.0: True, float("nan"): False}),
    ("Age", {17.99: True, 18.0: False, 100.0: False, 100.01: True, 12.0: True}),
    ("Tenure_Months", {-1.0: True, 0.0: False, 9999.0: False}),
    ("Digital_Engagement_Score", {-0.01: True, 0.0: False, 100.0: False, 100.01: True}),
])
def test_ranges(spark, enriched, column, values):
    for value, bad in values.items():
        r = check(spark, {**enriched, column: value})
        assert found(r) == ({(column, "OUT_OF_RANGE", 1)} if bad else set()), value
        if bad:
            assert r["errors"][0]["sample_invalid_values"] == [str(value) if value != 50000000.01 else "5.000000001E7"]


def test_nan_counts_as_missing_and_never_as_too_large(spark, enriched):
    df = spark.createDataFrame([{**enriched, "Amount_NGN": float("nan")}])  # not read through a source
    r = validate(df, strict=False)
    assert not r["errors"] and found(r, "warnings") == {("Amount_NGN", "MISSING_VALUES", 1)}


def test_empty(spark, txn):
    df = from_records(spark, txn).limit(0)
    for data in (None, df, spark.createDataFrame([], "a int")):
        r = validate(data, strict=False)
        assert r["action_taken"] == "REJECT_ALL" and r["total_records"] == 0
        assert ("Dataset", "EMPTY_DATASET", 0) in found(r)
    with pytest.raises(DataValidationError):
        validate(df)


def test_columns(spark, txn, enriched):
    short = {k: v for k, v in txn.items() if k != "Channel"}
    r = check(spark, {**short, "Amount_NGN": -1.0, "Branch": "x"})
    # missing columns end the checks, and lenient mode rejects too
    assert [e["error_type"] for e in r["errors"]] == ["MISSING_COLUMNS"] and r["action_taken"] == "REJECT_ALL"
    assert r["errors"][0]["sample_invalid_values"] == ["Channel"] and r["total_records"] == 1
    assert r["warnings"][0]["sample_invalid_values"] == ["Branch"]
    r = check(spark, {**enriched, "City": "Lagos"}, dataset_type="enriched")
    assert r["is_valid"] and r["warnings"][0]["error_type"] == "UNEXPECTED_COLUMNS"
    r = check(spark, enriched, dataset_type="enriched", training=True)
    assert r["errors"][0]["sample_invalid_values"] == ["Risk_Review_Flag"]
    assert check(spark, {**txn, "Risk_Review_Flag": "No"})["warnings"] == []  # the target is never unexpected


def test_customer_table(spark, profile):
    r = check(spark, profile, dataset_type="customer")
    assert r["is_valid"] and r["warnings"][0]["sample_invalid_values"] == ["Customer_Name", "City"]
    with pytest.raises(ValueError):
        check(spark, profile, dataset_type="branch")


def test_samples_are_the_first_five(spark, txn):
    df = from_records(spark, [{**txn, "Amount_NGN": -float(i)} for i in range(1, 9)]).withColumn("_row", F.expr("-Amount_NGN"))
    got = dq.samples(df, order=["_row"]).orderBy("position").collect()
    assert [(r.position, r.value) for r in got] == [(i, f"-{i}.0") for i in range(1, 6)]
    plan = dq.samples(df, order=["_row"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # tasks cut to five rows before the shuffle


def test_many_bad_categories_are_all_listed(spark, txn):
    base = from_records(spark, txn).drop("Channel")
    df = base.join(spark.range(300).selectExpr("id as _row", "concat('bad', id) as Channel"))
    assert dq.bad_categories(df, order=["_row"]).count() == 300
    r = validate(df, strict=False, order=["_row"])
    text = r["errors"][0]["message"]
    assert text == "Column 'Channel' contains unexpected categories in 300 rows. Distinct values: 300 (bad_categories lists them)."
    assert r["errors"][0]["sample_invalid_values"] == [f"bad{i}" for i in range(5)]


def test_quarantine_splits_all_rows(spark, enriched):
    rows = [enriched, {**enriched, "Age": 12.0, "Channel": "Fax"}, {**enriched, "Transaction_ID": " "},
            {**enriched, "Device_Type": None}]
    flagged = dq.with_row_issues(from_records(spark, rows))
    good, bad = dq.clean_rows(flagged), dq.quarantined_rows(flagged)
    assert good.count() == 2 and bad.count() == 2 and "_issues" not in good.columns
    both = {(i.field, i.error_type, i.value) for r in bad.collect() for i in r._issues}
    assert both == {("Age", "OUT_OF_RANGE", "12.0"), ("Channel", "UNEXPECTED_CATEGORY", "Fax"),
                    ("Transaction_ID", "NULL_PRIMARY_KEY", None)}


def test_counts_need_no_shuffle_of_rows(spark, sf):
    from riskflow.catalog.setup import dirty_enriched
    df = dirty_enriched(spark, sf)
    rules = dq.rules_for(df, dq.CONTRACT.variant(df.columns))
    assert len(rules) == 38
    plan = dq.issue_counts(df, rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") == 1  # the partial counters only


def dirty(spark, txn, n=60):
    """Rows with every kind of error, ties in time, and values that come first in one part and last in another."""
    base = from_records(spark, txn).drop("Amount_NGN", "Channel", "Location", "Transaction_ID")
    return base.join(spark.range(n).selectExpr(
        "id as _row", "pmod(id * 37, 7) as lead", "id % 4 as part", "concat('t', id) as Transaction_ID",
        "case when id % 5 = 0 then 'none' when id % 7 = 0 then cast(-id as string) when id % 11 = 0 then null else '12' end as Amount_NGN",
        "case when id % 3 = 0 then concat('c', pmod(id * 13, 10)) else 'POS' end as Channel",
        "case when id % 17 = 0 then 'Nowhere' else 'Lagos' end as Location"))


def test_report_reads_the_table_once(spark, txn, tmp_path, monkeypatch):
    place = str(tmp_path / "t")
    dirty(spark, txn).write.parquet(place)
    table, plans = spark.read.parquet(place), []

    def plan_of(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    monkeypatch.setattr(dq, "stored", lambda df, name, keep=dq.stored: (plans.append(plan_of(df)), keep(df, name))[1])
    report = dq.report(table, strict=False, order=["_row"])
    assert len(plans) == 1 and plans[0].count("Relation [") == 1 and "Aggregate [rule" in plans[0]
    assert "Device_Type#" in plans[0] and "Device_Type#" not in plan_of(report)  # the rest comes from the written cells
    assert report.first().total_records == 60


@pytest.mark.parametrize("order", [["_row"], ["lead", "_row"], ["lead", "Transaction_ID"]])
def test_listed_values_by_any_order(spark, txn, order):
    df = dirty(spark, txn).withColumn("lead", F.expr("nullif(lead, 3)"))
    want = {}
    for r in df.collect():
        at = tuple((getattr(r, c) is not None, getattr(r, c)) for c in order)
        for field, value in (("Channel", r.Channel), ("Location", r.Location)):
            if value.startswith("c") or value == "Nowhere":
                n, first = want.get((field, value), (0, at))
                want[field, value] = (n + 1, min(first, at))
    got = {(r.field, r.value): (r.n, tuple((v is not None, v) for v in r._at)) for r in dq.bad_categories(df, order=order).collect()}
    assert got == want
    rules = [r for r in dq.rules_for(df, dq.CONTRACT.variant(df.columns)) if r.error_type == dq.BAD_CATEGORY]
    hits = dq.violations(df, rules, order).withColumn("n", F.lit(1))
    plan = dq.listed_values(dq.stored(hits, "hits"), order)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[field" in plan  # the whole is counted without sorting it


def flat(report):
    return {**report, "errors": sorted(map(str, report["errors"])), "warnings": sorted(map(str, report["warnings"]))}


@pytest.mark.parametrize("order", [["_row"], ["lead", "Transaction_ID"]])
def test_growing_table(spark, txn, tmp_path, monkeypatch, order):
    from riskflow.operators import quality_state
    from riskflow.plans.validate import validate_growing
    place, ledger = str(tmp_path / "t"), str(tmp_path / "ledger")
    whole = dirty(spark, txn)
    read = []
    monkeypatch.setattr(quality_state, "state", lambda df, rules, order, keep=quality_state.state: (read.append({r[0] % 4 for r in df.select("_row").collect()}), keep(df, rules, order))[1])
    whole.where("part < 2").write.partitionBy("part").parquet(place)
    schema = whole.schema
    first = validate_growing(spark.read.schema(schema).parquet(place), "part", ledger, strict=False, order=order)
    assert flat(first) == flat(validate(whole.where("part < 2").drop("part"), strict=False, order=order))
    whole.where("part >= 2").write.mode("append").partitionBy("part").parquet(place)
    grown = validate_growing(spark.read.schema(schema).parquet(place), "part", ledger, strict=False, order=order)
    assert flat(grown) == flat(validate(whole.drop("part"), strict=False, order=order))
    assert grown["error_count"] >= 4 and read == [{0}, {1}, {2}, {3}]  # each part has been read once
    again = validate_growing(spark.read.schema(schema).parquet(place), "part", ledger, strict=False, order=order)
    assert again == grown and len(read) == 4
    quality_state.Ledger(spark, ledger).forget("1")
    assert flat(validate_growing(spark.read.schema(schema).parquet(place), "part", ledger, strict=False, order=order)) == flat(grown) and read[4:] == [{1}]
    with pytest.raises(DataValidationError):
        validate_growing(spark.read.schema(schema).parquet(place), "part", ledger, order=order)


def test_growing_table_without_rows_or_columns(spark, txn, tmp_path):
    from riskflow.plans.validate import validate_growing
    none = dirty(spark, txn).limit(0)
    assert validate_growing(none, "part", str(tmp_path / "a"), strict=False)["errors"][0]["error_type"] == "EMPTY_DATASET"
    short = dirty(spark, txn).drop("Device_Type")
    found = validate_growing(short, "part", str(tmp_path / "b"), strict=False)
    assert [e["error_type"] for e in found["errors"]] == ["MISSING_COLUMNS"] and found["total_records"] == 60
    good = from_records(spark, [txn, txn]).withColumn("part", F.lit(None).cast("string"))
    assert validate_growing(good, "part", str(tmp_path / "c"))["is_valid"]
