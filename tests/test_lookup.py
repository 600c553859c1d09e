import pytest
from pyspark.sql import functions as F

from riskflow.operators import layout, lookup as lk
from riskflow.operators.clean import clean_key, redact_pii
from riskflow.plans.prepare import enriched
from riskflow.sources.tables import from_records

FACT = "Transaction_ID string, Customer_ID string"


@pytest.fixture
def fact(spark):
    # half of the rows share one key, some have none, some have no partner
    rows = [(f"T{i}", "C1" if i % 2 == 0 else None if i % 9 == 0 else f"C{i % 20}") for i in range(400)]
    return spark.createDataFrame(rows, FACT)


@pytest.fixture
def dim(spark):
    return spark.createDataFrame([(f"C{i}", float(20 + i)) for i in range(15)], "Customer_ID string, Age double")


def rows(df):
    return sorted(tuple(map(str, r)) for r in df.select("Transaction_ID", "Customer_ID", "Age").collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_all_strategies_agree(fact, dim):
    ages = {f"C{i}": float(20 + i) for i in range(15)}
    want = sorted([(t, str(c), str(ages.get(c))) for t, c in fact.collect()])
    small = lk.lookup_join(fact, dim, "Customer_ID")
    assert rows(small) == want and "BroadcastHashJoin" in plan(small)
    for share in (0.001, 0.3, 0.9):
        large = lk.lookup_join(fact, dim, "Customer_ID", broadcast_bytes=0, share=share)
        assert rows(large) == want, share


def test_hot_keys_are_bounded_and_found(fact):
    assert lk.hot_keys(fact, "Customer_ID", 0.3) == ["C1"]
    assert len(lk.hot_keys(fact, "Customer_ID", 0.01)) <= 100


def test_size_is_measured(spark, dim):
    assert 15 * 8 < lk.measured_bytes(dim) < 15 * 60
    assert lk.measured_bytes(dim.limit(0)) == 0


def test_fan_out(spark, fact, dim):
    twice = dim.union(dim.where("Customer_ID = 'C3'"))
    with pytest.raises(ValueError, match="C3"):
        lk.enrich_strict(fact, twice)
    assert [tuple(r) for r in lk.duplicate_keys(twice, "Customer_ID").collect()] == [("C3", 2)]
    # a repeated key that no row refers to does no harm
    unused = dim.union(spark.createDataFrame([("X", 1.0), ("X", 2.0), (None, 1.0), (None, 2.0)], dim.schema))
    assert lk.enrich_strict(fact, unused).count() == 400


def test_clashing_columns_get_a_suffix(spark, dim):
    fact = spark.createDataFrame([("T1", "C1", 5.0)], FACT + ", Age double")
    assert lk.enrich_strict(fact, dim).first().asDict() == {
        "Transaction_ID": "T1", "Customer_ID": "C1", "Age": 5.0, "Age_cust": 21.0}


def test_padded_keys_join_null_keys_do_not(spark, txn, profile):
    t = from_records(spark, [{**txn, "Customer_ID": " who-1 "}, {**txn, "Customer_ID": None}])
    c = from_records(spark, [profile, {**profile, "Customer_ID": None}])
    out = enriched(t, c)
    assert sorted(str(r.Age) for r in out.collect()) == ["41.0", "None"]
    assert "Customer_Name" not in out.columns and "Customer_Name" not in redact_pii(c).columns
    assert redact_pii(t).columns == t.columns
    assert clean_key(t).where("Customer_ID is null").count() == 1


def test_first_of_duplicates_wins(spark, txn, profile):
    c = from_records(spark, [{**profile, "Age": 50.0, "seq": 2.0}, {**profile, "Age": 40.0, "seq": 1.0}])
    out = lk.enrich_lookup(from_records(spark, txn), c, order_by=["seq"])
    assert out.first().Age == 40.0 and out.count() == 1 and "seq" not in out.columns
    assert lk.first_per_key(c, "Customer_ID", ["seq"]).first().Age == 40.0
    assert plan(lk.first_per_key(c, "Customer_ID", ["seq"])).count("WindowGroupLimit") == 2


def test_lookup_only_where_needed(spark, txn, enriched, profile):
    c = from_records(spark, profile)
    whole = from_records(spark, enriched)
    assert lk.enrich_lookup(whole, c) is whole
    raw = from_records(spark, txn)
    assert lk.enrich_lookup(raw, None) is raw
    no_key = raw.drop("Customer_ID")
    assert lk.enrich_lookup(no_key, c) is no_key


def test_partly_enriched_input_is_filled(spark, txn, profile):
    rows = [{**txn, "Age": 22.0}, {**txn, "Age": None, "Customer_ID": "who-1"}]
    got = lk.enrich_lookup(from_records(spark, rows), from_records(spark, profile))
    assert sorted(r.Age for r in got.collect()) == [22.0, 41.0]
    assert {r.Gender for r in got.collect()} == {"Female"}


def test_rates_and_orphans(spark, fact, dim):
    c = dim.withColumn("Account_Type", F.expr("if(Customer_ID = 'C1', null, 'Savings')"))
    keys = [r.Customer_ID for r in fact.collect()]
    known = {f"C{i}" for i in range(15)}
    for limit in (lk.BROADCAST_BYTES, 0):
        r = lk.match_rate(fact, c, broadcast_bytes=limit).first()
        assert r.total == 400 and r.matched == sum(k in known for k in keys)
        assert r.match_rate == pytest.approx(100 * r.matched / 400)
        assert r.proxy_rate == pytest.approx(100 * sum(k in known - {"C1"} for k in keys) / 400)
        assert lk.orphans(fact, c, broadcast_bytes=limit).count() == sum(k not in known for k in keys)


def test_colocated_tables_are_not_shuffled(fact, dim, tmp_path):
    spark = fact.sparkSession
    ages = {f"C{i}": float(20 + i) for i in range(15)}
    for share in (0.001, 0.3, 0.9):
        layout.write_colocated(fact, dim.unionByName(dim.limit(1).withColumn("Customer_ID", F.lit(None))), "Customer_ID", "together", str(tmp_path / str(share)), buckets=6, share=share)
        found = layout.join_colocated(spark, "Customer_ID", "together")
        assert "Exchange" not in plan(found) and "SortMergeJoin" in plan(found)
        assert rows(found) == sorted((t, str(c), str(ages.get(c))) for t, c in fact.collect())
        alone = layout.join_colocated(spark, "Customer_ID", "together", "left_anti")
        assert "Exchange" not in plan(alone)
        assert sorted(r.Transaction_ID for r in alone.collect()) == sorted(t for t, c in fact.collect() if c not in ages)
