import hashlib
import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from riskflow.operators.split import append_split, find_cuts, freeze_cuts, needs_cut, split_drift, stratified_split
from riskflow.sources import testviews as views


def by_hand(rows, fraction=0.2, seed=42):
    """Ids of the test part: the smallest hashes of each class."""
    classes = defaultdict(list)
    for i, y in rows:
        classes[y].append((hashlib.md5(f"{i}|{seed}".encode()).hexdigest(), i))
    n = len(rows)
    wanted = math.ceil(round(n * fraction, 6))
    exact = {y: len(hs) * wanted / n for y, hs in classes.items()}
    take = {y: int(e + 1e-9) for y, e in exact.items()}
    for y in sorted(exact, key=lambda y: (-round(exact[y] - take[y], 9), y is not None, str(y)))[:wanted - sum(take.values())]:
        take[y] += 1
    return {i for y, hs in classes.items() for _, i in sorted(hs)[:take[y]]}


def test_size_of_the_test_part(spark):
    df = spark.range(12).selectExpr("concat('T', id) as Transaction_ID", "if(id < 6, 'Yes', 'No') as Risk_Review_Flag")
    assert stratified_split(df).where("split = 'test'").count() == 3
    assert stratified_split(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="single row"):
        stratified_split(df.where("id <= 6"))


@pytest.fixture
def table(spark):
    # one class holds most rows, one is tiny, one is NULL
    rows = [(f"T{i}", "Yes" if i % 5 == 0 else None if i % 97 == 0 else "Rare" if i in (1, 2, 3) else "No") for i in range(3000)]
    return spark.createDataFrame(rows, "Transaction_ID string, Risk_Review_Flag string")


@pytest.mark.parametrize("ranked_rows", [100_000, 50, 0])
@pytest.mark.parametrize("fraction, seed", [(0.2, 42), (0.5, 7), (0.0, 1), (1.0, 1)])
def test_same_as_ranking(table, ranked_rows, fraction, seed):
    rows = [tuple(r) for r in table.collect()]
    out = stratified_split(table, fraction=fraction, seed=seed, ranked_rows=ranked_rows).collect()
    assert len(out) == 3000
    assert {r.Transaction_ID for r in out if r.split == "test"} == by_hand(rows, fraction, seed)


def test_does_not_depend_on_layout(table):
    want = sorted(map(tuple, stratified_split(table).collect()), key=str)
    assert sorted(map(tuple, stratified_split(table.repartition(7)).collect()), key=str) == want


@pytest.mark.parametrize("copies", [1, 3])
def test_rows_sharing_one_id_are_divided_exactly(spark, copies):
    # every row of the table has the same id: only numbering the rows can divide them
    df = spark.range(1000).repartition(5).selectExpr("'T' as Transaction_ID", f"id % {copies} as v", "'No' as Risk_Review_Flag")
    out = stratified_split(df)
    assert Counter(r.split for r in out.collect()) == {"test": 200, "train": 800}
    assert out.columns == df.columns + ["split"]


def test_null_ids(spark):
    df = spark.range(100).selectExpr("if(id < 60, null, concat('T', id)) as Transaction_ID", "'No' as Risk_Review_Flag")
    assert stratified_split(df).where("split = 'test'").count() == 20


def test_no_target_is_all_train(spark):
    out = stratified_split(spark.range(10).selectExpr("string(id) as Transaction_ID"))
    assert {r.split for r in out.collect()} == {"train"}


def test_rows_are_only_filtered(spark, sf):
    out = stratified_split(views.transactions(spark, sf))
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_counters_are_few(spark, sf):
    txn = views.transactions(spark, sf)
    cuts = find_cuts(txn, "Risk_Review_Flag", "Transaction_ID")
    assert len(cuts) == 2 and all(c.take in (0, 1) for c in cuts)
    n = {r[0]: r[1] for r in txn.groupBy("Risk_Review_Flag").count().collect()}
    got = {r[0]: r[1] for r in stratified_split(txn).where("split = 'test'").groupBy("Risk_Review_Flag").count().collect()}
    assert sum(got.values()) == math.ceil(sum(n.values()) * 0.2) and all(abs(got[y] - c * 0.2) < 1 for y, c in n.items())


def sides(df):
    return {r.Transaction_ID: r.split for r in df.collect()}


def test_later_rows_join_a_split(spark, table):
    for ranked in (0, 100_000):
        cuts = freeze_cuts(table, ranked_rows=ranked)
        assert sides(append_split(table, cuts)) == sides(stratified_split(table))  # old rows stay where they are
    kinds = {r.label: r for r in cuts.collect()}
    assert sum(r.rows for r in kinds.values()) == 3000 and set(kinds) == {"Yes", "No", "Rare", None}
    later = spark.range(3000, 9000).selectExpr("concat('T', id) as Transaction_ID", "case id % 3 when 0 then 'Yes' when 1 then 'No' else 'New' end as Risk_Review_Flag")
    found = append_split(later, cuts)
    for r in found.collect():
        h, c = hashlib.md5(f"{r.Transaction_ID}|42".encode()).hexdigest(), kinds.get(r.Risk_Review_Flag)
        assert r.split == ("test" if (h <= c.hash if c else h < f"{int(0.2 * 2**128):032x}") else "train")
    drift = split_drift(append_split(table, cuts), cuts)
    assert all(abs(r.off) <= 1 for r in drift.collect()) and not needs_cut(drift)
    assert needs_cut(split_drift(found.withColumn("split", F.lit("test")), cuts))
    with pytest.raises(ValueError, match="empty"):
        append_split(later, freeze_cuts(table.limit(0)))


def test_a_divided_id_joins_the_train_part(spark):
    rows = spark.range(100).selectExpr("'same' as Transaction_ID", "'Yes' as Risk_Review_Flag")
    cuts = freeze_cuts(rows)
    assert [c.whole for c in cuts.collect()] == [False]
    assert append_split(rows, cuts).where("split = 'test'").count() == 0
