import math
import random

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from riskflow.functions.order_key import key_of, value_of, with_keys
from riskflow.operators import evaluate as ev
from riskflow.operators.median import exact_medians

EDGES = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.0, math.nextafter(1, 0), math.nextafter(1, 2), 2.0, math.nextafter(2, 0),
         1.7976931348623157e308, -1.7976931348623157e308, math.inf, -math.inf, 0.1, 1 / 3, 1e-300, 4503599627370496.5, 2.0 ** 1023, 2.0 ** -1022, 2.0 ** -1074]


def keys(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    return [r.k for r in with_keys(df, {"k": "x"}).orderBy("i").collect()]


def test_keys_of_edges(spark):
    powers = [m * 2.0 ** e for e in range(-1074, 1024, 3) for m in (1.0, 1.999999, 1.0000001)]
    values = EDGES + powers + [-p for p in powers]
    assert keys(spark, values + [None]) == [key_of(v) for v in values] + [None]
    assert keys(spark, [math.nan]) == [key_of(math.nan)] and key_of(math.nan) > key_of(math.inf)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False), min_size=2, max_size=200))
def test_keys_sort_alike(spark, values):
    found = keys(spark, values)
    assert found == [key_of(v) for v in values] and [value_of(k) for k in found] == values
    assert all((a < b) == (x < y) for a, x in zip(found, values) for b, y in zip(found, values))


def test_medians_of_any_distribution_in_six_passes(spark, monkeypatch):
    from riskflow.operators import median
    rng = random.Random(3)
    columns = [[rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300) for _ in range(999)], [2.0 ** (i - 500) for i in range(999)],
               [rng.choice([1.0, math.nextafter(1, 2), math.nextafter(1, 0)]) for _ in range(999)], [-1e308 if i % 2 else 1e308 for i in range(999)], [0.0] * 999]
    passes = []
    narrow = median._narrow
    monkeypatch.setattr(median, "_narrow", lambda src, ranks: (passes.append(len(ranks)), narrow(src, ranks)))
    df = spark.createDataFrame(list(zip(*columns)), ", ".join(f"c{i} double" for i in range(5))).repartition(3)
    assert exact_medians(df, df.columns, buffered=1) == {f"c{i}": sorted(c)[499] for i, c in enumerate(columns)}
    assert 1 <= len(passes) <= 6


def test_auc_reads_the_rows_once_and_needs_no_bounds(spark, tmp_path):
    rng = random.Random(4)
    pairs = [(int(rng.random() < 0.4), p) for p in [rng.random() * 10.0 ** -rng.randint(0, 40) for _ in range(400)] + [0.0, 1.0, 0.5, math.nextafter(0.5, 1)] * 3]
    df = spark.createDataFrame(pairs, "label int, probability double")
    won = sum((a > b) + (a == b) / 2 for y, a in pairs if y for z, b in pairs if not z)
    want = won / (sum(y for y, _ in pairs) * sum(1 - y for y, _ in pairs))
    assert abs(ev.roc_auc(df).first()[0] - want) < 1e-12
    df.write.parquet(str(tmp_path / "t"))
    plan = ev.evaluate(spark.read.parquet(str(tmp_path / "t")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange SinglePartition") <= 2


def test_auc_refuses_missing_scores(spark):
    for bad in (None, math.nan):
        df = spark.createDataFrame([(1, 0.5), (0, bad)], "label int, probability double")
        try:
            ev.roc_auc(df).collect()
        except Exception as e:
            assert "no score" in str(e)
        else:
            raise AssertionError(bad)
