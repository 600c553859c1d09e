import math
import statistics

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskflow.contract import CONTRACT
from riskflow.operators.clean import select_features
from riskflow.operators.features import FeaturePreparer, FeatureParams, fit_features, prepared_inputs, transform_vector, transform_wide
from riskflow.operators.median import exact_medians
from riskflow.sources.tables import from_records

HARD = [
    [1.0], [1.0, 2.0], [5.0] * 40, [1.0] * 20 + [9.0] * 20, [1.0] * 20 + [9.0] * 21, [0.0, 1e-300, 1e300],
    [-1e6] + [0.001 * i for i in range(50)] + [1e12], [float(i % 7) for i in range(100)], [-3.5, -2.5],
    [1.0, math.nextafter(1.0, 2.0)] * 10, [1.0, math.inf, math.inf, 2.0], [-math.inf] * 3 + [0.5, 0.7] * 4,
]


@pytest.mark.parametrize("values", HARD)
@pytest.mark.parametrize("buffered", [50_000, 3, 0])
def test_median_is_exact(spark, values, buffered):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    assert exact_medians(df, ["x"], buffered)["x"] == statistics.median(values)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.floats(-1e9, 1e9), st.integers(0, 5)), min_size=1, max_size=60))
def test_median_of_any_values(spark, rows):
    df = spark.createDataFrame([(a, float(b)) for a, b in rows], "a double, b double")
    got = exact_medians(df, ["a", "b"], buffered=2)
    assert got == {"a": statistics.median([a for a, _ in rows]), "b": statistics.median([float(b) for _, b in rows])}


def test_median_of_nothing(spark):
    df = spark.createDataFrame([(None, 1.0)], "a double, b double")
    assert exact_medians(df, ["a", "b"]) == {"a": None, "b": 1.0}


@pytest.fixture
def train(spark, enriched):
    rows = [enriched,
            {**enriched, "Transaction_DateTime": 46025.5, "Amount_NGN": 50000.0, "Channel": "POS", "Location": "Abuja",
             "Device_Type": None, "Age": 45.0},
            {**enriched, "Transaction_DateTime": 46026.75, "Amount_NGN": None, "Channel": "Web", "Location": "Kano", "Age": 28.0}]
    return from_records(spark, rows)


def matrix(df, params):
    return np.array([r[0] for r in transform_vector(df, params).select(vector_to_array("features")).collect()])


def test_fitted_statistics(train):
    p = fit_features(train)
    assert p.median["Amount_NGN"] == (8125.25 + 50000.0) / 2
    filled = [8125.25, 50000.0, p.median["Amount_NGN"]]
    assert p.mean["Amount_NGN"] == pytest.approx(np.mean(filled))
    assert p.scale["Amount_NGN"] == pytest.approx(np.std(filled))  # population deviation
    assert p.scale["Tenure_Months"] == 1.0  # constant
    assert p.levels["Device_Type"] == ["Missing", "iOS"] and p.levels["Channel"] == ["POS", "Web"]
    assert p.names()[:7] == list(CONTRACT.model_numeric)
    assert p.names()[7:9] == ["Transaction_Type_Card Purchase", "Channel_POS"]


def test_scaled_training_data_is_centred(train):
    p = fit_features(train)
    x = matrix(train, p)
    assert np.allclose(x[:, :7].mean(axis=0), 0)
    assert np.allclose(x[:, 0].std(), 1)
    assert x.shape == (3, len(p.names()))


def test_vector_equals_wide_columns(train):
    p = fit_features(train)
    wide = np.array([list(r) for r in transform_wide(train, p).collect()])
    assert transform_wide(train, p).columns == p.names()
    assert np.array_equal(matrix(train, p), wide)


def test_unseen_levels_are_zeros(spark, train, enriched):
    p = fit_features(train)
    odd = from_records(spark, {**enriched, "Channel": "VR", "Location": "Atlantis", "Customer_Segment": "Alien"})
    x = matrix(odd, p)
    assert x.shape == (1, len(p.names())) and not np.isnan(x).any()
    names = p.names()
    assert all(x[0][names.index(n)] == 0 for n in names if n.startswith(("Channel_", "Location_", "Customer_Segment_")))


def test_missing_values_are_imputed(spark, train, enriched):
    p = fit_features(train)
    gaps = from_records(spark, {**enriched, "Amount_NGN": float("nan"), "Age": None, "Device_Type": None,
                                "Monthly_Income_Band": None})
    x = matrix(gaps, p)[0]
    names = p.names()
    assert not np.isnan(x).any()
    assert x[0] == pytest.approx((p.median["Amount_NGN"] - p.mean["Amount_NGN"]) / p.scale["Amount_NGN"])
    assert x[names.index("Device_Type_Missing")] == 1
    # Missing is a level only where training had it
    assert sum(x[i] for i, n in enumerate(names) if n.startswith("Monthly_Income_Band_")) == 0


def test_all_null_numeric(spark, enriched):
    p = fit_features(from_records(spark, {**enriched, "Age": None}))
    assert p.median["Age"] == 0.0 and p.scale["Age"] == 1.0


def test_test_rows_use_train_statistics(spark, train, enriched):
    p = fit_features(train)
    rich = from_records(spark, [{**enriched, "Amount_NGN": 1e6}] * 5)
    x = matrix(rich, p)
    assert x[0][0] == pytest.approx((1e6 - p.mean["Amount_NGN"]) / p.scale["Amount_NGN"]) and x[0][0] > 5


def test_fit_comes_first(spark, train, tmp_path):
    f = FeaturePreparer()
    for call in (lambda: f.transform(train), lambda: f.save(spark, str(tmp_path / "f"))):
        with pytest.raises(RuntimeError):
            call()
    out = f.fit_transform(train)
    assert "features" in out.columns
    f.save(spark, str(tmp_path / "f"))
    assert FeaturePreparer.load(spark, str(tmp_path / "f")).params == f.params
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        FeatureParams.load(spark, str(tmp_path / "nothing"))


def test_prepared_inputs_and_selection(spark, enriched):
    df = prepared_inputs(from_records(spark, {**enriched, "Amount_NGN": "12"}))
    assert df.first().Amount_NGN == 12.0
    assert select_features(df).columns == list(CONTRACT.model_numeric + CONTRACT.categorical)
    assert len(select_features(df).columns) == 19


def test_full_domain_gives_sixty_features():
    from riskflow.catalog.setup import FROZEN
    assert len(FROZEN.names()) == 60


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(-1e4, 1e4), st.just(0.1)), min_size=1, max_size=40))
def test_moments_after_imputation(spark, values):
    from riskflow.operators.features import fit_moments
    from riskflow.operators.median import column_profile
    df = spark.createDataFrame([(v,) for v in values], "x double")
    profile = column_profile(df, ["x"])
    median = exact_medians(df, ["x"], profile=profile)["x"] or 0.0
    mean, scale = fit_moments(profile, {"x": median})
    filled = np.array([median if v is None else v for v in values])
    assert mean["x"] == pytest.approx(filled.mean(), abs=1e-9)
    assert scale["x"] == (1.0 if len(set(filled)) == 1 else pytest.approx(filled.std(), rel=1e-9))


def test_wide_columns_are_looked_up(spark, enriched):
    """Twelve thousand levels of one column: each has its place, unseen ones have none."""
    base = from_records(spark, enriched).drop("Location")
    df = base.crossJoin(spark.range(12_000).selectExpr("concat('place', id) as Location"))
    p = fit_features(df)
    assert len(p.levels["Location"]) == 12_000
    few = df.where("Location in ('place7', 'place11999')").unionByName(base.withColumn("Location", F.lit("nowhere")))
    rows = transform_vector(few, p).select("Location", "features").collect()
    names = p.names()
    for r in rows:
        on = [names[i] for i in r.features.toArray().nonzero()[0] if names[i].startswith("Location_")]
        assert len(r.features) == len(names) and on == ([] if r.Location == "nowhere" else [f"Location_{r.Location}"])


def test_rounding_is_saved(spark, train, tmp_path):
    made = FeaturePreparer(serial_rounding="micros").fit(train)
    made.save(spark, str(tmp_path / "features"))
    again = FeaturePreparer.load(spark, str(tmp_path / "features"))
    assert again.serial_rounding == again.params.serial_rounding == "micros"
