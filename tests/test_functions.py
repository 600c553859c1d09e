import math

import pytest
from pyspark.sql import functions as F, types as T

from riskflow.functions.numeric import double_literal, nan_to_null, number
from riskflow.functions.probability import label_number, recommended_action, review_flag, risk_tier, sigmoid
from riskflow.functions.time import night_flag, parse_time, serial_to_time, with_temporal_features


@pytest.mark.parametrize("text, value", [
    ("12", 12.0), (" 12 ", 12.0), ("1.0d", None), ("5f", None), ("nan", None), ("1,000", None), ("", None),
    ("0x1F", None), ("1_000", None), ("-.5e1", -5.0), ("+3.", 3.0), ("inf", math.inf), (None, None), ("1e5", 1e5),
])
def test_number_text(spark, text, value):
    df = spark.createDataFrame([(text,)], "a string")
    assert df.select(F.expr(number("a", T.StringType()))).first()[0] == value


def test_nan_is_missing(spark):
    df = nan_to_null(spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "a double, b int"))
    assert [tuple(r) for r in df.collect()] == [(None, 1), (2.0, 2)]
    assert df.schema["b"].dataType == T.IntegerType()


def test_double_literal_round_trip(spark):
    for v in (0.1, 1 / 3, 1e-300, 5e7, -2.5, 123456789.123456789):
        assert spark.sql(f"select {double_literal(v)}").first()[0] == v


def _hours(spark, serials, **kw):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(serials)], "i int, Transaction_DateTime double")
    out = with_temporal_features(df, **kw).orderBy("i").collect()
    return [(r.Transaction_Hour, r.Transaction_DayOfWeek, r.Is_Weekend) for r in out]


def test_serial_days(spark):
    # Thursday midnight, Saturday noon, Sunday 18:00, and no time at all
    assert _hours(spark, [46023.0, 46025.5, 46026.75, None, float("nan")]) == [
        (0, 3, 0), (12, 5, 1), (18, 6, 1), (12, 0, 0), (12, 0, 0)]


def test_every_full_hour(spark):
    serials = [46023 + k / 24 for k in range(24)]
    floor = [h for h, _, _ in _hours(spark, serials)]
    # stored a hair below the hour, these serials fall into the hour before
    early = {1, 4, 7, 10, 13, 16, 19, 22}
    assert floor == [k - 1 if k in early else k for k in range(24)]
    assert [h for h, _, _ in _hours(spark, serials, serial_rounding="micros")] == list(range(24))
    with pytest.raises(ValueError):
        _hours(spark, serials, serial_rounding="nearest")


def test_text_time_and_absent_column(spark):
    df = spark.createDataFrame([("2026-01-03 13:30:00",), ("junk",), (None,)], "Transaction_DateTime string")
    got = [tuple(r)[1:] for r in with_temporal_features(df).collect()]
    assert got == [(13, 5, 1), (12, 0, 0), (12, 0, 0)]
    assert tuple(with_temporal_features(df.select(F.lit(1).alias("x"))).first())[1:] == (12, 0, 0)
    assert df.select(parse_time("Transaction_DateTime")).collect()[1][0] is None


def test_serial_as_time_and_night(spark):
    df = spark.createDataFrame([(46025.5,)], "s double")
    assert str(df.select(serial_to_time("s")).first()[0]) == "2026-01-03 12:00:00"
    hours = spark.createDataFrame([(0,), (4,), (5,), (23,)], "Transaction_Hour int")
    assert [r[0] for r in hours.select(night_flag()).collect()] == [1, 1, 0, 0]


def test_decisions_at_the_edges(spark):
    p = [0.0, 0.2999, 0.30, 0.3499, 0.35, 0.69996, 0.70, 1.0]
    df = spark.createDataFrame([(x,) for x in p], "p double")
    c = F.col("p")
    rows = df.select(review_flag(c), risk_tier(c), recommended_action(c), F.bround(c, 4)).collect()
    assert [r[0] for r in rows] == ["No"] * 4 + ["Yes"] * 4
    assert [r[1] for r in rows] == ["Low", "Low", "Medium", "Medium", "Medium", "Medium", "High", "High"]
    assert rows[5][3] == 0.7  # rounds up to the bound but stays Medium
    assert {r[2] for r in rows} == {
        "Auto-Approve", "Secondary Verification (SMS/OTP)", "Immediate Review / Payment Hold"}


def test_sigmoid(spark):
    got = spark.range(1).select(sigmoid(F.lit(0.0)), sigmoid(F.lit(800.0)), sigmoid(F.lit(-800.0))).first()
    assert tuple(got) == (0.5, 1.0, 0.0)


def test_labels(spark):
    df = spark.createDataFrame([("Yes",), ("No",)], "y string")
    assert [r[0] for r in df.select(label_number(F.col("y"))).collect()] == [1, 0]
    odd = spark.createDataFrame([("Maybe",), (None,), ("yes",)], "y string")
    assert [r[0] for r in odd.select(label_number(F.col("y"), unmapped="zero")).collect()] == [0, 0, 0]
    with pytest.raises(Exception, match="unmapped target value: Maybe"):
        odd.where("y = 'Maybe'").select(label_number(F.col("y"))).collect()
