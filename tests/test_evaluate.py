import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from riskflow.operators import evaluate as ev


def frame(spark, pairs):
    return spark.createDataFrame([(int(y), float(p)) for y, p in pairs], "label int, probability double")


def auc_by_pairs(pairs):
    pos = [p for y, p in pairs if y == 1]
    neg = [p for y, p in pairs if y == 0]
    return sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))


def sample(n, digits, seed=0):
    r = random.Random(seed)
    return [(int(r.random() < 0.3), round(min(1.0, max(0.0, r.gauss(0.4, 0.2))), digits)) for _ in range(n)]


@pytest.mark.parametrize("digits", [1, 2, 12])
@pytest.mark.parametrize("bounds", [None, [], [0.4], [0.1, 0.2, 0.4, 0.5, 0.9]])
def test_auc_counts_pairs(spark, digits, bounds):
    pairs = sample(300, digits)
    df = frame(spark, pairs)
    row = ev.evaluate(df, bounds=bounds).first()
    assert row.roc_auc == pytest.approx(auc_by_pairs(pairs), abs=1e-12)
    assert row.brier_score == pytest.approx(np.mean([(p - y) ** 2 for y, p in pairs]))
    assert tuple(ev.confusion(df).first()) == (row.tn, row.fp, row.fn, row.tp)


def test_auc_with_a_third_of_rows_on_one_score(spark):
    pairs = sample(200, 3) + [(i % 2, 0.5) for i in range(100)]
    assert ev.evaluate(frame(spark, pairs)).first().roc_auc == pytest.approx(auc_by_pairs(pairs), abs=1e-12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 1), st.sampled_from([0.0, 0.1, 0.35, 0.5, 0.9, 1.0])), min_size=1, max_size=30))
def test_auc_of_anything(spark, pairs):
    got = ev.evaluate(frame(spark, pairs)).first().roc_auc
    assert got is None if len({y for y, _ in pairs}) < 2 else got == pytest.approx(auc_by_pairs(pairs))


def test_score_ranges_are_bounded(spark):
    df = frame(spark, [(i % 2, i / 5000) for i in range(5000)])
    bounds = ev.score_bounds(df, ranges=16)
    edges = [-1, *bounds, 2]
    sizes = [sum(a <= i / 5000 < b for i in range(5000)) for a, b in zip(edges, edges[1:])]
    assert len(bounds) == 15 and max(sizes) < 2 * 5000 / 16


def test_empty(spark):
    row = ev.evaluate(frame(spark, []).limit(0)).first()
    assert row.roc_auc is None and row.tp == 0


def test_threshold_is_inclusive(spark):
    row = ev.confusion(frame(spark, [(1, 0.35), (0, 0.35), (1, 0.3499), (0, 0.1)])).first()
    assert (row.tn, row.fp, row.fn, row.tp) == (1, 1, 1, 1)


def test_ratios(spark):
    # published confusion counts of the production model, and the ratios that go with them
    counts = spark.createDataFrame([(759, 1171, 77, 393)], "tn long, fp long, fn long, tp long")
    r = ev.class_metrics(counts).first()
    assert (round(r.precision, 4), round(r.recall, 4), round(r.f1_score, 4)) == (0.2513, 0.8362, 0.3864)
    none = ev.class_metrics(spark.createDataFrame([(5, 0, 0, 0)], counts.schema)).first()
    assert (none.precision, none.recall, none.f1_score) == (0.0, 0.0, 0.0)


def test_metric_record(spark):
    pairs = sample(200, 4)
    m = ev.metrics(frame(spark, pairs)).first()
    assert m.roc_auc == round(auc_by_pairs(pairs), 4) and m.decision_threshold == 0.35
    (tn, fp), (fn, tp) = m.confusion_matrix
    assert tn + fp + fn + tp == 200 and m.recall == round(tp / (tp + fn), 4)
    other = ev.metrics(frame(spark, [(y, 1 - p) for y, p in pairs]))
    c = ev.compare(ev.metrics(frame(spark, pairs)), other).first()
    assert c.improvement_roc_auc == pytest.approx(c.candidate_roc_auc - c.baseline_roc_auc, abs=1e-4)
    assert c.baseline_f1 == other.first().f1_score


def test_sweep_and_range(spark):
    pairs = sample(100, 3)
    df = frame(spark, pairs)
    rows = {r.threshold: r for r in ev.threshold_sweep(df, [0.2, 0.35, 0.5]).collect()}
    assert rows[0.2].recall >= rows[0.35].recall >= rows[0.5].recall
    assert rows[0.35].tp == ev.confusion(df).first().tp
    assert tuple(ev.probability_range(df).first()) == (min(p for _, p in pairs), max(p for _, p in pairs))


def test_class_weights_and_counts(spark):
    df = frame(spark, [(1, 0.5)] * 10 + [(0, 0.5)] * 30)
    w = {r.label: r.weight for r in ev.class_weights(df).collect()}
    assert w == {1: 2.0, 0: pytest.approx(40 / 60)}
    assert {r.label: r.share for r in ev.class_counts(df, "label").collect()} == {1: 0.25, 0: 0.75}
