"""Versions of artifacts that appear as one, and a stream whose dimension changes between two batches."""

import json
from pathlib import Path

import pytest

from riskflow.artifacts import manifest, newest, prune, publish, versions
from riskflow.catalog import setup as s
from riskflow.models.scorers import ExternalScorer, read_json, write_json
from riskflow.plans.score import ScoringJob
from riskflow.streaming.score import decisions, read_batches, request_stream, start_refreshed


def put(spark, value):
    return lambda path: write_json(spark, path, {"value": value})


def fail(path):
    raise InterruptedError(path)


def test_newest_whole_version(spark, tmp_path):
    root = str(tmp_path / "a")
    assert newest(spark, root) is None and versions(spark, root) == [] and prune(spark, root) == []
    first = publish(spark, root, {"x": put(spark, 1), "y": put(spark, 1)}, {"model_version": "1"})
    with pytest.raises(InterruptedError):
        publish(spark, root, {"x": put(spark, 2), "y": fail})
    assert newest(spark, root).endswith(first) and read_json(spark, f"{newest(spark, root)}/x") == {"value": 1}
    found = manifest(spark, newest(spark, root))
    assert found["parts"] == ["x", "y"] and found["model_version"] == "1"
    second = publish(spark, root, {"x": put(spark, 3)})
    assert newest(spark, root).endswith(second) and len(versions(spark, root)) == 2
    assert len(prune(spark, root, keep=1)) == 2  # the first, and the one that never became whole
    assert [v.endswith(second) for v in versions(spark, root)] == [True] and len(list((tmp_path / "a" / "versions").iterdir())) == 1


def test_a_failed_training_leaves_the_old_set(spark, txn, tmp_path):
    root = str(tmp_path / "a")

    class Constant:  # made here, its code travels with it
        def __init__(self, p):
            self.p = p

        def predict_proba(self, x):
            import numpy as np
            return np.tile([1 - self.p, self.p], (len(x), 1))

    def parts(p, last):
        scorer = ExternalScorer(Constant(p))
        return {"features": lambda path: s.FROZEN.save(spark, path), "classifier": scorer.save, "metrics": last or put(spark, p)}

    publish(spark, root, parts(0.25, None))
    profile = {"Age": 41.0, "Tenure_Months": 7.0, "Digital_Engagement_Score": 62.5}
    record = {**txn, **profile, **{c: s.CONTRACT.domains[c][0] for c in s.CONTRACT.customer_categorical}}
    for last, want in ((fail, 0.25), (None, 0.75)):
        try:
            publish(spark, root, parts(0.75, last))
        except InterruptedError:
            pass
        assert ScoringJob.load(spark, root).score(record).first()["Risk_Probability"] == want


def payload(txn, i, customer):
    return json.dumps({**txn, "Transaction_ID": f"t{i}", "Customer_ID": customer})


def test_stream_sees_a_changing_dimension(spark, sf, txn, profile, tmp_path, monkeypatch):
    from riskflow.operators import lookup
    folder, dim, out, state = (str(tmp_path / n) for n in ("in", "dim", "out", "state"))
    Path(folder).mkdir()
    measured = []
    own = lookup.measured_bytes
    monkeypatch.setattr(lookup, "measured_bytes", lambda df: measured.append(own(df)) or measured[-1])
    job = s.scoring_job(spark, sf).with_customers(None)
    job.customer_order = None

    def run(i, ids, known):
        spark.createDataFrame([{**profile, "Customer_ID": c} for c in known]).write.mode("overwrite").parquet(dim)
        Path(folder, f"{i}.json").write_text("\n".join(payload(txn, f"{i}-{c}", c) for c in ids))
        start_refreshed(request_stream(spark, folder), job, dim, out, state).awaitTermination()
        return {(r.batch, r.Transaction_ID): r.Age for r in read_batches(spark, out).collect()}

    first = run(0, ["c1", "c2"], ["c1", "c3"])
    assert first == {(0, "t0-c1"): 41.0, (0, "t0-c2"): None}
    both = run(1, ["c1", "c2"], ["c1", "c2", "c3", "c4"])
    assert both == {**first, (1, "t1-c1"): 41.0, (1, "t1-c2"): 41.0}  # the old batch keeps what it saw
    assert len(measured) == 2 and measured[1] == 2 * measured[0]  # the size is looked at anew for each batch
    want = decisions(spark.createDataFrame([(payload(txn, "1-c2", "c2"),)], "payload string"), job.with_customers(spark.read.parquet(dim))).first()
    got = read_batches(spark, out).where("Transaction_ID = 't1-c2'").first()
    assert (got.row_status, got.Risk_Probability) == (want.row_status, want.Risk_Probability)


def test_a_repeated_batch_adds_nothing(spark, sf, txn, profile, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    Path(folder).mkdir()
    Path(folder, "a.json").write_text("\n".join(payload(txn, i, "c1") for i in range(5)))
    job = s.scoring_job(spark, sf)
    job.customer_order = None

    def dimension(session):
        return session.createDataFrame([{**profile, "Customer_ID": "c1"}])

    for state in ("one", "two"):  # progress is lost after the first run, so the batch comes once more
        start_refreshed(request_stream(spark, folder), job, dimension, out, str(tmp_path / state)).awaitTermination()
        assert read_batches(spark, out).count() == 5
    (tmp_path / "out" / "batch=1").mkdir()
    (tmp_path / "out" / "batch=1" / "part.parquet").write_bytes(b"half a file")  # a batch that is still being written
    assert read_batches(spark, out).count() == 5
