import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from riskflow.catalog import setup as s
from riskflow.models.scorers import read_json
from riskflow.plans.prepare import load_or_prepare, load_parts, run_prepare
from riskflow.plans.score import ScoringJob
from riskflow.plans.train import run_training
from riskflow.plans.validate import DataValidationError
from riskflow.session import split_methods
from riskflow.sinks import write_table
from riskflow.sources import testviews as views
from riskflow.sources.tables import from_records
from riskflow.streaming.score import decisions, request_stream, start_scoring

OUTPUT = {"Transaction_ID", "Customer_ID", "Predicted_Risk_Flag", "Risk_Probability", "Risk_Tier", "Operational_Action",
          "Model_Version", "Scored_At"}


@pytest.fixture(scope="module")
def raw(spark):
    sf = "/root/testdata/sf0.001"
    return views.transactions(spark, sf), views.customers(spark, sf)


@pytest.fixture(scope="module")
def prepared(spark, raw, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("prepared"))
    return out, run_prepare(*raw, out)


def test_prepare(spark, prepared, raw):
    out, p = prepared
    assert (p.total_enriched_records, p.train_records, p.test_records) == (1000, 800, 200)
    assert len(p.columns) == 21 and "Customer_Name" not in p.columns
    train, test = load_parts(spark, p.enriched_path)
    assert train.count() == 800 and test.count() == 200 and set(train.columns) == set(p.columns)
    ids = [r.Transaction_ID for part in (train, test) for r in part.collect()]
    assert len(set(ids)) == 1000
    assert "Customer_Name" not in spark.read.parquet(p.customers_path).columns
    # every transaction found its customer
    assert train.where("Account_Type is null").count() == 0
    assert "PartitionFilters: [isnotnull(split" in test._jdf.queryExecution().executedPlan().toString()


def test_prepare_keeps_class_shares(spark, prepared):
    train, test = load_parts(spark, prepared[1].enriched_path)

    def share(df):
        return df.agg(F.avg((F.col("Risk_Review_Flag") == "Yes").cast("double"))).first()[0]

    assert abs(share(train) - share(test)) < 0.005


def test_load_or_prepare(spark, raw, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_or_prepare(spark, str(tmp_path / "new"))
    train, test = load_or_prepare(spark, str(tmp_path / "new"), lambda: raw)
    assert train.count() + test.count() == 1000
    again, _ = load_or_prepare(spark, str(tmp_path / "new"))  # reads what is there
    assert again.count() == train.count()


def test_prepare_as_csv(spark, raw, tmp_path):
    p = run_prepare(*raw, str(tmp_path / "csv"), fmt="csv")
    assert (p.train_records, p.test_records) == (800, 200)


@pytest.fixture(scope="module")
def trained(spark, prepared, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("artifacts"))
    return out, run_training(*load_parts(spark, prepared[1].enriched_path), out=out, trees=20, depth=6)


def test_training(spark, trained):
    out, t = trained
    assert t.card["train_samples"] == 800 and t.card["test_samples"] == 200
    assert t.card["features_count"] == len(t.features.params.names()) == len(t.importances)
    assert t.metrics["roc_auc"] > 0.55 and t.baseline_metrics["roc_auc"] > 0.55
    assert sum(map(sum, t.metrics["confusion_matrix"])) == 200
    assert read_json(spark, f"{out}/metrics") == t.metrics
    assert read_json(spark, f"{out}/classifier/metadata")["baseline_comparison"] == t.card["baseline_comparison"]


def test_training_gate(spark, prepared):
    train, test = load_parts(spark, prepared[1].enriched_path)
    for bad in ((train.limit(0), test), (train.drop("Age"), test), (train, test.drop("Channel"))):
        with pytest.raises(RuntimeError, match="validation rejected"):
            run_training(*bad)


@pytest.fixture(scope="module")
def job(spark, trained, prepared):
    return ScoringJob.load(spark, trained[0], prepared[1].customers_path)


def test_score_one_record(spark, job, txn):
    row = job.score({**txn, "Customer_ID": "FT-C000000001"}).first().asDict()
    assert OUTPUT <= set(row) and row["Age"] is not None and row["Customer_Segment"] is not None
    assert row["Predicted_Risk_Flag"] in ("Yes", "No") and 0 <= row["Risk_Probability"] <= 1
    assert row["Risk_Tier"] in ("Low", "Medium", "High") and row["Model_Version"] == "2.0.0-week3"
    assert row["Scored_At"].endswith("+00:00") and "T" in row["Scored_At"]
    again = job.score({**txn, "Customer_ID": "FT-C000000001"}).first().asDict()
    assert again["Risk_Probability"] == row["Risk_Probability"]


def test_score_several(spark, job, txn):
    rows = [txn, {**txn, "Transaction_ID": "T2", "Amount_NGN": 5e5, "Location": "Abuja"},
            {**txn, "Transaction_ID": "T3", "Amount_NGN": 1200.0, "Channel": "USSD"}]
    out = job.score(rows).collect()
    assert len(out) == 3 and len({r.Scored_At for r in out}) == 1
    assert {r.Age for r in out} == {None}  # an unknown customer is imputed, not refused


def test_strict_batch_is_rejected_whole(spark, job, txn):
    with pytest.raises(DataValidationError) as e:
        job.score([txn, {**txn, "Amount_NGN": -999.0}])
    assert e.value.report["errors"][0]["error_type"] == "OUT_OF_RANGE"
    with pytest.raises(TypeError):
        job.score("text")
    with pytest.raises(ValueError):
        ScoringJob(job.params, job.scorer, mode="lenient")


def test_without_customers(spark, trained, txn, enriched):
    job = ScoringJob.load(spark, trained[0])
    assert job.score(enriched).count() == 1
    with pytest.raises(ValueError, match="missing model inputs"):
        job.score(txn)


def test_quarantine_in_one_pass(spark, raw, sf, tmp_path):
    job = s.scoring_job(spark, sf)
    df = views.dirty_transactions(spark, sf)
    path = write_table(df, str(tmp_path / "in"))
    out = job.run(path, str(tmp_path / "out"))
    n = {r.row_status: r["count"] for r in out.groupBy("row_status").count().collect()}
    assert n["scored"] + n["quarantined"] == 1000 and n["quarantined"] == job.quarantine(df).count()
    assert out.where("row_status = 'quarantined' and Risk_Tier is not null").count() == 0
    assert out.where("row_status = 'quarantined' and size(_issues) = 0").count() == 0
    plan = job.both(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("events.parquet") == 1


def test_strict_run_from_csv(spark, sf, tmp_path):
    job = s.scoring_job(spark, sf)
    job.mode = "strict"
    txn = views.serial_transactions(spark, sf).where("Customer_ID <> 'FT-C000000000'")
    path = write_table(txn, str(tmp_path / "in"), "csv")
    out = job.run(path, str(tmp_path / "out"), "csv", "csv")
    want = {r.Transaction_ID: r.Risk_Probability for r in job.score(txn).collect()}
    assert {r.Transaction_ID: float(r.Risk_Probability) for r in out.collect()} == want


def test_scores_do_not_depend_on_row_order(spark, sf):
    job = s.scoring_job(spark, sf)
    df = views.dirty_transactions(spark, sf)

    def scores(x):
        return sorted((r._row, r.Risk_Probability) for r in job.score(x).select("_row", "Risk_Probability").collect())

    assert scores(df) == scores(df.repartition(5).orderBy(F.desc("_row")))


def decision(rows):
    return sorted((r.payload, r.row_status, str(r.Risk_Probability), len(r._issues)) for r in rows.collect())


def test_stream_equals_batch(spark, sf, tmp_path):
    job = s.scoring_job(spark, sf)
    lines = [r.payload for r in s.payloads(spark, sf).orderBy("_row").collect()]
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    Path(folder).mkdir()
    for i in range(3):  # files arrive between three runs of the stream
        part = lines[i::3]
        Path(folder, f"{i}.json").write_text("\n".join(part))
        start_scoring(request_stream(spark, folder, files_per_batch=1), job, out, state).awaitTermination()
        assert spark.read.parquet(out).count() == sum(len(lines[j::3]) for j in range(i + 1))
    batch = spark.createDataFrame([(x,) for x in lines], "payload string")
    assert decision(spark.read.parquet(out)) == decision(decisions(batch, job))
    # nothing new, nothing written twice
    start_scoring(request_stream(spark, folder), job, out, state).awaitTermination()
    assert spark.read.parquet(out).count() == len(lines)


def test_stream_with_a_dimension_too_large_to_broadcast(spark, sf, tmp_path, monkeypatch):
    from riskflow.operators import lookup
    want = decision(decisions(s.payloads(spark, sf).select("payload"), s.scoring_job(spark, sf)))
    monkeypatch.setattr(lookup, "measured_bytes", lambda df: 1 << 40)
    Path(tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(r.payload for r in s.payloads(spark, sf).collect()))
    start_scoring(request_stream(spark, str(tmp_path / "in")), s.scoring_job(spark, sf), str(tmp_path / "out"),
                  str(tmp_path / "state")).awaitTermination()
    assert decision(spark.read.parquet(str(tmp_path / "out"))) == want


def test_refused_requests_say_why(spark, sf, txn):
    job = s.scoring_job(spark, sf)
    df = spark.createDataFrame([(json.dumps({**txn, "Amount_NGN": "x"}),), ("junk",), (json.dumps(txn),)], "payload string")
    got = {r.payload[:4]: r for r in decisions(df, job).collect() if r.row_status == "quarantined"}
    assert got["junk"]._issues[0].value == "not a JSON object" and len(got) == 2


def test_target_outside_the_mapping_fails(spark, raw, tmp_path):
    txn, cust = raw
    odd = txn.withColumn("Risk_Review_Flag", F.expr("if(Transaction_ID like '%7', 'Maybe', Risk_Review_Flag)"))
    with pytest.raises(Exception, match="unmapped target value: Maybe"):
        run_prepare(odd, cust, str(tmp_path / "odd"))


def test_without_target_all_rows_train(spark, raw, tmp_path):
    p = run_prepare(raw[0].drop("Risk_Review_Flag"), raw[1], str(tmp_path / "plain"))
    assert (p.train_records, p.test_records) == (1000, 0)


def test_wide_projections_are_split_whatever_the_session_says(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "65535")
        with pytest.raises(KeyError), split_methods(spark):
            assert spark.conf.get(key) == "8000"
            raise KeyError
        assert spark.conf.get(key) == "65535"
    finally:
        spark.conf.set(key, old)
