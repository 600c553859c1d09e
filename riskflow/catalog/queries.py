"""Every registered query: a callable of session and table folder that gives a DataFrame.

Times of scoring are left out, doubles are rounded to six digits and counts are
bigint, so that results can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import lru_cache

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskflow.artifacts import newest, publish
from riskflow.catalog import setup as s
from riskflow.contract import CONTRACT
from riskflow.functions import probability as prob
from riskflow.functions.time import (
    hour_and_weekday, night_flag, parse_time, serial_to_time, time_to_serial, wall_micros, with_temporal_features,
)
from riskflow.models import certify
from riskflow.models.scorers import ExternalScorer
from riskflow.models.training import train_forest, train_logistic
from riskflow.operators import clean, decide, evaluate as ev, features as fe, layout, lookup, quality as dq, quality_state as dq_state, split as sp
from riskflow.operators.median import exact_medians
from riskflow.plans import prepare as prep
from riskflow.plans.score import ScoringJob, score_rows
from riskflow.plans.train import Trained, run_training
from riskflow.session import scratch_path, split_methods, stored
from riskflow.sinks import write_table
from riskflow.sources import requests as rq, testviews as views
from riskflow.sources.tables import read_table
from riskflow.streaming.score import decisions, read_batches, request_stream, start_refreshed, start_scoring

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ID = CONTRACT.transaction_id


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.selectExpr(*[
        f"round(`{f.name}`, {digits}) as `{f.name}`" if f.dataType.typeName() == "double" else f"`{f.name}`"
        for f in df.schema
    ])


def micros(column: str = CONTRACT.time):
    return F.expr(wall_micros(column))


# ---- sources, cleaning, joins -------------------------------------------------------

@query
def scan_txn(spark, sf):
    return views.transactions(spark, sf).withColumn(CONTRACT.time, micros())


@query
def scan_cust(spark, sf):
    return views.customers(spark, sf)


@query
def redact_pii(spark, sf):
    return clean.redact_pii(views.customers(spark, sf))


@query
def clean_keys(spark, sf):
    padded = F.concat(F.lit("  "), F.col("Customer_ID"), F.lit(" "))
    return clean.clean_key(views.customers(spark, sf).select(padded.alias("Customer_ID"), "Age"))


@query
def select_features(spark, sf):
    return clean.select_features(with_temporal_features(s.clean_enriched(spark, sf)))


@query
def label_map(spark, sf):
    txn = views.transactions(spark, sf, row=True)
    flag = F.when(F.col("_row") % 59 == 0, "Maybe").when(F.col("_row") % 61 == 0, None)
    gaps = txn.withColumn(CONTRACT.target, F.when(flag.isNotNull() | (F.col("_row") % 61 == 0), flag)
                          .otherwise(F.col(CONTRACT.target)))
    return clean.with_label(gaps, "label", unmapped="zero").select(ID, CONTRACT.target, "label")


@query
def enrich_left(spark, sf):
    return s.clean_enriched(spark, sf).withColumn(CONTRACT.time, micros())


@query
def dup_keys(spark, sf):
    return lookup.duplicate_keys(views.dirty_customers(spark, sf), "Customer_ID")


@query
def match_rate(spark, sf):
    return rounded(lookup.match_rate(views.dirty_transactions(spark, sf), views.dirty_customers(spark, sf)))


@query
def enrich_lookup(spark, sf):
    return s.dirty_enriched(spark, sf).select(
        F.col("_row").alias("row_id"), "Customer_ID", *CONTRACT.customer_features)


@query
def enrich_partial(spark, sf):
    txn = views.transactions(spark, sf, row=True).withColumns({
        "Age": F.when(F.col("_row") % 3 == 0, F.lit(33.0)),
        "Gender": F.when(F.col("_row") % 4 == 0, F.lit("Female")),
    })
    out = lookup.enrich_lookup(txn, views.customers(spark, sf))
    return out.select(ID, *CONTRACT.customer_features)


@query
def orphan_txn(spark, sf):
    found = lookup.orphans(views.dirty_transactions(spark, sf), views.dirty_customers(spark, sf))
    return found.select(F.col("_row").alias("row_id"), "Customer_ID")


# ---- validation ---------------------------------------------------------------------

def _issues_of(spark, sf, *types):
    found = dq.issues(s.dirty_enriched(spark, sf)).where(F.col("error_type").isin(*types))
    return found.select("severity", "field", "error_type", "invalid_rows_count", "message")


@query
def dq_type(spark, sf):
    return _issues_of(spark, sf, dq.BAD_TYPE)


@query
def dq_null_key(spark, sf):
    return _issues_of(spark, sf, dq.NULL_KEY)


@query
def dq_missing(spark, sf):
    return _issues_of(spark, sf, dq.MISSING)


@query
def dq_domain(spark, sf):
    return _issues_of(spark, sf, dq.BAD_CATEGORY).drop("message")


@query
def dq_range(spark, sf):
    return _issues_of(spark, sf, dq.OUT_OF_RANGE)


@query
def dq_empty(spark, sf):
    nothing = s.clean_enriched(spark, sf).where(F.col("Amount_NGN") < 0)
    return dq.issues(nothing).select("severity", "field", "error_type", "invalid_rows_count", "message", "total")


@query
def dq_columns(spark, sf):
    partial = views.transactions(spark, sf).drop("Channel", "Device_Type").withColumn("Branch", F.lit("x"))
    return dq.issues(partial).select("severity", "field", "error_type", "message", "total")


@query
def dq_samples(spark, sf):
    found = dq.samples(s.dirty_enriched(spark, sf), order=["_row"])
    number = F.when(F.col("error_type") == dq.OUT_OF_RANGE, F.col("value").cast("double"))
    text = F.when(F.col("error_type") != dq.OUT_OF_RANGE, F.col("value"))
    return found.select("field", "error_type", "position", number.alias("number"), text.alias("text"))


@query
def dq_bad_categories(spark, sf):
    return dq.bad_categories(s.dirty_enriched(spark, sf), order=["_row"]).select(
        "field", "value", "n", F.col("_at._row").alias("first_row"))


@query
def dq_verdict(spark, sf):
    dirty, good = s.dirty_enriched(spark, sf), s.clean_enriched(spark, sf)
    cases = [("dirty strict", dirty, True), ("dirty lenient", dirty, False), ("clean strict", good, True),
             ("incomplete lenient", good.drop("Channel"), False)]
    out = None
    for name, df, strict in cases:
        row = dq.report(df, strict=strict, with_samples=False).select(
            F.lit(name).alias("case"), "is_valid", "action_taken")
        out = row if out is None else out.unionByName(row)
    return out


def _flat_report(found):
    def listed(column):
        return F.array_join(F.transform(column, lambda x: F.concat_ws(
            ":", x["field"], x["error_type"], x["invalid_rows_count"].cast("string"), x["message"])), "|")

    return found.select(
        "is_valid", "total_records", "error_count", "warning_count", "action_taken",
        listed("errors").alias("errors"), listed("warnings").alias("warnings"),
        F.array_join(F.flatten(F.transform(
            F.filter("errors", lambda x: x["error_type"] == dq.BAD_CATEGORY),
            lambda x: x["sample_invalid_values"])), ",").alias("category_samples"))


@query
def dq_report(spark, sf):
    return _flat_report(dq.report(s.dirty_enriched(spark, sf), strict=False, order=["_row"]))


@query
def dq_merged(spark, sf):
    """Three parts of the table are checked apart; their merged states give the report of the whole."""
    df, order = s.dirty_enriched(spark, sf), ["_row"]
    rules = dq.rules_for(df, CONTRACT.variant(df.columns))
    parts = [dq_state.state(df.where(F.col("_row") % 3 == i), rules, order) for i in range(3)]
    return _flat_report(dq_state.report(dq_state.merged(parts[0].unionByName(parts[1]).unionByName(parts[2])), df, strict=False))


@query
def quarantine_clean(spark, sf):
    flagged = dq.with_row_issues(s.dirty_enriched(spark, sf))
    return dq.clean_rows(flagged).select(F.col("_row").alias("row_id"), ID, "Customer_ID", "Channel", "Age")


@query
def quarantine_bad(spark, sf):
    flagged = dq.with_row_issues(s.dirty_enriched(spark, sf))
    found = F.array_join(F.transform("_issues", lambda x: F.concat_ws(":", x["field"], x["error_type"])), "|")
    return dq.quarantined_rows(flagged).select(F.col("_row").alias("row_id"), found.alias("issues"))


# ---- scalar functions ---------------------------------------------------------------

@query
def serial_time(spark, sf):
    df = views.serial_transactions(spark, sf)
    hour, day = hour_and_weekday(CONTRACT.time, df.schema[CONTRACT.time].dataType)
    return df.select(ID, serial_to_time(CONTRACT.time).alias("t"),
                     F.expr(hour).alias("hour"), F.expr(day).alias("weekday")).select(
        ID, micros("t").alias("micros"), "hour", "weekday")


@query
def parse_time_(spark, sf):
    r = F.col("_row")
    text = (F.when(r % 5 == 0, "not a time").when(r % 7 == 0, "46023.125").when(r % 11 == 0, None)
            .otherwise(F.date_format(CONTRACT.time, "yyyy-MM-dd HH:mm:ss.SSSSSS")))
    txn = views.transactions(spark, sf, row=True).withColumn("text", text)
    return txn.select(r.alias("row_id"), parse_time("text").alias("t")).select("row_id", micros("t").alias("micros"))


@query
def temporal_features(spark, sf):
    txn = views.transactions(spark, sf, row=True)
    gaps = txn.withColumn(CONTRACT.time, F.when(F.col("_row") % 91 != 0, F.col(CONTRACT.time)))
    return with_temporal_features(gaps).select(ID, *CONTRACT.engineered)


@query
def night_flag_(spark, sf):
    df = with_temporal_features(views.transactions(spark, sf))
    return df.select(ID, night_flag().alias("is_night"))


@query
def margin_to_prob(spark, sf):
    txn = views.transactions(spark, sf)
    margin = (F.col("Amount_NGN") - 50000) / 25000
    return rounded(txn.select(ID, prob.sigmoid(margin).alias("probability")))


@query
def hard_to_prob(spark, sf):
    p = prob.hard_label_probability(F.col("label"))
    return clean.with_label(views.transactions(spark, sf)).select(ID, (1 - p).alias("p0"), p.alias("p1"))


@query
def csv_times(spark, sf):
    """Serial, date text and junk in one CSV file, scored by the job that reads it."""
    r = F.col("_row")
    txn = views.transactions(spark, sf, row=True)
    text = F.when(r % 3 == 0, time_to_serial(CONTRACT.time).cast("string")).when(
        r % 3 == 1, F.date_format(CONTRACT.time, "yyyy-MM-dd HH:mm:ss")).otherwise("soon")
    path, out = scratch_path(spark, "csv_in"), scratch_path(spark, "csv_out")
    write_table(txn.withColumn(CONTRACT.time, text).drop("_row"), path, "csv")
    job = ScoringJob(s.FROZEN, s.linear(), views.customers(spark, sf), mode="quarantine")
    return rounded(job.run(path, out, fmt="csv").select(ID, "Risk_Probability", "row_status"), 4)


@query
def time_bounds(spark, sf):
    """Serials beyond every calendar have no time, in either rounding."""
    r = F.col("_row")
    serial = (F.when(r % 6 == 0, 1e12).when(r % 6 == 1, -1e12).when(r % 6 == 2, 1e300).when(r % 6 == 3, float("inf"))
              .when(r % 6 == 4, 2958466.0).otherwise(2958465.5))
    df = views.transactions(spark, sf, row=True).withColumn(CONTRACT.time, serial)
    kind = df.schema[CONTRACT.time].dataType
    (h, d), (mh, md) = (hour_and_weekday(CONTRACT.time, kind, rounding) for rounding in ("floor", "micros"))
    return df.select(r.alias("row_id"), F.expr(h).alias("hour"), F.expr(d).alias("weekday"), F.expr(mh).alias("micros_hour"),
                     F.expr(md).alias("micros_weekday"))


@query
def no_probability(spark, sf):
    """Without a probability nothing is decided."""
    r = F.col("_row")
    p = F.when(r % 3 == 0, F.lit(None).cast("double")).when(r % 3 == 1, float("nan")).otherwise(0.5)
    out = decide.decide(views.transactions(spark, sf, row=True).select(r.alias("row_id"), p.alias("probability")))
    return out.select("row_id", *decide.DECISION_COLUMNS[:-2])


@query
def enrich_large(spark, sf):
    """The join of a dimension too large to broadcast; one customer holds a third of all rows, some rows have none."""
    txn, dim = _hot_customer(spark, sf)
    return lookup.lookup_join(txn, dim, "Customer_ID", broadcast_bytes=0).select(F.col("_row").alias("row_id"), "Customer_ID", "Age", "Gender")


def _hot_customer(spark, sf):
    r = F.col("_row")
    dim = views.customers(spark, sf)
    hot = dim.agg(F.min("Customer_ID")).scalar()
    key = F.when(r % 3 == 0, hot).when(r % 101 == 1, F.lit(None)).otherwise(F.col("Customer_ID"))
    return views.transactions(spark, sf, row=True).withColumn("Customer_ID", key), dim


def _colocated(spark, fact, dim, how):
    out = scratch_path(spark, "colocated")
    name = out.rsplit("/", 1)[1].replace("-", "_")
    layout.write_colocated(fact, dim, "Customer_ID", name, out)
    return layout.join_colocated(spark, "Customer_ID", name, how)


@query
def enrich_colocated(spark, sf):
    """The same join over tables written in buckets of the key."""
    return _colocated(spark, *_hot_customer(spark, sf), "left").select(F.col("_row").alias("row_id"), "Customer_ID", "Age", "Gender")


@query
def orphans_colocated(spark, sf):
    """Transactions without a customer, from the same layout."""
    dim = lookup.first_per_key(views.dirty_customers(spark, sf), "Customer_ID", ["_seq"])
    return _colocated(spark, views.dirty_transactions(spark, sf), dim, "left_anti").select(F.col("_row").alias("row_id"), "Customer_ID")


@query
def prepared_csv(spark, sf):
    """Preparation written as CSV and read back: both parts, from the one table."""
    out = scratch_path(spark, "prepared")
    done = prep.run_prepare(views.transactions(spark, sf), views.customers(spark, sf), out, fmt="csv")
    train, test = prep.load_parts(spark, done.enriched_path)
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    return both.select(ID, "split", F.col("Amount_NGN").cast("double").alias("Amount_NGN"), "Channel", "Gender")


@query
def written_tables(spark, sf):
    """Preparation as Parquet: the customers without personal data, read back."""
    out = scratch_path(spark, "prepared")
    done = prep.run_prepare(views.transactions(spark, sf), views.customers(spark, sf), out)
    return spark.read.parquet(done.customers_path)


@query
def scan_orc(spark, sf):
    """A table written as ORC and read with its stored types."""
    path = scratch_path(spark, "orc")
    write_table(views.transactions(spark, sf), path, "orc")
    return read_table(spark, path, "orc").withColumn(CONTRACT.time, micros())


@query
def enrich_none(spark, sf):
    """Scoring without a dimension leaves the rows as they are."""
    return lookup.enrich_lookup(views.transactions(spark, sf), None).select(ID, "Customer_ID", "Amount_NGN")


@query
def serial_micros(spark, sf):
    """Hour and weekday of serials that are rounded to microseconds first."""
    df = views.serial_transactions(spark, sf)
    hour, day = hour_and_weekday(CONTRACT.time, df.schema[CONTRACT.time].dataType, "micros")
    return df.select(ID, F.expr(hour).alias("hour"), F.expr(day).alias("weekday"))


@query
def saved_features(spark, sf):
    """Statistics written, read back and applied."""
    path = scratch_path(spark, "features")
    s.FROZEN.save(spark, path)
    p = fe.FeatureParams.load(spark, path)
    src = fe.prepared_inputs(s.clean_enriched(spark, sf))
    return rounded(src.select(ID, *[F.expr(fe.scaled(c, p)).alias(c) for c in p.median]))


@query
def published_features(spark, sf):
    """Statistics of the newest whole version: one before it had others, one after it was left without a manifest."""
    root = scratch_path(spark, "artifacts")
    older = replace(s.FROZEN, median={c: v + 1 for c, v in s.FROZEN.median.items()})
    for made in (older, s.FROZEN):
        publish(spark, root, {"features": lambda path: made.save(spark, path)})

    def fail(path):
        raise InterruptedError(path)

    try:
        publish(spark, root, {"features": lambda path: older.save(spark, path), "classifier": fail})
    except InterruptedError:
        pass
    p = fe.FeatureParams.load(spark, f"{newest(spark, root)}/features")
    src = fe.prepared_inputs(s.clean_enriched(spark, sf))
    return rounded(src.select(ID, *[F.expr(fe.scaled(c, p)).alias(c) for c in p.median]))


# ---- features -----------------------------------------------------------------------

def _train_inputs(spark, sf):
    return fe.prepared_inputs(s.part(spark, sf, "train"))


@query
def fit_medians(spark, sf):
    found = exact_medians(_train_inputs(spark, sf), list(CONTRACT.model_numeric))
    return spark.createDataFrame(list(found.items()), "field string, median double")


@query
def fit_scaler(spark, sf):
    _, mean, scale = fe.fit_numeric(_train_inputs(spark, sf))
    return rounded(spark.createDataFrame([(c, mean[c], scale[c]) for c in mean], "field string, mean double, scale double"))


@query
def impute_cat(spark, sf):
    df = views.transactions(spark, sf)
    return df.select(ID, *[F.expr(fe.filled_category(c)).alias(c) for c in CONTRACT.transaction_categorical])


@query
def fit_levels(spark, sf):
    return fe.level_table(s.part(spark, sf, "train")).select("field", "level", "n")


@query
def feature_names(spark, sf):
    found = fe.fit_features(s.part(spark, sf, "train"))
    return spark.createDataFrame(list(enumerate(found.names())), "position bigint, feature string")


@query
def scale_num(spark, sf):
    src = fe.prepared_inputs(s.clean_enriched(spark, sf))
    return rounded(src.select(ID, *[F.expr(fe.scaled(c, s.FROZEN)).alias(c) for c in s.FROZEN.median]))


@query
def onehot_wide(spark, sf):
    wide = fe.transform_wide(s.clean_enriched(spark, sf), s.FROZEN, keep=(ID,))
    return wide.drop(*s.FROZEN.median)


@query
def features_vector(spark, sf):
    out = fe.transform_vector(s.clean_enriched(spark, sf), s.FROZEN)
    width = range(len(s.FROZEN.names()))
    # a checksum that depends on every value and its place
    placed = " + ".join(f"{i + 1} * x[{i}]" for i in width)
    total = " + ".join(f"x[{i}]" for i in width)
    return out.select(ID, vector_to_array("features").alias("x")).selectExpr(
        ID, "size(x) as width", f"round({total}, 6) as total", f"round({placed}, 5) as placed")


@query
def no_leakage(spark, sf):
    table = s.split_table(spark, sf)
    median, mean, scale = fe.fit_numeric(fe.prepared_inputs(table.where("split = 'train'")))
    p = fe.FeatureParams(median, mean, scale, {})
    test = fe.prepared_inputs(table.where("split = 'test'"))
    return rounded(test.select(ID, *[F.expr(fe.scaled(c, p)).alias(c) for c in median]))


# ---- splitting ----------------------------------------------------------------------

@query
def split_exact(spark, sf):
    return sp.stratified_split(views.transactions(spark, sf)).select(ID, CONTRACT.target, "split")


@query
def split_scalable(spark, sf):
    # the same cut, found by hash prefixes all the way down
    return sp.stratified_split(views.transactions(spark, sf), ranked_rows=0).select(ID, CONTRACT.target, "split")


@query
def split_append(spark, sf):
    """One half of the rows is split, its cuts are written and read back, and the other half joins by them."""
    txn = views.transactions(spark, sf, row=True).withColumn("load", F.col("_row") % 2)
    old, new = txn.where("load = 0"), txn.where("load = 1")
    cuts = spark.read.parquet(write_table(sp.freeze_cuts(old), scratch_path(spark, "cuts")))
    both = sp.stratified_split(old).unionByName(sp.append_split(new, cuts))
    return both.select(ID, CONTRACT.target, F.col("load").cast("bigint").alias("load"), "split")


@query
def split_counts(spark, sf):
    return sp.split_counts(sp.stratified_split(views.transactions(spark, sf)))


@query
def prepare(spark, sf):
    return s.split_table(spark, sf).withColumn(CONTRACT.time, micros())


@query
def prepare_summary(spark, sf):
    return prep.summary(s.split_table(spark, sf))


# ---- models and decisions -----------------------------------------------------------

@query
def class_weights(spark, sf):
    return rounded(ev.class_weights(clean.with_label(s.part(spark, sf, "train"))))


@query
def linear_score(spark, sf):
    return rounded(s.linear_scored(spark, sf).select(ID, "probability"))


@query
def predict_flag(spark, sf):
    p = F.col("probability")
    return s.linear_scored(spark, sf).select(ID, prob.at_threshold(p).alias("prediction"))


@query
def decide_(spark, sf):
    out = decide.decide(s.linear_scored(spark, sf))
    return out.select(ID, *decide.DECISION_COLUMNS[:-1])


@query
def score_batch(spark, sf):
    out = s.scoring_job(spark, sf).score(views.dirty_transactions(spark, sf))
    return out.select(F.col("_row").alias("row_id"), ID, "Customer_ID", *decide.DECISION_COLUMNS[:-1])


@query
def score_response(spark, sf):
    out = score_rows(s.clean_enriched(spark, sf), s.FROZEN, s.linear())
    return decide.response(out).drop("Scored_At")


@query
def score_with_quarantine(spark, sf):
    out = s.scoring_job(spark, sf).both(views.dirty_transactions(spark, sf))
    return out.select(F.col("_row").alias("row_id"), "row_status", "Predicted_Risk_Flag", "Risk_Tier",
                      F.size("_issues").alias("n_issues"))


@query
def tier_mix(spark, sf):
    out = decide.decide(s.linear_scored(spark, sf))
    mixed = decide.tier_mix(out)
    return mixed.select("Risk_Tier", "n", F.round("amount", 2).alias("amount"),
                        F.round("mean_probability", 6).alias("mean_probability"))


def logistic_rule(weights: list[float], intercept: float):
    """A model from outside: plain numpy over the feature matrix."""

    class LogisticRule:
        def predict_proba(self, x):
            p = 1.0 / (1.0 + np.exp(-(x @ np.asarray(weights) + intercept)))
            return np.column_stack([1.0 - p, p])

    return LogisticRule()


@query
def score_external(spark, sf):
    # amount, age and hour, and the place of one category level
    names = s.FROZEN.names()
    weights = [0.0] * len(names)
    for name, w in {"Amount_NGN": 0.9, "Age": -0.1, "Transaction_Hour": 0.2, "Channel_USSD": 0.4}.items():
        weights[names.index(name)] = w
    scorer = ExternalScorer(logistic_rule(weights, -1.0), author="outside", model_name="logistic rule")
    df = fe.transform_vector(s.clean_enriched(spark, sf), s.FROZEN)
    return rounded(scorer.predict(df).select(ID, "probability", "prediction"))


# ---- evaluation ---------------------------------------------------------------------

@query
def confusion(spark, sf):
    return ev.confusion(s.linear_scored(spark, sf))


@query
def class_metrics(spark, sf):
    return rounded(ev.class_metrics(ev.confusion(s.linear_scored(spark, sf))))


@query
def brier(spark, sf):
    return rounded(ev.brier(s.linear_scored(spark, sf)))


@query
def roc_auc(spark, sf):
    return rounded(ev.roc_auc(s.linear_scored(spark, sf)))


@query
def roc_auc_ties(spark, sf):
    coarse = s.linear_scored(spark, sf).withColumn("probability", F.round("probability", 1))
    return rounded(ev.roc_auc(coarse))


@query
def metrics(spark, sf):
    m = ev.metrics(s.linear_scored(spark, sf))
    c = F.col("confusion_matrix")
    return m.select("roc_auc", "precision", "recall", "f1_score", "brier_score", "decision_threshold",
                    c[0][0].alias("tn"), c[0][1].alias("fp"), c[1][0].alias("fn"), c[1][1].alias("tp"))


@query
def compare_models(spark, sf):
    return ev.compare(ev.metrics(s.linear_scored(spark, sf)), ev.metrics(s.linear_scored(spark, sf, s.BASELINE_WEIGHTS)))


@query
def threshold_sweep(spark, sf):
    return rounded(ev.threshold_sweep(s.linear_scored(spark, sf), [0.20, 0.35, 0.50]))


@query
def prob_range(spark, sf):
    return rounded(ev.probability_range(s.linear_scored(spark, sf)))


@query
def class_counts(spark, sf):
    return rounded(ev.class_counts(views.transactions(spark, sf), CONTRACT.target))


# ---- requests and streaming ---------------------------------------------------------

def _reasons():
    return F.array_join(F.transform("_reasons", lambda x: F.concat_ws(":", x["field"], x["reason"])), "|")


@query
def json_requests(spark, sf):
    parsed = rq.parse_requests(s.payloads(spark, sf))
    return rounded(parsed.select(F.col("_row").alias("row_id"), *s.REQUEST, _reasons().alias("reasons")))


@query
def json_defaults(spark, sf):
    parsed = rq.accepted(rq.parse_requests(s.payloads(spark, sf)))
    return parsed.select(F.col("_row").alias("row_id"), *s.OPTIONAL)


@query
def json_requests_enriched(spark, sf):
    r = F.col("_row")
    given = lookup.enrich_lookup(views.transactions(spark, sf, row=True), views.customers(spark, sf))
    whole = F.to_json(F.struct(*s.REQUEST, *CONTRACT.customer_features))
    some = F.to_json(F.struct(*s.REQUEST, "Age", "Gender"))
    sent = given.withColumn(CONTRACT.time, F.lit(46023.5)).select(
        r, F.when(r % 3 == 0, some).otherwise(whole).alias("payload"))
    parsed = rq.parse_requests(sent, fields=rq.ENRICHED_FIELDS)
    return parsed.select(r.alias("row_id"), *CONTRACT.customer_features, F.size("_reasons").alias("n_reasons"))


@query
def json_batches(spark, sf):
    # fifty requests to a payload; one that isn't JSON on its own arrives as a piece of text in the list
    quoted = F.expr("substring(to_json(array(payload)), 2, length(to_json(array(payload))) - 2)")
    single = s.payloads(spark, sf).withColumn("payload", F.when(F.try_parse_json("payload").isNull(), quoted).otherwise(F.col("payload")))
    batch = single.groupBy(F.floor(F.col("_row") / 50).alias("batch")).agg(F.concat(
        F.lit('{"transactions":['), F.array_join(F.collect_list("payload"), ","), F.lit("]}")).alias("payload"))
    parsed = rq.parse_batches(batch)
    return parsed.groupBy("batch").agg(
        F.count(F.lit(1)).alias("total_processed"), F.count_if(F.size("_reasons") == 0).alias("accepted"),
        F.round(F.sum("Amount_NGN"), 2).alias("amount"),
        F.count_if(F.exists("_reasons", lambda x: x["field"] == "payload")).alias("malformed"))


def _decision_rows(df):
    return df.select(F.col("_row").alias("row_id"), "row_status", "Predicted_Risk_Flag", "Risk_Probability", "Risk_Tier",
                     F.size("_issues").alias("n_issues"))


@query
def score_requests(spark, sf):
    return _decision_rows(decisions(s.payloads(spark, sf), s.scoring_job(spark, sf)))


@query
def stream_score(spark, sf):
    table = f"{sf}/events.parquet"
    source = spark.readStream.schema(spark.read.parquet(table).schema)
    txn = source.option("pathGlobFilter", "events.parquet").parquet(sf)
    columns = {**views.TXN, "_row": "event_id"}
    txn = txn.selectExpr("*", f"{views.K} as k").selectExpr(*[f"{e} as {c}" for c, e in columns.items()])
    out, state = scratch_path(spark, "scored"), scratch_path(spark, "progress")
    start_scoring(s.as_payloads(txn), s.scoring_job(spark, sf), out, state).awaitTermination()
    return _decision_rows(spark.read.parquet(out))


@query
def stream_refreshed(spark, sf):
    """The same requests as two files and two micro-batches, each with the dimension as it is then."""
    place, out, state = (scratch_path(spark, n) for n in ("requests", "scored", "progress"))
    lines = s.payloads(spark, sf)
    for i in range(2):
        lines.where(F.col("_row") % 2 == i).select(F.to_json(F.struct("_row", "payload"))).coalesce(1).write.mode("append").text(place)
    taken = F.from_json("payload", "_row long, payload string")
    requests = request_stream(spark, place, files_per_batch=1).select(taken.alias("r")).select("r.*")
    job = s.scoring_job(spark, sf)
    start_refreshed(requests, job, lambda session: views.dirty_customers(session, sf), out, state).awaitTermination()
    return _decision_rows(read_batches(spark, out))


# ---- training: rows-only, no SQL twin -----------------------------------------------

@lru_cache(maxsize=4)
def _prepared(spark: SparkSession, sf: str) -> DataFrame:
    """The split table, written once: checks, fits and vectors read it many times, and each time would join it anew."""
    return stored(s.split_table(spark, sf), "prepared", "split")


@lru_cache(maxsize=4)
def _trained(spark: SparkSession, sf: str) -> Trained:
    """One training run serves the queries that report on it."""
    table = _prepared(spark, sf)
    return run_training(*(table.where(F.col("split") == part).drop("split") for part in ("train", "test")))


@lru_cache(maxsize=4)
def _features(spark: SparkSession, sf: str) -> fe.FeaturePreparer:
    """The features fitted on the train part, for the vectors and for those who ask for their names."""
    with split_methods(spark):
        return fe.FeaturePreparer().fit(_prepared(spark, sf).where("split = 'train'"))


@lru_cache(maxsize=4)
def _vectors(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Label and features of both parts, as a table in the shared folder that both models read."""
    rows = _features(spark, sf).transform(clean.with_label(_prepared(spark, sf)))
    with split_methods(spark):
        table = stored(rows.select(ID, "label", "features", "split"), "vectors", "split")
    return tuple(table.where(F.col("split") == part) for part in ("train", "test"))


def _held_out(fit, spark, sf):
    train, test = _vectors(spark, sf)
    return ev.metrics(fit(train).score(test).select("label", "probability"))


@query
def train_lr(spark, sf):
    return _held_out(train_logistic, spark, sf)


@query
def train_rf(spark, sf):
    return _held_out(train_forest, spark, sf)


@query
def model_card(spark, sf):
    card = _trained(spark, sf).card
    flat = {**{k: v for k, v in card.items() if not isinstance(v, dict)}, **card["baseline_comparison"],
            **{f"metric_{k}": v for k, v in card["metrics"].items() if k != "confusion_matrix"}}
    return spark.createDataFrame([tuple(flat.values())], list(flat))


@query
def importances(spark, sf):
    found = _trained(spark, sf)
    return spark.createDataFrame(list(found.importances.items()), "feature string, importance double")


# ---- certificates: what trained models must satisfy, computed without the library that fitted them ----

#: The steepest mean slope at which a logistic solution counts as one (at zero coefficients slopes are about 0.05).
FLAT = 1e-4


@lru_cache(maxsize=2)
def _forest(spark: SparkSession, sf: str):
    return train_forest(_vectors(spark, sf)[0])


@query
def lr_certificate(spark, sf):
    train, _ = _vectors(spark, sf)
    names = ["intercept", *_features(spark, sf).params.names()]
    named = spark.createDataFrame([(i - 1, n) for i, n in enumerate(names)], "position int, feature string")
    slopes = certify.logistic_gradient(train_logistic(train), train)
    return named.join(slopes, "position", "full").select(F.col("position").cast("long"), "feature", (F.abs("gradient") < FLAT).alias("at_optimum"))


@query
def forest_walk(spark, sf):
    model, (_, test) = _forest(spark, sf), _vectors(spark, sf)
    walked = certify.walk(model, certify.forest_nodes(model), test, ID).withColumnRenamed("probability", "walked")
    both = model.score(certify.dealt(test, ID)).select(ID, "label", "probability").join(walked, ID, "full")
    return both.select(ID, F.col("label").cast("long").alias("label"), (F.abs(F.col("probability") - F.col("walked")) < 1e-9).alias("same_score"))


@query
def forest_importances(spark, sf):
    model, names = _forest(spark, sf), _features(spark, sf).params.names()
    own = [(i, n, float(w)) for i, (n, w) in enumerate(zip(names, model.classifier.featureImportances.toArray()))]
    found = certify.forest_importances(certify.forest_nodes(model)).withColumnRenamed("feature", "position")
    both = spark.createDataFrame(own, "position int, feature string, own double").join(found, "position", "full")
    return both.select(F.col("position").cast("long"), "feature", (F.abs(F.coalesce("importance", F.lit(0.0)) - F.col("own")) < 1e-9).alias("same_importance"))
