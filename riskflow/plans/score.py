"""Batch scoring as one lazy plan from scan to decision rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskflow.artifacts import newest
from riskflow.contract import CONTRACT, Contract
from riskflow.models.scorers import LinearScorer, Scorer, load_scorer, model_version
from riskflow.operators.decide import DECISION_COLUMNS, decide
from riskflow.operators.features import FeatureParams, FeaturePreparer, prepared_inputs, scaled, transform_vector
from riskflow.operators.lookup import enrich_lookup
from riskflow.operators.quality import clean_rows, quarantined_rows, with_row_issues
from riskflow.plans.validate import validate
from riskflow.sinks import write_table
from riskflow.sources.tables import from_records, read_any, read_table, typed_numbers

SCORED, QUARANTINED = "scored", "quarantined"
REFUSED, UNSCORED = "REFUSED_REQUEST", "NO_PROBABILITY"


def with_features(df: DataFrame, params: FeatureParams, scorer: Scorer, contract: Contract = CONTRACT) -> DataFrame:
    """What the scorer reads: scaled columns for a linear expression, else the vector."""
    if not isinstance(scorer, LinearScorer):
        return transform_vector(df, params, contract, params.serial_rounding)
    return prepared_inputs(df, contract, params.serial_rounding).selectExpr("*", *[f"{scaled(c, params)} as _num_{c}" for c in params.median])


def score_rows(df: DataFrame, params: FeatureParams, scorer: Scorer, contract: Contract = CONTRACT,
               only: Column | None = None) -> DataFrame:
    """Decision columns next to the input columns; rows where ``only`` doesn't hold are not handed to the model."""
    given = df.columns
    out = scorer.score(with_features(df, params, scorer, contract), only).select(*given, "probability")
    return decide(out, "probability", scorer.threshold, model_version(scorer))


class ScoringJob:
    """Frozen features, a model and an optional customer dimension, ready to score.

    ``strict`` rejects a batch with any error, as one extra pass; ``quarantine`` diverts
    the offending rows and scores the others in the same plan.
    """

    def __init__(self, params: FeatureParams, scorer: Scorer, customers: DataFrame | None = None,
                 contract: Contract = CONTRACT, mode: str = "strict", customer_order: list[str] | None = None):
        if mode not in ("strict", "quarantine"):
            raise ValueError("mode must be 'strict' or 'quarantine'")
        self.params, self.scorer, self.customers = params, scorer, customers
        self.contract, self.mode, self.customer_order = contract, mode, customer_order

    @classmethod
    def load(cls, spark: SparkSession, artifacts: str, customers: str | None = None, **options) -> ScoringJob:
        """Read what training saved, the newest whole version where there are versions; without customers nothing is looked up."""
        artifacts = newest(spark, artifacts) or artifacts
        params = FeaturePreparer.load(spark, f"{artifacts}/features").params
        dim = read_any(spark, customers) if customers else None
        return cls(params, load_scorer(spark, f"{artifacts}/classifier"), dim, **options)

    def with_customers(self, customers: DataFrame | None) -> ScoringJob:
        """The same job with another dimension."""
        return ScoringJob(self.params, self.scorer, customers, self.contract, self.mode, self.customer_order)

    def enrich(self, df: DataFrame) -> DataFrame:
        return enrich_lookup(df, self.customers, self.contract, self.customer_order)

    def flagged(self, df: DataFrame) -> DataFrame:
        """Enriched rows with their errors."""
        return with_row_issues(self.enrich(df), self.contract, "enriched")

    def score(self, data) -> DataFrame:
        """Score a record, a list of records or a table."""
        data = from_records(SparkSession.active(), data, self.contract)
        if self.mode == "strict":
            rows = self.enrich(data)
            validate(rows, self.contract)
        else:
            rows = clean_rows(self.flagged(data))
        return score_rows(typed_numbers(rows, self.contract), self.params, self.scorer, self.contract)

    def quarantine(self, df: DataFrame) -> DataFrame:
        """The rows that are not scored, and why."""
        return quarantined_rows(self.flagged(df))

    def both(self, df: DataFrame) -> DataFrame:
        """All rows in one plan: decisions, or the errors, told apart by ``row_status``.

        Rows that arrive with ``_reasons`` of a refused request keep those as their errors.
        """
        flagged = self.flagged(df)
        if "_reasons" in df.columns:
            refused = F.transform("_reasons", lambda x: F.struct(
                x["field"].alias("field"), F.lit(REFUSED).alias("error_type"), x["reason"].alias("value")))
            flagged = flagged.withColumn(
                "_issues", F.when(F.size("_reasons") > 0, refused).otherwise(F.col("_issues"))).drop("_reasons")
        good = F.size("_issues") == 0
        scored = score_rows(typed_numbers(flagged, self.contract), self.params, self.scorer, self.contract, only=good)
        # a row the model gave no probability is diverted as well, with that as its error
        failed = F.array(F.struct(F.lit("probability").alias("field"), F.lit(UNSCORED).alias("error_type"), F.lit(None).cast("string").alias("value")))
        done = good & F.col("Risk_Probability").isNotNull()
        return scored.withColumns({
            **{c: F.when(done, F.col(c)) for c in DECISION_COLUMNS},
            "row_status": F.when(done, SCORED).otherwise(QUARANTINED),
            "_issues": F.when(good & ~done, failed).otherwise(F.col("_issues")),
        })

    def run(self, path: str, out: str, fmt: str = "parquet", out_fmt: str = "parquet") -> DataFrame:
        """Score a stored table and write the result; gives back what was written.

        In quarantine mode one pass writes both kinds of rows, as partitions of ``out``.
        """
        spark = SparkSession.active()
        schema = self.contract.enriched_schema() if fmt == "csv" else None
        df = read_table(spark, path, fmt, schema)
        if self.mode == "strict":
            write_table(self.score(df), out, out_fmt)
        else:
            write_table(self.both(df), out, out_fmt, ("row_status",))
        reader = spark.read.format(out_fmt)
        return (reader.option("header", True) if out_fmt == "csv" else reader).load(out)
