"""Reports that add up: the state of a table's checks, kept for each part and merged.

A state is a small table in long form: the number of rows, a counter for each rule, every unexpected category value with its
rows and first place, and the first offending values of the other rules. Counters and rows add up, the first place is
the least, and the first values of several parts are the first among theirs, so the merged state of parts is the state of all
their rows, in whatever order they are merged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskflow.contract import CONTRACT, Contract
from riskflow.functions.numeric import text_literal
from riskflow.operators.quality import (BAD_CATEGORY, EMPTY, SAMPLES, Rule, column_issues, first_values, issue_row, listed_values, measure, report_of,
                                        row_order, rules_for)

COUNTER, VALUE, SAMPLE = "counter", "value", "sample"


def state(df: DataFrame, rules: list[Rule], order: list[str]) -> DataFrame:
    """``kind, field, error_type, value, n, _at`` of one table, which is read once."""
    measured = measure(df, rules, order)
    keys = [("Dataset", EMPTY, "total"), *((r.field, r.error_type, f"r{i}") for i, r in enumerate(rules))]
    counters = measured.counts.selectExpr("inline(array(" + ", ".join(
        f"named_struct('field', {text_literal(f)}, 'error_type', '{t}', 'n', {c})" for f, t, c in keys) + "))")
    listed = listed_values(measured.hits, order)
    plain = first_values(measured.hits.where(F.col("error_type") != BAD_CATEGORY), listed.limit(0))
    nothing = F.lit(None).cast(listed.schema["_at"].dataType)
    return (
        counters.select(F.lit(COUNTER).alias("kind"), "field", "error_type", F.lit(None).cast("string").alias("value"), "n", nothing.alias("_at"))
        .unionByName(listed.select(F.lit(VALUE).alias("kind"), "field", "error_type", "value", "n", "_at"))
        .unionByName(plain.select(F.lit(SAMPLE).alias("kind"), "field", "error_type", "value", F.lit(1).cast("long").alias("n"), "_at"))
    )


def merged(states: DataFrame) -> DataFrame:
    """The state of all rows from the union of the states of their parts."""
    counts = states.where(F.col("kind") == COUNTER).groupBy("kind", "field", "error_type", "value").agg(F.sum("n").alias("n"))
    values = states.where(F.col("kind") == VALUE).groupBy("kind", "field", "error_type", "value").agg(F.sum("n").alias("n"), F.min("_at").alias("_at"))
    kept = states.where(F.col("kind") == SAMPLE)
    first = first_values(kept, values.limit(0).select("_at", "field", "error_type", "value"), SAMPLES)
    first = first.select(F.lit(SAMPLE).alias("kind"), "field", "error_type", "value", F.lit(1).cast("long").alias("n"), "_at")
    at = F.lit(None).cast(states.schema["_at"].dataType).alias("_at")
    return counts.select("kind", "field", "error_type", "value", "n", at).unionByName(values).unionByName(first)


def report(found: DataFrame, like: DataFrame, contract: Contract = CONTRACT, dataset_type: str = "auto", training: bool = False, strict: bool = True) -> DataFrame:
    """The report of a merged state, as one row; ``like`` has the columns of the table; its rows are counted only if a required one is missing."""
    variant = contract.variant(like.columns, dataset_type, training)
    missing, extra = column_issues(like, variant, contract)
    if missing:
        return report_of(issue_row(like, contract, dataset_type, training), missing, extra, strict)
    keys = [("total", "Dataset", EMPTY), *((f"r{i}", r.field, r.error_type) for i, r in enumerate(rules_for(like, variant, contract)))]
    counters = found.where(F.col("kind") == COUNTER)
    counts = counters.agg(*(F.expr(f"coalesce(sum(n) filter (where field = {text_literal(f)} and error_type = '{t}'), 0) as {c}") for c, f, t in keys))
    row = issue_row(like, contract, dataset_type, training, counts)
    listed = found.where(F.col("kind") == VALUE)
    first = first_values(found.where(F.col("kind") == SAMPLE), listed)
    return report_of(row, missing, extra, strict, listed, first)


class Ledger:
    """Saved states of the parts of a growing table, one folder for each part under ``path``."""

    def __init__(self, spark: SparkSession, path: str, contract: Contract = CONTRACT, dataset_type: str = "auto", training: bool = False):
        self.spark, self.path, self.contract, self.dataset_type, self.training = spark, path.rstrip("/"), contract, dataset_type, training

    def _folder(self):
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        return place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), place

    def _place(self, part: str) -> str:
        return f"{self.path}/{part.encode().hex() or '-'}"  # a part's name may hold what a path can't

    def known(self) -> set[str]:
        """Parts whose state has been written as a whole: Spark's mark of success comes last."""
        system, place = self._folder()
        if not system.exists(place):
            return set()
        whole = [f.getPath() for f in system.listStatus(place) if system.exists(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS"))]
        return {bytes.fromhex(p.getName().replace("-", "")).decode() for p in whole}

    def forget(self, part: str) -> None:
        """Drop the state of a part that has changed."""
        system, _ = self._folder()
        system.delete(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._place(part)), True)

    def update(self, df: DataFrame, part: str, order: list[str] | None = None) -> list[str]:
        """Read the parts that are new and save their states. Values of ``part`` are the table's folders, so few; null counts as a part named by nothing."""
        named = F.coalesce(F.col(part).cast("string"), F.lit(""))
        known, done = self.known(), []
        rows = df.drop(part)
        variant = self.contract.variant(rows.columns, self.dataset_type, self.training)
        if column_issues(rows, variant, self.contract)[0]:
            return done  # without a required column no row is checked
        rules, order = rules_for(rows, variant, self.contract), row_order(rows, self.contract, order)
        for name in sorted({r[0] for r in df.select(named).distinct().collect()} - known):
            new = df.where(F.col(part).isNull() | (F.col(part).cast("string") == "") if name == "" else F.col(part).cast("string") == name)
            state(new.drop(part), rules, order).coalesce(1).write.mode("overwrite").parquet(self._place(name))
            done.append(name)
        return done

    def report(self, like: DataFrame, strict: bool = True) -> DataFrame:
        """The report over all saved parts."""
        variant = self.contract.variant(like.columns, self.dataset_type, self.training)
        missing, extra = column_issues(like, variant, self.contract)
        parts = sorted(self._place(p) for p in self.known())
        if missing or not parts:  # only the number of rows counts
            return report_of(issue_row(like, self.contract, self.dataset_type, self.training), missing, extra, strict)
        return report(merged(self.spark.read.parquet(*parts)), like, self.contract, self.dataset_type, self.training, strict)
