"""Evaluation of scored rows; all are global aggregates.

The ranking metric needs an order over scores. Rows are first summed per distinct score. A score
has a 64-bit key that sorts alike, and the pairs of a positive and a negative row are counted where their keys
part: in the last 16 bits within a prefix of 48, in the 16 before that within one of 32, and so on. No window ever
has more than 65,536 rows, whatever the distribution, and nothing has to be known of the scores beforehand.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, functions as F

from riskflow.contract import REVIEW_THRESHOLD
from riskflow.functions.numeric import double_literal
from riskflow.functions.order_key import with_keys

SCORE_RANGES, RANGE_ROWS = 64, 1_000_000
DIGITS, DIGIT_BITS = 4, 16


def confusion_sql(label: str, probability: str, threshold: float) -> dict[str, str]:
    """The four counts, as SQL aggregates."""
    hit = f"{probability} >= {double_literal(threshold)}"
    return {"tn": f"count_if({label} = 0 and not {hit})", "fp": f"count_if({label} = 0 and {hit})",
            "fn": f"count_if({label} = 1 and not {hit})", "tp": f"count_if({label} = 1 and {hit})"}


def confusion(scored: DataFrame, label: str = "label", probability: str = "probability",
              threshold: float = REVIEW_THRESHOLD) -> DataFrame:
    """One row of true and false negatives and positives."""
    return scored.agg(*[F.expr(f"{e} as {c}") for c, e in confusion_sql(label, probability, threshold).items()])


def class_metrics(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 of confusion counts; 0 where undefined."""
    return counts.selectExpr(
        "*", "if(tp + fp = 0, 0D, try_divide(tp, tp + fp)) as precision",
        "if(tp + fn = 0, 0D, try_divide(tp, tp + fn)) as recall",
        "if(2 * tp + fp + fn = 0, 0D, try_divide(2 * tp, 2 * tp + fp + fn)) as f1_score")


def brier(scored: DataFrame, label: str = "label", probability: str = "probability") -> DataFrame:
    gap = F.col(probability) - F.col(label)
    return scored.agg(F.avg(gap * gap).alias("brier_score"))


def score_bounds(scored: DataFrame, probability: str = "probability", ranges: int | None = None) -> list[float]:
    """Inner bounds that cut the rows into ranges of about equal weight, a million rows each or fewer.

    They steer parallelism only: any bounds give the same results.
    """
    ranges = ranges or max(SCORE_RANGES, -(-scored.count() // RANGE_ROWS))
    cuts = [i / ranges for i in range(1, ranges)]
    found = scored.agg(F.percentile_approx(probability, cuts, 10 * ranges).alias("q")).first()["q"]
    return sorted(set(found or []))


def evaluate(scored: DataFrame, label: str = "label", probability: str = "probability",
             threshold: float = REVIEW_THRESHOLD, bounds: list[float] | None = None) -> DataFrame:
    """One row with ROC-AUC (ties count half), Brier score and confusion counts.

    ROC-AUC is NULL where one class is absent. The rows are read once. With ``bounds`` scores are cut
    there instead of by the digits of their keys; the result is the same.
    """
    per_score = scored.groupBy(F.expr(f"{probability} as p")).agg(
        F.expr(f"count_if({label} = 1) as pos"), F.expr(f"count_if({label} = 0) as neg"))
    totals = _by_digits(per_score, threshold) if bounds is None else _by_bounds(per_score, bounds or [0.0], threshold)
    return totals.selectExpr(
        "if(pos > 0 and neg > 0, try_divide(won, double(pos) * neg), null) as roc_auc",
        "try_divide(loss, pos + neg) as brier_score", "neg - fp as tn", "fp", "pos - tp as fn", "tp")


def _by_digits(per_score: DataFrame, threshold: float) -> DataFrame:
    """One row of sums; ``won`` counts a positive row's wins over negative ones, ties half.

    A level's groups are dealt by the digits before, their window and their sum over those digits need no further shuffle.
    """
    hit = f"p >= {double_literal(threshold)}"
    checked = per_score.withColumn("p", F.expr("if(p is null or isnan(p), raise_error('a row has no score'), p)"))
    level = with_keys(checked, {"key": "p"}).selectExpr(
        "key", "pos", "neg", "double(pos) * neg / 2 as won", f"if({hit}, pos, 0L) as tp", f"if({hit}, neg, 0L) as fp",
        "pos * (1 - p) * (1 - p) + neg * p * p as loss")
    sums = ("pos", "neg", "won", "tp", "fp", "loss")
    for digit in range(1, DIGITS):
        below = "sum(neg) over (partition by before order by key) - neg"
        level = (
            level.withColumn("before", F.expr(f"shiftright(key, {DIGIT_BITS})"))
            .withColumn("won", F.expr(f"won + double(pos) * ({below})"))
            .groupBy("before").agg(*(F.sum(c).alias(c) for c in sums)).withColumnRenamed("before", "key")
        )
    # at most 65,536 rows are left
    last = level.withColumn("won", F.expr("won + double(pos) * (sum(neg) over (order by key) - neg)"))
    return last.agg(*(F.expr(f"coalesce(sum({c}), 0) as {c}") for c in sums))


def _by_bounds(per_score: DataFrame, bounds: list[float], threshold: float) -> DataFrame:
    ranged = Bucketizer(splits=[float("-inf"), *bounds, float("inf")], inputCol="p", outputCol="r",
                        handleInvalid="error").transform(per_score)
    hit = f"p >= {double_literal(threshold)}"
    sums = {
        "pos": "sum(pos)", "neg": "sum(neg)", "won": "sum(double(pos) * (below + neg / 2))",
        "tp": f"sum(if({hit}, pos, 0))", "fp": f"sum(if({hit}, neg, 0))",
        "loss": "sum(pos * (1 - p) * (1 - p) + neg * p * p)",
    }
    per_range = (
        ranged.selectExpr("*", "sum(neg) over (partition by r order by p) - neg as below")
        .groupBy("r").agg(*[F.expr(f"{e} as {c}") for c, e in sums.items()])
    )
    # one row per range from here on
    before = "coalesce(sum(neg) over (order by r rows between unbounded preceding and 1 preceding), 0)"
    return per_range.selectExpr("pos", "neg", f"won + double(pos) * {before} as won", "tp", "fp", "loss").agg(
        *[F.expr(f"coalesce(sum({c}), 0) as {c}") for c in sums])


def roc_auc(scored: DataFrame, label: str = "label", probability: str = "probability") -> DataFrame:
    return evaluate(scored, label, probability).select("roc_auc")


def metrics(scored: DataFrame, label: str = "label", probability: str = "probability",
            threshold: float = REVIEW_THRESHOLD) -> DataFrame:
    """The metric record: everything rounded to four digits, with the confusion matrix."""
    full = class_metrics(evaluate(scored, label, probability, threshold))
    return full.select(
        *[F.round(c, 4).alias(c) for c in ("roc_auc", "precision", "recall", "f1_score", "brier_score")],
        F.lit(float(threshold)).alias("decision_threshold"),
        F.array(F.array("tn", "fp"), F.array("fn", "tp")).alias("confusion_matrix"),
    )


def compare(candidate: DataFrame, baseline: DataFrame) -> DataFrame:
    """Two metric records side by side: baseline AUC and F1, and the AUC gained."""
    both = candidate.withColumn("m", F.lit("c")).unionByName(baseline.withColumn("m", F.lit("b")))

    def of(model: str, column: str) -> Column:
        return F.max(F.when(F.col("m") == model, F.col(column)))

    return both.agg(
        of("c", "roc_auc").alias("candidate_roc_auc"), of("c", "f1_score").alias("candidate_f1"),
        of("b", "roc_auc").alias("baseline_roc_auc"), of("b", "f1_score").alias("baseline_f1"),
        F.round(of("c", "roc_auc") - of("b", "roc_auc"), 4).alias("improvement_roc_auc"),
    )


def threshold_sweep(scored: DataFrame, thresholds: list[float], label: str = "label",
                    probability: str = "probability") -> DataFrame:
    """Confusion counts, precision and recall at several thresholds, from one aggregate."""
    at = ", ".join(
        "named_struct('threshold', " + double_literal(t) + ", "
        + ", ".join(f"'{c}', {e}" for c, e in confusion_sql(label, probability, t).items()) + ")" for t in thresholds)
    return class_metrics(scored.agg(F.expr(f"array({at}) as a")).selectExpr("inline(a)"))


def probability_range(scored: DataFrame, probability: str = "probability") -> DataFrame:
    return scored.agg(F.min(probability).alias("min_probability"), F.max(probability).alias("max_probability"))


def class_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per class and their share."""
    counts = df.groupBy(column).agg(F.expr("count(1) as n"))
    return counts.withColumn("share", F.col("n") / counts.agg(F.expr("sum(n)")).scalar())


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weights: all rows, divided by classes times the rows of the class."""
    counts = df.groupBy(label).agg(F.expr("count(1) as n"))
    rows_per_class = counts.agg(F.expr("sum(n) / count(1)")).scalar()
    return counts.withColumn("weight", rows_per_class / F.col("n"))
