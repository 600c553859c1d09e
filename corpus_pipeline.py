"""The corpus pipeline: documents through five corpus operators, stage by stage.

Each stage takes what its predecessor kept, as a table with the columns of ``documents``, and returns the rows that stay with
the same columns; the last returns the pieces of all remaining documents with their places in sequences. The
classifiers learn from the labels of the documents they are given (never of those held out), so every stage stands on
its own input. Rows are handled as rows: of repeated ids each is judged on its own.

A stage's result must be written before the next stage begins: that is when the scratch tables of the stages before are deleted.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.llm import bestfit, fm, fsjoin, grace, toxicity
from riskflow.llm.tables import Scratch, fresh, ship, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_SCRATCH: dict[int, list[Scratch]] = {}


def _stage(place: int) -> Callable[[Stage], Stage]:
    """A stage at a place of the pipeline: it deletes the scratch of the stages before it, and leaves its own to the next."""

    def made(work: Stage) -> Stage:
        @wraps(work)
        def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            ship(spark)
            for before in [k for k in _SCRATCH if k < place]:
                for scratch in _SCRATCH.pop(before):
                    scratch.free(spark)
            with Scratch() as own:
                found = work(spark, docs, sf_dir)
            _SCRATCH.setdefault(place, []).append(own)
            return found

        return run

    return made


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


@_stage(0)
def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine doesn't reject."""
    score, = fresh(docs, "quality_score")
    return fm.score(docs, fm.fit(docs, _labels(spark, sf_dir)), name=score).where(F.col(score) >= fm.THRESHOLD).select(*docs.columns)


@_stage(1)
def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose nearest labelled examples don't make them toxic."""
    score, = fresh(docs, "toxicity_score")
    return toxicity.score(docs, toxicity.fit(docs, _labels(spark, sf_dir)), name=score).where(F.col(score) < toxicity.THRESHOLD).select(*docs.columns)


@_stage(2)
def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the least id."""
    return grace.deduplicated(docs)


@_stage(3)
def unalike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies (five-word shingles, similarity 0.8 or more) the document with the least id."""
    return fsjoin.one_of_each(docs, shingle=5, percent=80)


@_stage(4)
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining document's pieces and their places in sequences of 1024 tokens."""
    return bestfit.pack(docs)


STAGES = [("quality classifier", good), ("toxicity", harmless), ("exact dedup", distinct), ("n-gram Jaccard join", unalike), ("best-fit packing", packed)]

#: Trained models and token ids have no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order on ``documents``; each stage's result is written and read again."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        found = stage(spark, docs, sf_dir)
        with Scratch() as written:
            docs = stored(found, name.replace(" ", "_"))
        if before:
            before.free(spark)
        before = written
    return STAGES[-1][1](spark, docs, sf_dir)
