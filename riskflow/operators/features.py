"""Feature preparation: statistics are fitted on training rows and frozen.

Fitting reads medians, moments and category levels, a few small aggregates. Applying
them is a projection with the statistics as literals; for Spark ML the same projection
is a pipeline stage in front of the assembler of the (sparse) feature vector.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from riskflow.contract import CONTRACT, MISSING_LEVEL, Contract
from riskflow.functions.numeric import double_literal, number, quoted, text_literal
from riskflow.functions.time import temporal_columns
from riskflow.operators.median import column_profile, exact_medians


WIDE = 200  # levels of one column beyond which they are looked up instead of compared one by one


@dataclass(frozen=True)
class FeatureParams:
    """Frozen statistics, per input column."""

    median: dict[str, float]
    mean: dict[str, float]
    scale: dict[str, float]
    levels: dict[str, list[str]]
    serial_rounding: str = "floor"

    def names(self) -> list[str]:
        """Feature names in vector order: numerics as they are, then ``column_level``."""
        return list(self.median) + [f"{c}_{v}" for c, vs in self.levels.items() for v in vs]

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """One row per input column, in vector order."""
        rows = [(i, c, self.median[c], self.mean[c], self.scale[c], None) for i, c in enumerate(self.median)]
        rows += [(len(rows) + i, c, None, None, None, list(vs)) for i, (c, vs) in enumerate(self.levels.items())]
        return spark.createDataFrame(
            [(*r, self.serial_rounding) for r in rows],
            "position int, field string, median double, mean double, scale double, levels array<string>, serial_rounding string")

    @classmethod
    def from_frame(cls, df: DataFrame) -> FeatureParams:
        rows = df.orderBy("position").collect()  # one row per input column
        num = [r for r in rows if r["levels"] is None]
        return cls({r["field"]: r["median"] for r in num}, {r["field"]: r["mean"] for r in num},
                   {r["field"]: r["scale"] for r in num},
                   {r["field"]: list(r["levels"]) for r in rows if r["levels"] is not None},
                   rows[0]["serial_rounding"] if rows and "serial_rounding" in df.columns else "floor")

    def save(self, spark: SparkSession, path: str) -> str:
        self.to_frame(spark).coalesce(1).write.mode("overwrite").parquet(path)
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FeatureParams:
        """Read saved statistics; a missing path is an AnalysisException."""
        return cls.from_frame(spark.read.parquet(path))


def prepared_inputs(df: DataFrame, contract: Contract = CONTRACT, serial_rounding: str = "floor") -> DataFrame:
    """All columns, with numerics as doubles and the time features added."""
    absent = [c for c in contract.numeric + contract.categorical if c not in df.columns]
    if absent:
        raise ValueError(f"missing model inputs: {absent}")
    made = {c: f"double({e})" for c, e in temporal_columns(df, contract, serial_rounding).items()}
    made |= {c: number(c, df.schema[c].dataType) for c in contract.numeric}
    kept = [quoted(c) for c in df.columns if c not in made]
    return df.selectExpr(*kept, *[f"{e} as {quoted(c)}" for c, e in made.items()])


def fit_moments(profile: dict[str, Row], median: dict[str, float]) -> tuple[dict[str, float], dict[str, float]]:
    """Mean and population deviation after imputation; a constant column gets scale 1.

    The imputed rows are one more group of known size and value, so the moments of all
    rows follow from those of the non-null ones without another pass.
    """
    mean, scale = {}, {}
    for c, p in profile.items():
        if not p.n or p.lo == p.hi:
            mean[c], scale[c] = median[c], 1.0
            continue
        gaps, gap = p.rows - p.n, median[c] - p.mean
        mean[c] = p.mean + gap * gaps / p.rows
        scale[c] = math.sqrt((p.deviation ** 2 * p.n + gap * gap * p.n * gaps / p.rows) / p.rows)
    return mean, scale


def fit_numeric(src: DataFrame, contract: Contract = CONTRACT) -> tuple[dict, dict, dict]:
    """Medians, means and scales of prepared inputs. A column without any value is imputed with 0."""
    columns = list(contract.model_numeric)
    profile = column_profile(src, columns)
    median = {c: 0.0 if m is None else m for c, m in exact_medians(src, columns, profile=profile).items()}
    return median, *fit_moments(profile, median)


def filled_category(column: str) -> str:
    """SQL of a category's text with NULL as its own level."""
    return f"coalesce(cast({quoted(column)} as string), '{MISSING_LEVEL}')"


def level_table(df: DataFrame, contract: Contract = CONTRACT) -> DataFrame:
    """Distinct levels per category column with their row counts, from one pass."""
    pairs = ", ".join(f"named_struct('position', {i}, 'field', '{c}', 'level', {filled_category(c)})"
                      for i, c in enumerate(contract.categorical))
    return (
        df.selectExpr(f"explode(array({pairs})) as x")
        .groupBy("x.position", "x.field", "x.level").agg(F.count(F.lit(1)).alias("n"))
    )


def fit_features(df: DataFrame, contract: Contract = CONTRACT, serial_rounding: str = "floor") -> FeatureParams:
    """Fit on training rows."""
    src = prepared_inputs(df, contract, serial_rounding)
    median, mean, scale = fit_numeric(src, contract)
    levels: dict[str, list[str]] = {c: [] for c in contract.categorical}
    # each level is a column of the model, whose names and weights are as many
    for r in level_table(src, contract).orderBy("position", "level").collect():
        levels[r["field"]].append(r["level"])
    return FeatureParams(median, mean, scale, levels, serial_rounding)


def scaled(column: str, p: FeatureParams) -> str:
    """SQL of the imputed and standardised value of a prepared numeric column."""
    filled = f"coalesce({quoted(column)}, {double_literal(p.median[column])})"
    return f"({filled} - {double_literal(p.mean[column])}) / {double_literal(p.scale[column])}"


def indicators(p: FeatureParams) -> list[str]:
    """SQL of the 0/1 columns; a level not seen in training has none and is all zeros."""
    return [f"double({filled_category(c)} = {text_literal(v)})" for c, vs in p.levels.items() for v in vs]


def transform_wide(df: DataFrame, p: FeatureParams, contract: Contract = CONTRACT, keep: tuple[str, ...] = (),
                   serial_rounding: str = "floor") -> DataFrame:
    """Every feature as its own column, named as in :meth:`FeatureParams.names`."""
    values = [scaled(c, p) for c in p.median] + indicators(p)
    return prepared_inputs(df, contract, serial_rounding).selectExpr(
        *[quoted(c) for c in keep], *[f"{e} as {quoted(n)}" for e, n in zip(values, p.names())])


def vector_pipeline(p: FeatureParams) -> PipelineModel:
    """A saveable ML pipeline from prepared inputs to the ``features`` vector, in name order.

    A column of very many levels is indexed by a table of them and encoded as one sparse vector; the result is the same.
    """
    exprs, slots, indexed = [scaled(c, p) for c in p.median], [f"_n{i}" for i in range(len(p.median))], []
    order = list(slots)
    for j, (c, vs) in enumerate(p.levels.items()):
        if len(vs) > WIDE:
            exprs.append(filled_category(c))
            slots.append(f"_t{j}")
            indexed.append((f"_t{j}", f"_i{j}", f"_v{j}", vs))
            order.append(f"_v{j}")
        else:
            exprs += [f"double({filled_category(c)} = {text_literal(v)})" for v in vs]
            slots += [f"_x{j}_{k}" for k in range(len(vs))]
            order += [f"_x{j}_{k}" for k in range(len(vs))]
    columns = ", ".join(f"{e} AS {n}" for e, n in zip(exprs, slots))
    stages = [SQLTransformer(statement=f"SELECT *, {columns} FROM __THIS__")]
    for text, index, vector, vs in indexed:
        indexer = StringIndexerModel.from_labels(vs, inputCol=text, outputCol=index, handleInvalid="keep")
        # the indexer's metadata tells the encoder all sizes; its last index, for unseen levels, gets no place
        known = indexer.transform(SparkSession.active().createDataFrame([(vs[0],)], f"{text} string"))
        stages += [indexer, OneHotEncoder(inputCol=index, outputCol=vector, dropLast=True).fit(known)]
    return PipelineModel([*stages, VectorAssembler(inputCols=order, outputCol="features")])


def transform_vector(df: DataFrame, p: FeatureParams, contract: Contract = CONTRACT,
                     serial_rounding: str = "floor") -> DataFrame:
    """The input with the time features and a ``features`` vector added."""
    src = prepared_inputs(df, contract, serial_rounding)
    return vector_pipeline(p).transform(src).select(*src.columns, "features")


class FeaturePreparer:
    """Fit once on training rows, then transform any rows with the same statistics."""

    def __init__(self, contract: Contract = CONTRACT, serial_rounding: str = "floor"):
        self.contract, self.serial_rounding = contract, serial_rounding
        self.params: FeatureParams | None = None

    def fit(self, df: DataFrame) -> FeaturePreparer:
        self.params = fit_features(df, self.contract, self.serial_rounding)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        if self.params is None:
            raise RuntimeError("fit the features before transforming")
        return transform_vector(df, self.params, self.contract, self.serial_rounding)

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)

    def save(self, spark: SparkSession, path: str) -> str:
        if self.params is None:
            raise RuntimeError("fit the features before saving")
        return self.params.save(spark, path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, contract: Contract = CONTRACT) -> FeaturePreparer:
        params = FeatureParams.load(spark, path)
        made = cls(contract, params.serial_rounding)
        made.params = params
        return made
