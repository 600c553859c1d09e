"""The pipeline's stages on their own inputs, and its registration."""

import re

import corpus_pipeline
import __spark_entry__ as entry
from riskflow.llm import catalog, fm, toxicity
from riskflow.llm.tables import stored

from . import cases


def test_registered():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in catalog.QUERIES} == {f"op{i}" for i in range(1, 14)} and set(catalog.QUERIES) | {"pipeline"} <= names
    assert set(catalog.ORACLES) <= set(entry.oracle_sql()) and len(corpus_pipeline.STAGES) == 5


def test_stages(spark, tmp_path):
    rows = cases.texts() + [(1000 + i, cases.prose(i, 80) if i % 4 else "%%% $$$ " * 30 + str(i)) for i in range(200)]
    docs = stored(cases.documents(spark, rows), "docs")
    spark.createDataFrame([(1000 + i, int(i % 4 > 0), 0) for i in range(200)], cases.LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stored(stage(spark, docs, str(tmp_path)), "stage")
        assert left.columns == docs.columns and left.exceptAll(docs).count() == 0, name
        if name == "quality classifier":
            model = fm.fit(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
            assert left.count() == fm.score(docs, model, name="s").where(f"s >= {fm.THRESHOLD}").count()
            kept = {r.doc_id for r in left.collect()}
            assert not any(1000 + i in kept for i in range(0, 200, 4)) and all(1000 + i in kept for i in range(200) if i % 4)
        if name == "exact dedup":
            assert left.count() == len({re.sub("[\x20\x09-\x0d]+", " ", r.text or "") for r in docs.collect()})
        if name == "n-gram Jaccard join":
            found = [(r.doc_id, r.text) for r in docs.collect()]
            own = [x for x in cases.components(found, 5, 80)]
            assert {r.doc_id for r in left.collect()} - {None} == {c for _, n, c in own if c is not None}
        docs = left
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in docs.collect()}
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == pieces.count()
    assert toxicity.THRESHOLD == 0.5


def test_scratch_goes_with_its_stage(spark, tmp_path):
    """When a stage begins, nothing is left of the stages before it but the table that it is given."""
    from riskflow import session

    docs = stored(cases.documents(spark, cases.texts() + [(1000 + i, cases.prose(i, 80)) for i in range(100)]), "docs")
    spark.createDataFrame([(1000 + i, int(i % 4 > 0), int(i % 5 == 0)) for i in range(100)], cases.LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    made, before = [], set(session._SCRATCH)
    for name, stage in corpus_pipeline.STAGES:
        found, kept = stage(spark, docs, str(tmp_path)), set(made)
        made = [p for p in session._SCRATCH if p not in before]
        assert not kept & set(made), name
        docs = found
        place = str(tmp_path / name)
        docs.write.parquet(place)
        docs = spark.read.parquet(place)
    assert docs.count() > 0
