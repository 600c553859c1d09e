import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.ml.classification import RandomForestClassifier

import __spark_entry__ as entry
from riskflow.catalog import queries
from riskflow.catalog.oracles import ORACLES
from riskflow.catalog.queries import QUERIES
from riskflow.models.scorers import MlScorer
from tools.compare import TABLES, normal, same

SLOW = {"train_lr", "train_rf", "model_card", "importances"}


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def test_registry():
    assert set(ORACLES) == set(QUERIES) - SLOW
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query_equals_sql(spark, sf, duck, name):
    got, want = entry.queries()[name](spark, sf).toPandas(), duck.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert same(normal(got), normal(want))


def test_training_queries_join_and_fit_features_once(spark, sf, monkeypatch):
    made, fitted = [], []
    for log, of, name in ((made, queries.s, "split_table"), (fitted, queries.fe, "fit_features")):
        monkeypatch.setattr(of, name, lambda *a, f=getattr(of, name), log=log: (log.append(a), f(*a))[1])
    monkeypatch.setattr(queries, "train_forest", lambda train: MlScorer(RandomForestClassifier(numTrees=2, maxDepth=2, seed=1).fit(train)))
    shared = (queries._prepared, queries._features, queries._vectors, queries._forest)
    try:
        for c in shared:
            c.cache_clear()
        for name in ("forest_importances", "forest_walk"):
            QUERIES[name](spark, sf).collect()
        assert len(made) == len(fitted) == 1
        assert "Join" not in queries._prepared(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        for c in shared:
            c.cache_clear()


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 900 and "Risk_Tier" in df.columns


def test_entry_without_a_library_of_the_corpus_package():
    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op') for n in e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parents[1], capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == [str(len(QUERIES)), "False"], done.stderr
