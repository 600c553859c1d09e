"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS choose data and cores. Every
query is run in full (results go to a sink that discards them), twice after a warm-up
pass of the session; the smaller time counts. Training runs once, with its features.
BENCH_REPEAT=n benches the events n times over, in as many files (ids are shifted).
"""

from __future__ import annotations

import json
import os
import sys
import time

from riskflow.catalog import queries as catalog
from riskflow.catalog.queries import QUERIES
from riskflow.session import local_session, scratch_path

HEADLINE = ["score_batch", "score_with_quarantine", "enrich_left", "prepare", "split_exact", "dq_report",
            "dq_bad_categories", "quarantine_bad", "fit_medians", "fit_levels", "onehot_wide", "features_vector",
            "linear_score", "score_external", "metrics", "roc_auc", "tier_mix", "json_requests", "score_requests",
            "stream_score"]
ONCE = ["train_lr", "train_rf"]


def run(spark, name: str, sf: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def repeated(spark, sf: str, times: int) -> str:
    """A folder with the same tables, but the events ``times`` over."""
    out = scratch_path(spark, "bench")
    for name in ("customer", "events"):
        df = spark.read.parquet(f"{sf}/{name}.parquet")
        if name == "events":
            most = df.agg({"event_id": "max"}).first()[0] + 1
            df = df.crossJoin(spark.range(times).withColumnRenamed("id", "copy")).selectExpr(
                "* except (copy, event_id)", f"event_id + copy * {most} as event_id").select(*df.columns).repartition(times)
        df.write.parquet(f"{out}/{name}.parquet")
    return out


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(min(8, os.cpu_count() or 1)))
    spark = local_session("bench", cpus=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    data = repeated(spark, sf, n) if (n := int(os.environ.get("BENCH_REPEAT", "1"))) > 1 else sf
    run(spark, "scan_txn", data)
    times: dict[str, float] = {}
    for name in HEADLINE if data == sf else HEADLINE[:-1]:  # the stream reads a single file
        times[name] = min(run(spark, name, data) for _ in range(2))
    for name in ONCE:
        for made in (catalog._prepared, catalog._features, catalog._vectors):
            made.cache_clear()
        times[name] = run(spark, name, data)
    rows = spark.read.parquet(f"{data}/events.parquet").count()
    print(json.dumps({
        "metric": "total seconds of headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"), "rows": rows,
        "score_batch_rows_per_sec": round(rows / times["score_batch"])}))


if __name__ == "__main__":
    sys.exit(main())
