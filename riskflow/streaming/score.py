"""Streaming scoring: the batch plan over a stream of JSON requests.

Stateless: every request is parsed, looked up, checked and scored on its own, so there
is no watermark and nothing to keep. One file sink takes all rows, partitioned by what
became of them, and its log makes the output exactly-once across restarts.

A dimension that changes under a running stream needs a plan for each micro-batch (``start_refreshed``): it is
read and measured anew, and every batch has a folder of its own, which a repeated batch overwrites.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from riskflow.plans.score import ScoringJob
from riskflow.sources.requests import TRANSACTION_FIELDS, Field, parse_requests
from riskflow.sources.tables import read_any


def request_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """New files of JSON lines in a folder, one ``payload`` per line."""
    return (
        spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)
        .withColumnRenamed("value", "payload")
    )


def decisions(requests: DataFrame, job: ScoringJob, payload: str = "payload",
              fields: tuple[Field, ...] = TRANSACTION_FIELDS) -> DataFrame:
    """Requests, batch or streaming, as scored and quarantined rows."""
    return job.both(parse_requests(requests, payload, fields))


def start_scoring(requests: DataFrame, job: ScoringJob, out: str, checkpoint: str, once: bool = True,
                  fields: tuple[Field, ...] = TRANSACTION_FIELDS) -> StreamingQuery:
    """Start writing decisions to ``out``; ``once`` stops after what is there now."""
    writer = (
        decisions(requests, job, fields=fields).writeStream.format("parquet").outputMode("append")
        .partitionBy("row_status").option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if once else writer).start(out)


def start_refreshed(requests: DataFrame, job: ScoringJob, customers: str | Callable[[SparkSession], DataFrame], out: str, checkpoint: str,
                    once: bool = True, fields: tuple[Field, ...] = TRANSACTION_FIELDS) -> StreamingQuery:
    """Start writing decisions that look customers up as they are when a micro-batch begins.

    ``customers`` is the dimension's path or a function that reads it. Its size decides for each batch whether it is broadcast,
    and, as a batch is a table, hot keys are salted beyond that. Batch ``n`` goes to ``out/batch=n``; Spark gives a repeated
    batch the same number and the same rows, so it replaces its own folder and adds nothing.
    """

    def write(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        dimension = read_any(session, customers) if isinstance(customers, str) else customers(session)
        found = decisions(batch, job.with_customers(dimension), fields=fields)
        found.write.mode("overwrite").partitionBy("row_status").parquet(f"{out}/batch={number}")

    writer = requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_batches(spark: SparkSession, out: str) -> DataFrame:
    """Decisions of all batches that have been written as a whole, with their ``batch``."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    whole = [f.getPath().toString() for f in system.listStatus(place) if system.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS"))]
    return spark.read.option("basePath", out).parquet(*sorted(whole))
