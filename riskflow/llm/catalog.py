"""The registered queries of the corpus operators, with their SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.llm import bestfit, binpack, bitplanes, bpe, ctph, fm, fsjoin, grace, merkle, spelling, tokencount, toxicity, warc
from riskflow.llm.sql import MERKLE, SPELLING
from riskflow.llm.tables import ship


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def _labels(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/labels.parquet")


def _judged(scored: DataFrame, threshold: float, *more: str) -> DataFrame:
    return scored.select("doc_id", fm.held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), *more)


def op1_warc_index_merge(spark: SparkSession, sf: str) -> DataFrame:
    """The table has no capture times: a page counts as captured as many minutes after 2020 as its id modulo a year has."""
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    when = F.timestamp_seconds(F.lit(1577836800) + 60 * F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(525600)))
    return warc.archive(pages, time_col=when).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_bit_planes(spark: SparkSession, sf: str) -> DataFrame:
    files = bitplanes.write_ids(_documents(spark, sf))
    return bitplanes.read_documents(files).select("doc_id", "start", "n_tokens", "ids_crc32")


def op3_piecewise_hashes(spark: SparkSession, sf: str) -> DataFrame:
    return ctph.compare_neighbours(_documents(spark, sf))


def op4_vector_bin_packing(spark: SparkSession, sf: str) -> DataFrame:
    return binpack.shard(_documents(spark, sf))


def op5_nearest_examples(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf).select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, _labels(spark, sf)), evidence=True)
    return _judged(scored, toxicity.THRESHOLD, "neighbours", "cosines", "terms_found")


def op6_vertical_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return fsjoin.components(_documents(spark, sf), shingle=4, percent=85)


def op7_grace_hash_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return grace.decisions(_documents(spark, sf))


def op8_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return bestfit.pack(_documents(spark, sf))


def op9_forced_boundary_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.encode_decode(_documents(spark, sf), digests=True)


def op10_factorisation_machine(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf).select("doc_id", "text", "n_chars")
    return _judged(fm.score(docs, fm.fit(docs, _labels(spark, sf))), fm.THRESHOLD)


def op11_merkle_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Where the checksum of the id is even, the line ends of the text are taken out; the proofs find those rows."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle.audit(_documents(spark, sf), tampered, ["doc_id", "source", "lang", "n_chars", "text"])


def op12_heap_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return tokencount.count_tokens(_documents(spark, sf))


def op13_trie_variants(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.variants(_documents(spark, sf), strike=31)


def _shipped(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(f)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        ship(spark)
        return f(spark, sf)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: _shipped(f) for f in (
        op1_warc_index_merge, op2_bit_planes, op3_piecewise_hashes, op4_vector_bin_packing, op5_nearest_examples, op6_vertical_jaccard_join, op7_grace_hash_dedup, op8_best_fit_packing,
        op9_forced_boundary_bpe, op10_factorisation_machine, op11_merkle_windows, op12_heap_token_counts, op13_trie_variants)}

ORACLES: dict[str, str] = {
    "op1_warc_index_merge": """
WITH own AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     groups AS (SELECT html AS h, min(page_id) AS first_id FROM own WHERE strlen(html) >= 100 GROUP BY html)
SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest,
       CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM own LEFT JOIN groups ON html = h""",
    "op7_grace_hash_dedup": r"""
WITH texts AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
     groups AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM texts JOIN groups USING (t)""",
    "op11_merkle_windows": MERKLE,
    "op13_trie_variants": SPELLING,
}
