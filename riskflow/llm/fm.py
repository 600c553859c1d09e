"""Quality by a factorisation machine over hashed words, structure statistics and metadata.

A document is a sparse vector: its hashed words (log counts, of length 1 together), and for each statistic an indicator of
the step it lies in. Statistics are of the text's structure (shares of kinds of bytes, repetition of words, word pairs and
lines, lengths); metadata is the stored number of characters, how far it is from the text's own, and whether it is there.
The score is sigmoid(w0 + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j); the pairs cost linear time by
1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2).

The machine is fitted on at most ``fit_rows`` labelled documents (those of the lowest hash of their id, of the share that
isn't held out); its size is fixed by parameters. Every document is scored in one pass without a shuffle.

Null and empty texts have no words; their statistics say so, and they are scored like others. Null ids are kept,
are never labelled, and count as not held out. Rows with a null label aren't learned from; repeated rows are scored alike. Without
labels the score is 0.5; with one kind of label only, the smoothed base rate. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.encode import forget
from riskflow.llm.tables import fresh, slices, texts_of
from riskflow.llm.words import SPACES, joined, mix, word_hashes

WORD_BITS, FACTORS, STEPS = 15, 8, 24
FIT_ROWS, FOLDS, THRESHOLD = 8_000, 5, 0.3
EPOCHS, BATCH, RATE, DECAY = 6, 128, 0.08, 1e-4
STAT_WEIGHT, WORD_WEIGHT = 0.7, 0.5

# Kinds of bytes: others, small, capital, digit, blank, line end, stop, mark, symbol, beyond ASCII.
_KIND = np.zeros(256, np.int64)
for _i, _bytes in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n\r", b".,;:", b"!?'\"()-", b"#$%&*+/<=>@[\\]^_`{|}~", bytes(range(128, 256))), 1):
    _KIND[np.frombuffer(_bytes, np.uint8)] = _i
KINDS = 10
_LINE = np.ones(256, bool)
_LINE[[10, 13]] = False
STATS = KINDS + 10
WIDTH = (1 << WORD_BITS) + STATS * STEPS


def _step(share: np.ndarray) -> np.ndarray:
    """A share as one of 24 steps, finer near 0; exactly 0 has its own."""
    return np.where(share <= 0, 0, np.clip(1 + np.sqrt(share) * (STEPS - 2), 1, STEPS - 1)).astype(np.int64)


def _log_step(x: np.ndarray) -> np.ndarray:
    return np.clip(np.log2(np.maximum(x, 0) + 1) * 1.5, 0, STEPS - 1).astype(np.int64)


def _distinct(values: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(owner, value, count) of each distinct value of an owner, and the number of them for each."""
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    new = np.concatenate([[True], (v[1:] != v[:-1]) | (o[1:] != o[:-1])]) if len(v) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    return o[at], v[at], np.diff(np.concatenate([at, [len(v)]])), np.bincount(o[at], minlength=n)


def features(texts: list[str], n_chars: list[int | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows in compressed form: indices, values, and where each text's entries begin (one more at the end)."""
    n = len(texts)
    data, ends = joined(texts)
    sizes = np.diff(np.concatenate([[-1], ends])) - 1
    owner = np.repeat(np.arange(n), sizes + 1)
    kinds = np.bincount(owner * KINDS + _KIND[data], minlength=n * KINDS).reshape(n, KINDS)
    kinds[:, 4] -= 1  # the space after each text
    some = np.maximum(sizes, 1)
    words, bounds, _ = word_hashes(data, ends, ~SPACES)
    count = np.diff(bounds)
    of = np.repeat(np.arange(n), count)
    d_of, d_word, d_count, distinct = _distinct(words, of, n)
    most = np.zeros(n)
    np.maximum.at(most, d_of, d_count)
    same = (of[1:] == of[:-1])
    again = np.bincount(of[1:][same & (words[1:] == words[:-1])], minlength=n)
    pairs = mix(words[:-1] * np.uint64(3) + words[1:])[same]
    pair_of = of[1:][same]
    pair_kinds = _distinct(pairs, pair_of, n)[3]
    parted = data.copy()
    parted[ends] = 10
    lines, line_bounds, _ = word_hashes(parted, ends, _LINE)
    line_count = np.diff(line_bounds)
    line_kinds = _distinct(lines, np.repeat(np.arange(n), line_count), n)[3]
    chars = np.array([len(t) for t in texts])
    said = np.array([-1 if x is None else x for x in n_chars], np.int64)
    n_words, n_pairs = np.maximum(count, 1), np.maximum(count - 1, 1)
    steps = [_step(kinds[:, i] / some) for i in range(KINDS)] + [
        _step(1 - distinct / n_words), _step(most / n_words), _step(again / n_words), _step(1 - pair_kinds / n_pairs),
        _step(1 - line_kinds / np.maximum(line_count, 1)), _log_step(count), _log_step((sizes - kinds[:, 4]) / n_words),
        np.where(said < 0, 0, 1 + np.minimum(_log_step(said), STEPS - 2)), np.where(said < 0, 0, 1 + np.minimum(_log_step(np.abs(said - chars)), STEPS - 2)),
        _log_step(count / np.maximum(line_count, 1))]
    stats = (1 << WORD_BITS) + np.arange(STATS) * STEPS + np.stack(steps, 1)
    value = np.log1p(d_count)
    norm = np.sqrt(np.bincount(d_of, value * value, minlength=n))
    value = WORD_WEIGHT * value / np.maximum(norm, 1e-9)[d_of]
    at = (d_word & np.uint64((1 << WORD_BITS) - 1)).astype(np.int64)
    row = np.concatenate([d_of, np.repeat(np.arange(n), STATS)])
    order = np.argsort(row, kind="stable")
    index = np.concatenate([at, stats.ravel()])[order].astype(np.int32)
    values = np.concatenate([value, np.full(n * STATS, STAT_WEIGHT)])[order].astype(np.float32)
    return index, values, np.concatenate([[0], np.cumsum(distinct + STATS)])


@dataclass
class Machine:
    """w0, w (width), v (width x factors); ``rate`` set: a constant score instead."""

    w0: float
    w: np.ndarray
    v: np.ndarray
    rate: float | None = None

    def margin(self, index: np.ndarray, value: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        x, first = value[:, None], bounds[:-1]
        vx = self.v[index] * x
        total = np.add.reduceat(vx, first)
        return self.w0 + np.add.reduceat(self.w[index] * value, first) + 0.5 * (total * total - np.add.reduceat(vx * vx, first)).sum(1)

    def score(self, texts: list[str], n_chars: list[int | None]) -> np.ndarray:
        if self.rate is not None or not texts:
            return np.full(len(texts), self.rate if self.rate is not None else 0.0)
        return 1 / (1 + np.exp(-np.clip(self.margin(*features(texts, n_chars)).astype(np.float64), -30, 30)))


def fit_machine(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS, seed: int = 7) -> Machine:
    """Logistic loss, AdaGrad, rows in a fixed random order; ``rows`` are (indices, values, label)."""
    labels = np.array([y for _, _, y in rows], np.float64)
    if not len(rows) or labels.min() == labels.max():
        return Machine(0.0, np.zeros(1), np.zeros((1, 1)), (labels.sum() + 1) / (len(rows) + 2))
    rng = np.random.default_rng(seed)
    base = labels.mean()
    m = Machine(float(np.log(base / (1 - base))), np.zeros(WIDTH, np.float32), rng.normal(0, 0.02, (WIDTH, FACTORS)).astype(np.float32))
    seen_w, seen_v, seen_0 = np.full(WIDTH, 1e-3, np.float32), np.full((WIDTH, FACTORS), 1e-3, np.float32), 1e-3
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), BATCH):
            batch = order[at:at + BATCH]
            index, value = np.concatenate([rows[i][0] for i in batch]), np.concatenate([rows[i][1] for i in batch])
            sizes = np.array([len(rows[i][0]) for i in batch])
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            slope = (1 / (1 + np.exp(-m.margin(index, value, bounds))) - labels[batch]) / len(batch)
            each = np.repeat(slope, sizes).astype(np.float32) * value
            used, back = np.unique(index, return_inverse=True)
            v = m.v[index]
            total = np.repeat(np.add.reduceat(v * value[:, None], bounds[:-1]), sizes, axis=0)
            grad_v = each[:, None] * (total - v * value[:, None])
            g_w = np.bincount(back, each, len(used)) + DECAY * m.w[used]
            g_v = np.stack([np.bincount(back, grad_v[:, f], len(used)) for f in range(FACTORS)], 1) + DECAY * m.v[used]
            seen_w[used] += g_w * g_w
            seen_v[used] += g_v * g_v
            seen_0 += slope.sum() ** 2
            m.w[used] -= RATE * g_w / np.sqrt(seen_w[used])
            m.v[used] -= RATE * g_v / np.sqrt(seen_v[used])
            m.w0 -= RATE * slope.sum() / np.sqrt(seen_0)
    return m


def held_out(id_col: str = "doc_id") -> Column:
    """The share of ids that is never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, label: str, columns: list[str], limit: int) -> DataFrame:
    """At most ``limit`` rows of labelled documents that aren't held out: ``columns`` and ``y``, one for each id, text and label.

    Ids are taken by the lowest hash. Further texts of a repeated id come after all first texts, so no id crowds out others.
    Only ids and hashes of texts meet in the choice; its size bounds the broadcasts. Repeated rows leave within tasks first.
    """
    chosen = labels.select(F.col("doc_id").cast("long").alias("d_id"), F.col(label).cast("int").alias("y")).where(
        F.col("d_id").isNotNull() & F.col("y").isNotNull() & ~held_out("d_id")).distinct()
    there = docs.select(F.col("doc_id").cast("long").alias("d_id")).distinct()  # labels of other documents don't count
    chosen = chosen.join(there, "d_id", "left_semi").orderBy(F.xxhash64("d_id"), "d_id", "y").limit(limit)
    names = ["text", "n_chars"][:len(columns)]
    rows = docs.select(F.col("doc_id").cast("long").alias("d_id"), *(F.col(c).alias(a) for c, a in zip(columns, names))).join(
        F.broadcast(chosen), "d_id").withColumn("text_key", F.xxhash64("text"))
    keys = rows.groupBy("d_id", "y", "text_key").agg(F.count(F.lit(1)).alias("repeats"))
    first = keys.groupBy("d_id", "y").agg(F.min("text_key").alias("first_key"))
    kept = keys.join(F.broadcast(first), ["d_id", "y"]).orderBy(F.col("text_key") != F.col("first_key"), F.xxhash64("d_id"), "d_id", "y", "text_key").limit(limit)
    return rows.join(F.broadcast(kept.select("d_id", "y", "text_key")), ["d_id", "y", "text_key"], "left_semi").groupBy("d_id", "text", "y").agg(
        *(F.min(c).alias(c) for c in names[1:]), F.count(F.lit(1)).alias("repeats")).select("d_id", *names, "y")


def _with_chars(docs: DataFrame, text_col: str, chars_col: str) -> Column:
    return F.col(chars_col).cast("long") if chars_col in docs.columns else F.lit(None).cast("long")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", text_col: str = "text", chars_col: str = "n_chars", fit_rows: int = FIT_ROWS) -> Machine:
    """Fit on a bounded sample; executors make the vectors, the driver gets at most ``fit_rows`` of them."""
    named = docs.withColumn(chars_col, _with_chars(docs, text_col, chars_col))
    sample = labelled(named, labels, label, [text_col, chars_col], fit_rows)

    def vectors(batches):
        forget()
        for batch in slices(batches):
            index, value, bounds = features(texts_of(batch.column(1)), batch.column(2).to_pylist())
            cut = list(zip(bounds[:-1].tolist(), bounds[1:].tolist()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3).cast(pa.int32()), pa.array([index[a:b].tobytes() for a, b in cut], pa.binary()), pa.array([value[a:b].tobytes() for a, b in cut], pa.binary())],
                                             names=["d_id", "y", "places", "amounts"])

    rows = sample.mapInArrow(vectors, "d_id long, y int, places binary, amounts binary").collect()
    rows.sort(key=lambda r: (r.d_id, r.y, bytes(r.places), bytes(r.amounts)))  # the order in which tasks end changes nothing
    return fit_machine([(np.frombuffer(r.places, np.int32), np.frombuffer(r.amounts, np.float32), int(r.y > 0)) for r in rows])


def score(docs: DataFrame, machine: Machine, text_col: str = "text", chars_col: str = "n_chars", name: str = "score") -> DataFrame:
    """``docs`` with a score column; all other columns pass through (an older column of that name is replaced)."""
    spark = docs.sparkSession
    rest = docs.drop(name)
    held = spark.sparkContext.broadcast(machine)  # of a size that parameters fix
    t, c = fresh(rest, "scored_text", "scored_chars")
    wide = rest.withColumns({t: F.col(text_col), c: _with_chars(docs, text_col, chars_col)})

    def run(batches):
        forget()
        for batch in slices(batches):
            found = held.value.score(texts_of(batch.column(batch.num_columns - 2)), batch.column(batch.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(found, pa.float64())], names=[*batch.schema.names[:-2], name])

    from pyspark.sql.types import DoubleType, StructField, StructType

    return wide.mapInArrow(run, StructType([*rest.schema.fields, StructField(name, DoubleType())]))
