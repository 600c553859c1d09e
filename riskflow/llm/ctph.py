"""Context-triggered piecewise hashing of documents, and likeness of fingerprints by edit distance.

A rolling hash over seven bytes decides where pieces end: where its value plus one is a multiple of the block size
3 * 2^k. A piece gives one of 64 characters. The block size is the smallest with at most 63 cuts in the whole text, so
every byte counts and no piece stands for "the rest"; signatures at two and four times the block size make texts of
other lengths comparable. A fingerprint is ``block size:signature:at twice the size:at four times the size``.

Two fingerprints are compared at each block size that both have, and the best counts: 1 - d / (both lengths), where d
is the edit distance in which a change costs a deletion and an insertion. Signatures without a common run of up to seven
characters count as unlike (0), as chance alone shares single characters. Equal fingerprints have likeness 1.

Null texts count as empty (fingerprint ``3:::``). Rows follow each other by id, then by a hash of the text; null ids come first;
after the last comes the first, so a lone row follows itself. Repeated rows each get a row. An empty table gives no
rows. Other columns of the input are left alone.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.tables import slices, texts_of
from riskflow.llm.words import mix

WINDOW, CUTS, RUN, SIZES = 7, 63, 7, 3
#: Bytes hashed at once; a longer text is hashed piece by piece.
AT_ONCE = 1 << 20
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_CODE = np.zeros(256, np.uint8)
_CODE[ALPHABET] = np.arange(64)
_FIRST = -2**63


def _rolled(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte after the first seven: the rolling hash plus one, and the running sum of its mixed values."""
    c = data.astype(np.int64)
    s = np.cumsum(c)
    ss = np.cumsum(s)
    ss = np.concatenate([[0], ss])
    value = (s[7:] - s[:-7]) + 7 * s[7:] - (ss[7:-1] - ss[:-8])
    u = data.astype(np.uint32)
    two = u.copy()
    two[1:] ^= u[:-1] << np.uint32(5)
    four = two.copy()
    four[2:] ^= two[:-2] << np.uint32(10)
    value += four[7:] ^ (two[3:-4] << np.uint32(20)) ^ (u[1:-6] << np.uint32(30))
    value = (value & 0xFFFFFFFF) + 1
    mixed = value.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    return value, np.cumsum(mixed, dtype=np.uint64)


def _cuts(value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where a piece ends at block size 3, and the highest k at which it still does."""
    at = np.flatnonzero(value % 3 == 0)
    low = value[at] & -value[at]
    return at, np.frexp(low.astype(np.float64))[1] - 1


def _sign(sums: np.ndarray) -> str:
    """One character for each piece, from the running sums at the pieces' bounds."""
    return ALPHABET[(mix(np.diff(sums)) >> np.uint64(58)).astype(np.int64)].tobytes().decode()


def _level(k: np.ndarray) -> int:
    """The lowest level that has at most ``CUTS`` cuts."""
    counts = np.cumsum(np.bincount(k, minlength=1)[::-1])[::-1]
    return int(np.argmax(counts <= CUTS)) if counts[-1] <= CUTS else len(counts)


def _fingerprint(at: np.ndarray, k: np.ndarray, sums: np.ndarray, end: int, total: np.uint64, base: np.uint64, floor: int = 0) -> str:
    """From a text's cuts (places, levels, running sums there), its length and the sums at its end and start."""
    level, out = max(floor, _level(k)), []
    for size in range(level, level + SIZES):
        own = k >= size
        bounds = [base, *sums[own]]
        if end and not (own.any() and at[own][-1] == end - 1):
            bounds.append(total)
        out.append(_sign(np.array(bounds, np.uint64)) if len(bounds) > 1 else "")
    return ":".join([str(3 << level), *out])


def _long(text: bytes) -> str:
    """The fingerprint of a text of any length in bounded memory: cuts that no possible level needs are dropped."""
    at, k, sums, total, floor = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.zeros(1, np.uint64), 0
    for start in range(0, len(text), AT_ONCE):
        part = text[max(0, start - WINDOW):start + AT_ONCE]
        value, run = _rolled(np.frombuffer(b"\0" * max(0, WINDOW - start) + part, np.uint8))
        own, levels = _cuts(value)
        at, k, sums = np.concatenate([at, own + start]), np.concatenate([k, levels]), np.concatenate([sums, run[own] + total])
        total = run[-1:] + total
        floor = max(floor, _level(k))
        keep = k >= floor
        at, k, sums = at[keep], k[keep], sums[keep]
    return _fingerprint(at, k, sums, len(text), total[0], np.uint64(0), floor)


def fingerprints(texts: list[str]) -> list[str]:
    """The fingerprint of each text's UTF-8 bytes."""
    raw, out = [t.encode("utf-8", "surrogatepass") for t in texts], [""] * len(texts)
    group, size = [], 0
    for i, t in enumerate(raw):
        if len(t) > AT_ONCE:
            out[i] = _long(t)
            continue
        group.append(i)
        size += len(t)
        if size > AT_ONCE:
            _together(raw, group, out)
            group, size = [], 0
    if group:
        _together(raw, group, out)
    return out


def _together(raw: list[bytes], group: list[int], out: list[str]) -> None:
    """Fingerprints of many short texts at once; seven zero bytes before each keep their windows apart."""
    pad = b"\0" * WINDOW
    value, run = _rolled(np.frombuffer(b"".join([pad + raw[i] for i in group]) + pad, np.uint8))
    sizes = np.array([len(raw[i]) for i in group])
    starts = np.concatenate([[0], np.cumsum(sizes + WINDOW)[:-1]])  # places count from the first byte after the first pad
    at, k = _cuts(value)
    lows, highs = np.searchsorted(at, starts).tolist(), np.searchsorted(at, starts + sizes).tolist()
    sums = run[at]
    for i, a, b, start, n in zip(group, lows, highs, starts.tolist(), sizes.tolist()):
        base = run[start - 1] if start else np.uint64(0)
        out[i] = _fingerprint(at[a:b] - start, k[a:b], sums[a:b], n, run[start + n - 1] if n else base, base)


def _share_run(a: str, b: str) -> bool:
    n = min(RUN, max(1, min(len(a), len(b)) // 3))
    if min(len(a), len(b)) < n:
        return False
    grams = {a[i:i + n] for i in range(len(a) - n + 1)}
    return any(b[i:i + n] in grams for i in range(len(b) - n + 1))


def _common(pairs: list[tuple[str, str]]) -> np.ndarray:
    """Lengths of the longest common subsequences, bit-parallel over all pairs at once (at most 64 characters each)."""
    n = len(pairs)
    masks, rows = np.zeros((n, 64), np.uint64), np.arange(n)
    firsts, seconds = (np.zeros((n, 64), np.uint8) for _ in range(2))
    sizes = np.array([[len(a), len(b)] for a, b in pairs])
    for i, (a, b) in enumerate(pairs):
        firsts[i, :len(a)] = _CODE[np.frombuffer(a.encode(), np.uint8)]
        seconds[i, :len(b)] = _CODE[np.frombuffer(b.encode(), np.uint8)]
    for j in range(sizes[:, 0].max()):
        own = rows[sizes[:, 0] > j]
        masks[own, firsts[own, j]] |= np.uint64(1 << j)
    v = np.full(n, 2**64 - 1, np.uint64)
    for j in range(sizes[:, 1].max()):
        u = v & np.where(sizes[:, 1] > j, masks[rows, seconds[:, j]], np.uint64(0))
        v = (v + u) | (v - u)
    inside = np.where(sizes[:, 0] >= 64, np.uint64(2**64 - 1), (np.uint64(1) << np.minimum(sizes[:, 0], 63).astype(np.uint64)) - np.uint64(1))
    return np.bitwise_count(~v & inside).astype(np.int64)


def likeness(pairs: list[tuple[str, str]]) -> list[float]:
    """Likeness (0 to 1) of each pair of fingerprints."""
    out, todo, owner = [0.0] * len(pairs), [], []
    for i, (x, y) in enumerate(pairs):
        if x == y:
            out[i] = 1.0
            continue
        (p, *a), (q, *b) = x.split(":"), y.split(":")
        at = {int(p) << j: s for j, s in enumerate(a)}
        for j, t in enumerate(b):
            s = at.get(int(q) << j, "")
            if s and t and _share_run(s, t):
                todo.append((s, t))
                owner.append(i)
    if todo:
        for i, (s, t), n in zip(owner, todo, _common(todo).tolist()):
            out[i] = max(out[i], 2 * n / (len(s) + len(t)))
    return out


def edited(text: str, following: str) -> str:
    """The text whose last half of code points gives way to the first as many of the following one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def compare_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint beside those of its edited text and of the next document by id.

    Ids are cut at quantiles that occur among them; a row with such an id goes also to the range before, where it
    only serves as the next one. So one shuffle brings neighbours together, and no task sees more than its range.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    key = F.coalesce(F.col("doc_id"), F.lit(_FIRST))
    ranges = 4 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())
    found = own.select(key.alias("key")).agg(F.min("key"), F.percentile_approx("key", [i / ranges for i in range(1, ranges)], 10 * ranges)).first()
    heads = np.array(sorted({found[0], *found[1]}) if found[0] is not None else [_FIRST], np.int64)  # as many as there are ranges

    @F.pandas_udf("array<int>")
    def places(keys):
        at = np.searchsorted(heads, keys.to_numpy(), side="right") - 1
        first = heads[np.maximum(at, 0)] == keys.to_numpy()
        before = np.where(first, (at - 1) % len(heads), -1)
        import pandas as pd

        return pd.Series([[int(a)] if b < 0 else [int(a), int(b)] for a, b in zip(at, before)])

    spread = own.withColumn("key", key).withColumn("places", places(F.col("key")))
    dealt = spread.select("key", "doc_id", "text", F.posexplode("places").alias("ahead", "range"))
    ordered = dealt.repartition(-(-ranges // 4), "range").sortWithinPartitions("range", "ahead", "key", F.xxhash64("text"))

    def compare(batches):
        last = None  # (range, ahead, doc_id, text, fingerprint)
        for batch in slices(batches, 256):
            texts = texts_of(batch.column(2))
            rows = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist(), texts, fingerprints(texts)))
            seen = [last, *rows] if last else rows
            pairs = [(a, b) for a, b in zip(seen, seen[1:]) if a[0] == b[0] and a[1] == 0]
            last = rows[-1]
            if not pairs:
                continue
            new = [edited(a[3], b[3]) for a, b in pairs]
            marks = fingerprints(new)
            near = likeness([(a[4], m) for (a, _), m in zip(pairs, marks)] + [(a[4], b[4]) for a, b in pairs])
            yield pa.RecordBatch.from_arrays([
                pa.array([a[2] for a, _ in pairs], pa.int64()), pa.array([len(a[3]) for a, _ in pairs], pa.int64()),
                pa.array([hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in new], pa.string()),
                pa.array([a[4] for a, _ in pairs], pa.string()), pa.array(marks, pa.string()),
                pa.array(near[:len(pairs)], pa.float64()), pa.array(near[len(pairs):], pa.float64()),
            ], names=[c.split(" ")[0] for c in RESULT.split(", ")])

    return ordered.select("range", "ahead", "text", "doc_id").mapInArrow(compare, RESULT)
