"""Small tables with everything that may go wrong, and plain versions of the operators' rules."""

from __future__ import annotations

import random
import re

from pyspark.sql import Row
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from riskflow.llm.tables import ship

# Extra columns whose names the operators use themselves.
CLASHES = ["score", "bucket", "row", "n", "leaf", "key", "kept", "row_number", "range", "class", "y", "unit", "shard", "part", "y_id", "scored_text", "rank"]
SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()), StructField("source", StringType()),
                     StructField("n_chars", LongType()), *(StructField(c, DoubleType() if c == "score" else StringType()) for c in CLASHES)])
WORDS = "the of and river stone light under quiet window paper green letter morning carry follow answer simple garden winter silver".split()


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice("aeiou") + str(rng.randint(0, 9)) if rng.random() < 0.6 else rng.choice(WORDS) for _ in range(words))


def texts() -> list[tuple[int | None, str | None]]:
    base = prose(1, 120)
    out = [(5, base), (9, base), (2, base.replace(" ", "  \n", 3)), (11, base + " tail"), (12, "head " + base), (40, None), (41, ""), (42, " \t\n "), (43, "x"),
           (44, "A b"), (45, "a B"), (46, "It's 3 o'clock.  <|endoftext|> next\x00 line\x1c"), (47, "İstanbul ΟΔΟΣ J̌ naïve 中文 🎉🎉 　 ½"), (48, prose(2, 6000)),
           (49, "ab" * 4000), (None, "no id here"), (None, None), (7, "seven"), (7, "seven"), (7, "another seven"), (-3, prose(3, 40)), (2**61, prose(4, 40)),
           (60, "stupid idiot words here"), (61, prose(5, 300)), (62, prose(5, 300)[:1500])]
    for i in range(12):  # a family of near copies: each has other words changed
        words = base.split()
        for j in range(i % 4 + 1):
            words[(11 * i + 29 * j) % len(words)] = f"changed{i}x{j}"
        out.append((100 + i, " ".join(words)))
    return out


def documents(spark, rows=None):
    ship(spark)
    rows = texts() if rows is None else rows
    made = [Row(doc_id=d, text=t, lang=None if i % 3 else "en", source="s", n_chars=None if i % 4 == 0 else len(t or ""), **{c: 0.5 if c == "score" else c for c in CLASHES}) for i, (d, t) in enumerate(rows)]
    return spark.createDataFrame([tuple(r) for r in made], SCHEMA).repartition(3) if made else spark.createDataFrame([], SCHEMA)


LABELS = StructType([StructField("doc_id", LongType()), StructField("quality", IntegerType()), StructField("toxic", IntegerType())])


def shingles(text: str | None, k: int) -> frozenset:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lower)
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) if len(words) >= k else frozenset([tuple(words)] if words else [])


def components(rows, k: int, percent: int) -> list[tuple]:
    """Sorted (doc_id, n, least reachable id) by comparing all pairs."""
    sets, parent = [shingles(t, k) for _, t in rows], list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            o = len(sets[i] & sets[j])
            if o and 100 * o >= percent * (len(sets[i]) + len(sets[j]) - o):
                parent[root(i)] = root(j)
    least: dict[int, int] = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted(((d, len(sets[i]), least.get(root(i))) for i, (d, _) in enumerate(rows)), key=repr)
