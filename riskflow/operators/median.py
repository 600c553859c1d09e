"""Exact medians in bounded memory.

The built-in ``median`` keeps every distinct value of a column in one buffer. Here the
middle ranks are found by counting: values are turned into 64-bit keys that sort alike, keys fall
into buckets of equal width, the bucket with the wanted rank is kept, and its own smallest and largest key
span the next buckets. Each pass takes twelve bits of what is open, so six passes find any rank in any
distribution. A bracket that holds few values is sorted, one of a single value is the answer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, functions as F

from riskflow.functions.numeric import quoted
from riskflow.functions.order_key import key_of, value_of, with_keys

BUCKETS = 4096
BUFFERED_VALUES = 250_000  # values of one bracket that may be sorted in one buffer


class _Rank:
    """Search state of one zero-based rank: a bracket, the rows below it and inside it."""

    def __init__(self, column: int, rank: int, total: int, lo: int, hi: int):
        self.column, self.rank, self.below = column, rank, 0
        self.inside, self.lo, self.hi = total, lo, hi

    @property
    def value(self) -> str:
        return f"c{self.column}"

    @property
    def within(self) -> str:
        return f"{self.value} between {self.lo}L and {self.hi}L"

    @property
    def bracket(self) -> tuple:
        return self.column, self.lo, self.hi

    def bucket(self) -> str:
        # truncating division keeps the order; the two ends may be further apart than a number of 64 bits
        width = -(-(self.hi - self.lo) // BUCKETS)
        return f"{self.value} div {width}L"


def column_profile(df: DataFrame, columns: list[str]) -> dict[str, Row]:
    """Per column ``rows``, non-null ``n``, ``lo``, ``hi``, ``mean`` and ``deviation``: one aggregate for all."""
    row = df.agg(*[
        F.expr(f"struct(count(1) as rows, count({c}) as n, min({c}) as lo, max({c}) as hi, "
               f"avg({c}) as mean, stddev_pop({c}) as deviation) as c{i}")
        for i, c in enumerate(f"double({quoted(c)})" for c in columns)
    ]).first()
    return dict(zip(columns, row))


def exact_medians(df: DataFrame, columns: list[str], buffered: int = BUFFERED_VALUES,
                  profile: dict[str, Row] | None = None) -> dict[str, float | None]:
    """Median of each column over its non-null values; the mean of the two middle ones."""
    names = list(columns)
    seen = profile or column_profile(df, names)
    values = df.select(*[F.col(quoted(n)).cast("double").alias(f"d{i}") for i, n in enumerate(names)])
    src = with_keys(values, {f"c{i}": f"d{i}" for i in range(len(names))}).select(*[f"c{i}" for i in range(len(names))])
    ranks: list[_Rank] = []
    for i in range(len(names)):
        p = seen[names[i]]
        ranks += [_Rank(i, r, p.n, key_of(p.lo), key_of(p.hi)) for r in ({(p.n - 1) // 2, p.n // 2} if p.n else ())]

    while True:
        open_ = [r for r in ranks if r.inside > buffered and r.lo < r.hi]
        if not open_:
            break
        _narrow(src, open_)

    found: dict[int, list[float]] = {}
    unsorted = [r for r in ranks if r.lo < r.hi]
    for r in ranks:
        if r.lo == r.hi:
            found.setdefault(r.column, []).append(value_of(r.lo))
    if unsorted:
        place = {b: i for i, b in enumerate(dict.fromkeys(r.bracket for r in unsorted))}
        sort = {place[r.bracket]: f"sort_array(collect_list(if({r.within}, {r.value}, null)))" for r in unsorted}
        row = src.agg(*[F.expr(f"{e} as v{i}") for i, e in sort.items()]).selectExpr(
            *[f"v{place[r.bracket]}[{r.rank - r.below}]" for r in unsorted]).first()
        for r, value in zip(unsorted, row):
            found.setdefault(r.column, []).append(value_of(value))
    return {n: sum(found[i]) / len(found[i]) if i in found else None for i, n in enumerate(names)}


def _narrow(src: DataFrame, ranks: list[_Rank]) -> None:
    """One counting pass over all open brackets: at most ``BUCKETS + 2`` counters for each."""
    place = {b: i for i, b in enumerate(dict.fromkeys(r.bracket for r in ranks))}
    hits = {place[r.bracket]: f"if({r.within}, named_struct('k', {place[r.bracket]}, 'b', {r.bucket()}, 'v', {r.value}), null)"
            for r in ranks}
    counters = (
        src.selectExpr(f"explode(array({', '.join(hits.values())})) as h").where("h is not null")
        .groupBy("h.k", "h.b").agg(F.expr("count(1) as n"), F.expr("min(h.v) as lo"), F.expr("max(h.v) as hi"))
        .orderBy("k", "b").collect()
    )
    for r in ranks:
        k, below = place[r.bracket], r.below
        for c in (c for c in counters if c["k"] == k):
            if r.rank < below + c["n"]:
                r.below, r.inside, r.lo, r.hi = below, c["n"], c["lo"], c["hi"]
                break
            below += c["n"]
