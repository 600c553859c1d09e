"""Doubles as 64-bit integers that sort alike, and back.

The key of a number is the integer of its bits, negated below zero; both zeros have key 0, NaN comes last. A prefix of the key is
a range of numbers, so counting by prefix finds ranks and sums in order for any distribution, in as many steps as the 64 bits have prefixes.
"""

from __future__ import annotations

import struct

from pyspark.sql import DataFrame, functions as F

INFINITY_KEY, NAN_KEY = 0x7FF << 52, (0x7FF << 52) + 1


def key_of(value: float) -> int:
    """The key of one number."""
    if value != value:
        return NAN_KEY
    bits = struct.unpack(">q", struct.pack(">d", abs(value)))[0]
    return -bits if value < 0 else bits


def value_of(key: int) -> float:
    """The number that a key stands for."""
    value = struct.unpack(">d", struct.pack(">q", abs(key)))[0]
    return -value if key < 0 else value


def with_keys(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add key columns (name: column of doubles); NULL has no key.

    Exponent and fraction are reckoned by scaling with powers of two, which loses nothing; the logarithm may be
    beside the exponent by one and is put right.
    """
    own = {f"_{part}_{i}": expr for i, c in enumerate(columns.values()) for part, expr in (("size", f"abs(double(`{c}`))"),)}
    df = df.withColumns({n: F.expr(e) for n, e in own.items()})
    for i in range(len(columns)):
        guess = f"least(greatest(coalesce(floor(log2(_size_{i})), -1022), -1022), 1023)"
        df = df.withColumn(f"_power_{i}", F.expr(f"if(isnan(_size_{i}) or _size_{i} = double('inf'), 0, int({guess}))"))
    df = df.withColumns({f"_share_{i}": F.expr(f"_size_{i} * pow(2D, -(_power_{i} div 2)) * pow(2D, -(_power_{i} - _power_{i} div 2))") for i in range(len(columns))})
    keys = {}
    for i, (name, c) in enumerate(columns.items()):
        power = f"case when _share_{i} >= 2 then _power_{i} + 1 when _share_{i} < 1 and _power_{i} > -1022 then _power_{i} - 1 else _power_{i} end"
        share = f"case when _share_{i} >= 2 then _share_{i} / 2 when _share_{i} < 1 and _power_{i} > -1022 then _share_{i} * 2 else _share_{i} end"
        bits = f"shiftleft(bigint({power}) + 1022L, 52) + bigint(({share}) * {float(1 << 52)!r}D)"
        found = f"case when isnan(_size_{i}) then {NAN_KEY}L when _size_{i} = double('inf') then {INFINITY_KEY}L else {bits} end"
        keys[name] = F.expr(f"if(`{c}` is null, null, ({found}) * if(`{c}` < 0, -1L, 1L))")
    return df.withColumns(keys).drop(*(f"_{part}_{i}" for part in ("size", "power", "share") for i in range(len(columns))))
