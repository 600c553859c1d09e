"""Timestamps in their two encodings, and the features derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from riskflow.contract import CONTRACT, DEFAULT_HOUR, DEFAULT_WEEKDAY, Contract
from riskflow.functions.numeric import number, quoted

UNIX_EPOCH_SERIAL = 25569  # 1970-01-01 counted in days from 1899-12-30
MICROS_PER_DAY = 86_400_000_000
UNIX_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"
FIRST_SERIAL, END_SERIAL = -693_593, 2_958_466  # 0001-01-01, and the day after 9999-12-31


def in_range(serial: str) -> str:
    """SQL of a serial within the years 1 to 9999; NULL beyond, where no date exists."""
    return f"if({serial} >= {FIRST_SERIAL}D and {serial} < {END_SERIAL}D, {serial}, cast(null as double))"


def serial_to_time(serial: str) -> Column:
    """Serial days since 1899-12-30 as a wall-clock timestamp, rounded to microseconds; NULL beyond the years 1 to 9999."""
    return F.expr(_serial_to_time(serial))


def _serial_to_time(serial: str) -> str:
    return f"timestampadd(MICROSECOND, bigint(round(({in_range(serial)} - {UNIX_EPOCH_SERIAL}D) * {MICROS_PER_DAY}D)), {UNIX_EPOCH})"


def time_to_serial(ts: str) -> Column:
    """The wall-clock time of a timestamp as serial days since 1899-12-30."""
    return F.expr(f"{wall_micros(ts)} / {MICROS_PER_DAY}D + {UNIX_EPOCH_SERIAL}D")


def wall_micros(ts: str) -> str:
    """SQL of the microseconds from 1970 to a wall-clock time, in any session time zone."""
    return f"timestampdiff(MICROSECOND, {UNIX_EPOCH}, cast({ts} as timestamp_ntz))"


def parse_time(text: str) -> Column:
    """Timestamp text; NULL where it cannot be read."""
    return F.expr(f"try_to_timestamp({text})")


def hour_and_weekday(column: str, data_type: T.DataType, serial_rounding: str = "floor") -> tuple[str, str]:
    """SQL for hour 0-23 and weekday 0 (Monday) to 6; NULL where there is no time.

    Numeric input is serial days; text is serial days where it is a number, else a timestamp. With
    ``floor`` the hour is cut from the serial as stored, so a serial a hair below the full hour counts
    as the hour before; with ``micros`` it is first rounded to the nearest microsecond.
    """
    if serial_rounding not in ("floor", "micros"):
        raise ValueError("serial_rounding must be 'floor' or 'micros'")
    if not isinstance(data_type, (T.NumericType, T.StringType)):
        return f"hour({quoted(column)})", f"weekday({quoted(column)})"
    serial = number(column, data_type)
    if serial_rounding == "floor":
        day = in_range(serial)
        parts = (f"cast(floor(pmod({day}, 1D) * 24) as int)", f"weekday(date_add(date'1899-12-30', cast(floor({day}) as int)))")
    else:
        ts = _serial_to_time(serial)
        parts = (f"hour({ts})", f"weekday({ts})")
    if isinstance(data_type, T.NumericType):
        return parts
    ts = f"try_to_timestamp({quoted(column)})"
    return tuple(f"case when {serial} is not null then {p} else {name}({ts}) end" for p, name in zip(parts, ("hour", "weekday")))


def temporal_columns(df: DataFrame, contract: Contract = CONTRACT, serial_rounding: str = "floor") -> dict[str, str]:
    """SQL of hour, weekday and weekend flag; never NULL."""
    hour, day = f"{DEFAULT_HOUR}", f"{DEFAULT_WEEKDAY}"
    if contract.time in df.columns:
        h, d = hour_and_weekday(contract.time, df.schema[contract.time].dataType, serial_rounding)
        hour, day = f"coalesce({h}, {hour})", f"coalesce({d}, {day})"
    return dict(zip(contract.engineered, (hour, day, f"int({day} in (5, 6))")))


def with_temporal_features(df: DataFrame, contract: Contract = CONTRACT, serial_rounding: str = "floor") -> DataFrame:
    """Add hour, weekday and weekend flag as integers."""
    return df.withColumns({c: F.expr(e) for c, e in temporal_columns(df, contract, serial_rounding).items()})


def night_flag(hour: str = "Transaction_Hour") -> Column:
    """1 for transactions between midnight and 05:00."""
    return F.expr(f"int({hour} < 5)")
