"""Scoring requests as JSON text, checked field by field.

Each payload is parsed once into a variant, which keeps an absent field apart from an
explicit null. Payloads that break the request contract are kept with their reasons.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from riskflow.functions.numeric import NUMBER_TEXT, text_literal
from riskflow.functions.time import END_SERIAL, FIRST_SERIAL

REQUIRED = object()
REASON = "struct<field: string, reason: string>"


@dataclass(frozen=True)
class Field:
    """One request field: its kind, its default when absent, and whether null is allowed."""

    name: str
    kind: str  # "string" or "double"
    default: object = REQUIRED
    nullable: bool = False
    positive: bool = False
    serial: bool = False  # days that must name a date


# --- fixed values: request fields and their defaults ---
TRANSACTION_FIELDS = (
    Field("Transaction_ID", "string"),
    Field("Customer_ID", "string"),
    Field("Transaction_DateTime", "double", serial=True),
    Field("Transaction_Type", "string"),
    Field("Amount_NGN", "double", positive=True),
    Field("Channel", "string"),
    Field("Device_Type", "string", "Android", nullable=True),
    Field("Location", "string", "Lagos", nullable=True),
    Field("International_Transaction", "string", "No"),
    Field("Transaction_Status", "string", "Successful"),
)
ENRICHED_FIELDS = TRANSACTION_FIELDS + (
    Field("Age", "double", 35.0),
    Field("Tenure_Months", "double", 24.0),
    Field("Digital_Engagement_Score", "double", 75.0),
    Field("Gender", "string", "Female"),
    Field("Customer_Segment", "string", "Everyday"),
    Field("Account_Type", "string", "Savings"),
    Field("Monthly_Income_Band", "string", "250k-499k"),
    Field("Preferred_Channel", "string", "Mobile App"),
    Field("Account_Status", "string", "Active"),
)
# --- end of fixed values ---


def _read(f: Field) -> tuple[str, str]:
    """SQL of a field's value, and of the reason it is refused or NULL.

    ``_kind_`` is the JSON type (NULL where the field is absent, VOID for an explicit
    null), ``_as_`` the value as the wanted type.
    """
    kind, value = f"_kind_{f.name}", f"_as_{f.name}"
    # numbers, numeric text and booleans are numbers; only text is text
    wrong = f"{kind} <> 'STRING'" if f.kind == "string" else f"({value} is null or isnan({value}))"
    absent = "null" if f.default is not REQUIRED else "'missing'"
    null = "null" if f.nullable else "'null'"
    reason = f"when {kind} is null then {absent} when {kind} = 'VOID' then {null} when {wrong} then 'not a {f.kind}'"
    reason += f" when {value} <= 0 then 'not positive'" if f.positive else ""
    reason += f" when {value} < {FIRST_SERIAL} or {value} >= {END_SERIAL} then 'no date'" if f.serial else ""
    default = "null" if f.default is REQUIRED else text_literal(str(f.default))
    out = f"case when not _object then null when {kind} is null then cast({default} as {f.kind}) "
    out += f"when {kind} = 'VOID' or {wrong} then null else {value} end"
    return f"{out} as {f.name}", f"case {reason} end as _why_{f.name}"


def parse_requests(df: DataFrame, payload: str = "payload", fields: tuple[Field, ...] = TRANSACTION_FIELDS) -> DataFrame:
    """One row per payload: its other columns, the request fields, and ``_reasons``.

    ``_reasons`` is empty for a good request. Fields outside the contract are ignored.
    """
    keep = [c for c in df.columns if c != payload]
    parsed = df.withColumn("_v", F.try_parse_json(payload))
    return _checked(parsed, [*keep, payload], fields)


def _typed(f: Field) -> str:
    """SQL of the raw value as the wanted type; text counts as a number by the same rule as in tables."""
    value = f"try_variant_get(_raw_{f.name}, '$', '{f.kind}')"
    if f.kind == "string":
        return value
    odd = f"schema_of_variant(_raw_{f.name}) = 'STRING' and not try_variant_get(_raw_{f.name}, '$', 'string') rlike r'{NUMBER_TEXT}'"
    return f"if(coalesce({odd}, false), null, {value})"


def _checked(parsed: DataFrame, keep: list[str], fields: tuple[Field, ...]) -> DataFrame:
    names = [f.name for f in fields]
    raw = [f"variant_get(_v, '$.{n}', 'variant') as _raw_{n}" for n in names]
    some = " or ".join(f"_raw_{n} is not null" for n in names)
    typed = [e for f in fields for e in (f"schema_of_variant(_raw_{f.name}) as _kind_{f.name}", f"{_typed(f)} as _as_{f.name}")]
    checked = (
        parsed.selectExpr(*keep, "_v", *raw)
        .selectExpr(*keep, f"({some} or coalesce(startswith(schema_of_variant(_v), 'OBJECT'), false)) as _object", *typed)
        .selectExpr(*keep, "_object", *[e for f in fields for e in _read(f)])
    )
    why = ", ".join(f"if(_why_{n} is null, null, named_struct('field', '{n}', 'reason', _why_{n}))" for n in names)
    reasons = f"""case when not _object then array(named_struct('field', 'payload', 'reason', 'not a JSON object'))
        when coalesce({', '.join(f'_why_{n}' for n in names)}) is null then cast(array() as array<{REASON}>)
        else array_except(array({why}), array(cast(null as {REASON}))) end"""
    row = ", ".join(f"'{n}', {n}" for n in names)
    # One row in, one row out. The generator only passes columns on, but a later filter
    # on the outcome stays above it; below, it would parse the payload again for every test.
    return checked.selectExpr(*keep, f"inline(array(named_struct({row}, '_reasons', {reasons})))")


def parse_batches(df: DataFrame, payload: str = "payload", fields: tuple[Field, ...] = TRANSACTION_FIELDS) -> DataFrame:
    """One row per entry of each payload's ``transactions`` list, with its ``_entry`` place.

    A payload without such a list gives one row that names the fault.
    """
    keep = [c for c in df.columns if c != payload]
    entries = F.try_variant_get(F.try_parse_json(payload), "$.transactions", "array<variant>")
    parsed = df.select(*keep, F.posexplode_outer(entries).alias("_entry", "_v"))
    return _checked(parsed, [*keep, "_entry"], fields)


def accepted(parsed: DataFrame, payload: str = "payload") -> DataFrame:
    """Requests that keep the contract."""
    return parsed.where(F.size("_reasons") == 0).drop("_reasons", payload)


def refused(parsed: DataFrame) -> DataFrame:
    """Requests that break it, with the reasons."""
    return parsed.where(F.size("_reasons") > 0)
