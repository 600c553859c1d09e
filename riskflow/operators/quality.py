"""Data-quality rules, their report, and the row-level quarantine.

Every rule is one boolean expression. A report reads the table once: rows and offending cells are counted
in one aggregate, and the values come from those counts. The quarantine evaluates the same expressions per row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from riskflow.contract import CONTRACT, Contract, Variant
from riskflow.session import stored
from riskflow.functions.numeric import FLOATS, double_literal, number, quoted, text_literal

SAMPLES = 5

# --- fixed values: rule names, severities, actions and message formats of the report ---
ERROR, WARNING = "ERROR", "WARNING"
EMPTY = "EMPTY_DATASET"
MISSING_COLUMNS = "MISSING_COLUMNS"
UNEXPECTED_COLUMNS = "UNEXPECTED_COLUMNS"
BAD_TYPE = "INCORRECT_DATA_TYPE"
NULL_KEY = "NULL_PRIMARY_KEY"
MISSING = "MISSING_VALUES"
BAD_CATEGORY = "UNEXPECTED_CATEGORY"
OUT_OF_RANGE = "OUT_OF_RANGE"
PROCEED, REJECT, QUARANTINE = "PROCEED", "REJECT_ALL", "QUARANTINE_RECORDS"
EMPTY_MESSAGE = "The provided dataset is empty (0 rows or None). Processing cannot continue."
MISSING_COLUMNS_MESSAGE = "Dataset is missing required columns: %s"
UNEXPECTED_COLUMNS_MESSAGE = "Dataset contains unexpected extra columns: %s. These will be ignored."
BAD_TYPE_MESSAGE = "Column '%s' contains %%d non-numeric values."
NULL_KEY_MESSAGE = "Column '%s' contains %%d null or blank values. Primary keys must be complete."
MISSING_MESSAGE = "Column '%s' has %%d (%%.2f%%%%) missing values. Downstream imputation will be applied."
BAD_CATEGORY_MESSAGE = "Column '%s' contains unexpected categories in %%d rows."
DISTINCT_MESSAGE = " Distinct values: %d (bad_categories lists them)."
# --- end of fixed values ---

SHOWN = (BAD_TYPE, OUT_OF_RANGE, BAD_CATEGORY)  # rules whose offending values a report shows

OWN_COLUMNS = ("_issues", "_reasons", "_row", "_seq", "_entry")  # added by this library on the way
ERROR_STRUCT = "struct<field: string, error_type: string, value: string>"


@dataclass(frozen=True)
class Rule:
    """One check of one column; ``bad`` and ``value`` are SQL text."""

    field: str
    error_type: str
    severity: str
    bad: str
    value: str  # the offending value as text
    message: str


def rules_for(df: DataFrame, variant: Variant, contract: Contract = CONTRACT) -> list[Rule]:
    """The rules that apply to a table, in report order."""
    kinds = {f.name: f.dataType for f in df.schema}
    nothing = "cast(null as string)"

    def text(c: str) -> str:
        return f"cast({quoted(c)} as string)"

    def missing(c: str) -> str:
        nan = f" or isnan({quoted(c)})" if isinstance(kinds[c], FLOATS) else ""
        return f"({quoted(c)} is null{nan})"

    rules = []
    for c in variant.numeric:
        if c in kinds:
            # NaN already counts as missing, so only text can be a wrong type
            bad = f"(not {missing(c)} and {number(c, kinds[c])} is null)"
            rules.append(Rule(c, BAD_TYPE, ERROR, bad, text(c), BAD_TYPE_MESSAGE % c))
    for c in contract.ids:
        if c in kinds:
            bad = f"({quoted(c)} is null or trim({text(c)}) = '')"
            rules.append(Rule(c, NULL_KEY, ERROR, bad, nothing, NULL_KEY_MESSAGE % c))
    for c, domain in contract.domains.items():
        if c in kinds:
            allowed = ", ".join(text_literal(v) for v in domain)
            bad = f"coalesce({text(c)} not in ({allowed}), false)"
            rules.append(Rule(c, BAD_CATEGORY, ERROR, bad, text(c), BAD_CATEGORY_MESSAGE % c))
    for r in contract.ranges:
        if r.column in kinds:
            v = number(r.column, kinds[r.column])
            bad = f"{v} {'<=' if r.low_open else '<'} {double_literal(r.low)}"
            bad += f" or {v} > {double_literal(r.high)}" if r.high is not None else ""
            bad = f"coalesce({bad}, false)"
            rules.append(Rule(r.column, OUT_OF_RANGE, ERROR, bad, f"cast({v} as string)", r.message))
    for c in variant.numeric + variant.categorical:
        if c in kinds:
            rules.append(Rule(c, MISSING, WARNING, missing(c), nothing, MISSING_MESSAGE % c))
    return rules


def column_issues(df: DataFrame, variant: Variant, contract: Contract = CONTRACT) -> tuple[list[str], list[str]]:
    """Missing and unexpected columns, from the schema alone; the engine's own are neither."""
    missing = [c for c in variant.required if c not in df.columns]
    extra = [c for c in df.columns
             if c not in variant.required and c != contract.target and c not in OWN_COLUMNS]
    return missing, extra


def issue_counts(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row: ``total`` and one counter per rule (``r0``, ``r1``, ...), in one aggregate."""
    return df.agg(F.expr("count(1) as total"), *[F.expr(f"count_if({r.bad}) as r{i}") for i, r in enumerate(rules)])


@dataclass(frozen=True)
class Measured:
    """What one pass over a table leaves: :func:`issue_counts` as it came out, and every cell that a report shows values of."""

    counts: DataFrame
    hits: DataFrame  # _at, field, error_type, value, n

    @property
    def any_error(self) -> bool:
        return not self.hits.isEmpty()


def measure(df: DataFrame, rules: list[Rule], order: list[str]) -> Measured:
    """Read the table once: rows become a cell for themselves and one for each rule that they offend, and cells are counted.

    Cells of a rule that shows no values are alike, so each task sends one number for them; those that show values keep value and
    place. The counted cells are written; counters, samples and categories are taken from there.
    """
    place = f"struct({', '.join(quoted(c) for c in order)})"
    kind = df.selectExpr(f"{place} as _at").schema["_at"].dataType.simpleString()

    def cell(rule: int, value: str | None = None) -> str:
        at = f"cast(null as {kind})" if value is None else place
        return f"named_struct('rule', {rule}, 'value', {value or 'cast(null as string)'}, '_at', {at})"

    own = cell(-1)
    hits = ", ".join(f"if({r.bad}, {cell(i, r.value if r.error_type in SHOWN else None)}, null)" for i, r in enumerate(rules))
    nothing = f"cast(null as struct<rule: int, value: string, _at: {kind}>)"
    cells = f"array_except(array({own}, {hits}), array({nothing}))" if rules else f"array({own})"
    some = " or ".join(r.bad for r in rules) or "false"
    # the outer form of explode spares a filter on the array, for which the rules would run twice
    found = df.selectExpr(f"explode_outer(if({some}, {cells}, array({own}))) as c").selectExpr("c.*")
    counted = stored(found.groupBy("rule", "value", "_at").agg(F.count(F.lit(1)).alias("n")), "dq_cells")
    numbers = {"total": -1, **{f"r{i}": i for i in range(len(rules))}}
    counts = counted.agg(*(F.expr(f"coalesce(sum(n) filter (where rule = {i}), 0) as {name}") for name, i in numbers.items()))
    shown = [i for i, r in enumerate(rules) if r.error_type in SHOWN]
    names = {c: f"element_at(array({', '.join(text_literal(getattr(r, c)) for r in rules)}), rule + 1) as {c}" for c in ("field", "error_type")}
    hits = counted.where(F.col("rule").isin(shown)).selectExpr("_at", *names.values(), "value", "n") if shown else counted.where("false").selectExpr(
        "_at", "'' as field", "'' as error_type", "value", "n")
    return Measured(counts, hits)


def issue_row(df: DataFrame, contract: Contract = CONTRACT, dataset_type: str = "auto",
              training: bool = False, counts: DataFrame | None = None) -> DataFrame:
    """One row: ``total`` and the array of issues found, in report order.

    An empty table yields only ``EMPTY_DATASET``. Missing columns end the checks. ``counts`` are the
    :func:`issue_counts` where they are at hand already.
    """
    variant = contract.variant(df.columns, dataset_type, training)
    missing, extra = column_issues(df, variant, contract)
    rules = [] if missing else rules_for(df, variant, contract)
    found = [_issue(ERROR, "Dataset", EMPTY, "0", text_literal(EMPTY_MESSAGE), "total = 0")]
    if missing:
        text = text_literal(MISSING_COLUMNS_MESSAGE % missing)
        found.append(_issue(ERROR, "Columns", MISSING_COLUMNS, "0", text, "total > 0"))
    if extra:
        text = text_literal(UNEXPECTED_COLUMNS_MESSAGE % extra)
        found.append(_issue(WARNING, "Columns", UNEXPECTED_COLUMNS, "0", text, "total > 0"))
    for i, r in enumerate(rules):
        text = text_literal(r.message)
        if r.error_type == MISSING:
            text = f"format_string({text}, r{i}, r{i} / total * 100)"
        else:
            text = f"format_string({text}, r{i})"
        found.append(_issue(r.severity, r.field, r.error_type, f"r{i}", text, f"r{i} > 0"))
    hits = f"filter(array({', '.join(found)}), x -> x is not null) as issues"
    return (issue_counts(df, rules) if counts is None else counts).selectExpr("total", hits)


def issues(df: DataFrame, contract: Contract = CONTRACT, dataset_type: str = "auto",
           training: bool = False) -> DataFrame:
    """The report in long form, one row per issue, without samples."""
    return (
        issue_row(df, contract, dataset_type, training)
        .select("total", F.posexplode("issues").alias("position", "i"))
        .select("total", "position", "i.*")
    )


def _issue(severity: str, field: str, error_type: str, count: str, message: str, hit: str) -> str:
    return (f"if({hit}, named_struct('field', {text_literal(field)}, 'error_type', '{error_type}', 'message', {message}, "
            f"'severity', '{severity}', 'invalid_rows_count', bigint({count})), null)")


def row_errors(rules: list[Rule]) -> str:
    """SQL array of the errors of a row, as structs of field, error type and value.

    Good rows end after the rules' conditions. No lambda is used: a higher-order
    function would take the conditions out of code generation.
    """
    errors = [r for r in rules if r.severity == ERROR]
    hits = ", ".join(
        f"if({r.bad}, named_struct('field', {text_literal(r.field)}, 'error_type', '{r.error_type}', 'value', {r.value}), null)"
        for r in errors)
    some = f"array_except(array({hits}), array(cast(null as {ERROR_STRUCT})))"
    return f"if({' or '.join(r.bad for r in errors)}, {some}, cast(array() as array<{ERROR_STRUCT}>))"


def violations(df: DataFrame, rules: list[Rule], order: list[str]) -> DataFrame:
    """Long form of all errors: one row per offending cell, with the row's order columns."""
    at = f"struct({', '.join(quoted(c) for c in order)}) as _at"
    return df.selectExpr(at, f"explode({row_errors(rules)}) as v").selectExpr("_at", "v.field", "v.error_type", "v.value")


def row_order(df: DataFrame, contract: Contract, order: list[str] | None) -> list[str]:
    """Columns that stand for "first": rows of a table have no order of their own."""
    return order or [c for c in (contract.time, *contract.ids) if c in df.columns]


def listed_values(hits: DataFrame, order: list[str]) -> DataFrame:
    """Every unexpected category value among the offending cells, with its row count and first place.

    The least of a single column is a plain number or time to a hash aggregate. With several order columns the first is
    taken so, and only the cells that tie in it are compared as a whole.
    """
    found = hits.where(F.col("error_type") == BAD_CATEGORY)
    key, lead = ["field", "error_type", "value"], F.col(f"_at.{quoted(order[0])}")
    counts = found.groupBy(*key).agg(F.sum("n").alias("n"), F.min(lead).alias("_lead"), F.max(lead.isNull()).alias("_none"))
    if len(order) == 1:
        least = F.when(~F.col("_none"), F.col("_lead"))  # null comes first
        return counts.select(*key, "n", F.struct(least.alias(order[0])).alias("_at"))
    own = counts.select(*(F.col(c).alias(f"_{c}") for c in key[::2]), F.col("n").alias("_n"), F.when(~F.col("_none"), F.col("_lead")).alias("_lead"))
    tied = found.join(own, (F.col("field") == F.col("_field")) & (F.col("value") == F.col("_value")) & lead.eqNullSafe(F.col("_lead")))
    return tied.groupBy(*key, F.col("_n").alias("n")).agg(F.min("_at").alias("_at"))


def first_values(hits: DataFrame, listed: DataFrame, limit: int = SAMPLES) -> DataFrame:
    """The first ``limit`` offending values per issue with their places; for categories the first distinct ones.

    The filter on the row number turns into a group limit below the shuffle, so each
    task sends at most ``limit`` rows per issue however many rows offend.
    """
    plain = hits.where(F.col("error_type") != BAD_CATEGORY)
    plain = plain.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.least(F.col("n"), F.lit(limit))))).select("_at", "field", "error_type", "value")
    found = plain.unionByName(listed.select("_at", "field", "error_type", "value"))
    w = Window.partitionBy("field", "error_type").orderBy("_at", "value")
    return found.withColumn("position", F.row_number().over(w)).where(F.col("position") <= limit)


def _hits(df: DataFrame, contract: Contract, dataset_type: str, order: list[str], *kinds: str) -> DataFrame:
    rules = rules_for(df, contract.variant(df.columns, dataset_type), contract)
    return violations(df, [r for r in rules if r.error_type in kinds], order).withColumn("n", F.lit(1).cast("long"))


def bad_categories(df: DataFrame, contract: Contract = CONTRACT, dataset_type: str = "auto",
                   order: list[str] | None = None) -> DataFrame:
    """Every unexpected category value with its row count and first place."""
    order = row_order(df, contract, order)
    hits = _hits(df, contract, dataset_type, order, BAD_CATEGORY)
    if len(order) > 1:  # they are read twice
        hits = stored(hits, "dq_hits")
    return listed_values(hits, order)


def samples(df: DataFrame, contract: Contract = CONTRACT, dataset_type: str = "auto",
            order: list[str] | None = None, limit: int = SAMPLES) -> DataFrame:
    """First ``limit`` offending values per issue; for categories the first distinct ones."""
    order = row_order(df, contract, order)
    hits = stored(_hits(df, contract, dataset_type, order, *SHOWN), "dq_hits")
    return first_values(hits, listed_values(hits, order), limit).select("field", "error_type", "position", "value")


def report(df: DataFrame, contract: Contract = CONTRACT, dataset_type: str = "auto",
           training: bool = False, strict: bool = True, order: list[str] | None = None,
           with_samples: bool = True) -> DataFrame:
    """The whole report as one row with nested errors and warnings; with samples the table is read once, at the call."""
    variant = contract.variant(df.columns, dataset_type, training)
    missing, extra = column_issues(df, variant, contract)
    counts = listed = first = None
    if with_samples and not missing:
        order = row_order(df, contract, order)
        measured = measure(df, rules_for(df, variant, contract), order)
        counts = measured.counts
        if measured.any_error:
            listed = listed_values(measured.hits, order)
            first = first_values(measured.hits, listed)
    return report_of(issue_row(df, contract, dataset_type, training, counts), missing, extra, strict, listed, first)


def report_of(row: DataFrame, missing: list[str], extra: list[str], strict: bool = True,
              listed: DataFrame | None = None, first: DataFrame | None = None) -> DataFrame:
    """The report of an :func:`issue_row`, with the :func:`listed_values` and :func:`first_values` of the same table."""
    values, distinct = "cast(null as map<string, array<string>>)", "cast(null as map<string, bigint>)"
    if listed is not None:
        numbers = listed.groupBy("field").agg(F.count(F.lit(1)).alias("n"))  # one row per column
        row = row.withColumn("_distinct", numbers.agg(F.expr("map_from_entries(collect_list(struct(field, n)))")).scalar())
        distinct = "_distinct"
    if first is not None:
        # at most SAMPLES values per rule, so one small map
        per_issue = (
            first.groupBy(F.expr("concat_ws(':', field, error_type) as issue"))
            .agg(F.expr("sort_array(collect_list(struct(position, value))).value as values"))
        )
        as_map = per_issue.agg(F.expr("map_from_entries(collect_list(struct(issue, values)))"))
        row, values = row.withColumn("_values", as_map.scalar()), "_values"
    names = {MISSING_COLUMNS: missing, UNEXPECTED_COLUMNS: extra}
    by_name = " ".join(
        f"when '{kind}' then cast(array({', '.join(map(text_literal, cols))}) as array<string>)" for kind, cols in names.items())
    complete = f"""named_struct('field', x.i.field, 'error_type', x.i.error_type,
        'message', if(x.i.error_type = '{BAD_CATEGORY}' and x.d is not null,
            concat(x.i.message, format_string({text_literal(DISTINCT_MESSAGE)}, x.d)), x.i.message),
        'severity', x.i.severity, 'invalid_rows_count', x.i.invalid_rows_count,
        'sample_invalid_values', case x.i.error_type {by_name} else slice(x.v, 1, {SAMPLES}) end)"""
    paired = f"""transform(issues, x -> named_struct('i', x, 'd', {distinct}[x.field], 'v',
        coalesce({values}[concat_ws(':', x.field, x.error_type)], cast(array() as array<string>))))"""
    full = row.selectExpr("total", f"transform({paired}, x -> {complete}) as found").selectExpr(
        "total", f"filter(found, x -> x.severity = '{ERROR}') as errors",
        f"filter(found, x -> x.severity = '{WARNING}') as warnings")
    return full.selectExpr(
        "size(errors) = 0 as is_valid", "total as total_records", "size(errors) as error_count",
        "size(warnings) as warning_count", f"{action(strict)} as action_taken", "errors", "warnings")


def action(strict: bool) -> str:
    """What to do with the batch; an empty or incomplete table is always rejected."""
    return (f"case when size(errors) = 0 then '{PROCEED}' when {str(strict).lower()} or exists(errors, x -> "
            f"x.error_type in ('{EMPTY}', '{MISSING_COLUMNS}')) then '{REJECT}' else '{QUARANTINE}' end")


def with_row_issues(df: DataFrame, contract: Contract = CONTRACT, dataset_type: str = "auto") -> DataFrame:
    """Add ``_issues``: the errors of each row as ``array<struct<field,error_type,value>>``."""
    variant = contract.variant(df.columns, dataset_type)
    missing, _ = column_issues(df, variant, contract)
    if missing:
        raise ValueError(MISSING_COLUMNS_MESSAGE % missing)
    return df.withColumn("_issues", F.expr(row_errors(rules_for(df, variant, contract))))


def clean_rows(flagged: DataFrame) -> DataFrame:
    """Rows without an error."""
    return flagged.where(F.size("_issues") == 0).drop("_issues")


def quarantined_rows(flagged: DataFrame) -> DataFrame:
    """Rows with at least one error, and why."""
    return flagged.where(F.size("_issues") > 0)
