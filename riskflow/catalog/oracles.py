"""DuckDB SQL for the registered queries, over the driver tables as views.

Only the inputs (the table views) share their text with the Spark side; every
operator is written out here on its own, the plain way.
"""

from __future__ import annotations

from riskflow.catalog.setup import (
    ABROAD, BASELINE_WEIGHTS, FROZEN, INTERCEPT, OPTIONAL, REQUEST, WEIGHTS,
)
from riskflow.contract import CONTRACT, DOMAINS
from riskflow.sources.testviews import CUST, DIRTY, K, TXN, select_list

ORACLES: dict[str, str] = {}
C_FEATURES = ", ".join(CONTRACT.customer_features)

# ---- common table expressions -------------------------------------------------------

CTES = {
    "ev": f"SELECT *, {K} AS k FROM events",
    "txn": f"SELECT {select_list(TXN)}, event_id AS _row FROM ev",
    "cust": f"SELECT {select_list(CUST)} FROM customer",
    "dtxn": f"SELECT {select_list({**TXN, **DIRTY})}, event_id AS _row FROM ev",
    "dcust": f"""SELECT * REPLACE (CASE WHEN c_custkey % 211 = 0 THEN 12.0 ELSE Age END AS Age), 0 AS _seq
        FROM (SELECT {select_list(CUST)}, c_custkey FROM customer)
        UNION ALL SELECT * REPLACE (99.0 AS Age), 1 AS _seq
        FROM (SELECT {select_list(CUST)}, c_custkey FROM customer) WHERE c_custkey = 1""",
    "dfirst": f"""SELECT Customer_ID, {C_FEATURES} FROM dcust
        QUALIFY row_number() OVER (PARTITION BY Customer_ID ORDER BY _seq) = 1""",
    "enr": "SELECT t.*, c.* EXCLUDE (Customer_ID, Customer_Name) FROM txn t LEFT JOIN cust c USING (Customer_ID)",
    "denr": f"SELECT t.*, {C_FEATURES} FROM dtxn t LEFT JOIN dfirst c USING (Customer_ID)",
    "split": """SELECT *, CASE WHEN row_number() OVER (PARTITION BY Risk_Review_Flag
            ORDER BY md5(concat(Transaction_ID, '|42')))
            <= (SELECT q.take FROM quota q WHERE q.flag = Risk_Review_Flag) THEN 'test' ELSE 'train' END AS split
        FROM enr""",
    # the size of the test part first; then whole shares, then the largest remainders
    "quota": """SELECT flag, whole + (row_number() OVER (ORDER BY exact - whole DESC, flag)
            <= wanted - sum(whole) OVER ())::bigint AS take
        FROM (SELECT flag, wanted, n * wanted / total::double AS exact, floor(n * wanted / total::double)::bigint AS whole
            FROM (SELECT Risk_Review_Flag AS flag, count(*) AS n, sum(count(*)) OVER () AS total,
                  ceil(sum(count(*)) OVER () * 0.2)::bigint AS wanted FROM enr GROUP BY 1))""",
    "feat": """SELECT *, cast(hour(Transaction_DateTime) AS double) AS Transaction_Hour,
            cast(isodow(Transaction_DateTime) - 1 AS double) AS Transaction_DayOfWeek,
            cast(cast(isodow(Transaction_DateTime) >= 6 AS int) AS double) AS Is_Weekend
        FROM split""",
    "efeat": """SELECT *, cast(hour(Transaction_DateTime) AS double) AS Transaction_Hour,
            cast(isodow(Transaction_DateTime) - 1 AS double) AS Transaction_DayOfWeek,
            cast(cast(isodow(Transaction_DateTime) >= 6 AS int) AS double) AS Is_Weekend
        FROM enr""",
}
NEEDS = {"txn": ["ev"], "dtxn": ["ev"], "dfirst": ["dcust"], "enr": ["txn", "cust"], "denr": ["dtxn", "dfirst"],
         "quota": ["enr"], "split": ["enr", "quota"], "feat": ["split"], "efeat": ["enr"]}


def with_tables(sql: str, *names: str, **extra: str) -> str:
    """Prefix a query with the expressions it needs, in order."""
    order: list[str] = []

    def add(name: str) -> None:
        for n in NEEDS.get(name, []):
            add(n)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    parts = [f"{n} AS ({CTES[n]})" for n in order] + [f"{n} AS ({q})" for n, q in extra.items()]
    return f"WITH {', '.join(parts)} {sql}"


def z(column: str) -> str:
    """A frozen-scaled numeric column."""
    f = FROZEN
    return f"((coalesce({column}, {f.median[column]!r}::double) - {f.mean[column]!r}::double) / {f.scale[column]!r}::double)"


def linear(weights: dict[str, float] = WEIGHTS) -> str:
    terms = "".join(f" + {w!r}::double * {z(c)}" for c, w in weights.items())
    abroad = f"{ABROAD!r}::double * (CASE WHEN International_Transaction = 'Yes' THEN 1.0 ELSE 0.0 END)::double"
    return f"(1.0::double / (1.0::double + exp(-({INTERCEPT!r}::double{terms} + {abroad}))))"


def scored(name: str = "scored", weights: dict[str, float] = WEIGHTS) -> dict[str, str]:
    return {name: f"SELECT *, CASE WHEN Risk_Review_Flag = 'Yes' THEN 1 ELSE 0 END AS label, "
                  f"{linear(weights)} AS p FROM efeat"}


FLAG = "CASE WHEN p >= 0.35 THEN 'Yes' ELSE 'No' END AS Predicted_Risk_Flag"
TIER = "CASE WHEN p >= 0.7 THEN 'High' WHEN p >= 0.3 THEN 'Medium' ELSE 'Low' END AS Risk_Tier"
DECISION = f"""{FLAG}, round_even(p, 4) AS Risk_Probability, {TIER},
    CASE WHEN p >= 0.7 THEN 'Immediate Review / Payment Hold' WHEN p >= 0.3 THEN 'Secondary Verification (SMS/OTP)'
    ELSE 'Auto-Approve' END AS Operational_Action, '2.0.0-week3' AS Model_Version"""

# ---- rules, written out -------------------------------------------------------------

NUMBER = {c: f"try_cast({c} AS double)" for c in CONTRACT.numeric}


def _in(column: str) -> str:
    return "(" + ", ".join(f"'{v}'" for v in DOMAINS[column]) + ")"


def error_rules() -> list[tuple[str, str, str]]:
    """Field, error type and condition, in report order."""
    rules = [(c, "INCORRECT_DATA_TYPE", f"{c} IS NOT NULL AND {NUMBER[c]} IS NULL") for c in CONTRACT.numeric]
    rules += [(c, "NULL_PRIMARY_KEY", f"{c} IS NULL OR trim({c}) = ''") for c in CONTRACT.ids]
    rules += [(c, "UNEXPECTED_CATEGORY", f"{c} IS NOT NULL AND {c} NOT IN {_in(c)}") for c in CONTRACT.categorical]
    a, g, t, d = (NUMBER[c] for c in CONTRACT.numeric)
    rules += [("Amount_NGN", "OUT_OF_RANGE", f"{a} <= 0 OR {a} > 50000000"), ("Age", "OUT_OF_RANGE", f"{g} < 18 OR {g} > 100"),
              ("Tenure_Months", "OUT_OF_RANGE", f"{t} < 0"),
              ("Digital_Engagement_Score", "OUT_OF_RANGE", f"{d} < 0 OR {d} > 100")]
    return rules


MESSAGES = {
    ("Amount_NGN", "OUT_OF_RANGE"): "'Found ' || n || ' transactions with invalid Amount_NGN (<= 0 or > 50000000.0).'",
    ("Age", "OUT_OF_RANGE"): "'Found ' || n || ' customer records with invalid Age (< 18.0 or > 100.0).'",
    ("Tenure_Months", "OUT_OF_RANGE"): "'Found ' || n || ' customer records with negative Tenure_Months.'",
    ("Digital_Engagement_Score", "OUT_OF_RANGE"):
        "'Found ' || n || ' records with invalid Digital_Engagement_Score (must be 0-100).'",
}


def message(field: str, kind: str) -> str:
    if kind == "INCORRECT_DATA_TYPE":
        return f"'Column ''{field}'' contains ' || n || ' non-numeric values.'"
    if kind == "NULL_PRIMARY_KEY":
        return f"'Column ''{field}'' contains ' || n || ' null or blank values. Primary keys must be complete.'"
    if kind == "MISSING_VALUES":
        return (f"'Column ''{field}'' has ' || n || ' (' || printf('%.2f', n * 100.0 / total) || "
                "'%) missing values. Downstream imputation will be applied.'")
    if kind == "UNEXPECTED_CATEGORY":
        return (f"'Column ''{field}'' contains unexpected categories in ' || n || ' rows. Distinct values: ' || "
                f"(SELECT count(DISTINCT {field}) FROM denr WHERE {field} NOT IN {_in(field)}) || ' (bad_categories lists them).'")
    return MESSAGES[field, kind]


def issues(table: str = "denr") -> dict[str, str]:
    """All issues of a table with at least one row, as CTE ``issues``."""
    rows = [("ERROR", *r) for r in error_rules()]
    rows += [("WARNING", c, "MISSING_VALUES", f"{c} IS NULL") for c in CONTRACT.numeric + CONTRACT.categorical]
    counts = "SELECT count(*) AS total, " + ", ".join(
        f"count_if({cond}) AS r{i}" for i, (_, _, _, cond) in enumerate(rows)) + f" FROM {table}"
    union = " UNION ALL ".join(
        f"SELECT {i} AS place, '{sev}' AS severity, '{f}' AS field, '{kind}' AS error_type, n AS invalid_rows_count, "
        f"{message(f, kind)} AS message FROM (SELECT r{i}::bigint AS n, total FROM counts) WHERE n > 0"
        for i, (sev, f, kind, _) in enumerate(rows))
    return {"counts": counts, "issues": union}


def issue_list() -> str:
    parts = ", ".join(f"CASE WHEN {cond} THEN '{f}:{kind}' END" for f, kind, cond in error_rules())
    return f"list_filter([{parts}], lambda x: x IS NOT NULL)"


def _issue_oracle(kind: str, columns: str = "severity, field, error_type, invalid_rows_count, message") -> str:
    return with_tables(f"SELECT {columns} FROM issues WHERE error_type = '{kind}'", "denr", **issues())


# ---- sources, cleaning, joins -------------------------------------------------------

T_COLUMNS = ", ".join(c if c != "Transaction_DateTime" else "epoch_us(Transaction_DateTime) AS Transaction_DateTime" for c in TXN)
ORACLES["scan_txn"] = with_tables(f"SELECT {T_COLUMNS} FROM txn", "txn")
ORACLES["scan_cust"] = with_tables("SELECT * FROM cust", "cust")
ORACLES["redact_pii"] = with_tables("SELECT * EXCLUDE (Customer_Name) FROM cust", "cust")
ORACLES["clean_keys"] = with_tables("SELECT trim('  ' || Customer_ID || ' ') AS Customer_ID, Age FROM cust", "cust")
ORACLES["select_features"] = with_tables(
    f"""SELECT Amount_NGN, Age, Tenure_Months, Digital_Engagement_Score, Transaction_Hour::int AS Transaction_Hour,
    Transaction_DayOfWeek::int AS Transaction_DayOfWeek, Is_Weekend::int AS Is_Weekend,
    {', '.join(CONTRACT.categorical)} FROM efeat""", "efeat")
ORACLES["label_map"] = with_tables(
    """SELECT Transaction_ID, f AS Risk_Review_Flag, CASE WHEN f = 'Yes' THEN 1 ELSE 0 END AS label FROM (
    SELECT Transaction_ID, CASE WHEN _row % 59 = 0 THEN 'Maybe' WHEN _row % 61 = 0 THEN NULL
    ELSE Risk_Review_Flag END AS f FROM txn)""", "txn")
ORACLES["enrich_left"] = with_tables(
    "SELECT * EXCLUDE (_row) REPLACE (epoch_us(Transaction_DateTime) AS Transaction_DateTime) FROM enr", "enr")
ORACLES["dup_keys"] = with_tables(
    "SELECT Customer_ID, count(*) AS n FROM dcust GROUP BY 1 HAVING count(*) > 1", "dcust")
ORACLES["match_rate"] = with_tables(
    """SELECT count(*) AS total, count(c.Customer_ID) AS matched,
    round(count(c.Customer_ID) * 100.0 / count(*), 6)::double AS match_rate,
    round(count(c.Account_Type) * 100.0 / count(*), 6)::double AS proxy_rate
    FROM dtxn t LEFT JOIN dfirst c USING (Customer_ID)""", "dtxn", "dfirst")
ORACLES["enrich_lookup"] = with_tables(f"SELECT _row AS row_id, Customer_ID, {C_FEATURES} FROM denr", "denr")
ORACLES["enrich_partial"] = with_tables(
    f"""SELECT Transaction_ID, {', '.join(c for c in CONTRACT.customer_features if c not in ('Age', 'Gender'))},
    CASE WHEN _row % 3 = 0 THEN 33.0 ELSE Age END AS Age, CASE WHEN _row % 4 = 0 THEN 'Female' ELSE Gender END AS Gender
    FROM enr""", "enr")
ORACLES["orphan_txn"] = with_tables(
    "SELECT _row AS row_id, Customer_ID FROM dtxn WHERE Customer_ID NOT IN (SELECT Customer_ID FROM dcust)", "dtxn", "dcust")

# ---- validation ---------------------------------------------------------------------

ORACLES["dq_type"] = _issue_oracle("INCORRECT_DATA_TYPE")
ORACLES["dq_null_key"] = _issue_oracle("NULL_PRIMARY_KEY")
ORACLES["dq_missing"] = _issue_oracle("MISSING_VALUES")
ORACLES["dq_domain"] = _issue_oracle("UNEXPECTED_CATEGORY", "severity, field, error_type, invalid_rows_count")
ORACLES["dq_range"] = _issue_oracle("OUT_OF_RANGE")
ORACLES["dq_empty"] = with_tables(
    """SELECT 'ERROR' AS severity, 'Dataset' AS field, 'EMPTY_DATASET' AS error_type, 0::bigint AS invalid_rows_count,
    'The provided dataset is empty (0 rows or None). Processing cannot continue.' AS message, total
    FROM (SELECT count(*) AS total FROM enr WHERE Amount_NGN < 0) WHERE total = 0""", "enr")
ORACLES["dq_columns"] = """SELECT 'ERROR' AS severity, 'Columns' AS field, 'MISSING_COLUMNS' AS error_type,
    'Dataset is missing required columns: [''Channel'', ''Device_Type'']' AS message, count(*) AS total FROM events
    UNION ALL SELECT 'WARNING', 'Columns', 'UNEXPECTED_COLUMNS',
    'Dataset contains unexpected extra columns: [''Branch'']. These will be ignored.', count(*) FROM events"""
_plain = " UNION ALL ".join(
    f"SELECT '{f}' AS field, '{kind}' AS error_type, _row AS place, "
    + (f"{NUMBER[f]} AS number, NULL::varchar AS text" if kind == "OUT_OF_RANGE" else f"NULL::double AS number, {f}::varchar AS text")
    + f" FROM denr WHERE {cond}"
    for f, kind, cond in error_rules() if kind in ("INCORRECT_DATA_TYPE", "OUT_OF_RANGE"))
_values = " UNION ALL ".join(
    f"SELECT '{c}' AS field, {c} AS value, count(*) AS n, min(_row) AS first_row FROM denr "
    f"WHERE {c} NOT IN {_in(c)} GROUP BY {c}" for c in CONTRACT.categorical)
ORACLES["dq_samples"] = with_tables(
    """SELECT field, error_type, position, number, text FROM (
    SELECT *, row_number() OVER (PARTITION BY field, error_type ORDER BY place)::int AS position FROM found) WHERE position <= 5""",
    "denr", vals=_values,
    found=_plain + " UNION ALL SELECT field, 'UNEXPECTED_CATEGORY', first_row, NULL::double, value FROM vals")
ORACLES["dq_bad_categories"] = with_tables(f"SELECT field, value, n, first_row FROM ({_values})", "denr")
ORACLES["dq_verdict"] = with_tables(
    """SELECT 'dirty strict' AS "case", n = 0 AS is_valid, CASE WHEN n = 0 THEN 'PROCEED' ELSE 'REJECT_ALL' END AS action_taken
    FROM e UNION ALL SELECT 'dirty lenient', n = 0, CASE WHEN n = 0 THEN 'PROCEED' ELSE 'QUARANTINE_RECORDS' END FROM e
    UNION ALL SELECT 'clean strict', n = 0, CASE WHEN n = 0 THEN 'PROCEED' ELSE 'REJECT_ALL' END FROM c
    UNION ALL SELECT 'incomplete lenient', false, 'REJECT_ALL'""",
    "denr", "enr", **issues(), e="SELECT count(*) AS n FROM issues WHERE severity = 'ERROR'",
    c="SELECT " + " + ".join(f"count_if({cond})" for _, _, cond in error_rules()) + " AS n FROM enr")
_listed = ("string_agg(field || ':' || error_type || ':' || invalid_rows_count || ':' || message, '|' ORDER BY place) "
           "FILTER (WHERE severity = '{0}')")
_extra = "Columns:UNEXPECTED_COLUMNS"
ORACLES["dq_report"] = with_tables(
    f"""SELECT count_if(severity = 'ERROR') = 0 AS is_valid, (SELECT total FROM counts) AS total_records,
    count_if(severity = 'ERROR')::int AS error_count, count_if(severity = 'WARNING')::int AS warning_count,
    CASE WHEN count_if(severity = 'ERROR') = 0 THEN 'PROCEED' ELSE 'QUARANTINE_RECORDS' END AS action_taken,
    {_listed.format('ERROR')} AS errors, {_listed.format('WARNING')} AS warnings,
    (SELECT string_agg(value, ',' ORDER BY first_row) FROM vals) AS category_samples FROM issues""",
    "denr", **issues(), vals=_values)
ORACLES["dq_merged"] = ORACLES["dq_report"]
_no_error = " AND ".join(f"NOT coalesce({cond}, false)" for _, _, cond in error_rules())
ORACLES["quarantine_clean"] = with_tables(
    f"SELECT _row AS row_id, Transaction_ID, Customer_ID, Channel, Age FROM denr WHERE {_no_error}", "denr")
ORACLES["quarantine_bad"] = with_tables(
    f"SELECT _row AS row_id, array_to_string({issue_list()}, '|') AS issues FROM denr WHERE NOT ({_no_error})", "denr")

# ---- scalar functions ---------------------------------------------------------------

ORACLES["serial_time"] = with_tables(
    """SELECT Transaction_ID, round((s - 25569.0::double) * 86400000000.0::double)::bigint AS micros,
    floor((s % 1.0::double) * 24)::int AS hour,
    (isodow(date '1899-12-30' + floor(s)::int) - 1)::int AS weekday FROM serial""", "txn",
    serial="SELECT Transaction_ID, epoch_us(Transaction_DateTime) / 86400000000.0::double + 25569.0::double AS s FROM txn")
ORACLES["parse_time"] = with_tables(
    """SELECT _row AS row_id, CASE WHEN _row % 5 = 0 OR _row % 7 = 0 OR _row % 11 = 0 THEN NULL
    ELSE epoch_us(Transaction_DateTime) END AS micros FROM txn""", "txn")
ORACLES["temporal_features"] = with_tables(
    """SELECT Transaction_ID, coalesce(hour(t), 12)::int AS Transaction_Hour,
    coalesce(isodow(t) - 1, 0)::int AS Transaction_DayOfWeek, (coalesce(isodow(t) - 1, 0) >= 5)::int AS Is_Weekend
    FROM (SELECT Transaction_ID, CASE WHEN _row % 91 <> 0 THEN Transaction_DateTime END AS t FROM txn)""", "txn")
ORACLES["night_flag"] = with_tables(
    "SELECT Transaction_ID, (hour(Transaction_DateTime) < 5)::int AS is_night FROM txn", "txn")
ORACLES["margin_to_prob"] = with_tables(
    """SELECT Transaction_ID, round(1.0::double / (1.0::double + exp(-((Amount_NGN - 50000) / 25000))), 6) AS probability
    FROM txn""", "txn")
ORACLES["hard_to_prob"] = with_tables(
    """SELECT Transaction_ID, (Risk_Review_Flag = 'No')::int::double AS p0, (Risk_Review_Flag = 'Yes')::int::double AS p1
    FROM txn""", "txn")

# ---- features -----------------------------------------------------------------------

TRAIN = "SELECT * FROM feat WHERE split = 'train'"
NUM = CONTRACT.model_numeric
ORACLES["fit_medians"] = with_tables(
    " UNION ALL ".join(f"SELECT '{c}' AS field, median({c})::double AS median FROM train" for c in NUM), "feat", train=TRAIN)
_moments = " UNION ALL ".join(
    f"""SELECT '{c}' AS field, avg(x) AS mean, CASE WHEN stddev_pop(x) = 0 THEN 1.0 ELSE stddev_pop(x) END AS scale
    FROM (SELECT coalesce({c}, (SELECT median({c}) FROM train)) AS x FROM train)""" for c in NUM)
ORACLES["fit_scaler"] = with_tables(
    f"SELECT field, round(mean, 6) AS mean, round(scale, 6) AS scale FROM ({_moments})", "feat", train=TRAIN)
ORACLES["impute_cat"] = with_tables(
    "SELECT Transaction_ID, " + ", ".join(f"coalesce({c}, 'Missing') AS {c}" for c in CONTRACT.transaction_categorical)
    + " FROM txn", "txn")
_levels = " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS field, coalesce({c}, 'Missing') AS level, count(*) AS n FROM train GROUP BY 3"
    for i, c in enumerate(CONTRACT.categorical))
ORACLES["fit_levels"] = with_tables(f"SELECT field, level, n FROM ({_levels})", "feat", train=TRAIN)
_numbered = " UNION ALL ".join(f"SELECT -1 AS a, '' AS b, {i} AS c, '{n}' AS feature" for i, n in enumerate(NUM))
ORACLES["feature_names"] = with_tables(
    f"""SELECT row_number() OVER (ORDER BY a, b, c) - 1 AS position, feature FROM ({_numbered}
    UNION ALL SELECT position, level, 0, field || '_' || level FROM ({_levels}))""", "feat", train=TRAIN)
_names = ORACLES["feature_names"]
ORACLES["lr_certificate"] = f"SELECT position, feature, true AS at_optimum FROM ({_names}) UNION ALL SELECT -1, 'intercept', true"
ORACLES["forest_importances"] = f"SELECT position, feature, true AS same_importance FROM ({_names})"
ORACLES["scale_num"] = with_tables(
    "SELECT Transaction_ID, " + ", ".join(f"round({z(c)}, 6) AS {c}" for c in NUM) + " FROM efeat", "efeat")
HOT = [(c, v, f"(coalesce({c}, 'Missing') = '{v}')::int::double") for c, vs in FROZEN.levels.items() for v in vs]
ORACLES["onehot_wide"] = with_tables(
    "SELECT Transaction_ID, " + ", ".join(f'{e} AS "{c}_{v}"' for c, v, e in HOT) + " FROM enr", "enr")
_vector = [z(c) for c in NUM] + [e for _, _, e in HOT]
ORACLES["features_vector"] = with_tables(
    f"""SELECT Transaction_ID, {len(_vector)}::int AS width, round({' + '.join(_vector)}, 6) AS total,
    round({' + '.join(f'{i + 1} * {e}' for i, e in enumerate(_vector))}, 5) AS placed FROM efeat""", "efeat")
_stats = "SELECT " + ", ".join(f"median({c}) AS m_{c}, avg({c}) AS a_{c}, stddev_pop({c}) AS s_{c}" for c in NUM) + " FROM train"
ORACLES["no_leakage"] = with_tables(
    "SELECT Transaction_ID, " + ", ".join(f"round((coalesce({c}, m_{c}) - a_{c}) / s_{c}, 6) AS {c}" for c in NUM)
    + " FROM feat, stats WHERE split = 'test'", "feat", train=TRAIN, stats=_stats)

# ---- splitting ----------------------------------------------------------------------

ORACLES["split_exact"] = with_tables("SELECT Transaction_ID, Risk_Review_Flag, split FROM split", "split")
ORACLES["split_scalable"] = ORACLES["split_exact"]
ORACLES["forest_walk"] = with_tables(
    "SELECT Transaction_ID, (Risk_Review_Flag = 'Yes')::bigint AS label, true AS same_score FROM split WHERE split = 'test'", "split")
ORACLES["split_append"] = with_tables(
    """SELECT Transaction_ID, flag AS Risk_Review_Flag, load, CASE WHEN h <= cut THEN 'test' ELSE 'train' END AS split
    FROM hashed LEFT JOIN cuts USING (flag)""", "txn",
    hashed="SELECT Transaction_ID, Risk_Review_Flag AS flag, (_row % 2)::bigint AS load, md5(concat(Transaction_ID, '|42')) AS h FROM txn",
    shares=CTES["quota"].replace("Risk_Review_Flag", "flag").replace("FROM enr", "FROM hashed WHERE load = 0"),
    cuts="""SELECT flag, max(h) AS cut FROM (
        SELECT flag, h, row_number() OVER (PARTITION BY flag ORDER BY h) AS place FROM hashed WHERE load = 0) JOIN shares USING (flag)
        WHERE place <= take GROUP BY flag""")
ORACLES["split_counts"] = with_tables("SELECT Risk_Review_Flag, split, count(*) AS n FROM split GROUP BY ALL", "split")
ORACLES["prepare"] = with_tables(
    "SELECT * EXCLUDE (_row) REPLACE (epoch_us(Transaction_DateTime) AS Transaction_DateTime) FROM split", "split")
ORACLES["prepare_summary"] = with_tables(
    """SELECT count(*) AS total_enriched_records, count_if(split = 'train')::bigint AS train_records,
    count_if(split = 'test')::bigint AS test_records FROM split""", "split")

# ---- models and decisions -----------------------------------------------------------

ORACLES["class_weights"] = with_tables(
    """SELECT (Risk_Review_Flag = 'Yes')::int AS label, count(*) AS n,
    round((SELECT count(*) FROM train) / (2.0 * count(*)), 6)::double AS weight FROM train GROUP BY 1""", "feat", train=TRAIN)
ORACLES["linear_score"] = with_tables("SELECT Transaction_ID, round(p, 6) AS probability FROM scored", "efeat", **scored())
ORACLES["predict_flag"] = with_tables("SELECT Transaction_ID, (p >= 0.35)::int AS prediction FROM scored", "efeat", **scored())
ORACLES["decide"] = with_tables(f"SELECT Transaction_ID, {DECISION} FROM scored", "efeat", **scored())
ORACLES["score_response"] = with_tables(f"SELECT Transaction_ID, Customer_ID, {DECISION} FROM scored", "efeat", **scored())
_dscored = f"""SELECT *, {linear()} AS p FROM (SELECT * REPLACE (try_cast(Amount_NGN AS double) AS Amount_NGN),
    hour(Transaction_DateTime) AS Transaction_Hour, isodow(Transaction_DateTime) - 1 AS Transaction_DayOfWeek,
    (isodow(Transaction_DateTime) >= 6)::int AS Is_Weekend FROM denr WHERE {_no_error})"""
ORACLES["score_batch"] = with_tables(
    f"SELECT _row AS row_id, Transaction_ID, Customer_ID, {DECISION} FROM dscored", "denr", dscored=_dscored)
ORACLES["score_with_quarantine"] = with_tables(
    f"""SELECT _row AS row_id, 'scored' AS row_status, {FLAG}, {TIER}, 0 AS n_issues FROM dscored
    UNION ALL SELECT _row, 'quarantined', NULL, NULL, len({issue_list()})::int FROM denr WHERE NOT ({_no_error})""",
    "denr", dscored=_dscored)
ORACLES["tier_mix"] = with_tables(
    """SELECT Risk_Tier, count(*) AS n, round(sum(Amount_NGN), 2) AS amount,
    round(avg(Risk_Probability), 6) AS mean_probability FROM d GROUP BY 1""", "efeat", **scored(),
    d=f"SELECT Amount_NGN, {DECISION} FROM scored")
_outside = (f"-1.0::double + 0.9::double * {z('Amount_NGN')} - 0.1::double * {z('Age')} "
            f"+ 0.2::double * {z('Transaction_Hour')} + 0.4::double * (Channel = 'USSD')::int::double")
ORACLES["score_external"] = with_tables(
    "SELECT Transaction_ID, round(p, 6) AS probability, (p >= 0.35)::int AS prediction FROM ext", "efeat",
    ext=f"SELECT Transaction_ID, 1.0::double / (1.0::double + exp(-({_outside}))) AS p FROM efeat")

# ---- evaluation ---------------------------------------------------------------------

MATRIX = """count_if(label = 0 AND p < {t})::bigint AS tn, count_if(label = 0 AND p >= {t})::bigint AS fp,
    count_if(label = 1 AND p < {t})::bigint AS fn, count_if(label = 1 AND p >= {t})::bigint AS tp"""
RATIOS = """coalesce(tp / nullif(tp + fp, 0), 0)::double AS precision, coalesce(tp / nullif(tp + fn, 0), 0)::double AS recall,
    coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0)::double AS f1_score"""


def auc(p: str = "p", source: str = "scored") -> str:
    return f"""(SELECT sum(pos * (below + neg / 2.0))::double / (sum(pos)::double * sum(neg)) FROM (
        SELECT *, sum(neg) OVER (ORDER BY s) - neg AS below FROM (
        SELECT {p} AS s, count_if(label = 1) AS pos, count_if(label = 0) AS neg FROM {source} GROUP BY 1)))"""


def metric_record(source: str) -> str:
    return f"""SELECT round({auc(source=source)}, 4) AS roc_auc, round(precision, 4) AS precision, round(recall, 4) AS recall,
        round(f1_score, 4) AS f1_score, round(brier, 4) AS brier_score, 0.35::double AS decision_threshold, tn, fp, fn, tp
        FROM (SELECT *, {RATIOS} FROM (SELECT avg((p - label) * (p - label)) AS brier, {MATRIX.format(t=0.35)} FROM {source}))"""


ORACLES["confusion"] = with_tables(f"SELECT {MATRIX.format(t=0.35)} FROM scored", "efeat", **scored())
_ratio_columns = ", ".join(f"round({c}, 6) AS {c}" for c in ("precision", "recall", "f1_score"))
ORACLES["class_metrics"] = with_tables(
    f"SELECT tn, fp, fn, tp, {_ratio_columns} FROM (SELECT *, {RATIOS} FROM (SELECT {MATRIX.format(t=0.35)} FROM scored))",
    "efeat", **scored())
ORACLES["brier"] = with_tables(
    "SELECT round(avg((p - label) * (p - label)), 6) AS brier_score FROM scored", "efeat", **scored())
ORACLES["roc_auc"] = with_tables(f"SELECT round({auc()}, 6) AS roc_auc", "efeat", **scored())
ORACLES["roc_auc_ties"] = with_tables(f"SELECT round({auc('round(p, 1)')}, 6) AS roc_auc", "efeat", **scored())
ORACLES["metrics"] = with_tables(metric_record("scored"), "efeat", **scored())
ORACLES["compare_models"] = with_tables(
    f"""SELECT c.roc_auc AS candidate_roc_auc, c.f1_score AS candidate_f1, b.roc_auc AS baseline_roc_auc,
    b.f1_score AS baseline_f1, round(c.roc_auc - b.roc_auc, 4) AS improvement_roc_auc
    FROM ({metric_record('scored')}) c, ({metric_record('base')}) b""", "efeat", **scored(), **scored("base", BASELINE_WEIGHTS))
ORACLES["threshold_sweep"] = with_tables(
    " UNION ALL ".join(
        f"SELECT {t}::double AS threshold, tn, fp, fn, tp, {_ratio_columns} FROM (SELECT *, {RATIOS} "
        f"FROM (SELECT {MATRIX.format(t=t)} FROM scored))" for t in (0.20, 0.35, 0.50)), "efeat", **scored())
ORACLES["prob_range"] = with_tables(
    "SELECT round(min(p), 6) AS min_probability, round(max(p), 6) AS max_probability FROM scored", "efeat", **scored())
ORACLES["class_counts"] = with_tables(
    """SELECT Risk_Review_Flag, count(*) AS n, round(count(*) * 1.0::double / (SELECT count(*) FROM txn), 6) AS share
    FROM txn GROUP BY 1""", "txn")

# ---- requests and streaming ---------------------------------------------------------

# What the payloads say, before the request contract is applied. In short payloads the
# last four fields are absent; cut ones are no JSON at all.
_sent = """SELECT _row, CASE WHEN _row % 107 <> 0 THEN Transaction_ID END AS Transaction_ID, Customer_ID,
    epoch_us(Transaction_DateTime) / 86400000000.0::double + 25569.0::double AS Transaction_DateTime, Transaction_Type,
    CASE WHEN _row % 103 = 0 THEN NULL WHEN _row % 97 = 0 THEN -Amount_NGN ELSE Amount_NGN END AS Amount_NGN,
    Channel, Device_Type, Location, CASE WHEN _row % 109 <> 0 THEN International_Transaction END AS International_Transaction,
    Transaction_Status, _row % 7 = 0 AS short, _row % 127 = 0 AS cut FROM txn"""
_default = {"Device_Type": "Android", "Location": "Lagos", "International_Transaction": "No", "Transaction_Status": "Successful"}
_got = "SELECT _row, cut, " + ", ".join(
    f"CASE WHEN cut THEN NULL WHEN short THEN '{_default[c]}' ELSE {c} END AS {c}" if c in _default
    else f"CASE WHEN NOT cut THEN {c} END AS {c}" for c in REQUEST
) + """, CASE WHEN cut THEN 'payload:not a JSON object' ELSE array_to_string(list_filter([
    CASE WHEN _row % 107 = 0 THEN 'Transaction_ID:null' END,
    CASE WHEN _row % 103 = 0 THEN 'Amount_NGN:not a double' WHEN Amount_NGN <= 0 THEN 'Amount_NGN:not positive' END,
    CASE WHEN NOT short AND _row % 109 = 0 THEN 'International_Transaction:null' END], lambda x: x IS NOT NULL), '|') END AS reasons
    FROM sent"""
REQUESTS = {"sent": _sent, "got": _got}
_request_columns = ", ".join(
    f"round({c}, 6) AS {c}" if c in ("Transaction_DateTime", "Amount_NGN") else c for c in REQUEST)
ORACLES["json_requests"] = with_tables(f"SELECT _row AS row_id, {_request_columns}, reasons FROM got", "txn", **REQUESTS)
ORACLES["json_defaults"] = with_tables(
    f"SELECT _row AS row_id, {', '.join(OPTIONAL)} FROM got WHERE reasons = ''", "txn", **REQUESTS)
_given = {"Age": "35.0", "Tenure_Months": "24.0", "Digital_Engagement_Score": "75.0", "Gender": "'Female'",
          "Customer_Segment": "'Everyday'", "Account_Type": "'Savings'", "Monthly_Income_Band": "'250k-499k'",
          "Preferred_Channel": "'Mobile App'", "Account_Status": "'Active'"}
ORACLES["json_requests_enriched"] = with_tables(
    "SELECT _row AS row_id, Age, Gender, " + ", ".join(
        f"CASE WHEN _row % 3 = 0 THEN {_given[c]} ELSE {c} END AS {c}" for c in _given if c not in ("Age", "Gender"))
    + ", (Amount_NGN <= 0)::int AS n_reasons FROM enr", "enr")
ORACLES["json_batches"] = with_tables(
    """SELECT floor(_row / 50)::bigint AS batch, count(*) AS total_processed, count_if(reasons = '')::bigint AS accepted,
    round(sum(CASE WHEN NOT cut THEN Amount_NGN END), 2) AS amount, count_if(cut)::bigint AS malformed FROM got GROUP BY 1""", "txn", **REQUESTS)
_rscored = f"""SELECT *, {linear()} AS p, list_filter([CASE WHEN Amount_NGN <= 0 THEN 1 END,
    CASE WHEN Age < 18 THEN 1 END], lambda x: x IS NOT NULL) AS bad FROM (
    SELECT g.*, {C_FEATURES}, floor((Transaction_DateTime % 1.0::double) * 24) AS Transaction_Hour,
    isodow(date '1899-12-30' + floor(Transaction_DateTime)::int) - 1 AS Transaction_DayOfWeek,
    (isodow(date '1899-12-30' + floor(Transaction_DateTime)::int) >= 6)::int AS Is_Weekend
    FROM got g LEFT JOIN dfirst USING (Customer_ID))"""
_rows = f"""SELECT _row AS row_id, 'scored' AS row_status, {FLAG}, round_even(p, 4) AS Risk_Probability, {TIER}, 0 AS n_issues
    FROM rscored WHERE reasons = '' AND len(bad) = 0
    UNION ALL SELECT _row, 'quarantined', NULL, NULL, NULL,
    CASE WHEN reasons = '' THEN len(bad) ELSE len(string_split(reasons, '|')) END::int
    FROM rscored WHERE reasons <> '' OR len(bad) > 0"""
ORACLES["score_requests"] = with_tables(_rows, "txn", "dfirst", **REQUESTS, rscored=_rscored)
ORACLES["stream_score"] = ORACLES["score_requests"]
ORACLES["stream_refreshed"] = ORACLES["score_requests"]

# ---- inputs that used to break ------------------------------------------------------

_times = """SELECT *, cast(CASE _row % 3 WHEN 0 THEN floor((s % 1.0::double) * 24) WHEN 1 THEN hour(t) ELSE 12 END AS double) AS Transaction_Hour,
    cast(CASE _row % 3 WHEN 0 THEN isodow(date '1899-12-30' + floor(s)::int) - 1 WHEN 1 THEN isodow(t) - 1 ELSE 0 END AS double) AS Transaction_DayOfWeek
    FROM (SELECT *, Transaction_DateTime AS t, epoch_us(Transaction_DateTime) / 86400000000.0::double + 25569.0::double AS s FROM enr)"""
_weekend = "SELECT *, cast(Transaction_DayOfWeek >= 5 AS double) AS Is_Weekend FROM times"
_error_free = " AND ".join(f"NOT coalesce({cond}, false)" for _, _, cond in error_rules())
ORACLES["csv_times"] = with_tables(
    """SELECT Transaction_ID, round(p, 4) AS Risk_Probability, 'scored' AS row_status FROM scored_times""",
    "enr", times=_times, weekend=_weekend, scored_times=f"SELECT *, {linear()} AS p FROM weekend")
ORACLES["time_bounds"] = with_tables(
    """SELECT _row AS row_id, CASE WHEN _row % 6 = 5 THEN 12 END AS hour, CASE WHEN _row % 6 = 5 THEN 4 END AS weekday,
    CASE WHEN _row % 6 = 5 THEN 12 END AS micros_hour, CASE WHEN _row % 6 = 5 THEN 4 END AS micros_weekday FROM txn""", "txn")
ORACLES["no_probability"] = with_tables(
    """SELECT _row AS row_id, CASE WHEN _row % 3 = 2 THEN 'Yes' END AS Predicted_Risk_Flag,
    CASE WHEN _row % 3 = 2 THEN 0.5::double END AS Risk_Probability, CASE WHEN _row % 3 = 2 THEN 'Medium' END AS Risk_Tier,
    CASE WHEN _row % 3 = 2 THEN 'Secondary Verification (SMS/OTP)' END AS Operational_Action FROM txn""", "txn")
ORACLES["enrich_large"] = with_tables(
    """SELECT k._row AS row_id, k.c AS Customer_ID, Age, Gender FROM (
    SELECT _row, CASE WHEN _row % 3 = 0 THEN (SELECT min(Customer_ID) FROM cust) WHEN _row % 101 = 1 THEN NULL ELSE Customer_ID END AS c
    FROM txn) k LEFT JOIN cust ON cust.Customer_ID = k.c""", "txn", "cust")
ORACLES["enrich_colocated"] = ORACLES["enrich_large"]
ORACLES["orphans_colocated"] = ORACLES["orphan_txn"]
ORACLES["prepared_csv"] = with_tables("SELECT Transaction_ID, split, Amount_NGN, Channel, Gender FROM split", "split")
ORACLES["written_tables"] = with_tables("SELECT * EXCLUDE (Customer_Name) FROM cust", "cust")
ORACLES["scan_orc"] = ORACLES["scan_txn"]
ORACLES["enrich_none"] = with_tables("SELECT Transaction_ID, Customer_ID, Amount_NGN FROM txn", "txn")
ORACLES["serial_micros"] = with_tables(
    """SELECT Transaction_ID, hour(t)::int AS hour, (isodow(t) - 1)::int AS weekday FROM (
    SELECT Transaction_ID, make_timestamp(round((epoch_us(Transaction_DateTime) / 86400000000.0::double + 25569.0::double - 25569.0::double)
        * 86400000000.0::double)::bigint) AS t FROM txn)""", "txn")
ORACLES["saved_features"] = ORACLES["scale_num"]
ORACLES["published_features"] = ORACLES["scale_num"]
