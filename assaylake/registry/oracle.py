"""ANSI SQL for each registered query, written apart from the Spark code it checks."""

from __future__ import annotations

from assaylake import schemas as S
from assaylake.registry.transactions import NUMBERED_EVENTS, RAW_TEXT, TX_COLUMNS

_COLS = ", ".join(f'"{c}"' for c in S.RAW_COLUMNS)

_TX = "SELECT " + ", ".join(f'{e} AS "{c}"' for c, e in TX_COLUMNS.items()) + " FROM numbered"

_RAW_BASE = "SELECT event_id, " + ", ".join(f'{e} AS "{c}"' for c, e in RAW_TEXT.items()) + " FROM numbered"
_SAME_KEY = ", ".join("'77' AS session_duration" if c == "session_duration" else f'"{c}"' for c in S.RAW_COLUMNS)

_VALID = """ "timestamp" IS NOT NULL AND sending_address IS NOT NULL AND receiving_address IS NOT NULL
    AND amount >= 0 AND transaction_type IN ('purchase','sale','transfer')
    AND location_region IS NOT NULL AND risk_score BETWEEN 0 AND 100
    AND login_frequency >= 0 AND session_duration > 0
    AND anomaly IN ('low_risk','moderate_risk','high_risk') """


def _initcap(text: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower({text}), ' '), "
        f"lambda w: upper(w[1:1]) || w[2:]), ' ')"
    )


_WHOLE = "trunc(TRY_CAST({0} AS DECIMAL(38,10)))"


def _whole(column: str, to: str) -> str:
    return f"TRY_CAST({_WHOLE.format(column)} AS {to})"


def _epoch(column: str) -> str:
    return f"make_timestamp({_whole(column, 'BIGINT')} * 1000000)"


def _decimal(column: str, to: str) -> str:
    return f"TRY_CAST(replace({column}, ',', '.') AS {to})"


def _lower(*columns: str) -> str:
    return ", ".join(f"lower(trim({c})) AS {c}" for c in columns)


_NORMALISED = f"""
  SELECT trim("timestamp") AS "timestamp", {_lower("sending_address", "receiving_address")},
    trim(amount) AS amount, {_lower("transaction_type")},
    CASE WHEN location_region IS NOT NULL THEN {_initcap("trim(location_region)")} END AS location_region,
    trim(ip_prefix) AS ip_prefix, trim(login_frequency) AS login_frequency,
    trim(session_duration) AS session_duration, {_lower("purchase_pattern", "age_group")},
    trim(risk_score) AS risk_score, {_lower("anomaly")}
  FROM raw"""

_TYPED_ALL = f"""
  SELECT {_epoch('"timestamp"')} AS "timestamp", sending_address, receiving_address,
    {_decimal("amount", "DECIMAL(18,2)")} AS amount, transaction_type, location_region, ip_prefix,
    {_whole("login_frequency", "INTEGER")} AS login_frequency,
    {_whole("session_duration", "INTEGER")} AS session_duration, purchase_pattern, age_group,
    {_decimal("risk_score", "DECIMAL(5,2)")} AS risk_score, anomaly
  FROM normalised"""

_WITH = f"""WITH numbered AS ({NUMBERED_EVENTS}),
tx AS ({_TX}),
tx_valid AS (SELECT * FROM tx WHERE {_VALID}),
base AS ({_RAW_BASE}),
raw AS (SELECT {_COLS} FROM base
  UNION ALL SELECT {_COLS} FROM base WHERE event_id % 20 = 0
  UNION ALL SELECT {_SAME_KEY} FROM base WHERE event_id % 30 = 0),
normalised AS ({_NORMALISED}),
typed_all AS ({_TYPED_ALL}),
typed AS (SELECT DISTINCT * FROM typed_all),
silver AS (SELECT * FROM typed WHERE {_VALID}) """


def _sql(body: str) -> str:
    return _WITH + body


_KEY = '"timestamp", sending_address, receiving_address, amount, transaction_type'


def _risk(table: str) -> str:
    """The mean in whole numbers: risk in cents, to six places half up, then to two."""
    return _sql(f"""
, sums AS (SELECT location_region, CAST(sum(CAST(risk_score * 100 AS BIGINT)) AS HUGEINT) AS cents,
    count(*) AS n, count(*) FILTER (WHERE anomaly <> 'low_risk') AS suspicious
  FROM {table} GROUP BY location_region),
micros AS (SELECT *, (2 * cents * 10000 + n) // (2 * n) AS m FROM sums)
SELECT location_region, CAST(CAST((m + 5000) // 10000 AS DECIMAL(18,0)) * 0.01 AS DECIMAL(6,2)) AS avg_risk_score,
  CAST(n AS BIGINT) AS total_transactions, CAST(suspicious AS BIGINT) AS suspicious_transactions
FROM micros""")


def _latest(table: str, columns: str, ties: str = "") -> str:
    return f"""(SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY receiving_address
      ORDER BY "timestamp" DESC, amount DESC{ties}) AS rn
    FROM {table} WHERE transaction_type = 'sale') WHERE rn = 1)"""


_TIES = "".join(
    f", {c} ASC NULLS FIRST"
    for c in S.RAW_COLUMNS
    if c not in ("timestamp", "receiving_address", "amount")
)


def _top3(table: str) -> str:
    latest = _latest(table, 'receiving_address, amount, "timestamp"')
    return _sql(f'SELECT * FROM {latest} ORDER BY amount DESC, "timestamp" DESC, receiving_address LIMIT 3')


# ---- Quality: (rule, kind, column, condition that breaks it) ----

_REGION_LIST = "('" + "','".join(S.LOCATION_REGIONS) + "')"
_HEX = "'^0x[a-f0-9]{40}$'"

_NOT_NULL = [(f"not_null:{c}", "not_null", c, f'"{c}" IS NULL') for c in S.RAW_COLUMNS]
_IN_SET = [
    (f"in_set:{c}", "in_set", c, f"{c} NOT IN {domain}")
    for c, domain in (
        ("transaction_type", "('purchase','sale','transfer')"),
        ("purchase_pattern", "('focused','high_value','random','none')"),
        ("age_group", "('new','established','veteran','none')"),
        ("anomaly", "('low_risk','moderate_risk','high_risk')"),
        ("location_region", _REGION_LIST),
    )
]
_RANGE = [
    ("range:amount", "range", "amount", "amount < 0"),
    ("range:risk_score", "range", "risk_score", "risk_score < 0 OR risk_score > 100"),
    ("range:login_frequency", "range", "login_frequency", "login_frequency < 0"),
    ("range:session_duration", "range", "session_duration", "session_duration < 1"),
]
_LENGTH = [
    (f"length42:{c}", "length", c, f"length({c}) <> 42") for c in ("sending_address", "receiving_address")
]
_BLANK = [("region_not_blank", "not_regex", "location_region", r"regexp_matches(location_region, '^\s*$')")]
_REGEX = [
    *(
        (f"regex:{c}", "regex", c, f"NOT regexp_matches({c}, {_HEX})")
        for c in ("sending_address", "receiving_address")
    ),
    (
        "regex:ip_prefix",
        "regex",
        "ip_prefix",
        r"NOT regexp_matches(ip_prefix, '^([0-9]{1,3})(\.[0-9]{1,3}){1,3}$')",
    ),
]
_CONDITIONAL = [
    (
        "cond:transfer_purchase_pattern",
        "conditional",
        "purchase_pattern",
        "transaction_type = 'transfer' AND purchase_pattern <> 'none'",
    ),
    ("cond:transfer_age_group", "conditional", "age_group", "transaction_type = 'transfer' AND age_group <> 'none'"),
    ("cond:high_risk", "conditional", "risk_score", "anomaly = 'high_risk' AND (risk_score < 70 OR risk_score > 100)"),
    (
        "cond:moderate_risk",
        "conditional",
        "risk_score",
        "anomaly = 'moderate_risk' AND (risk_score < 40 OR risk_score >= 70)",
    ),
    ("cond:low_risk", "conditional", "risk_score", "anomaly = 'low_risk' AND (risk_score < 0 OR risk_score >= 40)"),
    ("cond:region_domain", "conditional", "location_region", f"location_region NOT IN {_REGION_LIST}"),
]
_ROW_RULES = [*_NOT_NULL, *_BLANK, *_IN_SET, *_RANGE, *_LENGTH, *_REGEX]


def _row_result(table: str, rule: tuple[str, str, str, str]) -> str:
    name, kind, column, breaks = rule
    tested = "count(*)" if kind == "not_null" else f'count("{column}")'
    return (
        f"SELECT '{name}' AS rule, '{kind}' AS kind, '{column}' AS \"column\", "
        f"{tested} AS tested, count(*) FILTER (WHERE {breaks}) AS broken FROM {table}"
    )


def _distinct_result(table: str) -> str:
    return f"""SELECT 'distinct_in_set:location_region' AS rule, 'distinct_in_set' AS kind,
    'location_region' AS "column", count(DISTINCT location_region) AS tested,
    count(DISTINCT location_region) FILTER (WHERE location_region NOT IN {_REGION_LIST}) AS broken
  FROM {table}"""


def _unique_result(table: str) -> str:
    return f"""SELECT 'unique:transaction' AS rule, 'unique' AS kind, CAST(NULL AS VARCHAR) AS "column",
    coalesce(sum(n), 0) AS tested, coalesce(sum(n) FILTER (WHERE n > 1), 0) AS broken
  FROM (SELECT count(*) AS n FROM {table} GROUP BY {_KEY})"""


def _schema_results(table: str, columns_match: bool) -> list[str]:
    rules = [("column_set", "column_set", "NULL", columns_match)]
    rules += [
        (f"type:{c}", "type", f"'{c}'", True) for c in ("timestamp", "amount", "login_frequency", "session_duration")
    ]
    return [
        f"SELECT '{name}' AS rule, '{kind}' AS kind, CAST({column} AS VARCHAR) AS \"column\", "
        f"{str(success).upper()} AS held, count(*) AS tested, 0 AS broken FROM {table}"
        for name, kind, column, success in rules
    ]


def _finish(selects: list[str]) -> str:
    """Result rows from (rule, kind, column, tested, broken), some with a fixed outcome in ``held``."""
    with_held = [s if " AS held" in s else f"SELECT rule, kind, \"column\", NULL AS held, tested, broken FROM ({s})" for s in selects]
    union = "\nUNION ALL ".join(with_held)
    return f"""results AS (SELECT rule, kind, "column", coalesce(held, broken = 0) AS success,
    CAST(tested AS BIGINT) AS tested, CAST(broken AS BIGINT) AS unexpected_count,
    CASE WHEN tested > 0 THEN CAST(100 AS DOUBLE) * CAST(broken AS DOUBLE) / CAST(tested AS DOUBLE)
      ELSE CAST(0 AS DOUBLE) END AS unexpected_percent
  FROM ({union}))"""


def _results(table: str, rules: list[tuple[str, str, str, str]]) -> str:
    return _sql(", " + _finish([_row_result(table, rule) for rule in rules]) + " SELECT * FROM results")


def _suite(table: str) -> str:
    return _finish(
        [
            *_schema_results(table, True),
            *(_row_result(table, rule) for rule in _ROW_RULES),
            _distinct_result(table),
            _unique_result(table),
        ]
    )


def _samples(table: str, rules: list[tuple[str, str, str, str]]) -> str:
    """CTEs ending in samples(rule, value, n, place): the most frequent values that broke each rule."""
    broken = [
        f"SELECT '{name}' AS rule, {20 if kind == 'conditional' else 10} AS most, "
        f'CAST("{column}" AS VARCHAR) AS value, count(*) AS n FROM {table} WHERE {breaks} GROUP BY 1, 2, 3'
        for name, kind, column, breaks in rules
    ]
    text = " || '|' || ".join(
        f"coalesce(CAST({c} AS VARCHAR), 'NULL')" for c in (k.strip() for k in _KEY.split(","))
    )
    keys = f"""SELECT 'unique:transaction' AS rule, 10 AS most, {text} AS value, count(*) AS n
      FROM {table} GROUP BY {_KEY} HAVING count(*) > 1"""
    union = "\nUNION ALL ".join([*broken, keys])
    return f"""samples AS (SELECT rule, value, CAST(n AS BIGINT) AS n, place FROM (
    SELECT *, row_number() OVER (PARTITION BY rule ORDER BY n DESC, value ASC NULLS FIRST) AS place
    FROM ({union})) WHERE place <= most)"""


_EXPECTATION = """CASE kind WHEN 'column_set' THEN 'expect_table_columns_to_match_set'
    WHEN 'type' THEN 'expect_column_values_to_be_of_type'
    WHEN 'not_null' THEN 'expect_column_values_to_not_be_null'
    WHEN 'not_regex' THEN 'expect_column_values_to_not_match_regex'
    WHEN 'regex' THEN 'expect_column_values_to_match_regex'
    WHEN 'in_set' THEN 'expect_column_values_to_be_in_set'
    WHEN 'distinct_in_set' THEN 'expect_column_distinct_values_to_be_in_set'
    WHEN 'range' THEN 'expect_column_values_to_be_between'
    WHEN 'length' THEN 'expect_column_value_lengths_to_equal'
    WHEN 'unique' THEN 'expect_compound_columns_to_be_unique' END"""

_FAILED = _sql(
    ", "
    + _suite("silver")
    + ", "
    + _samples("silver", _ROW_RULES)
    + f"""
SELECT {_EXPECTATION} AS expectation, r."column",
  CASE WHEN kind = 'distinct_in_set' THEN CAST(0 AS BIGINT) ELSE unexpected_count END AS unexpected_count,
  CASE WHEN kind = 'distinct_in_set' THEN CAST(0 AS DOUBLE) ELSE unexpected_percent END AS unexpected_percent,
  coalesce((SELECT string_agg(coalesce(value, 'NULL'), ';' ORDER BY place) FROM samples s WHERE s.rule = r.rule), '')
    AS partial_unexpected_list
FROM results r WHERE NOT success"""
)

_VERDICT = (
    ", "
    + _suite("silver")
    + ", "
    + _finish([_row_result("silver", rule) for rule in _CONDITIONAL]).replace("results AS", "conditional AS", 1)
    + """, verdict AS (SELECT (SELECT bool_and(success) FROM results) AS validation_success,
    (SELECT bool_and(success) FROM conditional) AS conditional_rules_success) """
)


def _field_values() -> dict[str, str]:
    names = {
        "cond:transfer_purchase_pattern": "transfer_purchase_pattern_none_rule",
        "cond:transfer_age_group": "transfer_age_group_none_rule",
        "cond:high_risk": "high_risk_score_range_rule",
        "cond:moderate_risk": "moderate_risk_score_range_rule",
        "cond:low_risk": "low_risk_score_range_rule",
        "cond:region_domain": "location_region_domain_rule",
    }
    fields = {
        "execution_timestamp_utc": "'2024-02-01T00:00:00'",
        "total_records": "(SELECT count(*) FROM silver)",
        "validation_success": "(SELECT validation_success FROM verdict)",
        "conditional_rules_success": "(SELECT conditional_rules_success FROM verdict)",
        "overall_success": "(SELECT validation_success AND conditional_rules_success FROM verdict)",
        "total_expectations": "(SELECT count(*) FROM results)",
        "successful_expectations": "(SELECT count(*) FROM results WHERE success)",
        "failed_expectations_count": "(SELECT count(*) FROM results WHERE NOT success)",
        "duplicate_count": f"(SELECT count(*) FROM (SELECT 1 FROM silver GROUP BY {_KEY} HAVING count(*) > 1))",
    }
    for rule, name in names.items():
        fields[f"conditional_failures.{name}.invalid_count"] = (
            f"(SELECT unexpected_count FROM conditional WHERE rule = '{rule}')"
        )
    return fields


def _rows_of(fields: dict[str, str], name: str) -> str:
    return " UNION ALL ".join(f"SELECT '{f}' AS {name}, CAST({e} AS VARCHAR) AS value" for f, e in fields.items())


def _leaves() -> str:
    fields = _field_values()
    for column, domain in (("anomaly", S.ANOMALY_LEVELS), ("location_region", S.LOCATION_REGIONS)):
        at = f"{column}_distribution"
        listed = ", ".join(f"'{value}'" for value in domain)
        blank = rf"regexp_full_match({column}, '\s*')"
        for value in domain:
            fields[f"{at}.{value}"] = f"(SELECT count(*) FROM silver WHERE {column} = '{value}')"
        fields[f"{at}.blank"] = f"(SELECT count(*) FROM silver WHERE {blank})"
        fields[f"{at}.null"] = f"(SELECT count(*) FROM silver WHERE {column} IS NULL)"
        others = f"FROM silver WHERE {column} NOT IN ({listed}) AND NOT {blank}"
        fields[f"{at}.outside_domain.records"] = f"(SELECT count(*) {others})"
        fields[f"{at}.outside_domain.distinct_values"] = f"(SELECT count(DISTINCT {column}) {others})"
    for i, region in enumerate(S.LOCATION_REGIONS):
        fields[f"allowed_location_regions[{i}]"] = f"'{region}'"
    sampled = " UNION ALL ".join(
        f"SELECT 'conditional_failures.{name}.sample_values[' || (place - 1) || ']', coalesce(value, 'NULL') FROM samples WHERE rule = '{rule}'"
        for rule, name in {
            "cond:transfer_purchase_pattern": "transfer_purchase_pattern_none_rule",
            "cond:transfer_age_group": "transfer_age_group_none_rule",
            "cond:region_domain": "location_region_domain_rule",
        }.items()
    )
    failed = f"""failed AS (SELECT concat_ws('.', 'failed_expectations', {_EXPECTATION}, "column") AS path, rule,
      CASE WHEN kind = 'distinct_in_set' THEN 0 ELSE unexpected_count END AS n,
      CASE WHEN kind = 'distinct_in_set' THEN 0 ELSE unexpected_percent END AS share FROM results WHERE NOT success)"""
    lists = """SELECT path || '.unexpected_count', CAST(n AS VARCHAR) FROM failed
      UNION ALL SELECT path || '.unexpected_percent', CAST(CAST(round(share, 6) AS DECIMAL(20,6)) AS VARCHAR) FROM failed
      UNION ALL SELECT path || '[' || (place - 1) || ']', coalesce(value, 'NULL') FROM failed JOIN samples USING (rule)"""
    samples = _samples("silver", [*_ROW_RULES, *_CONDITIONAL])
    head = _VERDICT.rstrip() + ", " + samples + ", " + failed + " "
    return _sql(head + _rows_of(fields, "path") + " UNION ALL " + sampled + " UNION ALL " + lists)


def _fields() -> str:
    fields = _field_values()
    for level in S.ANOMALY_LEVELS:
        fields[f"anomaly_distribution.{level}"] = f"(SELECT count(*) FROM silver WHERE anomaly = '{level}')"
    for region in ("Africa", "Asia", "North America"):
        fields[f"location_region_distribution.{region}"] = (
            f"(SELECT count(*) FROM silver WHERE location_region = '{region}')"
        )
    fields["location_region_distribution.outside_domain.records"] = (
        f"(SELECT count(*) FROM silver WHERE location_region NOT IN {_REGION_LIST} AND trim(location_region) <> '')"
    )
    return _sql(_VERDICT + _rows_of(fields, "field"))


def _drift(rules: str) -> str:
    """The checks that a stored Silver of that shape fails, whatever its rows."""
    return f"""SELECT expectation, CAST(col AS VARCHAR) AS "column" FROM (VALUES {rules}) AS t(expectation, col)"""


_MESSAGE = "name || ' is currently in space flying on the ' || craft || '! Hello! :)'"

ORACLE: dict[str, str] = {
    # A CSV file cannot tell an empty field from a missing one, and Spark reads both as NULL.
    "raw_scan": _sql(f"""SELECT {", ".join(f'nullif("{c}", {chr(39) * 2}) AS "{c}"' for c in S.RAW_COLUMNS)} FROM raw"""),
    "silver_normalise": _sql("SELECT * FROM normalised"),
    "parse_decimal_comma": _sql(
        f"""SELECT trim(amount) AS amount_text, {_decimal("trim(amount)", "DECIMAL(18,2)")} AS amount,
        trim(risk_score) AS risk_text, {_decimal("trim(risk_score)", "DECIMAL(5,2)")} AS risk_score FROM raw"""
    ),
    "parse_int_lenient": _sql(
        f"""SELECT trim(login_frequency) AS login_text, {_whole("trim(login_frequency)", "INTEGER")} AS login_frequency,
        trim(session_duration) AS session_text, {_whole("trim(session_duration)", "INTEGER")} AS session_duration
        FROM raw"""
    ),
    "parse_epoch": _sql(
        f"""SELECT trim("timestamp") AS epoch_text, {_whole('trim("timestamp")', "BIGINT")} AS epoch_seconds,
        {_epoch('trim("timestamp")')} AS "timestamp" FROM raw"""
    ),
    "silver_typed": _sql("SELECT * FROM typed_all"),
    "silver_dedup": _sql("SELECT * FROM typed"),
    "silver_valid": _sql("SELECT * FROM silver"),
    "silver_rejects": _sql("""
SELECT * FROM (SELECT *, concat_ws(',',
  CASE WHEN "timestamp" IS NULL THEN 'timestamp' END,
  CASE WHEN sending_address IS NULL THEN 'sending_address' END,
  CASE WHEN receiving_address IS NULL THEN 'receiving_address' END,
  CASE WHEN amount IS NULL OR amount < 0 THEN 'amount' END,
  CASE WHEN transaction_type IS NULL OR transaction_type NOT IN ('purchase','sale','transfer') THEN 'transaction_type' END,
  CASE WHEN location_region IS NULL THEN 'location_region' END,
  CASE WHEN risk_score IS NULL OR risk_score NOT BETWEEN 0 AND 100 THEN 'risk_score' END,
  CASE WHEN login_frequency IS NULL OR login_frequency < 0 THEN 'login_frequency' END,
  CASE WHEN session_duration IS NULL OR session_duration <= 0 THEN 'session_duration' END,
  CASE WHEN anomaly IS NULL OR anomaly NOT IN ('low_risk','moderate_risk','high_risk') THEN 'anomaly' END
  ) AS reject_reason FROM typed) WHERE reject_reason <> ''"""),
    "silver_scan": _sql("SELECT * FROM tx_valid"),
    "silver_roundtrip": _sql("SELECT * FROM silver"),
    "layer_counts": _sql(
        "SELECT 'bronze' AS layer, count(*) AS records FROM raw UNION ALL SELECT 'silver', count(*) FROM silver"
    ),
    "region_risk": _risk("tx_valid"),
    "region_risk_raw": _risk("silver"),
    "sales_only": _sql("SELECT * FROM silver WHERE transaction_type = 'sale'"),
    "latest_sale_per_address": _sql("SELECT * FROM " + _latest("silver", _COLS, _TIES)),
    "top_receiving_sales": _top3("tx_valid"),
    "top_receiving_sales_raw": _top3("silver"),
    "gold_fraud_credit": _sql("SELECT * FROM silver"),
    "catalog_gold_tables": _sql("""
SELECT 'fraud_credit' AS table_name, count(*) AS records FROM tx_valid
UNION ALL SELECT 'location_region_risk_score', count(DISTINCT location_region) FROM tx_valid
UNION ALL SELECT 'top_receiving_address_sales',
  least(3, count(DISTINCT receiving_address) FILTER (WHERE transaction_type = 'sale')) FROM tx_valid"""),
    "browse_gold": _sql(f"""SELECT * FROM tx_valid ORDER BY
{", ".join(f'"{c}" ASC NULLS FIRST' for c in S.SILVER.names if c != "ingestion_timestamp")} LIMIT 50"""),
    "lake_run_summary": _sql(
        ", "
        + _suite("silver")
        + f"""
SELECT 'bronze' AS layer, count(*) AS records FROM raw
UNION ALL SELECT 'silver', count(*) FROM silver
UNION ALL SELECT 'quality_failed_expectations', count(*) FROM results WHERE NOT success
UNION ALL SELECT 'quality_duplicate_keys', count(*)
  FROM (SELECT 1 FROM silver GROUP BY {_KEY} HAVING count(*) > 1)
UNION ALL SELECT 'fraud_credit', count(*) FROM silver
UNION ALL SELECT 'location_region_risk_score', count(DISTINCT location_region) FROM silver
UNION ALL SELECT 'top_receiving_address_sales',
  least(3, count(DISTINCT receiving_address) FILTER (WHERE transaction_type = 'sale')) FROM silver"""
    ),
    "dist_anomaly": _sql("SELECT anomaly, count(*) AS records FROM tx GROUP BY anomaly"),
    "dist_region": _sql("SELECT location_region, count(*) AS records FROM typed GROUP BY location_region"),
    "duplicate_keys": _sql(f"""
SELECT count(*) AS duplicate_count, CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT count(*) AS n FROM typed GROUP BY {_KEY} HAVING count(*) > 1)"""),
    "show_gold": """SELECT * FROM (VALUES ('fraud_credit'), ('location_region_risk_score'),
  ('top_receiving_address_sales')) AS t(table_name)""",
    "gold_region_values": _risk("tx_valid"),
    "gold_top_values": _top3("tx_valid"),
    "load_time": _sql("SELECT count(*) AS records, CAST(count(*) > 0 AS BIGINT) AS load_times, CAST(0 AS BIGINT) AS missing FROM silver"),
    "landing_accounts": """
SELECT 'bronze' AS layer, value, count(*) AS records
FROM (SELECT CASE WHEN event_id % 10 = 2 THEN 'y' || chr(10) || 'z' ELSE 'y' END AS value FROM events WHERE event_id % 10 NOT IN (0, 1))
GROUP BY value
UNION ALL SELECT 'rejects', CASE event_id % 10 WHEN 0 THEN event_id || ',x,y,z' ELSE event_id || ',x' END, 1
FROM events WHERE event_id % 10 IN (0, 1)""",
    "dq_schema_drift_extra": _drift("('expect_table_columns_to_match_set', NULL)"),
    "dq_schema_drift_missing": _drift(
        "('expect_table_columns_to_match_set', NULL), ('expect_column_values_to_not_be_null', 'age_group'), "
        "('expect_column_values_to_be_in_set', 'age_group')"
    ),
    "dq_schema_drift_type": _drift(
        "('expect_column_values_to_be_of_type', 'amount'), ('expect_column_values_to_be_of_type', 'login_frequency')"
    ),
    "dq_schema_drift_mixed": _drift(
        "('expect_table_columns_to_match_set', NULL), ('expect_column_values_to_be_of_type', 'session_duration')"
    ),
    "dq_normalise": _sql("SELECT * FROM tx"),
    "dq_schema_checks": _sql(", " + _finish(_schema_results("tx", False)) + " SELECT * FROM results"),
    "dq_not_null": _results("typed", _NOT_NULL),
    "dq_in_set": _results("typed", _IN_SET),
    "dq_range": _results("typed", _RANGE),
    "dq_length": _results("typed", _LENGTH),
    "dq_regex": _results("typed", [*_BLANK, *_REGEX]),
    "dq_distinct_in_set": _sql(", " + _finish([_distinct_result("typed")]) + " SELECT * FROM results"),
    "dq_compound_unique": _sql(", " + _finish([_unique_result("typed")]) + " SELECT * FROM results"),
    "dq_conditional_rules": _results("typed", _CONDITIONAL),
    "dq_suite": _sql(", " + _suite("typed") + " SELECT * FROM results"),
    "dq_suite_silver": _sql(", " + _suite("silver") + " SELECT * FROM results"),
    "dq_failed": _FAILED,
    "dq_rule_samples": _sql(
        ", " + _samples("typed", [*_ROW_RULES, *_CONDITIONAL]) + " SELECT rule, value, n FROM samples"
    ),
    "dq_verdict": _sql(
        _VERDICT + "SELECT *, validation_success AND conditional_rules_success AS overall_success FROM verdict"
    ),
    "dq_report_fields": _fields(),
    "dq_report_json": _leaves(),
    "flatten_records": f"""
WITH payloads AS (SELECT json('{{"number":' || CAST(event_id AS VARCHAR) || ',"people":[{{"craft":"' || event_type
    || '","name":"user ' || CAST(user_id AS VARCHAR) || '"}},{{"craft":"k","name":"'
    || regexp_extract(props, '[0-9]+', 0) || '"}}]}}') AS payload FROM events),
people AS (SELECT CAST(payload->>'$.number' AS INTEGER) AS number,
    unnest(CAST(json_extract(payload, '$.people[*]') AS JSON[])) AS person FROM payloads),
named AS (SELECT number, person->>'$.craft' AS craft, person->>'$.name' AS name FROM people)
SELECT number, craft, name, {_MESSAGE} AS message FROM named""",
}
