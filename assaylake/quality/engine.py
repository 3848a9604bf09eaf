"""Runs the suite: two passes over the table, whatever the number of rules.

Pass one turns each row into *facts*: its anomaly level, its region, and one fact for each rule it
breaks, with the value that broke it. Facts are counted by (fact, value) in each task before they
are shuffled, so a hot value sends one row per task and a clean table shuffles next to nothing.
Row totals, rule counts, distributions and samples all come from this one count.

Pass two counts rows by transaction key, again combined in each task first.

Both passes end in *findings*, one row for each fact name, of which there are a few dozen however
large the table is:

    fact, n (rows), n_values (distinct values), n_outside (distinct regions outside the domain),
    inside (rows of each value of a domain, and of blank and NULL), outside (rows and distinct values of all
    others), top (its most frequent values with their counts, at most ``TOP_VALUES``)

Expressions are SQL text: one parse builds what would take hundreds of calls from Python to the JVM.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaylake import schemas as S
from assaylake.operators.profile import key_counts, repeated_keys
from assaylake.quality import rules as R

ANOMALIES = "values:anomaly"
REGIONS = "values:location_region"
ROWS = "rows"
KEY_SAMPLES = 10

# Values kept for each fact: those of the longest sample list.
TOP_VALUES = 20

# The columns whose distributions are reported, with their facts and domains.
DISTRIBUTIONS = {
    "anomaly": (ANOMALIES, S.ANOMALY_LEVELS),
    "location_region": (REGIONS, S.LOCATION_REGIONS),
}

_TOP = "array<struct<value:string,n:bigint>>"
_OUTSIDE = "struct<records:bigint,distinct_values:bigint>"
_FINDING = {
    "fact": "string",
    "n": "bigint",
    "n_values": "bigint",
    "n_outside": "bigint",
    "inside": _TOP,
    "outside": _OUTSIDE,
    "top": _TOP,
}
_FOREIGN_REGION = "NOT IN " + R.text_list(S.LOCATION_REGIONS)


# Values of the distributions that are shown by name: those of the domains, blank ones and NULL. There are a
# few dozen, so that they fit in one row whatever the table holds.
_BLANK_VALUE = f"value RLIKE {R.literal(R.BLANK)}"
_IN_DOMAIN = "(CASE fact {} ELSE false END)".format(
    " ".join(
        f"WHEN '{fact}' THEN value IS NULL OR {_BLANK_VALUE} OR value IN {R.text_list(domain)}"
        for fact, domain in DISTRIBUTIONS.values()
    )
)
_SHOWN = f"CASE WHEN value IS NULL THEN 'null' WHEN {_BLANK_VALUE} THEN 'blank' ELSE value END"


def _as_findings(found: DataFrame) -> DataFrame:
    """Fill the columns a finding lacks with NULL, for a union by position."""
    return found.selectExpr(
        *(name if name in found.columns else f"CAST(NULL AS {kind}) AS {name}" for name, kind in _FINDING.items())
    )


def _fact(name: str, column: str) -> str:
    return f"named_struct('fact', {R.literal(name)}, 'value', CAST(`{column}` AS STRING))"


def facts(rows: DataFrame, row_rules: Iterable[R.RowRule]) -> DataFrame:
    """(fact, value, n): how many rows state each fact. Every row states one without a value, which counts
    the rows. Rules and distributions of absent columns state none."""
    stated = [f"named_struct('fact', '{ROWS}', 'value', CAST(NULL AS STRING))"]
    stated += [_fact(fact, column) for column, (fact, _) in DISTRIBUTIONS.items() if column in rows.columns]
    stated += [
        f"CASE WHEN {rule.breaks} THEN {_fact(rule.name, rule.column)} END"
        for rule in row_rules
        if rule.fits(rows.columns)
    ]
    return (
        rows.selectExpr(f"explode(array({', '.join(stated)})) AS stated")
        .filter("stated IS NOT NULL")
        .selectExpr("stated.fact AS fact", "stated.value AS value")
        .groupBy("fact", "value")
        .agg(F.expr("count(1) AS n"))
    )


def summarise(counted: DataFrame) -> DataFrame:
    """Findings from facts; each fact has one row of totals and one of top values, which ``gather``
    merges.

    Totals and ranks read the same counts, and neither filters or joins them by fact: Spark then
    runs the count once and reuses its shuffle, where a filter would be pushed down to a second scan.
    Before ranks are shuffled by fact, each task keeps only its own ``TOP_VALUES`` of a fact, so a
    rule broken by a billion distinct values does not fill the task that ranks it.
    """
    totals = counted.groupBy("fact").agg(
        F.expr("sum(n) AS n"),
        F.expr("count(value) AS n_values"),
        F.expr(f"count_if(value {_FOREIGN_REGION}) AS n_outside"),
        F.expr(f"collect_list(CASE WHEN {_IN_DOMAIN} THEN struct({_SHOWN} AS value, n) END) AS inside"),
        F.expr(
            f"struct(coalesce(sum(CASE WHEN NOT {_IN_DOMAIN} THEN n END), 0) AS records, "
            f"count_if(NOT {_IN_DOMAIN}) AS distinct_values) AS outside"
        ),
    )
    tops = (
        counted.selectExpr("*", "row_number() OVER (PARTITION BY fact ORDER BY n DESC, value ASC) AS place")
        .filter(f"place <= {TOP_VALUES}")
        .groupBy("fact")
        .agg(F.expr(_in_order("place") + " AS top"))
    )
    return _as_findings(totals).unionByName(_as_findings(tops))


def _in_order(place: str) -> str:
    """SQL that collects (value, n) by place."""
    ordered = f"sort_array(collect_list(struct({place} AS place, value, n)))"
    return f"transform({ordered}, x -> struct(x.value AS value, x.n AS n))"


def row_findings(rows: DataFrame) -> DataFrame:
    """Pass one: all row rules, with values."""
    return summarise(all_facts(rows))


def all_facts(rows: DataFrame) -> DataFrame:
    """The facts of the whole suite, counted."""
    return facts(rows, (*R.ROW_RULES, *R.CONDITIONAL_RULES))


def distribution(counted: DataFrame, column: str) -> DataFrame:
    """(value of the column, records) of every value, from facts."""
    fact, _ = DISTRIBUTIONS[column]
    return counted.where(F.col("fact") == fact).select(F.col("value").alias(column), F.col("n").alias("records"))


def row_counts(rows: DataFrame, row_rules: Iterable[R.RowRule]) -> DataFrame:
    """Findings without values: one aggregation to a single row, which needs no shuffle of facts.

    Cheaper than ``row_findings`` when only some rules are asked for and no samples. The NULLs of
    every tested column are counted as well, as they decide how many values a rule tested.
    """
    wanted = {rule.name: rule for rule in row_rules if rule.fits(rows.columns)}
    for rule in list(wanted.values()):
        wanted.setdefault(f"not_null:{rule.column}", R.not_null(rule.column))
    one_row = rows.selectExpr(
        f"count(1) AS {ROWS}", *(f"count_if({rule.breaks}) AS `{name}`" for name, rule in wanted.items())
    )
    pairs = ", ".join(f"'{name}', `{name}`" for name in (ROWS, *wanted))
    return _as_findings(one_row.selectExpr(f"stack({len(wanted) + 1}, {pairs}) AS (fact, n)"))


def distinct_regions(rows: DataFrame) -> DataFrame:
    """Finding on the distinct regions alone."""
    regions = rows.groupBy("location_region").agg(F.expr("count(1) AS n"))
    return _as_findings(
        regions.selectExpr(
            f"'{REGIONS}' AS fact",
            "coalesce(sum(n), 0) AS n",
            "count(location_region) AS n_values",
            f"count_if(location_region {_FOREIGN_REGION}) AS n_outside",
        )
    )


def key_findings(rows: DataFrame, count_rows: bool = False) -> DataFrame:
    """Pass two: the rows in repeated transaction keys (``n``), the number of such keys
    (``n_values``) and the most repeated ones. NULLs are equal here, as in any grouping.

    Only repeated keys go on after the count. Their own small shuffle is there to be reused: counts
    and samples read it, instead of each finishing the count of all keys again.
    """
    key = ", ".join(f"coalesce(CAST(`{c}` AS STRING), 'NULL')" for c in S.TRANSACTION_KEY)
    repeated = (
        repeated_keys(rows).selectExpr(f"concat_ws('|', {key}) AS value", "copies AS n").repartition("value")
    )
    name = f"'{R.UNIQUE_KEY}' AS fact"
    counts = repeated.selectExpr(name, "n").groupBy("fact").agg(F.expr("sum(n) AS n"), F.expr("count(1) AS n_values"))
    top = (
        repeated.orderBy(F.expr("n DESC"), F.expr("value ASC"))
        .limit(KEY_SAMPLES)
        .selectExpr(name, f"{_in_order('-n')} AS top")
    )
    found = _as_findings(counts).unionByName(_as_findings(top))
    if not count_rows:
        return found
    # all rows, from the same count of keys, for a check without the first pass
    rows_of_keys = key_counts(rows).selectExpr(f"'{ROWS}' AS fact", "copies AS n").groupBy("fact").agg(F.expr("sum(n) AS n"))
    return found.unionByName(_as_findings(rows_of_keys))


def gather(*found: DataFrame) -> DataFrame:
    """All findings in one row: ``found``, a map by fact name. A few dozen entries by design."""
    union = found[0]
    for more in found[1:]:
        union = union.unionByName(more)
    parts = ("n", "n_values", "n_outside")
    lists = ("inside", "outside", "top")
    merged = union.groupBy("fact").agg(
        *(F.expr(f"max({part}) AS {part}") for part in parts),
        *(F.expr(f"first({part}, true) AS {part}") for part in lists),
    )
    return merged.selectExpr(
        f"map_from_entries(collect_list(struct(fact, struct({', '.join((*parts, *lists))})))) AS found"
    )


def found(fact: str, part: str) -> str:
    """SQL for a number of a finding; 0 where nothing stated the fact. ``fact`` is SQL as well."""
    return f"coalesce(try_element_at(found, {fact}).{part}, 0)"


# Rows of the table, from either kind of pass.
TOTAL_ROWS = found(f"'{ROWS}'", "n")


def _check(name: str, kind: str, column: str | None, samples: int = 0, held: bool | None = None) -> str:
    """A check as a constant. ``held`` is its outcome where no data has to be read for it."""
    column_text = "NULL" if column is None else f"'{column}'"
    held_text = "NULL" if held is None else str(held)
    return (
        f"named_struct('rule', '{name}', 'kind', '{kind}', 'column', CAST({column_text} AS STRING), "
        f"'samples', {samples}, 'held', CAST({held_text} AS BOOLEAN))"
    )


def row_checks(rules: Iterable[R.RowRule], columns: Sequence[str]) -> list[str]:
    """A check on an absent column fails and counts nothing."""
    return [
        _check(r.name, r.kind, r.column, r.samples, None if r.fits(columns) else False) for r in rules
    ]


def schema_checks(schemas: Sequence[T.StructType]) -> list[str]:
    """Checks on column names and types, which each schema of the stored files must pass. They read no values."""
    made = [_check(R.COLUMN_SET, "column_set", None, held=all(set(s.names) == set(R.EXPECTED_COLUMNS) for s in schemas))]
    for rule in R.TYPE_RULES:
        held = all(rule.column in s.names and isinstance(s[rule.column].dataType, rule.expected) for s in schemas)
        made.append(_check(rule.name, rule.kind, rule.column, held=held))
    return made


def distinct_check(columns: Sequence[str]) -> str:
    column = "location_region"
    return _check(R.DISTINCT_REGIONS, "distinct_in_set", column, held=None if column in columns else False)


def unique_check(columns: Sequence[str]) -> str:
    complete = set(S.TRANSACTION_KEY) <= set(columns)
    return _check(R.UNIQUE_KEY, "unique", None, KEY_SAMPLES, None if complete else False)


def suite_checks(schemas: Sequence[T.StructType], columns: Sequence[str]) -> list[str]:
    """The 35 checks of the suite. ``schemas`` are those of the stored files, ``columns`` those of the rows."""
    return [
        *schema_checks(schemas),
        *row_checks(R.ROW_RULES, columns),
        distinct_check(columns),
        unique_check(columns),
    ]


_TESTED = f"""CASE
    WHEN c.kind IN ('column_set', 'type') THEN {TOTAL_ROWS}
    WHEN c.held IS NOT NULL THEN 0
    WHEN c.kind = 'distinct_in_set' THEN {found(f"'{REGIONS}'", 'n_values')}
    WHEN c.kind IN ('not_null', 'unique') THEN {TOTAL_ROWS}
    ELSE {TOTAL_ROWS} - {found("concat('not_null:', c.column)", 'n')} END"""

_BROKEN = f"""CASE
    WHEN c.held IS NOT NULL THEN 0
    WHEN c.kind = 'distinct_in_set' THEN {found(f"'{REGIONS}'", 'n_outside')}
    ELSE {found('c.rule', 'n')} END"""


def judge(gathered: DataFrame, checks: Sequence[str], name: str = "suite") -> DataFrame:
    """Add the results of some checks to the gathered findings, as an array under ``name``.

    The checks are constants and one small expression judges each of them; one expression for each
    check would outgrow the size limit of generated code.
    """
    counted = (
        f"transform(array({', '.join(checks)}), c -> named_struct('check', c, 'tested', {_TESTED}, "
        f"'broken', {_BROKEN}))"
    )
    result = f"""named_struct(
        'rule', r.check.rule,
        'kind', r.check.kind,
        'column', r.check.column,
        'success', coalesce(r.check.held, r.broken = 0),
        'tested', r.tested,
        'unexpected_count', r.broken,
        'unexpected_percent',
            CASE WHEN r.tested > 0 THEN 100D * r.broken / r.tested ELSE 0D END,
        'samples', coalesce(
            slice(try_element_at(found, r.check.rule).top, 1, r.check.samples), CAST(array() AS {_TOP})))"""
    return gathered.selectExpr("*", f"transform({counted}, r -> {result}) AS {name}")


def result_rows(judged: DataFrame, name: str = "suite") -> DataFrame:
    """One row for each result, without samples."""
    return judged.selectExpr(f"inline({name})").drop("samples")


def all_findings(rows: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """Both passes, gathered in one row. ``counted`` are the table's facts, if they are there already."""
    first = row_findings(rows) if counted is None else summarise(counted)
    if set(S.TRANSACTION_KEY) <= set(rows.columns):
        return gather(first, key_findings(rows))
    return gather(first)


def run_suite(rows: DataFrame, counted: DataFrame | None = None, stored: Sequence[T.StructType] = ()) -> DataFrame:
    """Both passes and all checks: one row with ``found``, ``suite`` and ``conditional``. ``stored`` are the schemas
    that the checks on columns and types judge, if they aren't that of ``rows``."""
    judged = judge(all_findings(rows, counted), suite_checks(stored or [rows.schema], rows.columns))
    return judge(judged, row_checks(R.CONDITIONAL_RULES, rows.columns), "conditional")


def run_schema_checks(rows: DataFrame) -> DataFrame:
    return result_rows(judge(gather(row_counts(rows, ())), schema_checks([rows.schema])))


def run_distinct_check(rows: DataFrame) -> DataFrame:
    return result_rows(judge(gather(distinct_regions(rows)), [distinct_check(rows.columns)]))


def run_unique_check(rows: DataFrame) -> DataFrame:
    complete = set(S.TRANSACTION_KEY) <= set(rows.columns)
    findings = gather(key_findings(rows, count_rows=True) if complete else row_counts(rows, ()))
    return result_rows(judge(findings, [unique_check(rows.columns)]))


def run_row_rules(rows: DataFrame, rules: Sequence[R.RowRule]) -> DataFrame:
    """Results of some row rules only, in one pass without samples."""
    return result_rows(judge(gather(row_counts(rows, rules)), row_checks(rules, rows.columns)))
