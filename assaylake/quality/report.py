"""Verdicts, failures, samples and the one-line JSON report.

Everything here reads the single row that ``engine.run_suite`` makes, so nothing grows with the table.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame

from assaylake import schemas as S
from assaylake.quality import engine as E
from assaylake.quality import rules as R

# ---- Fixed values: the names the report uses for checks and conditional rules ----
EXPECTATIONS = {
    "column_set": "expect_table_columns_to_match_set",
    "type": "expect_column_values_to_be_of_type",
    "not_null": "expect_column_values_to_not_be_null",
    "not_regex": "expect_column_values_to_not_match_regex",
    "regex": "expect_column_values_to_match_regex",
    "in_set": "expect_column_values_to_be_in_set",
    "distinct_in_set": "expect_column_distinct_values_to_be_in_set",
    "range": "expect_column_values_to_be_between",
    "length": "expect_column_value_lengths_to_equal",
    "unique": "expect_compound_columns_to_be_unique",
}
CONDITIONAL_NAMES = {
    "cond:transfer_purchase_pattern": "transfer_purchase_pattern_none_rule",
    "cond:transfer_age_group": "transfer_age_group_none_rule",
    "cond:high_risk": "high_risk_score_range_rule",
    "cond:moderate_risk": "moderate_risk_score_range_rule",
    "cond:low_risk": "low_risk_score_range_rule",
    "cond:region_domain": "location_region_domain_rule",
}
SAMPLED_CONDITIONALS = ("cond:transfer_purchase_pattern", "cond:transfer_age_group", "cond:region_domain")

# Kinds that judge the table as a whole; the failed list gives them neither a count nor samples.
_WHOLE_TABLE = ("column_set", "type", "distinct_in_set")


def rule_samples(judged: DataFrame) -> DataFrame:
    """(rule, value, n): the most frequent values that broke each rule."""
    return judged.selectExpr("explode(concat(suite, conditional)) AS result").selectExpr(
        "result.rule AS rule", "inline(result.samples)"
    )


def _all_pass(results: str) -> str:
    return f"forall({results}, r -> r.success)"


_VERDICTS = {
    "validation_success": _all_pass("suite"),
    "conditional_rules_success": _all_pass("conditional"),
    "overall_success": f"{_all_pass('suite')} AND {_all_pass('conditional')}",
}


def verdict(judged: DataFrame) -> DataFrame:
    """One row: did the suite pass, did the conditional rules, did both."""
    return judged.selectExpr(*(f"{test} AS {name}" for name, test in _VERDICTS.items()))


def _failures() -> str:
    """Failed checks of the suite, in suite order."""
    names = ", ".join(f"'{text}'" for pair in EXPECTATIONS.items() for text in pair)
    whole_table = f"r.kind IN {R.text_list(_WHOLE_TABLE)}"
    return f"""transform(filter(suite, r -> NOT r.success), r -> named_struct(
        'expectation', map({names})[r.kind],
        'column', r.column,
        'unexpected_count', if({whole_table}, 0L, r.unexpected_count),
        'unexpected_percent', if({whole_table}, 0D, r.unexpected_percent),
        'partial_unexpected_list', transform(r.samples, x -> x.value)))"""


def failed_checks(judged: DataFrame) -> DataFrame:
    """One row for each failed check of the suite, with its most frequent offending values."""
    return judged.selectExpr(f"inline({_failures()})")


def _conditional_failures() -> str:
    made = []
    for rule, name in CONDITIONAL_NAMES.items():
        result = f"filter(conditional, r -> r.rule = '{rule}')[0]"
        parts = f"'invalid_count', {result}.unexpected_count"
        if rule in SAMPLED_CONDITIONALS:
            parts += f", 'sample_values', transform({result}.samples, x -> x.value)"
        made.append(f"'{name}', named_struct({parts})")
    return f"named_struct({', '.join(made)})"


def _distribution(column: str) -> str:
    """Rows of each value of the domain, of blank values and of NULL, and of all other values together; the
    same fields for a table of any size. Their counts add up to the table's rows."""
    fact, domain = E.DISTRIBUTIONS[column]
    finding = f"try_element_at(found, '{fact}')"

    def rows(shown: str) -> str:
        return f"aggregate(coalesce({finding}.inside, array()), 0L, (t, x) -> t + if(x.value = {R.literal(shown)}, x.n, 0L))"

    named = ", ".join(f"{R.literal(value)}, {rows(value)}" for value in (*domain, "blank", "null"))
    outside = ", ".join(f"'{part}', coalesce({finding}.outside.{part}, 0L)" for part in ("records", "distinct_values"))
    return f"named_struct({named}, 'outside_domain', named_struct({outside}))"


def report(judged: DataFrame, run_at: datetime | None = None) -> DataFrame:
    """One row, one column ``metrics_json``: the whole quality report as one line of JSON."""
    run_at = run_at or datetime.now(timezone.utc)
    parts = {
        "execution_timestamp_utc": f"'{run_at.isoformat()}'",
        "total_records": E.TOTAL_ROWS,
        **_VERDICTS,
        "total_expectations": "size(suite)",
        "successful_expectations": "size(filter(suite, r -> r.success))",
        "failed_expectations_count": "size(filter(suite, r -> NOT r.success))",
        "failed_expectations": _failures(),
        "conditional_failures": _conditional_failures(),
        "duplicate_count": E.found(f"'{R.UNIQUE_KEY}'", "n_values"),
        "anomaly_distribution": _distribution("anomaly"),
        "location_region_distribution": _distribution("location_region"),
        "allowed_location_regions": f"array{R.text_list(S.LOCATION_REGIONS)}",
    }
    body = ", ".join(f"'{name}', {part}" for name, part in parts.items())
    return judged.selectExpr(f"to_json(named_struct({body}), map('ignoreNullFields', 'false')) AS metrics_json")
