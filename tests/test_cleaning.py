import pytest
from conftest import SF, T0, executed_plan, raw_row
from pyspark.errors import AnalysisException

from assaylake import schemas as S
from assaylake.operators import cleaning
from assaylake.registry import transactions as tx


def test_columns_are_taken_by_name(raw):
    rows = raw(raw_row()).select(*reversed(S.RAW_COLUMNS))
    assert cleaning.normalise_raw(rows).columns == list(S.RAW_COLUMNS)
    with pytest.raises(AnalysisException):
        cleaning.normalise_raw(rows.drop("anomaly"))


def test_silver_types(raw):
    silver = cleaning.clean(raw(raw_row()), T0)
    types = {f.name: f.dataType for f in silver.schema}
    assert types == {f.name: f.dataType for f in S.SILVER}
    assert silver.first()["ingestion_timestamp"] == T0


def test_load_time_is_the_same_for_all_rows(raw):
    rows = cleaning.clean(raw(raw_row(), raw_row(amount="3"), raw_row(amount="4")))
    assert rows.select("ingestion_timestamp").distinct().count() == 1


def test_copies_are_found_after_normalising(raw):
    rows = raw(raw_row(), raw_row(location_region=" ASIA "), raw_row(amount="10,0"), raw_row(session_duration="77"))
    assert sorted(r["session_duration"] for r in cleaning.type_raw(rows).collect()) == [40, 77]


@pytest.mark.parametrize(
    "change, kept",
    [
        ({"timestamp": "bad"}, False),
        ({"sending_address": None}, False),
        ({"receiving_address": None}, False),
        ({"amount": "-0.01"}, False),
        ({"amount": "0"}, True),
        ({"amount": "n/a"}, False),
        ({"transaction_type": "scam"}, False),
        ({"transaction_type": " TRANSFER"}, True),
        ({"location_region": None}, False),
        ({"location_region": "   "}, True),
        ({"location_region": "\t"}, True),
        ({"risk_score": "100"}, True),
        ({"risk_score": "100,01"}, False),
        ({"risk_score": "1234"}, False),
        ({"login_frequency": "-1"}, False),
        ({"login_frequency": "0.9"}, True),
        ({"session_duration": "0.9"}, False),
        ({"session_duration": "1"}, True),
        ({"anomaly": "unknown"}, False),
        ({"anomaly": None}, False),
        ({"ip_prefix": None, "purchase_pattern": None, "age_group": "x"}, True),
    ],
)
def test_validity(raw, change, kept):
    typed = cleaning.type_raw(raw(raw_row(**change)))
    assert cleaning.keep_valid(typed).count() == int(kept)
    rejected = cleaning.rejects(typed).collect()
    assert [r["reject_reason"] for r in rejected] == ([] if kept else [next(iter(change))])


def test_valid_and_rejected_rows_make_up_all_rows(spark):
    typed = tx.raw_typed(spark, SF)
    valid, rejected = cleaning.keep_valid(typed), cleaning.rejects(typed).drop("reject_reason")
    assert valid.intersect(rejected).count() == 0
    assert valid.unionByName(rejected).exceptAll(typed).count() == 0
    assert valid.count() + rejected.count() == typed.count()


def test_normalising_twice_changes_nothing(spark):
    typed = tx.raw_typed(spark, SF)
    again = cleaning.normalise_again(typed)
    assert again.columns == typed.columns
    assert again.exceptAll(typed).count() == 0
    assert typed.exceptAll(again).count() == 0


def test_cleaning_filters_before_its_only_shuffle(spark, raw):
    rows = cleaning.clean(raw(raw_row()), T0)
    rows.collect()
    plan = executed_plan(rows)
    assert plan.count("Exchange") == 1
    assert plan.index("Exchange") < plan.index("Filter")
    assert "Python" not in plan


def test_valid_rows_are_parsed_once(spark, raw):
    plan = executed_plan(cleaning.clean(raw(raw_row()), T0))
    once = executed_plan(cleaning.parse(raw(raw_row())))
    assert plan.count("regexp_extract") == once.count("regexp_extract")
