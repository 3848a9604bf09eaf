from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaylake import schemas as S
from assaylake.functions import casts, text

CASES = [
    # text, int, long, decimal(18,2), decimal(5,2)
    ("12", 12, 12, "12.00", "12.00"),
    ("12.7", 12, 12, "12.70", "12.70"),
    ("-3.9", -3, -3, "-3.90", "-3.90"),
    (" 5 ", 5, 5, "5.00", "5.00"),
    ("12,5", None, None, "12.50", "12.50"),
    ("1.005", 1, 1, "1.01", "1.01"),
    ("999.995", 999, 999, "1000.00", None),
    ("99999999999", None, 99999999999, "99999999999.00", None),
    ("1656789012.0", 1656789012, 1656789012, "1656789012.00", None),
    ("0.99999999999", 0, 0, "1.00", "1.00"),
    ("1e3", None, None, "1000.00", None),
    (".5", 0, 0, "0.50", "0.50"),
    ("+7", 7, 7, "7.00", "7.00"),
    ("\t8\n", 8, 8, "8.00", "8.00"),
    ("1,234.5", None, None, None, None),
    ("abc", None, None, None, None),
    ("", None, None, None, None),
    ("-", None, None, None, None),
    ("NaN", None, None, None, None),
    (None, None, None, None, None),
]


def test_lenient_casts(spark):
    x = F.col("x")
    rows = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, x string")
    found = rows.orderBy("i").select(
        casts.whole_number(x, T.IntegerType()),
        casts.whole_number(x, T.LongType()),
        casts.decimal_number(x, S.AMOUNT),
        casts.decimal_number(x, S.RISK_SCORE),
    )
    for case, row in zip(CASES, found.collect(), strict=True):
        assert tuple(row) == (*case[1:3], *(None if d is None else Decimal(d) for d in case[3:])), case


@pytest.mark.parametrize(
    "given_text, expected",
    [
        ("1704067200", "2024-01-01 00:00:00"),
        (" 1704067200.9 ", "2024-01-01 00:00:00"),
        ("-1", "1969-12-31 23:59:59"),
        ("9223372036855", None),
        ("99999999999999999999", None),
        ("bad", None),
    ],
)
def test_epoch_seconds(spark, given_text, expected):
    row = spark.createDataFrame([(given_text,)], "x string")
    assert row.select(casts.epoch_seconds(F.col("x")).cast("string")).first()[0] == expected


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="0123456789.,+-eE x\t", max_size=14), min_size=50, max_size=80))
def test_casts_agree_with_the_lenient_mode_of_spark(spark, texts):
    """With ANSI mode off a plain cast is the lenient one; ours must agree with it in ANSI mode."""
    x = F.col("x")
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, x string").coalesce(1)
    ours = rows.select("i", casts.whole_number(x, T.IntegerType()), casts.decimal_number(x, S.AMOUNT)).collect()
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        plain = rows.select("i", x.cast("int"), F.regexp_replace("x", ",", ".").cast("decimal(18,2)")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert [tuple(r) for r in ours] == [tuple(r) for r in plain]


def test_text_functions(spark):
    row = spark.createDataFrame([("  NORTH america ", "\tx-Y ")], "a string, b string")
    found = row.select(text.title("a"), text.code("a"), text.trimmed("a"), text.title("b"), text.trimmed("b")).first()
    assert tuple(found) == ("North America", "north america", "NORTH america", "\tx-y", "\tx-Y")
