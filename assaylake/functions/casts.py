"""Casts of dirty text: bad text or overflow gives NULL and never stops a job.

A plain ``cast`` raises on bad text under ANSI mode, the default since Spark 4, hence ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Sign and digits before an optional decimal point. Spaces and control characters may surround them.
_WHOLE_PART = r"^[\x00-\x20]*([+-]?[0-9]+)(\.[0-9]*)?[\x00-\x20]*$"
_FRACTION_ONLY = r"^[\x00-\x20]*[+-]?\.[0-9]*[\x00-\x20]*$"


def whole_number(text: Column, to: T.DataType) -> Column:
    """Integer text, with any fraction cut off: ``12.7`` gives 12 and ``-3.9`` gives -3.

    The pattern lets only digits reach ``try_cast``: a failing cast raises and drops an exception
    inside the task, which costs many times the match on a column with much bad text.
    """
    digits = F.nullif(F.regexp_extract(text, _WHOLE_PART, 1), F.lit(""))
    return F.coalesce(digits.try_cast(to), F.when(text.rlike(_FRACTION_ONLY), F.lit(0).cast(to)))


def decimal_number(text: Column, to: T.DecimalType) -> Column:
    """Decimal text with a comma or a dot before the fraction, rounded half up."""
    return F.replace(text, F.lit(","), F.lit(".")).try_cast(to)


def epoch_seconds(text: Column) -> Column:
    """Seconds since 1970 as text. Numbers beyond the timestamp range give NULL."""
    micros = F.try_multiply(whole_number(text, T.LongType()), F.lit(1_000_000))
    return F.timestamp_micros(micros)
