"""Text clean-up. All three trim spaces (U+0020) only, so a tab stays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trimmed(name: str) -> Column:
    return F.trim(F.col(name))


def code(name: str) -> Column:
    """Lower-case form used for addresses and category codes."""
    return F.lower(trimmed(name))


def title(name: str) -> Column:
    """Each space-separated word capitalised, the rest lower-case."""
    return F.initcap(trimmed(name))
