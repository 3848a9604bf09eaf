"""Names for columns that an operator adds for a while."""

from __future__ import annotations

from pyspark.sql import DataFrame


def unused(frame: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores after it as make it differ from all columns of ``frame``."""
    taken = {c.lower() for c in frame.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
