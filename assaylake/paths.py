"""Where each layer of the lake lives."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class LakePaths:
    """Folders of one lake below ``root``, which may be any Hadoop URI (``s3a://``, ``hdfs://``, a path)."""

    root: str

    def _below(self, *parts: str) -> str:
        return "/".join((self.root.rstrip("/"), *parts))

    @property
    def bronze(self) -> str:
        return self._below("bronze", "fraud_credit")

    @property
    def bronze_rejects(self) -> str:
        """Lines of the source that don't fit its header, as they are."""
        return self._below("bronze", "fraud_credit_rejects")

    @property
    def silver(self) -> str:
        return self._below("silver", "fraud_credit")

    def gold(self, table: str) -> str:
        return self._below("gold", table)

    @property
    def quality_report(self) -> str:
        return self._below("gold", "data_quality")

    def quality_table(self, table: str) -> str:
        """Parquet tables behind the report: kept beside it because they may outgrow one JSON row."""
        return self._below("gold", "data_quality_tables", table)
