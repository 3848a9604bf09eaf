from __future__ import annotations

from conftest import SF

from assaylake.registry import queries


def test_landing_accounts_writes_a_file_for_each_partition(spark, monkeypatch):
    whole = sorted(queries.landing_accounts(spark, SF).collect())
    events, write, written = queries.tx.events, queries.files.write_text, []
    monkeypatch.setattr(queries.tx, "events", lambda *a: events(*a).repartition(4))
    monkeypatch.setattr(queries.files, "write_text", lambda frame, path: (written.append(path), write(frame, path)))
    parts = sorted(queries.landing_accounts(spark, SF).collect())
    assert parts == whole
    assert len(spark.read.text(written[0]).inputFiles()) == 4
