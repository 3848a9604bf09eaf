import json

import pytest
from conftest import raw_row, transaction
from pyspark.errors import AnalysisException

from assaylake import schemas as S
from assaylake.sources import files, records


def lines(folder) -> list[list[str]]:
    return [p.read_text().splitlines() for p in folder.glob("*.csv")]


def test_landing_in_many_files_keeps_every_row_and_space(spark, raw, tmp_path):
    rows = [raw_row(amount=str(i), ip_prefix=" x ", location_region="   ", anomaly='a "b", \\c') for i in range(20)]
    folder = tmp_path / "bronze"
    files.write_csv(raw(*rows).repartition(5), str(folder))
    assert len(lines(folder)) == 5
    back = files.scan_csv(spark, str(folder))
    assert back.columns == list(S.RAW_COLUMNS)
    assert {f.dataType.simpleString() for f in back.schema} == {"string"}
    assert sorted(back.collect(), key=lambda r: int(r["amount"])) == raw(*rows).collect()


def test_empty_fields_are_null(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n,  \n\"\",x\n")
    assert [tuple(r) for r in files.scan_csv(spark, str(tmp_path / "a.csv")).collect()] == [(None, "  "), (None, "x")]


def test_a_file_with_another_header_raises(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "2.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="header does not conform"):
        files.scan_csv(spark, str(tmp_path)).collect()


def test_quoted_line_breaks(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('a,b\n1,"x\ny"\n2,z\n')
    assert files.scan_csv(spark, str(path), multi_line=True).count() == 2
    assert files.scan_csv(spark, str(path)).count() == 3


def test_missing_source_raises(spark, tmp_path):
    with pytest.raises(AnalysisException):
        files.scan_csv(spark, str(tmp_path / "nowhere"))


def test_silver_partitions_are_replaced(spark, silver, tmp_path):
    folder = tmp_path / "silver"
    files.write_silver(silver(transaction(), transaction(transaction_type="transfer")), str(folder))
    files.write_silver(silver(transaction(amount=None)), str(folder))
    back = files.scan_silver(spark, str(folder))
    assert back.schema == S.SILVER
    assert [(r["transaction_type"], r["amount"]) for r in back.collect()] == [("sale", None)]
    assert [p.name for p in folder.glob("transaction_type=*")] == ["transaction_type=sale"]
    assert all(p.name.endswith(".snappy.parquet") for p in folder.glob("*/*.parquet"))


def test_empty_silver_reads_as_no_rows(spark, silver, tmp_path):
    folder = str(tmp_path / "silver")
    files.write_silver(silver(transaction()).filter("amount < 0"), folder)
    assert files.scan_silver(spark, folder).count() == 0


def test_folder_bytes(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.csv").write_text("12345")
    (tmp_path / "sub" / "b.csv").write_text("123")
    assert files.folder_bytes(spark, str(tmp_path)) == 8


def test_flatten_people(spark):
    payloads = [
        json.dumps({"number": 2, "people": [{"craft": "ISS", "name": "A B"}, {"craft": "T", "name": "C"}]}),
        json.dumps({"number": 0, "people": []}),
        "not json",
    ]
    rows = spark.createDataFrame([(p,) for p in payloads], "payload string")
    assert [tuple(r) for r in records.flatten_people(rows).collect()] == [
        (2, "ISS", "A B", "A B is currently in space flying on the ISS! Hello! :)"),
        (2, "T", "C", "C is currently in space flying on the T! Hello! :)"),
    ]
    assert records.flatten_people(rows, greeting="Hi").first()["message"].endswith("ISS! Hi")
