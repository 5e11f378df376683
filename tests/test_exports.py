"""Exports that are whole or not there, and records of CSV files that are no lines."""

import pytest

from patronage.sources import exports
from patronage.sources.transactions import read_checked, read_transactions


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(
        [(3, 1.5, "a,b"), (1, None, 'quo"te'), (2, -0.25, None)], "CustomerID long, Monetary double, `Seg ment` string"
    )


@pytest.mark.parametrize("format", ["csv", "parquet"])
def test_export_reads_back(spark, rows, tmp_path, format):
    path = str(tmp_path / "out")
    manifest = exports.commit_export(rows, path, format=format)
    assert manifest["rows"] == 3
    assert [c for c, _ in manifest["columns"]] == rows.columns
    back = exports.read_export(spark, path)
    assert back.schema == rows.schema
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))
    exports.commit_export(rows.limit(1), path, format=format)
    assert exports.read_export(spark, path).count() == 1
    assert [p.name for p in tmp_path.iterdir()] == ["out"]


def test_an_interrupted_export_is_not_read(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    exports.commit_export(rows, path)

    def stopped(*args, **kwargs):
        raise KeyboardInterrupt

    monkeypatch.setattr(exports.json, "dumps", stopped)
    with pytest.raises(KeyboardInterrupt):
        exports.commit_export(rows.limit(1), path)
    monkeypatch.undo()
    assert exports.read_export(spark, path).count() == 3
    beside = [p for p in tmp_path.iterdir() if p.name != "out"]
    assert len(beside) == 1
    with pytest.raises(FileNotFoundError):
        exports.read_export(spark, str(beside[0]))
    with pytest.raises(FileNotFoundError):
        exports.read_export(spark, str(tmp_path / "nowhere"))


def test_an_export_that_lost_rows_is_refused(spark, rows, tmp_path):
    path = tmp_path / "out"
    exports.commit_export(rows.coalesce(1), str(path))
    for part in path.glob("part-*"):
        part.write_text(part.read_text().rsplit("\n", 2)[0] + "\n")
    for check in path.glob(".part-*"):
        check.write_bytes(b"")
    with pytest.raises(Exception, match="manifest|checksum|Checksum"):
        exports.read_export(spark, str(path))


def test_corrupt_records_are_kept_apart(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(
        "Country,UnitPrice,CustomerID,InvoiceNo,InvoiceDate,Quantity,Other\n"
        "F,2,1,a,x,1.5,\n"
        "F,2,2,b,y,many,\n"
        ",,,,,,\n"
        "F,2,4\n"
        "F,2,5,e,z,1,9,extra\n"
        "F,free,6,f,z,1,9\n"
        "F,8,7.0,g,z,7,9\n"
        "F,8,abc,h,z,7,9\n"
    )
    found = read_checked(spark, str(path))
    assert [(r.CustomerID, r.InvoiceNo, r.Quantity) for r in found.lines.collect()] == [
        (1, "a", 1.5), (None, None, None), (7, "g", 7.0),
    ]
    assert [r.InvoiceNo for r in found.lines.select("InvoiceNo").collect()] == ["a", None, "g"]
    records = ["F,2,2,b,y,many,", "F,2,4", "F,2,5,e,z,1,9,extra", "F,free,6,f,z,1,9", "F,8.0,abc,h,z,7.0,9"]
    assert [r.record for r in found.corrupt.collect()] == records
    assert tuple(found.counts().first()) == (8, 3, 5)
    assert read_checked(spark, str(path), customer_type="string").lines.count() == 4
    assert read_transactions(spark, str(path)).count() == 8


def test_a_file_of_a_header_alone(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("CustomerID,InvoiceNo,InvoiceDate,Quantity,UnitPrice\n")
    assert tuple(read_checked(spark, str(path)).counts().first()) == (0, 0, 0)
    path.write_text("CustomerID,InvoiceNo\n1,2\n")
    with pytest.raises(ValueError, match="missing columns"):
        read_checked(spark, str(path))
