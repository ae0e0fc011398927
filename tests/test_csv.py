"""CSV with line breaks inside fields, however the files are split."""

import csv
import io

import pytest

from riskloom.sources import csvtext
from riskloom.sources.tables import scan_csv

ROWS = [
    (1, "plain", 1.5), (2, "two\nlines", 2.0), (3, 'a "quoted"\n\nword, and\r\nmore', None), (4, "", 4.0), (5, "ünï\ncödé", 5.0),
    (6, '"', 6.0), (7, "\n", 7.0), (8, "x\n" * 12 + "y", 8.0), (9, "last", 9.0),
]


def write(path, rows, end="\n"):
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator=end).writerows([("id", "note", "amt"), *rows])
    path.write_bytes(out.getvalue().encode())
    return len(path.read_bytes())


def read(spark, path, **options):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("note", T.StringType()), T.StructField("amt", T.DoubleType())])
    return sorted((r["id"], r["note"] or "", r["amt"]) for r in scan_csv(spark, str(path), schema, **options).collect())


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_line_breaks_in_fields(spark, tmp_path, end):
    write(tmp_path / "a.csv", ROWS, end)
    assert csvtext.has_line_breaks(spark, str(tmp_path / "a.csv"))
    assert read(spark, tmp_path / "a.csv") == ROWS


def test_files_cut_into_small_blocks(spark, tmp_path):
    """Down to three bytes, so most line breaks, quotes and letters are once the first of a block."""
    size = write(tmp_path / "a.csv", ROWS)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        for n in (3, 7, 13, 29, 64, size - 1):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
            assert read(spark, tmp_path / "a.csv", line_breaks=True) == ROWS, n
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_several_files_and_rows_that_do_not_fit(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder / "a.csv", ROWS[:3])
    write(folder / "b.csv", [*ROWS[3:], ("no\nnumber", "z", 1.0)])
    assert read(spark, folder, rejects=str(tmp_path / "bad")) == ROWS
    lines = [r["_rejected_line"] for r in spark.read.parquet(str(tmp_path / "bad")).collect()]
    assert lines == ['"no\nnumber",z,1.0']
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        read(spark, folder)


def test_files_without_line_breaks_are_read_as_before(spark, tmp_path):
    write(tmp_path / "a.csv", [(1, 'say "x"', 1.0), (2, "b", None)])
    assert not csvtext.has_line_breaks(spark, str(tmp_path / "a.csv"))
    assert read(spark, tmp_path / "a.csv") == read(spark, tmp_path / "a.csv", line_breaks=True) == [(1, 'say "x"', 1.0), (2, "b", None)]
    write(tmp_path / "b.csv", [])
    assert read(spark, tmp_path / "b.csv") == read(spark, tmp_path / "b.csv", line_breaks=True) == []
