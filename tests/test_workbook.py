"""The workbook's sheets from pieces of tasks, and the tables in order."""

import random
import re
import zipfile
import zlib
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from vitrine.plans import runner
from vitrine.sources import workbook as B

ROWS = [("б", 2.5, None), ("а", None, "x<&>\"'"), (None, 1e-05, "tab\tand\x01"), ("а", float("nan"), ""), ("b" * 90, 7.0, "🙂")]
SCHEMA = "name string, lat double, more string"


def order():
    return [F.coalesce("name", F.lit("")), F.coalesce("more", F.lit(""))]


def by_hand(names, widths, rows):
    """The whole sheet as one text of rows in order."""
    return B._opening(names, widths) + "".join(B._row(y, r) for y, r in enumerate(rows, 2)) + B._ending(names, len(rows))


def sheets(path):
    with zipfile.ZipFile(path) as z:
        assert z.testzip() is None  # lengths and checksums of joined pieces hold
        names = [e.attrib["name"] for e in ElementTree.fromstring(z.read("xl/workbook.xml")).iter() if e.tag.endswith("}sheet")]
        return {n: z.read(f"xl/worksheets/sheet{i}.xml").decode() for i, n in enumerate(names, 1)}


def numbers(sheet):
    return [int(x) for x in re.findall(r'<row r="\d+"><c [^>]*><v>(\d+)</v>', sheet)]


def test_checksum_of_joined_texts():
    dice = random.Random(5)
    for n, m in ((0, 0), (0, 9), (9, 0), (1, 1), (70_000, 300_001)):
        a, b = dice.randbytes(n), dice.randbytes(m)
        assert B.joined_crc(zlib.crc32(a), zlib.crc32(b), m) == zlib.crc32(a + b)


@pytest.mark.parametrize("partitions", [1, 5])
def test_same_bytes_as_one_text(spark, tmp_path, partitions):
    """Nulls, NaN, marks of XML, controls, repeated keys; any partitioning gives the same sheet."""
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(partitions)
    out = str(tmp_path / "a" / "b.xlsx")
    B.write_workbook(out, [(df, ["name", "lat", "more"], order())], ("Лист & 1",))
    rows = sorted(ROWS, key=lambda r: (r[0] or "", r[2] or ""))
    assert sheets(out) == {"Лист & 1": by_hand(["name", "lat", "more"], {"name": 80, "lat": 12, "more": 12}, rows)}


def test_empty_table_and_kept_workbook(spark, tmp_path):
    out = tmp_path / "b.xlsx"
    empty = spark.createDataFrame([], SCHEMA)
    B.write_workbook(str(out), [(empty, empty.columns, order())], ("s",))
    assert sheets(out)["s"].count("<row ") == 1 and 'ref="A1:C1"' in sheets(out)["s"]
    before = out.read_bytes()
    broken = spark.range(3).select(F.raise_error("no").cast("string").alias("name"))
    with pytest.raises(Exception, match="no"):
        B.write_workbook(str(out), [(broken, ["name"], [F.col("name")])], ("s",))
    assert out.read_bytes() == before


def test_long_table_goes_on_in_further_sheets(spark, tmp_path):
    """Sheets of ten rows under a header; pieces end where a sheet does."""
    df = spark.range(35).select(((F.col("id") * 11) % 35).alias("n")).repartition(4)
    other = spark.range(2).toDF("n")
    out = str(tmp_path / "b.xlsx")
    B.write_workbook(out, [(df, ["n"], [F.col("n")]), (other, ["n"], [-F.col("n")])], ("a", "b"), limit=11)
    got = sheets(out)
    assert list(got) == ["a", "a 2", "a 3", "a 4", "b"]
    assert [numbers(got[x]) for x in got] == [[*range(10)], [*range(10, 20)], [*range(20, 30)], [*range(30, 35)], [1, 0]]
    small = B.pieces(df, ["n"], [F.col("n")], most=100).collect()
    assert [r.first for r in small] == sorted(r.first for r in small) and sum(r.rows for r in small) == 35 and max(r.rows for r in small) <= 4


def test_million_rows(spark, tmp_path):
    """More rows than a sheet holds; no task renders more than a piece at a time."""
    n = 1_100_000
    df = spark.range(n).select((F.lit(n - 1) - F.col("id")).alias("n"))
    out = str(tmp_path / "b.xlsx")
    B.write_workbook(out, [(df, ["n"], [F.col("n")])], ("a",))
    got = sheets(out)
    assert list(got) == ["a", "a 2"]
    assert numbers(got["a"]) == [*range(B.ROW_LIMIT - 1)] and numbers(got["a 2"]) == [*range(B.ROW_LIMIT - 1, n)]


def test_tables_of_a_run(spark, tmp_path):
    rows = lambda *hours: lambda s: s.createDataFrame([("N", f"https://x.ru/shop/{9 - i}", h) for i, h in enumerate(hours)], "network string, source_url string, work_time string")
    out, folder = str(tmp_path / "r.xlsx"), str(tmp_path / "t")
    runner.run(spark, {"a": rows("8-20", "9-21")}, out)
    runner.run(spark, {"a": rows("8-22", "9-21", "1-2")}, out, tables=folder)
    stores = spark.read.parquet(f"{folder}/stores").orderBy("place").collect()
    assert [(r.place, r.source_url) for r in stores] == [(i, f"https://x.ru/shop/{6 + i}") for i in (1, 2, 3)] and "stable_key" not in stores[0]
    assert [(r.place, r.change_type) for r in spark.read.parquet(f"{folder}/changes").orderBy("place").collect()] == [(1, "added"), (2, "changed")]
    assert [(r.network, r.stores_count, r.place) for r in spark.read.parquet(f"{folder}/statistics").collect()] == [("N", 3, 1)]
    assert list(sheets(out)) == list(B.SHEETS)
