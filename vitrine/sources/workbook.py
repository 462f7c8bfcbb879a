"""Report tables in order: as folders of Parquet files, or as one workbook whose rows are rendered and compressed by tasks.

A table is ranked by range partitions. For a workbook each partition turns its rows into compressed pieces of a sheet, which lie in the shared
folder. Only the pieces pass through the writer of the file, one partition's at a time and as they are: a compressed stream may be
joined from pieces that end on a byte. A table longer than a sheet goes on in further sheets.
"""

from __future__ import annotations

import math
import os
import zipfile
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.report import SHEETS, column_widths, ranked
from ..shared import cut

NS = "http://schemas.openxmlformats.org"
ROW_LIMIT = 1_048_576  # of the format, the header's row included
PIECE = 4_000_000  # characters of a piece before compression
TABLES = ("stores", "changes", "statistics")
#: A table, the columns shown and the order of its rows.
Report = tuple[DataFrame, list[str], list[Column]]
PIECES = "sheet int, first long, rows long, size long, crc long, data binary"


def _letters(i: int) -> str:
    s = ""
    while i >= 0:
        s, i = chr(65 + i % 26) + s, i // 26 - 1
    return s


def _cell(ref: str, v, style: int) -> str:
    if v is None or isinstance(v, float) and not math.isfinite(v):
        return ""
    if isinstance(v, (int, float)) and not isinstance(v, bool):
        return f'<c r="{ref}" s="{style}"><v>{v!r}</v></c>'
    clean = "".join(c for c in str(v) if c >= " " or c in "\t\n\r")
    return f'<c r="{ref}" s="{style}" t="inlineStr"><is><t xml:space="preserve">{escape(clean)}</t></is></c>'


def _row(y: int, values: Iterable, style: int = 0) -> str:
    return f'<row r="{y}">' + "".join(_cell(f"{_letters(x)}{y}", v, style) for x, v in enumerate(values)) + "</row>"


@dataclass
class Piece:
    """A stretch of a file: deflated without an end of the stream, with the length and checksum of what it holds."""

    size: int
    crc: int
    data: bytes


def squeezed(text: str, *, last: bool = False) -> Piece:
    raw, z = text.encode(), zlib.compressobj(wbits=-zlib.MAX_WBITS)
    return Piece(len(raw), zlib.crc32(raw), z.compress(raw) + z.flush(zlib.Z_FINISH if last else zlib.Z_FULL_FLUSH))


def _product(a: int, b: int) -> int:
    """Of two polynomials modulo that of CRC-32, the highest bit standing for x^0."""
    p = 0
    for i in range(31, -1, -1):
        if a >> i & 1:
            p ^= b
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return p


def joined_crc(a: int, b: int, n: int) -> int:
    """CRC-32 of two texts in a row, of their checksums and the length of the second: the first, times x^(8n), plus the second."""
    shift, power = 1 << 31, 1 << 23
    while n:
        if n & 1:
            shift = _product(power, shift)
        power, n = _product(power, power), n >> 1
    return _product(shift, a) ^ b


def pieces(df: DataFrame, columns: list[str], order: list[Column], limit: int = ROW_LIMIT, most: int = PIECE) -> DataFrame:
    """Rows of PIECES, in the order of the table: its columns of the rows `first` and on of a sheet (numbered from 0 on), at most about `most` characters of them.

    limit: rows of a sheet with its header. A task holds one batch of rows and one piece, however long its partition is.
    """
    room = limit - 1

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["sheet", "first", "rows", "size", "crc", "data"]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        lines, size, start = [], 0, None

        def piece() -> pa.RecordBatch:
            p = squeezed("".join(lines))
            values = [start // room, start % room, len(lines), p.size, p.crc, p.data]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

        for batch in batches:
            *values, places = [c.to_pylist() for c in batch.columns]
            for place, row in zip(places, zip(*values, strict=True), strict=True):
                at = place - 1
                if lines and (at % room == 0 or size >= most):
                    yield piece()
                    lines, size = [], 0
                if not lines:
                    start = at
                lines.append(_row(at % room + 2, row))
                size += len(lines[-1])
        if lines:
            yield piece()

    return cut(ranked(df, order, to="__place").select(*columns, "__place").mapInArrow(render, PIECES))


class _Book(zipfile.ZipFile):
    def join(self, name: str, parts: Iterable[Piece]) -> None:
        """A file of the archive from deflated pieces, the last of which ends the stream. They are copied as they come."""
        info = zipfile.ZipInfo(name)
        info.compress_type, info.header_offset, info.CRC = zipfile.ZIP_DEFLATED, self.start_dir, 0
        self.fp.seek(self.start_dir)
        self.fp.write(info.FileHeader(zip64=True))
        for p in parts:
            self.fp.write(p.data)
            info.CRC = joined_crc(info.CRC, p.crc, p.size)
            info.file_size, info.compress_size = info.file_size + p.size, info.compress_size + len(p.data)
        self.start_dir = self.fp.tell()
        self.fp.seek(info.header_offset)
        self.fp.write(info.FileHeader(zip64=True))
        self.filelist.append(info)
        self.NameToInfo[name] = info


def _opening(names: list[str], widths: dict[str, int]) -> str:
    cols = "".join(f'<col min="{i}" max="{i}" width="{widths[n]}" customWidth="1"/>' for i, n in enumerate(names, 1))
    return f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{NS}/spreadsheetml/2006/main"><sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" activePane="bottomLeft" state="frozen"/></sheetView></sheetViews><cols>{cols}</cols><sheetData>{_row(1, names, 1)}'


def _ending(names: list[str], rows: int) -> str:
    return f'</sheetData><autoFilter ref="A1:{_letters(len(names) - 1)}{rows + 1}"/></worksheet>'


def _sheet(names: list[str], widths: dict[str, int], rows: int, body: Iterable) -> Iterator[Piece]:
    """A sheet's pieces, the body's among them; a body that isn't whole or not in order fails."""
    yield squeezed(_opening(names, widths))
    at = 0
    while at < rows:
        r = next(body)
        if r.first != at:
            raise RuntimeError(f"a sheet's rows from {at} on are missing")
        yield Piece(r.size, r.crc, bytes(r.data))
        at += r.rows
    yield squeezed(_ending(names, rows), last=True)


def write_workbook(path: str, tables: list[Report], names: tuple[str, ...] = SHEETS, limit: int = ROW_LIMIT) -> None:
    """W2, W3. A sheet a table with its columns, its rows by ascending values of the order, with a frozen bold header, a filter and fitted widths.

    An empty table gives a sheet with its header only. What goes beyond `limit` rows is in sheets of the same name and a number from 2 on.
    A workbook that isn't finished doesn't replace the one that is there.
    """
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    sheets = []
    for (df, columns, order), name in zip(tables, names, strict=True):
        done = pieces(df, columns, order, limit)
        widths = {r["column"]: r["width"] for r in column_widths(df, columns).collect()}
        counts = {r.sheet: r.n for r in done.groupBy("sheet").agg(F.sum("rows").alias("n")).collect()} or {0: 0}  # one row a sheet
        body = done.toLocalIterator()  # a partition at a time
        sheets += [(name if i == 0 else f"{name} {i + 1}", columns, widths, counts[i], body) for i in sorted(counts)]
    n = range(1, len(sheets) + 1)
    unfinished = f"{path}.part"
    with _Book(unfinished, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", f'<?xml version="1.0" encoding="UTF-8"?><Types xmlns="{NS}/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>' + "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in n) + "</Types>")
        z.writestr("_rels/.rels", f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{NS}/package/2006/relationships"><Relationship Id="r1" Type="{NS}/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="{NS}/spreadsheetml/2006/main" xmlns:r="{NS}/officeDocument/2006/relationships"><sheets>' + "".join(f'<sheet name={quoteattr(s)} sheetId="{i}" r:id="r{i}"/>' for i, (s, *_) in zip(n, sheets, strict=True)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{NS}/package/2006/relationships">' + "".join(f'<Relationship Id="r{i}" Type="{NS}/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in n) + f'<Relationship Id="styles" Type="{NS}/officeDocument/2006/relationships/styles" Target="styles.xml"/></Relationships>')
        z.writestr("xl/styles.xml", f'<?xml version="1.0" encoding="UTF-8"?><styleSheet xmlns="{NS}/spreadsheetml/2006/main"><fonts count="2"><font/><font><b/></font></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="2"><xf/><xf fontId="1" applyFont="1"/></cellXfs></styleSheet>')
        for i, (_, columns, widths, rows, body) in zip(n, sheets, strict=True):
            z.join(f"xl/worksheets/sheet{i}.xml", _sheet(columns, widths, rows, body))
    os.replace(unfinished, path)


def write_tables(folder: str, tables: list[Report], names: tuple[str, ...] = TABLES) -> None:
    """O1, C7. A folder of Parquet files a table, written by tasks alone: the rows with their `place` (long, from 1), in the order of
    the files' names and in each file by place."""
    for (df, columns, order), name in zip(tables, names, strict=True):
        ranked(df, order).select(*columns, "place").write.mode("overwrite").parquet(f"{folder}/{name}")
