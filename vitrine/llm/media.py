"""Operator 4, media columns: bytes carried in MPEG transport streams (ISO/IEC 13818-1).

Storing: the payload is cut into access units, each unit into a PES packet with a presentation
timestamp, each PES packet into 188-byte transport packets with continuity counters; a program
association table and a program map table lead every stream, and units at a fixed distance are
random-access points with a clock reference. Reading: the association table gives the map table, the map
table the elementary streams; counters are checked, PES packets reassembled, timestamps and
random-access flags stored by unit.

Scale: one pass over rows, no shuffle; a worker holds one batch and one stream at a time.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, table, text_or_empty

PACKET, BODY = 188, 184
PMT_PID, ES_PID, PROGRAM, PRIVATE_PES, STREAM_ID = 0x1000, 0x0100, 1, 0x06, 0xBD
UNIT, CLOCK, FRAME_TICKS, RAP_EVERY = 16_384, 90_000, 3_600, 8

_CRC_TABLE = []
for _i in range(256):
    _c = _i << 24
    for _ in range(8):
        _c = ((_c << 1) ^ 0x04C11DB7 if _c & 0x80000000 else _c << 1) & 0xFFFFFFFF
    _CRC_TABLE.append(_c)


def crc32_mpeg(data: bytes) -> int:
    """CRC of program tables: polynomial 0x04C11DB7, no reflection, initial value all ones."""
    c = 0xFFFFFFFF
    for b in data:
        c = ((c << 8) & 0xFFFFFFFF) ^ _CRC_TABLE[(c >> 24) ^ b]
    return c


def _section(table_id: int, ident: int, body: bytes) -> bytes:
    head = bytes([table_id]) + (0xB000 | len(body) + 9).to_bytes(2, "big") + ident.to_bytes(2, "big") + b"\xc1\x00\x00"
    s = head + body
    return s + crc32_mpeg(s).to_bytes(4, "big")


def _table_packet(pid: int, section: bytes) -> bytes:
    return (b"\x47" + (0x4000 | pid).to_bytes(2, "big") + b"\x10\x00" + section).ljust(PACKET, b"\xff")


_PAT = _table_packet(0, _section(0, 1, PROGRAM.to_bytes(2, "big") + (0xE000 | PMT_PID).to_bytes(2, "big")))
_PMT = _table_packet(PMT_PID, _section(2, PROGRAM, (0xE000 | ES_PID).to_bytes(2, "big") + b"\xf0\x00" + bytes([PRIVATE_PES]) + (0xE000 | ES_PID).to_bytes(2, "big") + b"\xf0\x00"))
_START = [(0x4000 | ES_PID).to_bytes(2, "big"), ES_PID.to_bytes(2, "big")]


def _stamp(prefix: int, t: int) -> bytes:
    return bytes([prefix << 4 | (t >> 29) & 0x0E | 1, t >> 22 & 0xFF, (t >> 14) & 0xFE | 1, t >> 7 & 0xFF, (t << 1) & 0xFE | 1])


def mux(payload: bytes, *, unit: int = UNIT) -> bytes:
    """One transport stream that carries the payload; equal payloads give equal streams. Empty payload: tables only."""
    out, cc = [_PAT, _PMT], 0
    first, later = b"\x47" + _START[0], b"\x47" + _START[1]
    for n, at in enumerate(range(0, len(payload), unit)):
        t = (CLOCK + n * FRAME_TICKS) & 0x1FFFFFFFF
        data = payload[at : at + unit]
        rap = n % RAP_EVERY == 0
        pes = b"\x00\x00\x01" + bytes([STREAM_ID]) + (len(data) + 8).to_bytes(2, "big") + b"\x84\x80\x05" + _stamp(2, t) + data
        i, total, head = 0, len(pes), first
        while i < total:
            if i == 0 and rap:  # random-access indicator and program clock reference
                field_ = b"\x50" + (t >> 1).to_bytes(4, "big") + bytes([(t & 1) << 7 | 0x7E, 0])
            else:
                field_ = b""
            room = BODY - (len(field_) + 1 if field_ else 0)
            if total - i >= room:
                out.append(head + bytes([(0x30 if field_ else 0x10) | cc]) + (bytes([len(field_)]) + field_ if field_ else b"") + pes[i : i + room])
                i += room
            else:  # the last packet of a unit is filled up by stuffing in the adaptation field
                rest = pes[i:]
                length = BODY - 1 - len(rest)
                stuffed = (field_ or (b"\x00" if length else b"")).ljust(length, b"\xff")
                out.append(head + bytes([0x30 | cc, length]) + stuffed + rest)
                i = total
            cc, head = (cc + 1) & 15, later
    return b"".join(out)


@dataclass
class Demuxed:
    """What a stream holds: programs {number: {pid: stream type}}, units by pid in order, and what was wrong."""

    packets: int = 0
    programs: dict[int, dict[int, int]] = field(default_factory=dict)
    units: list[dict] = field(default_factory=list)
    continuity_errors: int = 0
    sync_errors: int = 0
    table_errors: int = 0

    def payload(self, pid: int | None = None) -> bytes:
        return b"".join(u["data"] for u in self.units if pid is None or u["pid"] == pid)


class _Sections:
    """Joins the sections of one table stream: a section may span packets, a packet may hold several."""

    def __init__(self):
        self.open: bytes | None = None  # None: wait for a packet in which a section starts

    def add(self, body: bytes, start: bool) -> Iterator[bytes | None]:
        """Whole sections, or None for one that is cut short or has a wrong CRC."""
        if not start:
            if self.open is not None:
                self.open += body
                yield from self._take()
            return
        at = 1 + body[0] if body else 0
        if at > len(body) or not body:
            self.open = None
            yield None
            return
        if self.open:
            self.open += body[1:at]
            yield from self._take()
            if self.open:
                yield None
        self.open = body[at:]
        yield from self._take()

    def _take(self) -> Iterator[bytes | None]:
        while self.open:
            if self.open[0] == 0xFF:  # stuffing up to the packet's end
                self.open = b""
                return
            if len(self.open) < 3:
                return
            n = 3 + (int.from_bytes(self.open[1:3], "big") & 0xFFF)
            if n > len(self.open):
                return
            s, self.open = self.open[:n], self.open[n:]
            yield s if n >= 12 and crc32_mpeg(s) == 0 else None


def demux(stream: bytes) -> Demuxed:
    """Parse a stream. Packets without the sync byte, with the error indicator or a bad header are counted and left out; a
    missing or repeated counter counts as a continuity error (a repeat of the last packet of its PID is dropped, as the
    standard allows, whatever lies between); table sections may span packets, those with a wrong CRC or cut short are
    counted and left out; a unit cut short keeps what arrived. Any bytes are accepted."""
    d, maps, wanted = Demuxed(), set(), {}
    whole = len(stream) // PACKET
    d.packets = whole
    d.sync_errors = int(len(stream) % PACKET != 0)
    if not whole:
        return d
    p = np.frombuffer(stream, np.uint8, whole * PACKET).reshape(-1, PACKET)
    pids = ((p[:, 1] & 0x1F).astype(np.int32) << 8 | p[:, 2]).tolist()
    start, control, cc = (p[:, 1] & 0x40 != 0).tolist(), (p[:, 3] >> 4 & 3).tolist(), (p[:, 3] & 15).tolist()
    good = ((p[:, 0] == 0x47) & (p[:, 1] & 0x80 == 0)).tolist()
    length, flags = np.where(p[:, 3] & 0x20 != 0, p[:, 4].astype(np.int32) + 1, 0).tolist(), p[:, 5].tolist()
    last: dict[int, int] = {}  # the last packet of each PID that was read
    open_: dict[int, dict] = {}
    tables: dict[int, _Sections] = {}

    def close(pid: int) -> None:
        if u := open_.pop(pid, None):
            d.units.append(_unit(pid, u))

    for i in range(whole):
        if not good[i] or length[i] > BODY:
            d.sync_errors += 1
            continue
        pid = pids[i]
        if pid == 0x1FFF or not control[i] & 1:
            continue
        was = last.get(pid)
        broken = was is not None and cc[i] != (cc[was] + 1) & 15 and not (length[i] > 1 and flags[i] & 0x80)
        if broken and cc[i] == cc[was] and stream[i * PACKET : (i + 1) * PACKET] == stream[was * PACKET : (was + 1) * PACKET]:
            continue
        last[pid] = i
        d.continuity_errors += broken
        at = i * PACKET + 4 + length[i]
        body = stream[at : (i + 1) * PACKET]
        if pid == 0 or pid in maps:
            for s in tables.setdefault(pid, _Sections()).add(body, start[i]):
                if s is None:
                    d.table_errors += 1
                else:
                    _read_section(s, d, maps, wanted)
        elif pid in wanted:
            if start[i]:
                close(pid)
                open_[pid] = {"parts": [body], "rap": bool(length[i] > 1 and flags[i] & 0x40), "packet": i}
            elif pid in open_:
                open_[pid]["parts"].append(body)
    d.table_errors += sum(bool(t.open) for t in tables.values())
    for pid in list(open_):
        close(pid)
    return d


def _read_section(s: bytes, d: Demuxed, maps: set[int], wanted: dict[int, int]) -> None:
    """An association section names the map tables, a map section the elementary streams; others are left alone."""
    if s[0] == 0:
        for k in range(8, len(s) - 4, 4):
            number, at_pid = int.from_bytes(s[k : k + 2], "big"), int.from_bytes(s[k + 2 : k + 4], "big") & 0x1FFF
            if number:
                maps.add(at_pid)
                d.programs.setdefault(number, {})
    elif s[0] == 2:
        streams, k = d.programs.setdefault(int.from_bytes(s[3:5], "big"), {}), 12 + (int.from_bytes(s[10:12], "big") & 0xFFF)
        while k + 5 <= len(s) - 4:
            streams[es := int.from_bytes(s[k + 1 : k + 3], "big") & 0x1FFF] = s[k]
            wanted[es] = s[k]
            k += 5 + (int.from_bytes(s[k + 3 : k + 5], "big") & 0xFFF)


def _unit(pid: int, u: dict) -> dict:
    pes = b"".join(u["parts"])
    pts = dts = None
    head = 0
    if len(pes) >= 9 and pes[:3] == b"\x00\x00\x01":
        head, size = 9 + pes[8], int.from_bytes(pes[4:6], "big")
        read = lambda k: (pes[k] >> 1 & 7) << 30 | pes[k + 1] << 22 | pes[k + 2] >> 1 << 15 | pes[k + 3] << 7 | pes[k + 4] >> 1
        if pes[7] & 0x80 and len(pes) >= 14:
            pts = dts = read(9)
            if pes[7] & 0x40 and len(pes) >= 19:
                dts = read(14)
        if size:
            pes = pes[: 6 + size]
    return {"pid": pid, "pts": pts, "dts": dts, "random_access": u["rap"], "packet": u["packet"], "data": pes[head:]}


UNITS = "packets:bigint,programs:array<struct<number:int,pid:int,stream_type:int>>,continuity_errors:bigint,sync_errors:bigint,table_errors:bigint,units:array<struct<pid:int,pts:bigint,dts:bigint,random_access:boolean,packet:bigint,size:bigint>>"


def parse_streams(df: DataFrame, column: str, to: str = "ts") -> DataFrame:
    """df plus a struct column: program tables, error counts and the units' timestamps and random-access points.

    A null stream gives null, an empty one a struct of zero counts; a column named like `to` is replaced.
    """
    return df.withColumn(to, F.pandas_udf(_parse_series, f"struct<{UNITS}>")(F.col(column)))


def _parse_series(s: pd.Series) -> pd.DataFrame:
    names = [x.split(":")[0] for x in ("packets:", "programs:", "continuity_errors:", "sync_errors:", "table_errors:", "units:")]
    rows = []
    for b in s:
        if b is None:
            rows.append(dict.fromkeys(names))
            continue
        d = demux(bytes(b))
        rows.append({"packets": d.packets, "programs": [{"number": n, "pid": p, "stream_type": t} for n, m in d.programs.items() for p, t in m.items()], "continuity_errors": d.continuity_errors, "sync_errors": d.sync_errors, "table_errors": d.table_errors, "units": [{k: v for k, v in u.items() if k != "data"} | {"size": len(u["data"])} for u in d.units]})
    return pd.DataFrame(rows, columns=names)


def store_streams(df: DataFrame, column: str, to: str = "media") -> DataFrame:
    """df plus a binary column: the padded bytes of a text or binary column as a transport stream. Null is as empty."""
    raw = F.coalesce(F.col(column).cast("binary"), F.lit(b""))
    return df.withColumn(to, F.pandas_udf(_mux_series, "binary")(raw))


def _mux_series(s: pd.Series) -> pd.Series:
    return pd.Series([mux(pad(bytes(x))) for x in s], dtype=object)


def pad(data: bytes, multiple: int = 64) -> bytes:
    """Bytes 0 appended up to a positive multiple."""
    return data.ljust(max(multiple, -(-len(data) // multiple) * multiple), b"\0")


def _digest(batch):
    out = {k: [] for k in ("n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")}
    out["doc_id"] = batch["doc_id"]
    for t in batch["text"].to_pylist():
        raw = t.encode("utf-8")
        media = mux(pad(raw))
        d = demux(media)
        back = d.payload(ES_PID)
        streams = ";".join(f"{n}:{p}:{k}" for n, m in d.programs.items() for p, k in m.items())
        mean = int(np.frombuffer(back, np.uint8).sum(dtype=np.int64)) // len(back)
        feature = f"programs={streams},packets={d.packets},units={len(d.units)},first_pts={d.units[0]['pts']},last_pts={d.units[-1]['pts']},random_access={sum(u['random_access'] for u in d.units)},continuity_errors={d.continuity_errors},sync_errors={d.sync_errors},mean_byte={mean}"
        for k, v in (("n_bytes", len(raw)), ("payload_bytes", len(back)), ("payload_sha256", hashlib.sha256(back).hexdigest()), ("tail_crc32", zlib.crc32(back[-64:])), ("media_bytes", len(media)), ("media_sha256", hashlib.sha256(media).hexdigest()), ("feature", feature)):
            out[k].append(v)
    return out


def op4_mpegts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; null texts are as empty (64 bytes of padding), repeated rows stay, no rows for an empty table."""
    docs = table(spark, sf_dir, "documents").select("doc_id", text_or_empty().alias("text"))
    return arrow_map(docs, _digest, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
