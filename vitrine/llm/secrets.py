"""Operator 2, secret scans: fixed patterns, and sliding-window Shannon entropy over candidate strings.

Candidates are the maximal runs of each character class (hex, letters and digits, the base64 alphabet) of 20 characters or more; a run of
one class may lie inside one of another, as the digest in `key=9F86...` does. A window of 20 characters slides over each;
counts change by one character in and one out, and sum(c * log2 c) is kept with them, so a step costs
O(1). Windows at or above the class's entropy are merged, over all classes, into spans of kind entropy. The allow-list drops runs
that are words, numbers, UUIDs, placeholders, paths or repeat patterns; runs inside a dropped one are judged by themselves.

Scale: one pass over the rows, no shuffle, whole texts, memory of one Arrow batch.
"""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, table, text_or_empty

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # a maximal run of fewer characters fails at any start
HEX = re.compile(r"[0-9a-f]{16,}")
WINDOW = 20
#: Character classes and the bits a character that a window of 20 needs under each.
CLASSES = (("hex", re.compile(r"[0-9a-fA-F]{20,}"), 3.0), ("alnum", re.compile(r"[0-9A-Za-z]{20,}"), 3.7), ("base64", re.compile(r"[A-Za-z0-9+/_=-]{20,}"), 3.8))
#: The class that holds the others.
CANDIDATE = CLASSES[-1][1]
#: Candidates that aren't secrets: words, numbers, UUIDs, placeholders, dotted or slashed words.
ALLOW = (
    re.compile(r"[A-Za-z_=-]*"),
    re.compile(r"[0-9+/_=-]*"),
    re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),
    re.compile(r"(?i).*(example|placeholder|changeme|your[_-]?(key|token|secret)|dummy|xxxx).*"),
    re.compile(r"/?([A-Za-z0-9]{1,12}/)+[A-Za-z0-9_-]{0,12}"),
    re.compile(r"(.{1,8}?)\1{2,}.{0,8}"),
)
_XLOG = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 2)]


def entropy_spans(text: str, start: int, end: int, bits: float, window: int = WINDOW) -> list[tuple[int, int]]:
    """Merged spans [a, b) of the windows of text[start:end] with at least `bits` of entropy a character."""
    counts: dict[str, int] = {}
    total, spans, log_w = 0.0, [], math.log2(window)
    for i in range(start, end):
        c = text[i]
        n = counts.get(c, 0)
        total += _XLOG[n + 1] - _XLOG[n]
        counts[c] = n + 1
        if i - start >= window:
            c = text[i - window]
            n = counts[c]
            total += _XLOG[n - 1] - _XLOG[n]
            counts[c] = n - 1
        if i - start >= window - 1 and log_w - total / window >= bits - 1e-9:
            a = i - window + 1
            if spans and a <= spans[-1][1]:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((a, i + 1))
    return spans


def class_spans(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Merged spans of the runs of every class in text[start:end], a maximal run of the widest class."""
    found = []
    for _, run, bits in CLASSES:
        whole = False
        for m in run.finditer(text, start, end):
            if not any(a.fullmatch(m.group()) for a in ALLOW):
                found += entropy_spans(text, m.start(), m.end(), bits)
            whole = m.start() == start and m.end() == end
        if whole:  # wider classes have the same run and ask for more bits
            break
    merged: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def scan(text: str) -> list[tuple[int, int, int]]:
    """Spans (start, kind, end) of one text in order; kind indexes KINDS. Code points, end exclusive."""
    spans = []
    low = text.lower() if "=" in text or ":" in text else ""
    if any(x in low for x in NAMES):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    for m in CANDIDATE.finditer(text):
        spans += [(a, 3, b) for a, b in class_spans(text, m.start(), m.end())]
    return sorted(spans)


def redact(text: str, spans: list[tuple[int, int, int]], mark: str = "[SECRET]") -> str:
    """The text with each run of overlapping spans replaced by the mark."""
    out, at = [], 0
    for a, _, b in sorted(spans):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:]


def scan_secrets(docs: DataFrame, text: str = "text", *, prefix: str = "") -> DataFrame:
    """docs plus a column `secrets`: array of (kind, start, end), in order of start and kind; null text: empty array.

    Rows keep their other columns; repeated rows stay repeated; an input column of that name is replaced.
    """
    find = F.arrow_udf(_scan_array, "array<struct<kind:string,start:int,end:int>>")
    return docs.withColumn(f"{prefix}secrets", find(text_or_empty(text)))


def _scan_array(texts: pa.Array) -> pa.Array:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    return pa.array([[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in scan(t)] for t in texts.to_pylist()], kind)


def _digest(batch):
    out = {k: [] for k in ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_entropy")}
    out["doc_id"] = batch["doc_id"]
    for t in batch["text"].to_pylist():
        spans = scan(t)
        base = [x for x in spans if x[1] < 3]
        join = lambda x: ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in x)
        n = [sum(k == i for _, k, _ in spans) for i in range(4)]
        for key, v in zip(("n_assign", "n_access", "n_hex", "n_entropy", "base_sha256", "spans"), (*n, hashlib.sha256(join(base).encode()).hexdigest(), join(spans)), strict=True):
            out[key].append(v)
    return out


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents. Null and empty texts have none; repeated rows and null ids each give their row, an empty table none."""
    docs = table(spark, sf_dir, "documents").select("doc_id", text_or_empty().alias("text"))
    return arrow_map(docs, _digest, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_entropy long")


def redact_secrets(docs: DataFrame) -> DataFrame:
    """Documents with the secrets of their texts masked; n_chars, where present, follows the new text. Null texts stay null."""
    hide = F.arrow_udf(_redact_array, "string")
    text = F.when(F.col("text").isNotNull(), hide(text_or_empty()))
    out = docs.withColumn("text", text)
    return out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.char_length(F.coalesce("text", F.lit(""))).cast(docs.schema["n_chars"].dataType))) if "n_chars" in docs.columns else out


def _redact_array(texts: pa.Array) -> pa.Array:
    return pa.array([redact(t, scan(t)) for t in texts.to_pylist()], pa.string())
