"""Operator 7, BPE encoding and decoding: batched numpy merge rounds.

The words of a batch that the cache does not know are laid out as symbols in one flat array. A round looks all
neighbouring pairs up by binary search over the sorted pair keys, takes each word's lowest rank, merges
every occurrence of that pair in the word (left to right, not overlapping), and drops words without a pair. Since a merge can
only give rise to pairs of later rank, this equals merging one pair at a time.

Scale: one pass over rows, no shuffle. A worker keeps the merge table (fixed size) and a cache of words
bounded in entries and in bytes; of a long text all words are held at once, beside the text.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType

from .common import arrow_map, give_back, table, text_or_empty

CACHE_WORDS, CACHE_WORD_BYTES, ROUND_SYMBOLS = 200_000, 64, 2_000_000


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file: itself where printable, else from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, n = {b: chr(b) for b in plain}, 0x100
    for b in range(256):
        if b not in out:
            out[b] = chr(n)
            n += 1
    return [out[b] for b in range(256)]


#: The fixed pattern by which the file's pre-tokenizer cuts words, and what it comes to on ASCII, which `re` scans twice as fast.
#: The regex module may know a later Unicode than the file's library: characters new since Unicode 16 can be cut in another place.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")


def cut_words(text: str) -> list[str]:
    return (ASCII_WORDS if text.isascii() else WORDS).findall(text)


class ByteBPE:
    """Encoder and decoder for a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        alphabet = byte_alphabet()
        back = {c: b for b, c in enumerate(alphabet)}
        size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.token_bytes = [b""] * size
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(back[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for text, i in self.special.items():
            self.token_bytes[i] = text.encode()
        self.byte_ids = np.array([vocab[c] for c in alphabet], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.split = regex.compile("(" + "|".join(regex.escape(x) for x in sorted(self.special, key=len, reverse=True)) + ")").split if self.special else lambda t: [t]
        self.cache: dict[str, bytes] = {}

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids (little-endian 32-bit) of each word."""
        out: list[bytes] = [b""] * len(words)
        i = 0
        while i < len(words):
            j, total = i, 0
            while j < len(words) and (j == i or total + len(words[j]) <= ROUND_SYMBOLS):
                total += len(words[j])
                j += 1
            self._merge(words[i:j], out, i)
            i = j
        return out

    def _merge(self, words: list[bytes], out: list[bytes], base: int) -> None:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), lengths)
        none = len(self.keys)
        rank = np.full(len(symbols), none, np.int64)  # of the pair that starts here
        self._look_up(symbols, owner, rank, np.arange(len(symbols) - 1))
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            low = np.minimum.reduceat(rank, starts)
            counts = np.diff(np.r_[starts, len(symbols)])
            if (over := low == none).any():  # these words are done
                ids = symbols.astype("<u4").tobytes()
                for s, n, w in zip((4 * starts[over]).tolist(), (4 * counts[over]).tolist(), owner[starts[over]].tolist(), strict=True):
                    out[base + w] = ids[s : s + n]
                stay = np.repeat(~over, counts)
                symbols, owner, rank = symbols[stay], owner[stay], rank[stay]
                low, counts = low[~over], counts[~over]
                if not len(symbols):
                    return
            chosen = rank == np.repeat(low, counts)
            at = np.flatnonzero(chosen)
            if len(at) > 1:  # of a run of overlapping pairs every other one
                fresh = np.r_[True, np.diff(at) > 1]
                run = np.cumsum(fresh) - 1
                at = at[(at - at[fresh][run]) % 2 == 0]
            symbols[at] = self.made[rank[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, owner, rank = symbols[keep], owner[keep], rank[keep]
            at -= np.arange(len(at))  # each merge before has taken one symbol away
            rank[at] = none
            # only pairs with a merged symbol are new
            self._look_up(symbols, owner, rank, np.concatenate([at[at + 1 < len(symbols)], at[at > 0] - 1]))

    def _look_up(self, symbols: np.ndarray, owner: np.ndarray, rank: np.ndarray, at: np.ndarray) -> None:
        """Set the ranks of the pairs that start at these positions, by binary search over the sorted pair keys."""
        key = symbols[at] << 32 | symbols[at + 1]
        found = np.searchsorted(self.keys, key)
        found[found == len(self.keys)] = 0
        hit = (self.keys[found] == key) & (owner[at] == owner[at + 1])
        rank[at] = np.where(hit, self.ranks[found], len(self.keys))

    def encode_batch(self, texts: Iterable[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        found, seen = [], set()
        for t in texts:
            parts = []
            for k, piece in enumerate(self.split(t)):
                if k % 2:
                    parts.append(piece)  # a special token, which no word equals as a part of odd place
                elif piece:
                    parts.append(w := cut_words(piece))
                    seen.update(w)
            found.append(parts)
        new = list(seen.difference(self.cache))
        if len(self.cache) + len(new) > CACHE_WORDS:  # start again from the words of this batch
            self.cache = {w: b for w, b in self.cache.items() if w in seen}
        known = self.cache
        known.update(zip(new, self.merge([x.encode("utf-8") for x in new]), strict=True))
        ids = known.__getitem__
        out = [b"".join([self.special[p].to_bytes(4, "little") if isinstance(p, str) else b"".join(map(ids, p)) for p in parts]) for parts in found]
        if len(known) > CACHE_WORDS:
            self.cache = {}
        else:
            for w in new:
                if len(known[w]) > 4 * CACHE_WORD_BYTES:
                    del known[w]
        return out

    def decode(self, ids: bytes) -> str:
        table_ = self.token_bytes
        return b"".join([table_[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


_LOADED: dict[str, ByteBPE] = {}


def load(path: str) -> ByteBPE:
    """One tokenizer a worker process."""
    if path not in _LOADED:
        _LOADED[path] = ByteBPE(path)
    return _LOADED[path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _slices(texts: list[str], chars: int = 1_000_000):
    """Consecutive parts of a batch of up to so many characters together, at least one text each."""
    i = 0
    while i < len(texts):
        j, n = i, 0
        while j < len(texts) and (j == i or n + len(texts[j]) <= chars):
            n += len(texts[j])
            j += 1
        yield texts[i:j]
        i = j


def encode(docs: DataFrame, text: str = "text", *, columns: list[str] | None = None, path: str | None = None) -> DataFrame:
    """docs, or of it the given columns, plus token_ids (array<int>) and n_tokens (long).

    Null texts are as empty: no ids. Columns of those names are replaced. Leaving the text out of `columns` keeps it
    from being sent to the workers twice and back again.
    """
    where = path or default_path()
    keep = [c for c in (docs.columns if columns is None else columns) if c not in ("token_ids", "n_tokens")]
    base = docs.select(*keep, text_or_empty(text).alias("__text"))
    schema = StructType(base.schema.fields[:-1]).add("token_ids", ArrayType(IntegerType())).add("n_tokens", LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(where)
        for batch in batches:
            at = 0
            for part in _slices(batch["__text"].to_pylist()):  # a part's ids leave before the next part's are made
                ids = bpe.encode_batch(part)
                counts = np.array([len(x) // 4 for x in ids], np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(np.frombuffer(b"".join(ids), "<i4")))
                rows = batch.slice(at, len(part))
                yield pa.RecordBatch.from_arrays([*[rows[c] for c in keep], lists, pa.array(counts)], names=[*keep, "token_ids", "n_tokens"])
                at += len(part)
        give_back()

    return base.mapInArrow(run, schema)


def decode(docs: DataFrame, ids: str = "token_ids", to: str = "decoded", *, path: str | None = None) -> DataFrame:
    """docs plus the text of an array of ids; null gives null, ids out of range fail."""
    where = path or default_path()

    def run(lists: pa.Array) -> pa.Array:
        bpe = load(where)
        return pa.array([None if x is None else bpe.decode(np.asarray(x, "<u4").tobytes()) for x in lists.to_pylist()], pa.string())

    return docs.withColumn(to, F.arrow_udf(run, "string")(F.col(ids)))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, encoded and decoded. Null and empty texts have no tokens; repeated rows and null ids each give their row, an empty table none."""
    where = default_path()

    def digest(batch):
        bpe = load(where)
        out = {k: [] for k in ("n_tokens", "ids_sha256", "decoded_sha256")} | {"doc_id": batch["doc_id"]}
        for part in _slices(batch["text"].to_pylist()):
            for ids in bpe.encode_batch(part):
                out["n_tokens"].append(len(ids) // 4)
                out["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(bpe.decode(ids).encode("utf-8")).hexdigest())
        return out

    docs = table(spark, sf_dir, "documents").select("doc_id", text_or_empty().alias("text"))
    return arrow_map(docs, digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
