"""Operator 12, importance resampling towards a target distribution, by a dictionary of distinct features.

A document's features are its n-grams of words, repeats counted. Each distinct n-gram string is counted over the whole corpus and hashed
once, into one of a fixed number of buckets; a bucket's gain is the log ratio of its smoothed share in the target texts to that in the
corpus. The gains go back to the strings and meet the documents' own counts; a document's weight is their sum, and the documents with the
highest weights plus Gumbel noise are drawn: a sample without replacement in proportion to importance.

Scale: one pass counts features a block of documents. A block has at most BLOCK_DOCS documents and BLOCK_BYTES of texts, or a single longer text.
What is shuffled is one row (block, feature), so a feature that every document has is one row a block, not one a document, and no
key is hot. It meets the dictionary by feature and goes back, as a number, to its block, whose documents' own counts lie there as bytes, about two
for a document's feature. Texts are read once. The only thing broadcast is the table of buckets, BUCKETS rows whatever the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.report import ranked
from .common import discard, give_back, materialize, table

BUCKETS = 10_000
NGRAM = 1
PERCENT, LEAST_WORDS, SEED = 10, 20, 2024
BLOCK_DOCS, BLOCK_BYTES = 16_384, 12_000_000

#: Fixed value: the bytes of words, ASCII letters and digits and all bytes beyond ASCII, after A-Z are lower-cased.
WORD_BYTES = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IN_WORD = np.isin(np.arange(256), np.frombuffer(WORD_BYTES, np.uint8))

COUNTS_SCHEMA = "block long, feature string, n long, place int, held array<binary>"


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, one after another, and the place of each one's text. Null texts have none."""
    raw = texts.fill_null("").cast(pa.large_binary())
    bounds = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    data = LOWER[np.frombuffer(raw.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]]
    bounds = bounds - bounds[0]
    inside = IN_WORD[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    edges = bounds[:-1][bounds[:-1] < bounds[1:]]
    opens[edges] = inside[edges]  # a word ends with its text
    start = np.flatnonzero(opens)
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | opens[1:]
    offsets = np.append(0, np.cumsum(np.flatnonzero(closes) + 1 - start)).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
    return words, np.searchsorted(bounds, start, "right") - 1


def _features(texts: pa.Array, n: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The n-grams of 1 to n words of the texts, the place of each one's text, and the texts' numbers of words."""
    words, of = _words(texts)
    grams, places = [words], [of]
    for k in range(2, n + 1):
        at = np.flatnonzero(of[: len(of) - k + 1] == of[k - 1 :]) if len(of) >= k else np.zeros(0, np.int64)
        grams.append(pc.binary_join_element_wise(*[words.take(pa.array(at + i)) for i in range(k)], pa.scalar(b" ", pa.large_binary())))
        places.append(of[at])
    return pa.concat_arrays(grams), np.concatenate(places), np.bincount(of, minlength=len(texts))


def _pack(doc: np.ndarray, count: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and counts as bytes, two a step: how far the place moves on, how much is added there. Larger moves and counts take several steps.

    doc, count: sorted by feature, then place; first: where a feature begins. Also returns where its steps begin."""
    move = doc.copy()
    move[1:] -= doc[:-1]
    move[first] = doc[first]
    moves, adds = move // 255, np.maximum(1, -(-count // 255))
    steps = moves + adds
    ends = np.cumsum(steps)
    within = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - steps, steps)
    moving = within < np.repeat(moves, steps)
    at = within - np.repeat(moves, steps)
    moved = np.where(moving, 255, np.where(at == 0, np.repeat(move % 255, steps), 0))
    added = np.where(moving, 0, np.minimum(255, np.repeat(count, steps) - 255 * at))
    return moved.astype(np.uint8), added.astype(np.uint8), (ends - steps)[first]


def _block(name: int, ids: pa.Array, texts: pa.Array, n: int) -> pa.RecordBatch:
    """Rows of COUNTS_SCHEMA of one block of documents."""
    grams, of, words = _features(texts, n)
    coded = grams.dictionary_encode()
    key, count = np.unique(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(texts) + of, return_counts=True)
    feature, doc = np.divmod(key, max(1, len(texts)))
    first = np.flatnonzero(np.diff(feature, prepend=-1))
    moved, added, begin = _pack(doc, count, first)
    total = np.add.reduceat(count, first) if len(first) else np.zeros(0, np.int64)
    marked = np.stack([ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False)], axis=1)
    sizes = np.stack([np.bincount(of, minlength=len(texts)), words], axis=1)
    held = [marked.astype("<i8").tobytes(), sizes.astype("<i8").tobytes(), np.diff(np.append(begin, len(moved))).astype("<u4").tobytes(), moved.tobytes(), added.tobytes()]
    columns = [
        pa.array(np.full(len(first) + 1, name)),
        pa.concat_arrays([coded.dictionary.cast(pa.large_string()), pa.nulls(1, pa.large_string())]).cast(pa.string()),
        pa.array(np.append(total, 0)),
        pa.array(np.arange(len(first) + 1, dtype=np.int32)),
        pa.concat_arrays([pa.nulls(len(first), pa.list_(pa.binary())), pa.array([held], pa.list_(pa.binary()))]),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["block", "feature", "n", "place", "held"])


def block_counts(docs: DataFrame, n: int = NGRAM) -> DataFrame:
    """(block, feature, n, place, held) of docs (doc_id long, text string), and a row with a null feature a block.

    n is how often the block has the feature, place numbers the block's features from 0. The row without a feature holds the block's documents:
    ids with marks of null ones, numbers of features and words, and for each feature in order its documents and counts as _pack has them.
    Blocks are named by the task that made them, so the rows must be written before they are used: a second run may cut them otherwise.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held, chars = TaskContext.get().partitionId() << 32, [], 0

        def block() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held).combine_chunks()
            return _block(name, whole.column(0).combine_chunks(), whole.column(1).combine_chunks(), n)

        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            at = 0
            while at < batch.num_rows:
                fits = np.searchsorted(np.cumsum(sizes[at:], dtype=np.int64), BLOCK_BYTES - chars, "right") + (not held)
                some = int(min(max(fits, 0), BLOCK_DOCS - sum(x.num_rows for x in held), batch.num_rows - at))
                if some:
                    held.append(batch.slice(at, some))
                    chars += int(sizes[at : at + some].sum())
                    at += some
                if at < batch.num_rows:  # full
                    yield block()
                    name, held, chars = name + 1, [], 0
        if held:
            yield block()
        give_back()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, COUNTS_SCHEMA)


def bucket(feature: Column, buckets: int = BUCKETS) -> Column:
    """The bucket of a feature: unsigned crc32 of its UTF-8 bytes, modulo the number of buckets."""
    return F.crc32(feature.cast("binary")) % buckets


def dictionary(counts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(feature, n, bucket): each distinct feature once, with its count over all blocks."""
    return counts.where("feature is not null").groupBy("feature").agg(F.sum("n").alias("n")).select("feature", "n", bucket(F.col("feature"), buckets).alias("bucket"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) for every bucket, from two dictionaries: floor(1000 * ln(((t + 1) * (S + buckets)) / ((s + 1) * (T + buckets)))).

    s and t are the bucket's features in corpus and target, S and T those of all buckets. At most `buckets` rows are gathered anywhere.
    """
    here = corpus.groupBy("bucket").agg(F.sum("n").alias("s"))
    there = target.groupBy("bucket").agg(F.sum("n").alias("t"))
    every = corpus.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
    both = every.join(here, "bucket", "left").join(there, "bucket", "left").na.fill(0, ["s", "t"])
    both = both.crossJoin(F.broadcast(both.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))))  # one row
    up = (F.col("t") + 1).cast("double") * (F.col("all_s") + buckets).cast("double")
    down = (F.col("s") + 1).cast("double") * (F.col("all_t") + buckets).cast("double")
    return both.select("bucket", F.floor(F.lit(1000.0) * F.log(up / down)).cast("long").alias("gain"))


def _block_weights(heads: pa.Table, priced: pa.Table) -> pa.Table:
    """Cogrouped applyInArrow: weights of a block's documents from what it holds and the gains of its features (place, gain)."""
    marked, sizes, steps, moved, added = (x.as_py() for x in heads.column("held")[0])
    marked, sizes = np.frombuffer(marked, "<i8").reshape(-1, 2), np.frombuffer(sizes, "<i8").reshape(-1, 2)
    steps, moved, added = np.frombuffer(steps, "<u4").astype(np.int64), np.frombuffer(moved, np.uint8), np.frombuffer(added, np.uint8)
    gains = np.zeros(len(steps), np.int64)
    gains[priced.column("place").to_numpy()] = priced.column("gain").to_numpy()
    way = np.append(0, np.cumsum(moved, dtype=np.int64))
    doc = way[1:] - np.repeat(way[np.cumsum(steps) - steps], steps)  # each feature's places begin at 0
    weights = np.zeros(len(marked), np.int64)
    np.add.at(weights, doc, np.repeat(gains, steps) * added)
    doc_id = pa.array(marked[:, 0], pa.int64(), mask=marked[:, 1] == 1)
    return pa.table({"doc_id": doc_id, "n_features": sizes[:, 0], "n_words": sizes[:, 1], "weight": weights})


def importance(docs: DataFrame, target: DataFrame, *, n: int = NGRAM, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_features, n_words, weight) of each row of docs (doc_id, text), by its likeness to target (text).

    Null and empty texts have no features and weigh 0. Rows that repeat, as a whole or in their id, are judged one by one; null ids
    come through. More columns are left behind, whatever their names. Without documents there are no rows; without target texts
    every gain compares with an even spread.
    """
    counts = materialize(block_counts(docs, n), "features")
    wanted = materialize(block_counts(target.select(F.lit(0).alias("doc_id"), "text"), n), "target")
    known = materialize(dictionary(counts, buckets), "dictionary")
    gains = bucket_gains(known, dictionary(wanted, buckets), buckets)
    priced = known.select("feature", "bucket").join(F.broadcast(gains), "bucket").select("feature", "gain")  # gains: one row a bucket
    met = counts.where("feature is not null").select("block", "place", "feature").join(priced, "feature").select(F.col("block").alias("of"), "place", "gain")
    heads = counts.where("feature is null").select("block", "held")
    out = materialize(heads.groupBy("block").cogroup(met.groupBy("of")).applyInArrow(_block_weights, "doc_id long, n_features long, n_words long, weight long"), "weights")
    discard(counts, wanted, known)
    return out


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """1000 times a Gumbel variate made of the id, rounded down: h is the first 32 bits of sha256 of `seed:id` (a null id: `seed:`)."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    u = (h.cast("double") + 0.5) / 4294967296.0
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u))).cast("long")


def draw(weights: DataFrame, *, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """weights plus score and rank. Of the N rows with at least least_words words, the floor(percent * N / 100) highest scores get
    ranks from 1; ties go to the smaller doc_id, null ids last. The others' rank is null."""
    scored = weights.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    able = F.col("n_words") >= least_words
    placed = ranked(scored, [~able, -F.col("score"), F.col("doc_id").isNull(), F.col("doc_id")])
    number = scored.where(able).count() * percent // 100
    return placed.withColumn("rank", F.when(able & (F.col("place") <= number), F.col("place"))).drop("place")


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark texts: single words, 10000 buckets, a tenth of those with 20 words or more.

    Null and empty texts weigh 0 and aren't drawn; empty tables give no rows."""
    weights = importance(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("text"))
    return draw(weights).select("doc_id", "n_features", "weight", "score", "rank")


ORACLE = """
with crc_table as (select list_transform(range(256), lambda n: list_reduce(list_concat([n::bigint], range(8)), lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as tbl),
d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words from documents),
b as (select regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words from benchmark),
dw as (select doc_id, w, count(*) as n from (select doc_id, unnest(words) as w from d) group by 1, 2),
bw as (select w, count(*) as n from (select unnest(words) as w from b) group by 1),
strings as (select w, hex(encode(w)) as h from (select w from dw union select w from bw)),
hashed as (select w, xor(list_reduce(list_concat([4294967295::bigint], list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, (2 * i + 1)::bigint, 2))::bigint)),
           lambda c, x: xor(c >> 8, tbl[(xor(c, x) & 255) + 1])), 4294967295) % 10000 as bucket from strings, crc_table),
s as (select bucket, sum(n) as s from dw join hashed using (w) group by 1),
t as (select bucket, sum(n) as t from bw join hashed using (w) group by 1),
both_sides as (select r.range as bucket, coalesce(s, 0)::double as s, coalesce(t, 0)::double as t from range(10000) r left join s on s.bucket = r.range left join t on t.bucket = r.range),
gains as (select bucket, floor(1000.0 * ln(((t + 1) * (sum(s) over () + 10000)) / ((s + 1) * (sum(t) over () + 10000))))::bigint as gain from both_sides),
priced as (select w, gain from hashed join gains using (bucket)),
weights as (select doc_id, sum(n)::bigint as n_features, sum(n * gain)::bigint as weight from dw join priced using (w) group by 1),
scored as (select d.doc_id, coalesce(n_features, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight, coalesce(weight, 0)::bigint +
           floor(-1000.0 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(d.doc_id::varchar, '')), 1, 8))::bigint::double + 0.5) / 4294967296.0)))::bigint as score from d left join weights w on d.doc_id = w.doc_id),
able as (select doc_id, row_number() over (order by score desc, doc_id) as place, count(*) over () as n from scored where n_features >= 20)
select s.doc_id, n_features, weight, score, case when place <= (10 * n) // 100 then place end as rank from scored s left join able a on s.doc_id = a.doc_id
"""
