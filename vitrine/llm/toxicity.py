"""Operator 3, toxicity: cumulative-link ordinal regression over sparse word features.

P(grade <= j | x) = sigmoid(c_j - w.x): one weight vector shared by all thresholds c_0 < c_1 < ..., so the
grades are ordered by construction; the expected severity is sum over j of P(grade > j). Features are
the words of a bounded vocabulary, those whose presence differs between grade 0 and the others beyond
chance (MIN_Z); a feature's value is log(1 + occurrences in a thousand words).

Grades: the labels table knows toxic and not. A toxic document is graded 2 (severe) where the share of
its words that mark toxic documents (by smoothed log odds over the training rows) is above the median of the
toxic rows, else 1 (mild); others 0. Callers with graded labels pass them as they are.

Fit: on a documented bounded sample, the MAX_TRAIN labelled documents with the least hash of their id, and of each the counts of
a vocabulary of at most MAX_WORDS words. Scoring covers every row and whole texts, in one pass without a
shuffle. The model that is sent to the workers is bounded by MAX_WORDS.
"""

from __future__ import annotations

import math
import re
import sys
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, discard, materialize, table, text_or_empty

MAX_TRAIN, MAX_WORDS, MIN_DOCS, MIN_Z, MAX_TRAIN_CHARS = 4_000, 2_000, 3, 5.0, 50_000_000
MAX_TEXT_CHARS = 1_000_000
TOKEN = re.compile(r"[^\W_]+")


def words(text: str) -> Counter:
    return Counter(TOKEN.findall(text.lower()))


@dataclass
class OrdinalModel:
    """weights by word, and thresholds in rising order; severity = expected grade."""

    weights: dict[str, float]
    thresholds: list[float]
    cut: float  # expected severity from which a document counts as toxic

    def severity(self, text: str) -> float:
        return self.severity_of(words(text))

    def severity_of(self, counts: Counter) -> float:
        get, per = self.weights.get, 1000.0 / max(1, sum(counts.values()))
        z = 0.0
        for word, n in counts.items():
            w = get(word)
            if w is not None:
                z += w * math.log1p(n * per)
        return sum(1.0 / (1.0 + math.exp(max(-30.0, min(30.0, c - z)))) for c in self.thresholds)


def telling_words(counts: list[Counter], grades: np.ndarray) -> list[str]:
    """The words whose share of documents differs most between grade 0 and the others, by z score, at most MAX_WORDS."""
    n1 = int((grades > 0).sum())
    n0 = len(grades) - n1
    if not n0 or not n1:
        return []
    df = [Counter(), Counter()]
    for c, g in zip(counts, grades, strict=True):
        df[int(g > 0)].update(c.keys())
    z = {}
    for w in df[0].keys() | df[1].keys():
        a, b = df[1][w], df[0][w]
        if a + b >= MIN_DOCS:
            p = (a + b) / (n0 + n1)
            z[w] = abs(a / n1 - b / n0) / math.sqrt(p * (1 - p) * (1 / n0 + 1 / n1) + 1e-12)
    return [w for w, x in sorted(z.items(), key=lambda x: (-x[1], x[0])) if x >= MIN_Z][:MAX_WORDS]


def fit_ordinal(counts: list[Counter], grades: np.ndarray, *, l2: float = 3e-4, steps: int = 400) -> OrdinalModel:
    """Fit by full-batch Adam on the cumulative-link likelihood. Grades 0..K-1; one grade only: a model that always gives it."""
    vocabulary = telling_words(counts, grades)
    at = {w: i for i, w in enumerate(vocabulary)}
    rows, cols, vals = [], [], []
    for r, c in enumerate(counts):
        per = 1000.0 / max(1, sum(c.values()))
        x = [(at[w], math.log1p(n * per)) for w, n in c.items() if w in at]
        rows.append(np.full(len(x), r, np.int64))
        cols.append(np.array([i for i, _ in x], np.int64))
        vals.append(np.array([v for _, v in x], np.float64))
    rows, cols, vals = (np.concatenate(a) if a else np.empty(0) for a in (rows, cols, vals))
    n, top = len(counts), int(grades.max()) if len(grades) else 0
    if n == 0 or top == 0:
        return OrdinalModel({}, [], 0.5)
    share = np.array([(grades <= j).mean() for j in range(top)]).clip(1e-3, 1 - 1e-3)
    first = np.log(share / (1 - share))
    theta = np.concatenate([np.zeros(len(vocabulary)), first[:1], np.log(np.diff(first).clip(1e-2))])  # gaps by exp keep the order
    v = len(vocabulary)
    m, s = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        w, c = theta[:v], np.concatenate([theta[v : v + 1], theta[v] + np.cumsum(np.exp(theta[v + 1 :]))])
        z = np.bincount(rows, w[cols] * vals, n) if len(rows) else np.zeros(n)
        bounds = np.concatenate([[-np.inf], c, [np.inf]])
        sig = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
        up, lo = sig(bounds[grades + 1] - z), sig(bounds[grades] - z)
        up, lo = np.where(grades == top, 1.0, up), np.where(grades == 0, 0.0, lo)
        p = np.clip(up - lo, 1e-12, None)
        du, dl = up * (1 - up) / p, lo * (1 - lo) / p
        gz = (du - dl) / n  # d(-log p)/dz
        gc = np.zeros(top)
        for j in range(top):
            gc[j] = (-du[grades == j].sum() + dl[grades == j + 1].sum()) / n
        tail = np.cumsum(gc[::-1])[::-1]
        g = np.concatenate([np.bincount(cols, gz[rows] * vals, v) + l2 * w, tail[:1], tail[1:] * np.exp(theta[v + 1 :])])
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        theta -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
    w, c = theta[:v], np.concatenate([theta[v : v + 1], theta[v] + np.cumsum(np.exp(theta[v + 1 :]))])
    return OrdinalModel({x: float(y) for x, y in zip(vocabulary, w, strict=True) if abs(y) > 1e-6}, [float(x) for x in c], 0.5)


def grade_toxic(counts: list[Counter], toxic: np.ndarray) -> np.ndarray:
    """0 not toxic; toxic: 2 where the share of marking words is above the toxic rows' median, else 1."""
    n = [max(1, int((toxic == k).sum())) for k in (0, 1)]
    df = [Counter(w for c, t in zip(counts, toxic, strict=True) if t == k for w in c) for k in (0, 1)]
    odds = {w: np.log((k + 0.5) / n[1]) - np.log((df[0][w] + 0.5) / n[0]) for w, k in df[1].items() if k >= MIN_DOCS}
    marks = {w for w, o in odds.items() if o > 1.5}
    share = np.array([sum(k for w, k in c.items() if w in marks) / max(1, sum(c.values())) for c in counts])
    median = float(np.median(share[toxic == 1])) if (toxic == 1).any() else 0.0
    return np.where(toxic == 0, 0, np.where(share > median, 2, 1)).astype(np.int64)


def train(docs: DataFrame, labels: DataFrame, *, max_train: int = MAX_TRAIN) -> OrdinalModel:
    """Model from documents (doc_id, text) and labels (doc_id, toxic, or grade 0..K-1): the max_train labelled documents of least hash.

    Null labels and texts are left out; a document with several labels takes the largest. Where no word tells toxic
    documents from others (always with fewer than MIN_Z ** 2 = 25 of them), no document is called toxic. Documents with a text of over
    MAX_TEXT_CHARS are left out too, and the next in hash order take their place. The sampled texts together are
    taken in hash order up to MAX_TRAIN_CHARS, so what reaches the driver is bounded.
    """
    graded = "grade" in labels.columns
    target = "grade" if graded else "toxic"
    y = labels.where(F.col(target).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(F.col(target).cast("int")).alias("y"))
    texts = docs.select("doc_id", "text").where("text is not null")
    y = y.join(texts.where(F.length("text") > MAX_TEXT_CHARS).select("doc_id"), "doc_id", "left_anti")
    sample = y.withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(max_train)
    got = texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(F.min("h").alias("h"), F.min("y").alias("y"), F.min("text").alias("text"))
    got = materialize(got, "training")
    sizes = got.select("h", "doc_id", F.length("text").alias("chars")).toArrow().sort_by([("h", "ascending"), ("doc_id", "ascending")])  # max_train rows
    fit = int((np.cumsum(sizes["chars"].to_numpy()) <= MAX_TRAIN_CHARS).sum())
    if fit:
        upto = F.struct(*[F.lit(int(sizes[c][fit - 1].as_py())).alias(c) for c in ("h", "doc_id")])
        used = got.where(F.struct("h", F.col("doc_id").cast("long").alias("doc_id")) <= upto)
    else:
        used = got.limit(0)
    counted = arrow_map(used, _counts, "doc_id long, h long, y int, words array<string>, n array<int>")
    local = counted.toArrow().combine_chunks()  # bounded by max_train and MAX_TRAIN_CHARS
    discard(got)
    ids, hashes = local["doc_id"].to_pylist(), local["h"].to_pylist()
    counts, grades = [], []
    for i in sorted(range(local.num_rows), key=lambda i: (hashes[i], ids[i])):
        counts.append(Counter(dict(zip(map(sys.intern, local["words"][i].as_py()), local["n"][i].as_py(), strict=True))))
        grades.append(local["y"][i].as_py())
    grades = np.array(grades, np.int64)
    if not graded:
        grades = grade_toxic(counts, grades) if len(grades) else grades
    model = fit_ordinal(counts, grades)
    model.cut = _cut(model, counts, grades)
    return model


def _counts(batch):
    c = [words(t) for t in batch["text"].to_pylist()]
    return {"doc_id": batch["doc_id"], "h": batch["h"], "y": batch["y"], "words": [list(x) for x in c], "n": [list(x.values()) for x in c]}


def _cut(model: OrdinalModel, counts: list[Counter], grades: np.ndarray) -> float:
    """The severity from which training documents are toxic rather than not: the cut with the best F1 between two different severities.

    Documents of one severity (all without a telling word have the same) are on one side of it; it lies midway between
    neighbours. Infinite, so that nothing is toxic, where no word tells or no cut has a toxic document above it.
    """
    if not model.weights or not len(grades):
        return float("inf")
    s = np.array([model.severity_of(c) for c in counts])
    o = np.argsort(-s, kind="stable")
    s, hit = s[o], np.cumsum(grades[o] > 0)
    ends = np.flatnonzero(s[:-1] > s[1:])  # the last row of each run of equal severity but the lowest
    f1 = 2 * hit[ends] / (ends + 1 + hit[-1])
    if not len(ends) or not f1.max() > 0:
        return float("inf")
    k = int(ends[f1.argmax()])
    middle = (s[k] + s[k + 1]) / 2
    return float(middle if middle > s[k + 1] else s[k])  # of neighbouring floats the middle is one of them


def score(docs: DataFrame, model: OrdinalModel, text: str = "text") -> DataFrame:
    """docs plus expected_severity (double), grade (int, the most probable number of thresholds passed) and toxic (boolean).

    Null and empty texts have the features of no word: the thresholds alone decide. Input columns of those names are replaced.
    """
    sent = model

    keep = [c for c in docs.columns if c not in ("expected_severity", "grade", "toxic")]

    def severities(texts: pa.Array) -> pa.Array:
        return pa.array([sent.severity(t) for t in texts.to_pylist()], pa.float64())

    out = docs.select(keep).withColumn("expected_severity", F.arrow_udf(severities, "double")(text_or_empty(text)))
    return out.withColumns({"grade": F.round("expected_severity").cast("int"), "toxic": F.col("expected_severity") >= F.lit(sent.cut)})


def keep_clean(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """The documents below the model's cut; columns as before, whatever their names. Null and empty texts are judged as texts without words."""
    packed = docs.select(F.struct("*").alias("row"), "text")
    return score(packed, model).where("not toxic").select("row.*")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, scored by a model of their labels; a row for each row of the table, no rows for an empty one."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return score(docs, model).select("doc_id", "expected_severity", "grade", "toxic")
