"""The ids that stages of the pipeline keep, against small versions that share no code with them."""

import hashlib
import math
import re
from collections import Counter

import pytest

import corpus_pipeline
from tests.llm.test_oracles import brute_components
from vitrine.llm import toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_toxicity_stage(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.train(docs, labels.select("doc_id", "toxic"))

    def severity(text):
        words = re.findall(r"[^\W_]+", (text or "").lower())
        z = sum(model.weights.get(w, 0.0) * math.log(1 + n * 1000 / len(words)) for w, n in Counter(words).items())
        return sum(1 / (1 + math.exp(c - z)) for c in model.thresholds)

    texts = {r.doc_id: r.text for r in docs.collect()}
    toxic = {i: max(r.toxic for r in labels.collect() if r.doc_id == i and r.toxic is not None) for i in {r.doc_id for r in labels.collect() if r.toxic is not None} if texts.get(i) is not None}
    s = {i: severity(texts[i]) for i in toxic}
    levels = sorted({round(x, 9) for x in s.values()}, reverse=True)
    best = lambda cut: 2 * sum(toxic[i] for i in s if s[i] >= cut) / (sum(x >= cut for x in s.values()) + sum(toxic.values()))
    cuts = [(a + b) / 2 for a, b in zip(levels, levels[1:])]
    if model.weights:
        assert abs(best(model.cut) - max(map(best, cuts))) < 1e-9 and all(abs(x - model.cut) > 1e-10 for x in levels)
    else:
        assert model.cut == math.inf
    assert {r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs, SF).collect()} == {i for i, t in texts.items() if severity(t) < model.cut}


def test_near_dedup_stage(spark, docs):
    found = brute_components([(r.doc_id, r.text) for r in docs.collect()], 5)
    got = [r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, SF).collect()]
    assert sorted(got) == sorted(i for i, (_, _, stays) in found.items() if stays) and len(got) < len(found)


def test_mixing_stage(spark, docs):
    """Weighted queues by hand: two rounds of each source in order of hash, served by finish time."""
    rows = [(r.doc_id, r.source, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))) for r in docs.collect()]
    size = Counter()
    for _, s, n in rows:
        size[s] += n
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(size, key=lambda s: (s is None, s or "")))}
    budget, open_, target = 1.5 * sum(size.values()), set(size), {}
    while open_:
        level = (budget - sum(target.values())) / sum(weight[s] for s in open_)
        full = {s for s in open_ if 2 * size[s] < level * weight[s]}
        target |= {s: 2.0 * size[s] for s in full} if full else {s: level * weight[s] for s in open_}
        open_ = open_ - full if full else set()
    queue = []
    for source in size:
        done = 0
        for e in range(2):
            for i, _, n in sorted((r for r in rows if r[1] == source), key=lambda r: hashlib.md5(f"mix:{r[0]}".encode()).hexdigest()):
                done += n
                if n:
                    queue.append((done / target[source], e, i, n))
    want, spent = Counter(), 0
    for _, _, i, n in sorted(queue):
        spent += n
        if spent > math.floor(sum(target.values()) + 0.5):
            break
        want[i] += 1
    assert Counter(r.doc_id for r in corpus_pipeline.mix_sources(spark, docs, SF).collect()) == want
