import corpus_pipeline
from vitrine.llm import bpe, minhash, secrets
from vitrine.llm.common import materialize


def test_stages_one_by_one(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf), "stage")
        kept[name] = docs
        if name != "bpe":
            assert docs.columns == columns
    left = {r.doc_id: r.text for r in kept["toxicity"].collect()}
    once = {r.doc_id for r in kept["near_dedup"].collect()}
    assert len(once) == kept["near_dedup"].count() and once <= set(left)
    assert once == {r.doc_id for r in minhash.near_duplicates(kept["toxicity"]).where("kept").collect()}
    masked = {r.doc_id: r.text for r in kept["secrets"].collect()}
    assert set(masked) == once and all(masked[i] == secrets.redact(left[i], secrets.scan(left[i])) for i in once)
    coder = bpe.load(bpe.default_path())
    rows = kept["bpe"].collect()
    assert len(rows) == kept["mixing"].count()
    for r in rows:
        assert coder.encode_batch([masked[r.doc_id]])[0] == b"".join(x.to_bytes(4, "little") for x in r.token_ids) and r.n_tokens == len(r.token_ids)
