"""The corpus pipeline: five stages over documents, each of which works on all that its predecessor kept.

Toxic documents go, one document of each group of near copies stays, secrets are masked, sources are
mixed to their target weights (a document that the mix takes twice is there twice), texts are encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vitrine.llm import bpe, minhash, mixing, secrets, toxicity
from vitrine.llm.common import materialize, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity is below the model's cut; the model is fitted on labelled documents of the input.

    Null and empty texts are judged as texts without words; repeated rows are judged alike; null ids have no label. Columns of any
    name come through; an empty table gives none.
    """
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies (five-word shingles, similarity 0.8) the document of least id.

    Nulls, repeated rows and ids and clashing columns as keep_one has them: texts without words are in no group and stay.
    """
    return minhash.keep_one(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with [SECRET] in place of secrets; null texts stay null, repeated rows stay, all columns but text and n_chars as they were."""
    return secrets.redact_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all where its text has no words or is null. Columns of any name come through."""
    return mixing.mix_documents(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens and token_ids of each row; null and empty texts have no tokens, other columns are left behind."""
    return bpe.encode(docs, columns=["doc_id", "source"]).select("doc_id", "source", "n_tokens", "token_ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("bpe", encode_texts),
]

#: SQL can express neither the classifier nor the tokenizer; tests/llm/test_stages.py holds what toxicity, near_dedup and mixing keep
#: against versions of its own, test_by_hand.py the secrets, test_oracles.py the encoder against another library.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
