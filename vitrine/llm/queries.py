"""The queries of this subpackage and their SQL, where SQL can express them."""

from . import bpe, chat, media, minhash, mixing, neighbours, resampling, secrets, sessions, suffix, topk, toxicity, urls


def queries():
    return {
        "op1_topk": topk.op1_topk,
        "op2_secrets": secrets.op2_secrets,
        "op3_toxicity": toxicity.op3_toxicity,
        "op4_mpegts": media.op4_mpegts,
        "op5_suffix": suffix.op5_suffix,
        "op6_mix": mixing.op6_mix,
        "op7_bpe": bpe.op7_bpe,
        "op8_minhash": minhash.op8_minhash,
        "op9_urls": urls.op9_urls,
        "op10_chat": chat.op10_chat,
        "op11_sessions": sessions.op11_sessions,
        "op12_resample": resampling.op12_resample,
        "op13_neighbours": neighbours.op13_neighbours,
    }


def oracle_sql():
    return {
        "op1_topk": topk.ORACLE,
        "op6_mix": mixing.ORACLE,
        "op8_minhash": minhash.ORACLE,
        "op9_urls": urls.ORACLE,
        "op10_chat": chat.ORACLE,
        "op11_sessions": sessions.ORACLE,
        "op12_resample": resampling.ORACLE,
    }
