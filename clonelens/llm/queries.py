"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import chat, collocations, decontaminate, manifest, media, mixing, ngram_join, pfor, piece_bpe, secrets, sharding, toxicity, warc


def queries() -> dict:
    return {
        "op1_toxicity": toxicity.op1_toxicity,
        "op2_secrets": secrets.op2_secrets,
        "op4_chat": chat.op4_chat,
        "op3_token_blocks": pfor.op3_token_blocks,
        "op5_ngram_join": ngram_join.op5_ngram_join,
        "op6_decontamination": decontaminate.op6_decontamination,
        "op7_mixing": mixing.op7_mixing,
        "op8_sharding": sharding.op8_sharding,
        "op9_warc": warc.op9_warc,
        "op10_media": media.op10_media,
        "op11_collocations": collocations.op11_collocations,
        "op12_manifest": manifest.op12_manifest,
        "op13_byte_bpe": piece_bpe.op13_byte_bpe,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_secrets": secrets.OP2_SQL,
        "op4_chat": chat.OP4_SQL,
        "op5_ngram_join": ngram_join.OP5_SQL,
        "op6_decontamination": decontaminate.OP6_SQL,
        "op7_mixing": mixing.OP7_SQL,
        "op8_sharding": sharding.OP8_SQL,
        "op9_warc": warc.OP9_SQL,
        "op11_collocations": collocations.OP11_SQL,
        "op12_manifest": manifest.OP12_SQL,
    }
