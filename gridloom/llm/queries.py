"""Queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from . import blocks, chat, decontam, hmm, kneser, langid, neardup, packing, partenum, warc

QUERIES = {
    "op1_warc": warc.query,
    "op2_hmm_score": hmm.query,
    "op3_html_extraction": blocks.query,
    "op4_decontamination": decontam.query,
    "op5_ngram_jaccard": partenum.query,
    "op6_chat_format": chat.query,
    "op7_language_id": langid.query,
    "op8_best_fit_packing": packing.query,
    "op9_quality_kneser_ney": kneser.query,
    "op10_embedding_neardup": neardup.query,
}

ORACLE = {
    "op4_decontamination": decontam.ORACLE,
    "op6_chat_format": chat.ORACLE,
}
