"""Registered queries of this subpackage, by name, and their SQL twins."""

from __future__ import annotations

from tillscope.llm import (
    collocations, crosspolytope, decontam, lm, mixing, nbsvm, pii, quotes, repair, simhash, toxicity, urls, warc,
)

LLM_QUERIES = {
    "op1_mixing": mixing.query,
    "op2_quality": nbsvm.query,
    "op3_warc": warc.query,
    "op4_pii": pii.query,
    "op5_quotations": quotes.query,
    "op6_toxicity": toxicity.query,
    "op7_language_model": lm.query,
    "op8_decontamination": decontam.query,
    "op9_embeddings": crosspolytope.query,
    "op10_simhash": simhash.query,
    "op11_conversation_repair": repair.query,
    "op12_url_filter": urls.query,
    "op13_collocations": collocations.query,
}

LLM_ORACLES = {
    "op5_quotations": quotes.ORACLE,
    "op13_collocations": collocations.ORACLE,
}
