"""Queries of the training-data operators and the SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from voltframe.llm import ann, decontaminate, divergence, htmltext, jaccard, language, mixing, pii, quality, tokenalign, topk, urlfilter, warc

QUERIES = {
    "op1_quality": quality.query,
    "op2_decontaminate": decontaminate.query,
    "op3_pii": pii.query,
    "op4_mixing": mixing.query,
    "op5_language": language.query,
    "op6_html": htmltext.query,
    "op7_ann": ann.query,
    "op8_jaccard": jaccard.query,
    "op9_urls": urlfilter.query,
    "op10_warc": warc.query,
    "op11_tokenalign": tokenalign.query,
    "op12_divergence": divergence.query,
    "op13_topk": topk.query,
    "pipeline": corpus_pipeline.run,
}

#: The others hold a classifier, a permutation, raking or a search; tests/llm checks them by brute
#: force, round trip or held-out accuracy.
ORACLE: dict[str, str] = {
    "op2_decontaminate": decontaminate.ORACLE_SQL,
    "op8_jaccard": jaccard.ORACLE_SQL,
    "op10_warc": warc.ORACLE_SQL,
    "op12_divergence": divergence.ORACLE_SQL,
    "op13_topk": topk.ORACLE_SQL,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
