"""The registered queries of this folder and their oracle SQL."""

from __future__ import annotations

from . import capfilter, conversations, decontaminate, extract, jaccard, language, lines, mixing, personal, resample, search, toxicity, warc

QUERIES = {
    "op1_lines": lines.op1_lines,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_extract": extract.op3_extract,
    "op4_decontaminate": decontaminate.op4_decontaminate,
    "op5_search": search.op5_search,
    "op6_language": language.op6_language,
    "op7_jaccard": jaccard.op7_jaccard,
    "op8_warc": warc.op8_warc,
    "op9_mixing": mixing.op9_mixing,
    "op10_personal": personal.op10_personal,
    "op11_conversations": conversations.op11_conversations,
    "op12_resample": resample.op12_resample,
    "op13_embeddings": capfilter.op13_embeddings,
}

SQL = {
    "op4_decontaminate": decontaminate.SQL,
    "op7_jaccard": jaccard.SQL,
    "op9_mixing": mixing.SQL,
    "op10_personal": personal.SQL,
    "op11_conversations": conversations.SQL,
    "op12_resample": resample.SQL,
}
