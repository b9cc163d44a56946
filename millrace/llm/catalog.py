"""The operators' queries and their DuckDB SQL."""

from __future__ import annotations

from millrace.llm import chat, decontaminate, substrings, warc
from millrace.llm.decontaminate import op10_decontamination
from millrace.llm.html import op1_html
from millrace.llm.media import op7_media
from millrace.llm.simhash import op3_simhash
from millrace.llm.spm import op2_sentencepiece
from millrace.llm.substrings import op5_substrings
from millrace.llm.toxicity import op4_toxicity
from millrace.llm.urls import op8_urls
from millrace.llm.warc import op9_warc

QUERIES = {
    "op1_html": op1_html,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_simhash": op3_simhash,
    "op4_toxicity": op4_toxicity,
    "op5_substrings": op5_substrings,
    "op6_preferences": chat.op6_preferences,
    "op7_media": op7_media,
    "op8_urls": op8_urls,
    "op9_warc": op9_warc,
    "op10_decontamination": op10_decontamination,
}
ORACLES: dict[str, str] = {
    "op5_substrings": substrings.ORACLE,
    "op6_preferences": chat.ORACLE,
    "op9_warc": warc.ORACLE,
    "op10_decontamination": decontaminate.ORACLE,
}
