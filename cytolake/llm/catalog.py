"""Registered queries of the training-data operators and, where SQL can say them, their DuckDB twins."""

from __future__ import annotations

from corpus_pipeline import ORACLE_SQL, run
from cytolake.llm.bpe import op5_byte_bpe
from cytolake.llm.chat import OP7_SQL, op7_chat
from cytolake.llm.langid import op9_language_id
from cytolake.llm.license import op3_license_scan
from cytolake.llm.media import op8_media
from cytolake.llm.minhash import op10_near_duplicates
from cytolake.llm.packing import op1_packing
from cytolake.llm.quality import op2_quality
from cytolake.llm.suffix import op4_suffix_dedup
from cytolake.llm.warc import OP6_SQL, op6_warc

QUERIES = {f.__name__: f for f in (op1_packing, op2_quality, op3_license_scan, op4_suffix_dedup, op5_byte_bpe, op6_warc, op7_chat, op8_media, op9_language_id, op10_near_duplicates)} | {"pipeline": run}
ORACLES: dict[str, str] = {"op6_warc": OP6_SQL, "op7_chat": OP7_SQL} | ({"pipeline": ORACLE_SQL} if ORACLE_SQL else {})
