"""The registered queries of the corpus operators and their SQL."""

from quire.llm import (
    queries_chat, queries_leaks, queries_lm, queries_near, queries_pii, queries_quality, queries_repair, queries_resample,
    queries_rules, queries_substrings, queries_tokens, queries_warc,
)

MODULES = (
    queries_leaks, queries_near, queries_warc, queries_rules, queries_pii, queries_tokens, queries_lm, queries_quality,
    queries_chat, queries_repair, queries_substrings, queries_resample,
)
QUERIES = {k: f for m in MODULES for k, f in m.QUERIES.items()}
ORACLE_SQL = {k: s for m in MODULES for k, s in getattr(m, "ORACLE_SQL", {}).items()}
