"""Query ``op12_substring_dedup`` and its SQL."""

from pyspark.sql import functions as F

from quire.llm.common import WORD, table
from quire.llm.substring_dedup import WORDS, without_repeats


def op12_substring_dedup(spark, sf_dir):
    """Every document without the passages that a document before it has."""
    out = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


QUERIES = {"op12_substring_dedup": op12_substring_dedup}

ORACLE_SQL = {
    "op12_substring_dedup": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) - {WORDS} + 2)) AS s FROM d),
w AS (SELECT doc_id, s, array_to_string(ws[s:s + {WORDS - 1}], ' ') AS passage FROM p),
m AS (SELECT passage, min(doc_id) AS least FROM w GROUP BY passage),
bad AS (SELECT doc_id, s FROM w JOIN m USING (passage) WHERE doc_id > least),
gone AS (SELECT DISTINCT doc_id, s + unnest(range({WORDS})) AS i FROM bad),
each AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
         FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""",
}
