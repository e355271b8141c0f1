"""Query ``op2_near_dedup`` and its SQL."""

from quire.llm.common import table
from quire.llm.near_dedup import near_duplicates


def op2_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)


QUERIES = {"op2_near_dedup": op2_near_dedup}

SETS_SQL = r"""
w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
       FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i
             FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id)"""

ORACLE_SQL = {
    "op2_near_dedup": rf"""
WITH RECURSIVE {SETS_SQL},
common AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c
           FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT u, v FROM common JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v
         WHERE 100 * c >= 85 * (a.n + b.n - c)),
reach AS (SELECT doc_id AS u, doc_id AS v FROM documents
          UNION SELECT r.u, l.v FROM reach r JOIN link l ON r.v = l.u)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, w.doc_id = c.component_id AS kept
FROM w LEFT JOIN n USING (doc_id)
JOIN (SELECT u AS doc_id, min(v) AS component_id FROM reach GROUP BY u) c USING (doc_id)""",
}
