"""Query ``op13_importance_resample`` and its SQL."""

from quire.llm.common import table
from quire.llm.importance import BUCKETS, LEAST_WORDS, SEED, SHARE, crc_table, resampled


def op13_importance_resample(spark, sf_dir):
    """Every document weighed against the benchmark's texts; a tenth is drawn."""
    docs, target = (table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return resampled(docs.select("doc_id", "text"), target.select("text")).select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {"op13_importance_resample": op13_importance_resample}

_TABLE = ", ".join(map(str, crc_table().tolist()))
#: CRC-32 of a BLOB's hex digits, byte by byte with the step table.
_CRC = (
    "xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length({h}), 2), lambda i: ('0x' || substr({h}, i, 2))::BIGINT)), "
    "lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)"
)

ORACLE_SQL = {
    "op13_importance_resample": rf"""
WITH k AS (SELECT [{_TABLE}]::BIGINT[] AS tab),
d0 AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b0 AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
d1 AS (SELECT doc_id, unnest(ws) AS w FROM d0), b1 AS (SELECT unnest(ws) AS w FROM b0),
h AS (SELECT w, hex(encode(w)) AS hx FROM (SELECT w FROM d1 UNION SELECT w FROM b1)),
c AS (SELECT w, {_CRC.format(h="hx")} % {BUCKETS} AS bucket FROM h, k),
s AS (SELECT bucket, count(*) AS n FROM d1 JOIN c USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM b1 JOIN c USING (w) GROUP BY bucket),
g AS (SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + {BUCKETS})::DOUBLE
        / ((s.n + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + {BUCKETS})::DOUBLE)))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket)),
w AS (SELECT doc_id, count(*) AS n, sum(gain) AS total FROM d1 JOIN c USING (w) JOIN g USING (bucket) GROUP BY doc_id),
r AS (SELECT doc_id, len(ws) AS n_features, coalesce(floor(total::DOUBLE / n), 0)::BIGINT AS weight,
        ('0x' || sha256('{SEED}:' || doc_id)[:8])::BIGINT::DOUBLE AS hash FROM d0 LEFT JOIN w USING (doc_id)),
sc AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((hash + 0.5) / 4294967296)))::BIGINT AS score FROM r),
o AS (SELECT *, row_number() OVER (PARTITION BY n_features >= {LEAST_WORDS} ORDER BY score DESC, doc_id) AS place,
        (SELECT count(*) FROM sc WHERE n_features >= {LEAST_WORDS}) * {SHARE} // 100 AS drawn FROM sc)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= {LEAST_WORDS} AND place <= drawn THEN place END AS rank FROM o""",
}
