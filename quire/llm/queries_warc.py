"""Query ``op3_warc_segments`` and its SQL."""

from quire.llm.common import fresh_path, table
from quire.llm.warc import read_warc, write_warc


def op3_warc_segments(spark, sf_dir):
    """All pages written as segmented, chunked WARC records and read back."""
    path = fresh_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    return read_warc(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = {"op3_warc_segments": op3_warc_segments}

ORACLE_SQL = {
    "op3_warc_segments": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY d) AS last FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id < last THEN last END AS refers_to
FROM q""",
}
