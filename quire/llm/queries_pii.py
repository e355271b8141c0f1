"""Query ``op5_disclosure``: personal data and terms that disclose it."""

from pyspark.sql import functions as F

from quire.llm.common import table
from quire.llm.disclosure import KINDS, PATTERNS, sanitised


def op5_disclosure(spark, sf_dir):
    out = sanitised(table(spark, sf_dir, "documents").select("doc_id", "text"))
    name = F.array(*[F.lit(k) for k in KINDS])
    as_text = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", F.element_at(name, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < len(PATTERNS))
    return out.select(
        "doc_id", *[count(k).alias(f"n_{kind}") for k, kind in enumerate(PATTERNS)],
        F.sha2(F.encode(as_text(base), "UTF-8"), 256).alias("base_sha256"), as_text(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["kind"] == len(PATTERNS))).cast("long").alias("n_terms"),
    )


QUERIES = {"op5_disclosure": op5_disclosure}
