"""Queries ``op8_sentencepiece`` and ``op6_training_order``."""

from pyspark.sql import functions as F

from quire.llm import sentencepiece_dropout as spm, training_order
from quire.llm.common import fresh_path, table


def op8_sentencepiece(spark, sf_dir):
    """Every document encoded with dropout and decoded again: counts and digests."""
    docs = table(spark, sf_dir, "documents")
    back = spm.decode(spm.encode(docs))
    return back.select(
        "doc_id", "n_pieces", "n_byte_pieces",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("text_sha256"),
    )


def op6_training_order(spark, sf_dir):
    """All documents tokenised and written as shards in training order; every slot read back."""
    path = fresh_path(spark, "order")
    layout = training_order.write_training_order(table(spark, sf_dir, "documents"), path)
    rows = training_order.read_training_order(spark, path, layout)
    return rows.select("slot", "shard", "offset", "sequence", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES = {"op8_sentencepiece": op8_sentencepiece, "op6_training_order": op6_training_order}
