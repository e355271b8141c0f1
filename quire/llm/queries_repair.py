"""Query ``op11_conversation_repair``."""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quire.llm.common import batch_rows, byte_values, table, written
from quire.llm.conversation_repair import repaired


def damaged(rows: DataFrame) -> DataFrame:
    """A row in twenty is dropped, emptied, cut off, repeated or given to the user, by its key."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    k = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    rows = rows.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), k.alias("k")).filter("k <> 0")
    text = F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("k") == 4, "user").otherwise(F.col("role"))
    copies = F.array_repeat(F.lit(0), F.when(F.col("k") == 3, 2).otherwise(1))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def digests(turns: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256: the turns' lines pass in order, no conversation is held as a whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, now, digest, out, empty = False, None, None, [], True
        for batch in batches:
            for conv, text, n in zip(batch.column(0).to_pylist(), byte_values(batch.column(1)), batch.column(2).to_pylist()):
                if not open_ or conv != now:
                    if open_:
                        out.append((now, digest.hexdigest()))
                    open_, now, digest, empty = True, conv, hashlib.sha256(), True
                if n:
                    digest.update(text if empty else b"\n" + text)
                    empty = False
            if len(out) > 1000:
                yield batch_of(out)
                out = []
        if open_:
            yield batch_of([*out, (now, digest.hexdigest())])

    def batch_of(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.string()))], ["conv_id", "repaired_sha256"])

    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    rows = turns.select("conv_id", F.array_join(line, "\n").alias("text"), F.size("turns").alias("n"), "chunk")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
    return rows.select("conv_id", "text", "n").mapInArrow(run, "conv_id long, repaired_sha256 string")


def op11_conversation_repair(spark, sf_dir):
    """All conversations damaged, audited and repaired: counts, edits and digests."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    counts, mended = repaired(damaged(turns))
    with batch_rows(spark, 1000):
        digest = written(digests(mended), "digests")
    every = turns.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().alias("e")
    out = every.join(counts.alias("c"), F.expr("e.conv_id <=> c.conv_id"), "left").join(
        digest.alias("d"), F.expr("e.conv_id <=> d.conv_id"), "left")
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select(
        "e.conv_id", *[F.coalesce(F.col(f"c.{n}"), F.lit(0)).cast("long").alias(n) for n in names],
        F.coalesce("c.audit", F.lit("")).alias("audit"),
        F.coalesce("d.repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


QUERIES = {"op11_conversation_repair": op11_conversation_repair}
