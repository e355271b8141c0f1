"""Query ``op10_chat_windows`` and its SQL."""

from pyspark.sql import functions as F

from quire.llm.chat_windows import BUDGET, HISTORY, chat_windows, read_turns
from quire.llm.common import WORD, table, written

_PROBE = "</s>[INST] ok [/INST]"
_BLOCK = 256  # windows of a conversation that are joined before it is put together


def op10_chat_windows(spark, sf_dir):
    """All conversations and one made of control strings, formatted, written and read back.

    The digests are of one text for each conversation, and no native function hashes a text in parts: the query, not the
    operator, puts the said and the target texts of a conversation together in one row, at most Spark's 2 GB a string.
    """
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(_PROBE).alias("text"),
    )
    back = read_turns(written(chat_windows(turns.unionByName(probe)), "windows"))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    part = back.select(
        "conv_id", "window", F.size("turns").alias("n"), F.array_join(said, "").alias("said"),
        F.array_join("targets", "").alias("loss"), F.char_length("text").alias("chars"),
    )

    def joined(rows, *key):
        both = F.sort_array(F.collect_list(F.struct("window", "said", "loss")))
        rows = rows.groupBy(*key).agg(both.alias("b"), F.sum("n").alias("n"), F.sum("chars").alias("chars"))
        text = lambda f: F.array_join(F.transform("b", lambda x: x[f]), "")
        return rows.select("conv_id", F.col("b")[0]["window"].alias("window"), "n", "chars", text("said").alias("said"), text("loss").alias("loss"))

    rows = joined(joined(part, "conv_id", F.floor(F.col("window") / _BLOCK)), "conv_id")
    return rows.select(
        "conv_id", F.col("n").cast("long").alias("n_turns"), F.sha2(F.encode("said", "UTF-8"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2(F.encode("loss", "UTF-8"), 256).alias("loss_sha256"),
        F.col("chars").cast("long").alias("formatted_chars"),
    )


QUERIES = {"op10_chat_windows": op10_chat_windows}

ORACLE_SQL = {
    "op10_chat_windows": rf"""
WITH t0 AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{_PROBE}'), (-7, 1, 'assistant', '{_PROBE}')),
t1 AS (SELECT *, len(regexp_extract_all(text, '{WORD}')) + 3 AS tokens FROM t0),
t2 AS (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY conv_id ORDER BY turn, role, text
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lo,
       length(text) + length(text) - length(replace(text, '\', ''))
       + length(regexp_replace(text, '(</?s>|<</?SYS>>|\[/?INST\]|\[/?TURN\]|\[:\])', '\1_', 'g')) - length(text)
       + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
                   ELSE 16 + length(role) END AS size FROM t1),
sys AS (SELECT conv_id, min(lo) AS sys_lo, arg_min(tokens, lo) AS sys_tokens, arg_min(size, lo) AS sys_size
        FROM t2 WHERE role = 'system' GROUP BY conv_id),
t3 AS (SELECT t2.*, sys_lo, sys_size,
       greatest({BUDGET - HISTORY} - coalesce(sys_tokens, 0), {BUDGET // 4}) AS step
       FROM t2 LEFT JOIN sys USING (conv_id)),
t4 AS (SELECT *, CASE WHEN floor(lo / step) = floor((lo + tokens - 1) / step)
       THEN 2 * floor(lo / step) + 1 ELSE 2 * floor((lo + tokens - 1) / step) END AS w FROM t3),
win AS (SELECT conv_id, w, min(lo) AS start, min(sys_lo) AS sys_lo, min(sys_size) AS sys_size, sum(size) AS size
        FROM t4 GROUP BY ALL),
old AS (SELECT win.conv_id, win.w, sum(t4.size) AS size FROM win JOIN t4
        ON t4.conv_id = win.conv_id AND t4.lo + t4.tokens <= win.start AND t4.lo + {HISTORY} >= win.start
        GROUP BY ALL),
chars AS (SELECT conv_id, sum(win.size + coalesce(old.size, 0)
            + CASE WHEN win.sys_lo + {HISTORY} < win.start THEN win.sys_size ELSE 0 END) AS n
          FROM win LEFT JOIN old USING (conv_id, w) GROUP BY conv_id),
said AS (SELECT conv_id, count(*) AS n_turns,
           string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
           coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '') AS loss
         FROM t0 GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars,
       sha256(loss) AS loss_sha256, n::BIGINT AS formatted_chars
FROM said JOIN chars USING (conv_id)""",
}
