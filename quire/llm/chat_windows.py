"""Chat formatting in budgeted windows, with DataFrame functions only.

Turns are cut into windows by prefix sums of their tokens: cells of ``step`` tokens are
laid over a conversation; the turns that lie inside a cell form a window, a turn that
crosses a border is a window of its own. A window repeats the conversation's first system
turn and the latest earlier turns that fit the history budget; these are context and never
under the loss mask. Every turn is new in exactly one window, so every assistant text is a
target once.

A conversation is never gathered for this: prefix sums are taken within range partitions
and joined with the sums of the partitions before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from quire.llm.common import WORD, written

BUDGET, HISTORY = 512, 128
#: Marks of a turn; all begin with one of ``<`` and ``[``.
MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
OTHER = ("[TURN]", "[:]", "[/TURN]")
_CONTROL = r"(?=/?s>|</?SYS>>)", r"(?=/?INST\]|/?TURN\]|:\])"
_TURN = r"(?s)<<SYS>>.*?<</SYS>>|\[INST\].*?\[/INST\]|<s>.*?</s>|\[TURN\].*?\[/TURN\]"
_MARK_TOKENS = 3


def escape(text: Column) -> Column:
    """No mark of the template is left in the result; ``unescape`` gives the text back."""
    text = F.replace(text, F.lit("\\"), F.lit("\\e"))
    text = F.regexp_replace(text, "<" + _CONTROL[0], r"\\l")
    return F.regexp_replace(text, r"\[" + _CONTROL[1], r"\\b")


def unescape(text: Column) -> Column:
    for code, char in (("\\l", "<"), ("\\b", "["), ("\\e", "\\")):
        text = F.replace(text, F.lit(code), F.lit(char))
    return text


def _head(role: Column) -> Column:
    out = F.when(role == "system", MARKS["system"][0]).when(role == "user", MARKS["user"][0])
    out = out.when(role == "assistant", MARKS["assistant"][0])
    return out.otherwise(F.concat(F.lit(OTHER[0]), escape(role), F.lit(OTHER[1])))


def _tail(role: Column) -> Column:
    out = F.when(role == "system", MARKS["system"][1]).when(role == "user", MARKS["user"][1])
    return out.when(role == "assistant", MARKS["assistant"][1]).otherwise(OTHER[2])


def token_count(text: Column) -> Column:
    """Words of a text, and the marks around it."""
    return F.regexp_count(text, F.lit(WORD)).cast("long") + _MARK_TOKENS


def _placed(turns: DataFrame, partitions: int) -> DataFrame:
    """Each turn with its tokens and ``lo``: the tokens before it in its conversation."""
    t = turns.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("c"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("tokens", token_count(F.col("text"))).withColumn("row", F.monotonically_increasing_id())
    order = ["turn", "role", "text", "row"]
    t = t.repartitionByRange(partitions, "c", *order).withColumn("part", F.spark_partition_id())
    t = written(t, "turns")
    inside = Window.partitionBy("part", "c").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("lo", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    parts = t.groupBy("part", "c").agg(F.sum("tokens").alias("sum"))
    before = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", "c", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("base"))
    return t.join(parts, ["part", "c"]).withColumn("lo", F.col("lo") + F.col("base")).drop("base", "part", "row")


def chat_windows(
    turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, partitions: int | None = None
) -> DataFrame:
    """One row per window of ``turns`` (conv_id, turn, role, text, ...): conv_id, window
    (its order in the conversation), text, n_context (leading turns that only repeat), n_turns, tokens
    and loss (code point ranges of the target texts, escaped, as start and end).

    New turns and history keep within the budget together with the system turn; a
    turn longer than that is a window of its own, and a system turn longer than
    5/8 of the budget still leaves a quarter of it for new turns.

    Null texts and roles are empty strings; a null turn stands before the others; rows
    with a null conv_id form one conversation. Turns with equal numbers are ordered by
    role and text, and repeated rows are all kept. Other columns are ignored, whatever their
    names. An empty table gives an empty result.
    """
    if not 0 <= history < budget:
        raise ValueError("history must be in [0, budget)")
    spark = turns.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    t = written(_placed(turns, partitions), "placed")
    first = t.filter("role = 'system'").groupBy("c").agg(F.min(F.struct("lo", "tokens", "text")).alias("s"))
    room = F.greatest(F.lit(budget - history) - F.coalesce(F.col("s.tokens"), F.lit(0)), F.lit(max(budget // 4, 1)))
    t = t.join(first, "c", "left").select("c", "lo", "role", "text", "tokens", F.col("s.lo").alias("sys_lo"), room.alias("step"))
    a, b = F.floor(F.col("lo") / F.col("step")), F.floor((F.col("lo") + F.col("tokens") - 1) / F.col("step"))
    t = t.withColumn("window", F.when(a == b, 2 * a + 1).otherwise(2 * b))

    spans = t.groupBy("c", "window").agg(
        F.min("lo").alias("start"), F.max(F.coalesce("sys_lo", F.lit(-1))).alias("sys_lo")
    )
    # a turn is history where its end is not after the start, and its own start is near enough
    near = max(history, 1)
    old = t.select(
        "c", "lo", "role", "text", "tokens",
        F.explode(F.array_distinct(F.array(
            F.floor((F.col("lo") + F.col("tokens")) / near), F.floor((F.col("lo") + history) / near)
        ))).alias("cell"),
    )
    past = old.join(spans.select("c", "window", "start", F.floor(F.col("start") / near).alias("cell")), ["c", "cell"])
    past = past.filter((F.col("lo") + F.col("tokens") <= F.col("start")) & (F.col("lo") + history >= F.col("start")))
    system = spans.filter((F.col("sys_lo") >= 0) & (F.col("sys_lo") + history < F.col("start")))
    system = system.select("c", "window").join(first.select("c", "s.lo", "s.tokens", "s.text"), "c").withColumn("role", F.lit("system"))
    cols = ["c", "window", "lo", "role", "text", "tokens"]
    items = t.select(*cols, F.lit(True).alias("new"))
    items = items.unionByName(past.select(*cols, F.lit(False).alias("new")))
    items = items.unionByName(system.select(*cols, F.lit(False).alias("new")))
    item = F.struct(
        "lo", F.col("new"), F.col("tokens"), F.col("role"),
        _head(F.col("role")).alias("head"), escape(F.col("text")).alias("body"), _tail(F.col("role")).alias("tail"),
    )
    w = items.groupBy("c", "window").agg(F.sort_array(F.collect_list(item)).alias("i"))
    size = lambda x: F.char_length(x["head"]) + F.char_length(x["body"]) + F.char_length(x["tail"])
    walk = F.aggregate(
        "i",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("loss")),
        lambda acc, x: F.struct(
            (acc["at"] + size(x)).alias("at"),
            F.when(
                x["new"] & (x["role"] == "assistant"),
                F.concat(acc["loss"], F.array(F.struct(
                    (acc["at"] + F.char_length(x["head"])).alias("start"),
                    (acc["at"] + F.char_length(x["head"]) + F.char_length(x["body"])).alias("end"),
                ))),
            ).otherwise(acc["loss"]).alias("loss"),
        ),
        lambda acc: acc["loss"],
    )
    return w.select(
        F.expr("cast(nullif(c, '') as long)").alias("conv_id"),
        F.col("window").cast("long").alias("window"),
        F.array_join(F.transform("i", lambda x: F.concat(x["head"], x["body"], x["tail"])), "").alias("text"),
        F.size(F.filter("i", lambda x: ~x["new"])).alias("n_context"),
        F.size("i").alias("n_turns"),
        F.aggregate("i", F.lit(0).cast("long"), lambda n, x: n + x["tokens"]).alias("tokens"),
        walk.alias("loss"),
    )


def read_turns(windows: DataFrame) -> DataFrame:
    """``windows`` with ``turns``: role and text of each window's new turns, parsed from
    its text, and ``targets``: the texts under the loss mask, unescaped."""
    raw = F.regexp_extract_all("text", F.lit(_TURN), F.lit(0))
    new = F.slice(raw, F.col("n_context") + 1, F.greatest(F.size(raw), F.lit(1)))

    def inner(t: Column, head: Column, tail: str) -> Column:
        return unescape(F.substring(t, head + 1, F.char_length(t) - head - len(tail)))

    def turn(t: Column) -> Column:
        out = F.when(F.lit(False), F.lit(None).cast("struct<role:string,text:string>"))
        for role, (head, tail) in MARKS.items():
            text = inner(t, F.lit(len(head)), tail)
            out = out.when(t.startswith(head), F.struct(F.lit(role).alias("role"), text.alias("text")))
        colon = F.instr(t, OTHER[1])
        role = unescape(F.substring(t, F.lit(len(OTHER[0]) + 1), colon - 1 - len(OTHER[0])))
        text = inner(t, colon + len(OTHER[1]) - 1, OTHER[2])
        return out.otherwise(F.struct(role.alias("role"), text.alias("text")))

    target = F.transform("loss", lambda s: unescape(F.substring("text", s["start"] + 1, s["end"] - s["start"])))
    return windows.withColumn("turns", F.transform(new, turn)).withColumn("targets", target)
