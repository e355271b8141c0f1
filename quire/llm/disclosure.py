"""Information-theoretic sanitisation, with DataFrame functions only.

Personal data (e-mail, IP address, card, phone) found by pattern are the protected
entities. A term that stands near mentions of an entity discloses it as far as the
corpus shows: with document frequencies over the whole corpus, the pointwise mutual
information PMI = log2 p(term, entity) / (p(term) p(entity)) is set against the entity's own
information IC = -log2 p(entity). Terms with PMI >= IC / alpha (and enough joint documents to be
no chance) are generalised in the documents that mention the entity; those that give nearly all of it
away (PMI >= removal * IC) are removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quire.llm.common import written

#: Leftmost non-overlapping matches, written so that a long run costs linear time: a match
#: starts where its first class starts, or where the match before ended.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GUARDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
KINDS = [*PATTERNS, "term"]
_TERM = r"\p{L}[\p{L}\p{N}]*"
_NEAR = 160  # code points on either side of a mention in which its context lies
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_SPAN = "struct<kind:int,start:int,end:int,label:string>"


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(s: Column) -> Column:
    d = F.transform(F.split(F.reverse(_digits(s)), ""), lambda c: F.coalesce(c.cast("int"), F.lit(0)))
    d = F.transform(d, lambda x, i: F.when(i % 2 == 0, x).when(x > 4, 2 * x - 9).otherwise(2 * x))
    return F.aggregate(d, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, s: Column) -> Column:
    if kind == "ip":
        return s.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.char_length(_digits(s)).between(13, 19) & _luhn(s)
    if kind == "phone":
        return F.char_length(_digits(s)).between(9, 15)
    return F.lit(True)


def _matches(text: Column, pattern: Column) -> Column:
    """All matches in order with their code point ranges."""
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    step = lambda acc, i: F.struct(
        (acc["at"] + F.char_length(gaps[i]) + F.char_length(hits[i])).alias("at"),
        F.concat(acc["out"], F.array(F.struct(
            (acc["at"] + F.char_length(gaps[i])).alias("start"),
            (acc["at"] + F.char_length(gaps[i]) + F.char_length(hits[i])).alias("end"),
            hits[i].alias("value"),
        ))).alias("out"),
    )
    index = F.transform(hits, lambda _, i: i)
    return F.aggregate(index, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda acc: acc["out"])


def _context(text: Column, start: Column, end: Column, words: int) -> Column:
    """The last words before a mention and the first after it, whatever else the patterns match
    there; a word cut at the border is left out."""
    before = F.substring(text, F.greatest(start - _NEAR, F.lit(1)), F.least(start, F.lit(_NEAR + 1)))
    after = F.substring(text, end + 1, F.lit(_NEAR + 1))
    before = F.when(F.char_length(before) > _NEAR, F.regexp_replace(before, r"^[\p{L}\p{N}]+", "")).otherwise(before)
    after = F.when(F.char_length(after) > _NEAR, F.regexp_replace(after, r"[\p{L}\p{N}]+$", "")).otherwise(after)
    b, a = (F.regexp_extract_all(F.lower(x), F.lit(_TERM), F.lit(0)) for x in (before, after))
    return F.concat(F.slice(F.reverse(b), 1, words), F.slice(a, 1, words))


def _base(docs: DataFrame, words: int) -> DataFrame:
    """``docs`` with found: kind, range, value and context terms of each entity mention."""
    t = F.coalesce(F.col("text").cast("string"), F.lit(""))

    def mentions(k: int, kind: str) -> Column:
        hits = F.filter(_matches(t, F.lit(PATTERNS[kind])), lambda m: _valid(kind, m["value"]))
        return F.transform(hits, lambda m: F.struct(
            F.lit(k).alias("kind"), m["start"].alias("start"), m["end"].alias("end"),
            F.concat(F.lit(f"{kind}:"), F.lower(m["value"])).alias("entity"),
            _context(t, m["start"], m["end"], words).alias("near"),
        ))

    none = F.array().cast("array<struct<kind:int,start:int,end:int,entity:string,near:array<string>>>")
    parts = [
        F.when(t.contains(GUARDS[kind]) & t.rlike(pattern.replace("|\\G", "")), mentions(k, kind)).otherwise(none)
        for k, (kind, pattern) in enumerate(PATTERNS.items())
    ]
    return docs.withColumn("_found", F.concat(*parts))


def disclosing_terms(found: DataFrame, docs: DataFrame, alpha: float, removal: float, min_joint: int) -> DataFrame:
    """entity, term, label for terms whose PMI with the entity passes the threshold."""
    n = docs.count()
    entity = F.array_distinct(F.transform("_found", lambda m: m["entity"]))
    df_e = found.select(F.explode(entity).alias("entity")).groupBy("entity").agg(F.count("*").alias("n_e"))
    pair = F.flatten(F.transform("_found", lambda m: F.transform(
        m["near"], lambda t: F.struct(m["entity"].alias("entity"), t.alias("term")))))
    joint = (
        found.select(F.explode(F.array_distinct(pair)).alias("p")).groupBy("p.entity", "p.term")
        .agg(F.count("*").alias("n_et")).filter(F.col("n_et") >= min_joint)
    )
    joint = written(joint.join(df_e, "entity"), "joint")
    every = F.array_distinct(F.regexp_extract_all(F.lower(F.col("text").cast("string")), F.lit(_TERM), F.lit(0)))
    df_t = docs.select(F.explode(every).alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))
    ic = -F.log2(F.col("n_e") / n)
    pmi = F.log2(F.col("n_et") * F.lit(float(n)) / (F.col("n_t") * F.col("n_e")))
    return (
        joint.join(df_t, "term").withColumn("ic", ic).withColumn("pmi", pmi)
        .filter((F.col("ic") > 0) & (F.col("pmi") >= F.col("ic") / alpha))
        .select("entity", "term", F.when(F.col("pmi") >= F.col("ic") * removal, "").otherwise("[TERM]").alias("label"))
    )


def _term_pattern(terms: Column) -> Column:
    """Matches the terms as whole words, in any case. Terms hold letters and digits only."""
    return F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), F.array_join(terms, "|"), F.lit(r")(?![\p{L}\p{N}])"))


def sanitised(
    docs: DataFrame, alpha: float = 1.25, removal: float = 0.95, min_joint: int = 2, words: int = 8
) -> DataFrame:
    """``docs`` (doc_id, text, ...) with ``text`` sanitised and ``spans`` added: kind (an index
    of KINDS), start, end (code points of the old text) and what stands there now.

    ``words`` on either side of a mention are its context; ``min_joint`` documents must show
    term and entity together. Pattern matches are always replaced by their kind. Term spans that touch
    them are left out. Where spans of kinds overlap, the text shows the first one's label.

    Null texts stay null and have no spans, empty ones likewise. Ids play no part, so null and repeated ids
    and rows are kept as they are. Other columns are passed on, whatever their names
    (a column ``spans`` is replaced). An empty table gives an empty result.
    """
    cols = [c for c in docs.columns if c != "spans"]
    docs = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("doc"), F.col("text").cast("string").alias("text"))
    base = _base(docs, words)
    found = written(base.filter(F.size("_found") > 0).withColumn("_row", F.monotonically_increasing_id()), "found")
    out = [F.col("text") if c == "text" else F.col("doc")[c].alias(c) for c in cols]
    clean = base.filter(F.size("_found") == 0).select(*out, F.array().cast(f"array<{_SPAN}>").alias("spans"))

    terms = written(disclosing_terms(found, docs.select("text"), alpha, removal, min_joint), "terms")
    entity = F.array_distinct(F.transform("_found", lambda m: m["entity"]))
    of_doc = found.select("_row", F.explode(entity).alias("entity")).join(terms, "entity")
    of_doc = of_doc.groupBy("_row", "term").agg(F.min("label").alias("label"))
    of_doc = of_doc.groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("term", "label"))).alias("_terms"))

    rows = found.join(of_doc, "_row", "left")
    own = F.transform("_found", lambda m: F.struct(
        m["kind"].alias("kind"), m["start"].alias("start"), m["end"].alias("end"),
        F.element_at(F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS]), m["kind"] + 1).alias("label"),
    ))
    hits = _matches(F.col("text"), _term_pattern(F.map_keys("_terms")))
    hits = F.filter(hits, lambda t: ~F.exists("_found", lambda m: (m["start"] < t["end"]) & (t["start"] < m["end"])))
    hits = F.transform(hits, lambda t: F.struct(
        F.lit(len(PATTERNS)).alias("kind"), t["start"].alias("start"), t["end"].alias("end"),
        F.coalesce(F.col("_terms")[F.lower(t["value"])], F.lit("[TERM]")).alias("label"),
    ))
    spans = F.concat(own, F.when(F.col("_terms").isNotNull(), hits).otherwise(F.array().cast(f"array<{_SPAN}>")))
    rows = rows.withColumn("spans", F.array_sort(spans.cast(f"array<{_SPAN}>")))
    by_place = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"], s["end"], s["label"])))
    walked = F.aggregate(
        by_place, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.when(s["start"] < acc["at"], F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out")))
        .otherwise(F.struct(s["end"].alias("at"), F.concat(
            acc["out"], F.substring("text", acc["at"] + 1, s["start"] - acc["at"]), s["label"]).alias("out"))),
        lambda acc: F.concat(acc["out"], F.substring("text", acc["at"] + 1, F.char_length("text"))),
    )
    rows = rows.withColumn("text", walked)
    return clean.unionByName(rows.select(*out, "spans"))
