"""Personal data: base patterns, and information-theoretic sanitisation
(DataFrame only).

Base spans are emails, IP addresses, card and phone numbers (patterns and checks
below).  Their values are the protected entities.  A term discloses an entity in
the measure in which their pointwise mutual information, estimated from the
documents of the corpus, reaches the entity's own information content::

    PMI(c; t) = log2(n * n_ct / (n_c * n_t)),   IC(c) = log2(n / n_c)

with n texts in all, n_c that hold the entity, n_t that hold the term, n_ct that
hold both, anywhere in the text.  One joint sighting is no evidence: every word of a
text is seen once with an entity of that text alone.  So the estimate is a lower one:
n_ct / n_c, the share of the entity's texts that hold the term, is replaced by the
lower end of its Wilson interval (``Z`` standard errors), and n_ct >= ``MIN_TOGETHER``
different texts must agree.  In documents that hold c, terms whose lower PMI is at
least ``THRESHOLD`` * IC are spans of kind ``term`` as well, wherever they stand
outside a base span.  ``sanitise`` replaces base spans by their kind (generalised) and
terms by nothing (removed).

All counts run over the distinct lower-cased texts, so copies of a document are no
evidence.  As n_ct <= n_c, a term can only pass if n_c >= ``MIN_TOGETHER`` and
n_t <= n_c * (n / n_c) ** (1 - ``THRESHOLD``): terms are joined with their n_t first
and those above the bound make no pairs.  Counts are pre-aggregated before each
shuffle.

Positions are running sums over the matches of a text, taken in blocks of ``BLOCK``
matches, so that the work grows in proportion to them.

Defined results: a null text is empty and has no spans (the digest is that of the
empty string); rows with equal ids or texts have equal spans each; a span of one
kind may overlap one of another; positions are code points, ends exclusive; very long
texts are searched whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, text_of

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
MIN_TOGETHER = 2
#: Standard errors of the lower end: its lower quartile.
Z = 0.6745
THRESHOLD = 0.9
#: Matches of a text that are folded in one go; longer lists are folded block by block.
BLOCK = 256
_SPAN = "struct<start:int,order:int,end:int,kind:string,value:string>"

# The patterns find what the stated ones find, leftmost and without overlap, in
# linear time: runs start where the character before is not of the run, or where
# the match before ended (\G), and runs are possessive.  Cards are held to at
# least 12 digits here already.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold to be searched for a kind.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
TERM_PATTERN = r"\p{L}{3,}"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    places = F.transform(F.split(F.reverse(digits), ""), lambda d: F.when(d == "", F.lit(0)).otherwise(d.cast("int")))
    weighed = F.transform(places, lambda d, i: F.when(i % 2 == 1, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d))
    return F.aggregate(weighed, F.lit(0), lambda s, x: s + x) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    digits = _digits(value)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.length(digits).between(12, 19) & _luhn(digits)


def scan(items: Column, zero: Column, item_type: str, carry: Callable, emit: Callable) -> Column:
    """``emit(state, item)`` of every item, where the state starts at ``zero`` and
    becomes ``carry(state, item)`` after it.  A fold that appends copies what it has
    gathered with each item; here only the ``BLOCK`` items of a block are copied so, and
    the list of blocks once a block."""
    empty = F.array().cast(f"array<{item_type}>")

    def step(state: Column, item: Column) -> Column:
        out = F.concat(state["out"], F.array(emit(state["at"], item)))
        return F.struct(carry(state["at"], item).alias("at"), out.alias("out"))

    def block(state: Column, number: Column) -> Column:
        return F.aggregate(
            F.slice(items, number * BLOCK + 1, BLOCK),
            F.struct(state["at"].alias("at"), empty.alias("out")),
            step,
            lambda done: F.struct(done["at"].alias("at"), F.concat(state["blocks"], F.array(done["out"])).alias("blocks")),
        )

    blocks = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int"))
    start = F.struct(zero.alias("at"), F.array().cast(f"array<array<{item_type}>>").alias("blocks"))
    folded = F.aggregate(blocks, start, block, lambda state: F.flatten(state["blocks"]))
    return F.when(F.size(items) > 0, folded).otherwise(empty)


def match_spans(text: Column, pattern: Column, kind: str, order: int) -> Column:
    """(start, order, end, kind, value) of every match: the pieces between the
    matches and the matches themselves give the positions."""
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    pieces = F.transform(F.split(text, pattern, -1), F.length)
    pairs = F.zip_with(
        found, F.slice(pieces, 1, F.size(found)),
        lambda v, n: F.struct(v.alias("value"), F.coalesce(n, F.lit(0)).alias("before"), F.length(v).alias("length")),
    )

    def span(at: Column, pair: Column) -> Column:
        start = at + pair["before"]
        return F.struct(
            start.alias("start"), F.lit(order).alias("order"), (start + pair["length"]).alias("end"),
            F.lit(kind).alias("kind"), pair["value"].alias("value"),
        )

    return F.transform(F.array(pairs), lambda ps: scan(ps, F.lit(0), _SPAN, lambda at, p: at + p["before"] + p["length"], span))[0]


def with_terms(base: Column, own: Column) -> Column:
    """Base spans and those term spans that overlap none, by start and kind.  Term
    spans of a text don't overlap each other: of the spans that start inside a term
    the next in order is one, and of those before it the largest end tells."""
    ordered = F.array_sort(F.concat(base, own))
    items = F.zip_with(ordered, F.slice(ordered, 2, F.size(ordered)), lambda s, n: F.struct(s.alias("span"), n.alias("next")))
    is_term = lambda s: s["kind"] == TERM

    def judged(end: Column, item: Column) -> Column:
        free = (end <= item["span"]["start"]) & F.coalesce(
            is_term(item["next"]) | (item["next"]["start"] >= item["span"]["end"]), F.lit(True)
        )
        return F.struct(item["span"].alias("span"), (~is_term(item["span"]) | free).alias("stays"))

    def carry(end: Column, item: Column) -> Column:
        return F.when(is_term(item["span"]), end).otherwise(F.greatest(end, item["span"]["end"]))

    def both(pairs: Column) -> Column:
        out = scan(pairs, F.lit(0), f"struct<span:{_SPAN},stays:boolean>", carry, judged)
        return F.transform(F.filter(out, lambda x: x["stays"]), lambda x: x["span"])

    return F.transform(F.array(items), both)[0]


def base_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``spans``: the base spans by start, then kind in the order listed."""
    empty = F.array().cast(f"array<{_SPAN}>")
    text = F.col(text_col)
    for order, kind in enumerate(KINDS):
        hint = F.contains(text, F.lit(HINTS[kind])) if kind == "email" else text.rlike(HINTS[kind])
        spans = match_spans(text, F.lit(PATTERNS[kind]), kind, order)
        docs = docs.withColumn(f"_{kind}", F.when(hint, spans).otherwise(empty))
        docs = docs.withColumn(f"_{kind}", _kept(kind))
    return docs.withColumn("spans", F.array_sort(F.concat(*[F.col(f"_{k}") for k in KINDS]))).drop(*[f"_{k}" for k in KINDS])


def _kept(kind: str) -> Column:
    return F.filter(f"_{kind}", lambda s: _valid(kind, s["value"]))


def spans_text(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def _entity(span: Column) -> Column:
    value = F.when(span["kind"] == "email", F.lower(span["value"])).otherwise(_digits(F.regexp_replace(span["value"], r"\.", "0")))
    value = F.when(span["kind"] == "ip", span["value"]).otherwise(value)
    return F.concat_ws(":", span["kind"], value)


def _terms(text: Column) -> Column:
    """The terms of a lower-cased text, each once."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(TERM_PATTERN), F.lit(0)))


def _least_share(together: Column, entity_texts: Column, z: float) -> Column:
    """The lower end of Wilson's interval for ``together`` of ``entity_texts``."""
    n = entity_texts.cast("double")
    p = together / n
    spread = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    return (p + z * z / (2 * n) - spread) / (1 + z * z / n)


def disclosing_terms(
    docs: DataFrame, rows: DataFrame, threshold: float = THRESHOLD, min_together: int = MIN_TOGETHER, z: float = Z
) -> DataFrame:
    """(low, entity, term, together, entity_texts, term_texts, share): for every
    distinct text the terms in it whose lower PMI with an entity in it is at least
    ``threshold`` of the entity's information content.  ``rows`` has low (digest of
    the lower-cased text), entities and, where there are any, text."""
    texts = rows.select("low").distinct().count()
    held = rows.filter(F.size("entities") > 0)
    entities = held.select("low", F.explode("entities").alias("entity")).distinct()
    entity_texts = materialise(entities.groupBy("entity").agg(F.count(F.lit(1)).alias("entity_texts")), "pii-entities")
    most = entity_texts.agg(F.max("entity_texts")).head()[0] or 0
    log = lambda c: F.log2(c.cast("double"))
    content = log(F.lit(texts)) - log(F.col("entity_texts"))

    def bound(entity_texts: Column) -> Column:
        """The most texts that a term of an entity may be in (rounding allowed for)."""
        return F.pow(entity_texts.cast("double"), F.lit(threshold)) * F.pow(F.lit(float(texts)), F.lit(1 - threshold)) * (1 + 1e-9)

    # every text of the corpus, once: which of its words are terms
    distinct = docs.select(F.lower(text_of()).alias("t")).groupBy("t").agg(F.lit(1).alias("one"))
    words = distinct.select(F.explode(_terms(F.col("t"))).alias("term"))
    counted = words.groupBy("term").agg(F.count(F.lit(1)).alias("term_texts"))
    counted = materialise(counted.filter(F.col("term_texts") <= bound(F.lit(most))), "pii-term-texts")
    own = held.groupBy("low").agg(F.first(F.lower("text")).alias("t")).select("low", F.explode(_terms(F.col("t"))).alias("term"))
    of_texts = materialise(entities.join(entity_texts.filter(F.col("entity_texts") >= min_together), "entity"), "pii-held")
    # of the terms of a text, those rare enough for an entity in it
    pairs = materialise(
        materialise(own.join(counted, "term"), "pii-rare")
        .join(of_texts, "low")
        .filter(F.col("term_texts") <= bound(F.col("entity_texts"))),
        "pii-pairs",
    )
    pmi = log(F.lit(texts)) + log(_least_share(F.col("together"), F.col("entity_texts"), z)) - log(F.col("term_texts"))
    passed = materialise(
        pairs.groupBy("entity", "term", "entity_texts", "term_texts")
        .agg(F.count(F.lit(1)).alias("together"))
        .withColumn("share", F.when(content > 0, pmi / content).otherwise(0.0))
        .filter((F.col("together") >= min_together) & (F.col("share") >= threshold)),
        "pii-terms",
    )
    return pairs.select("low", "entity", "term").join(passed, ["entity", "term"]).select(
        "low", "entity", "term", "together", "entity_texts", "term_texts", "share"
    )


def find_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    min_together: int = MIN_TOGETHER,
    z: float = Z,
) -> DataFrame:
    """doc_id, text_hash, base (array of base spans), spans (with the term spans)
    of every row."""
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    entities = F.array_distinct(F.transform("spans", _entity))
    # of the texts only those that hold an entity are written
    rows = materialise(
        base_spans(plain).select(
            "doc_id", F.xxhash64("text").alias("text_hash"), F.unhex(F.md5(F.lower("text"))).alias("low"), F.col("spans").alias("base"),
            entities.alias("entities"), F.when(F.size("spans") > 0, F.col("text")).alias("text"),
        ),
        "pii-base",
    )
    found = disclosing_terms(plain.select("text"), rows, threshold, min_together, z)
    flagged = materialise(found.groupBy("low").agg(F.collect_set("term").alias("terms")), "pii-flagged")
    # a text without an entity has no terms to remove
    none = rows.filter(F.size("entities") == 0).select("doc_id", "text_hash", "base", F.col("base").alias("spans"))
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join("terms", "|"), F.lit(r")(?!\p{L})"))
    own = F.when(F.col("terms").isNotNull(), match_spans(F.col("text"), pattern, TERM, len(KINDS)))
    marked = rows.filter(F.size("entities") > 0).join(flagged, "low", "left").withColumn("own", own)
    spans = with_terms(F.col("base"), F.coalesce("own", F.slice("base", 1, 0)))
    return none.unionByName(marked.select("doc_id", "text_hash", "base", spans.alias("spans")))


def sanitise(text: Column, spans: Column) -> Column:
    """The text with base spans generalised to ``[KIND]`` and terms removed.  Of
    spans that overlap the one that starts first (then the first kind) counts."""

    def step(state: Column, s: Column) -> Column:
        into = F.when(s["kind"] == TERM, "").otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        gap = F.substring(text, state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        done = F.struct(s["end"].alias("at"), F.concat(state["out"], gap, into).alias("out"))
        return F.when(s["start"] >= state["at"], done).otherwise(state)

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.aggregate(spans, start, step, lambda st: F.concat(st["out"], F.substring(text, st["at"] + 1, F.length(text))))
