"""J13: elements of HTML pages as rows (page, element, position, value).

All of it is column expressions on the row that holds the page (no Python, no shuffle):

1. One regex pass cuts the page into tokens: comments, script and style blocks with what
   they hold, tags (a ``>`` in a quoted attribute doesn't end one), runs of text.
2. A fold over the tokens keeps the stack of open elements and notes where each element
   of a wanted tag ends.  An end tag closes the innermost open element of its name and all
   in it; one without an open element is ignored; an element never closed runs to the end
   of its parent or of the page.  Void and self-closed tags are no parents.
3. A wanted element is a tag with, if asked for, a class among its classes.  Its value is
   an attribute, or its text: the text tokens up to its end, those of inner elements too.

Names of tags and attributes have any case, attribute values any quotes or none.  An
element may be wanted under several names.  A null or empty page has no rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Element(NamedTuple):
    """What to look for: a tag, a class it must have, the attribute to read (else text)."""

    tag: str
    class_name: str | None = None
    attribute: str | None = None


# The elements of the job.
ELEMENTS = {
    "a_href": Element("a", attribute="href"),
    "h1": Element("h1"),
    "div_ad": Element("div", class_name="ad"),
}
# Entity -> character; '&amp;' last so '&amp;lt;' stays '&lt;'.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]
# Elements of HTML that have no end tag.
VOID_TAGS = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"]

_TOKEN = (
    r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b[^>]*+>.*?(?:</\1\s*>|\z)|<![^>]*+>"
    r"""|</?[a-z](?:[^>"']++|"[^"]*+"|'[^']*+')*+>|</?[a-z][^>]*+>|[^<]++|<"""
)
_BLOCK = r"(?i)^<(?:!|(?:script|style)\b)"
_TAG = r"^</?([A-Za-z][^\s/>]*)"
_ATTRIBUTE = r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+))?"""
_VALUE = r"""(?s)^[^=]*=\s*(?:"([^"]*)"|'([^']*)'|(.*))$"""
_OPEN, _CLOSE, _TEXT, _NONE = "open", "close", "text", "none"


def unescape_basic(col: Column) -> Column:
    for entity, char in ENTITIES:
        col = F.replace(col, F.lit(entity), F.lit(char))
    return col


def _token(text: Column) -> Column:
    is_tag = text.rlike(r"^</?[A-Za-z]") & text.endswith(">")
    kind = (
        F.when(text.rlike(_BLOCK), _NONE)
        .when(is_tag & text.startswith("</"), _CLOSE)
        .when(is_tag, _OPEN)
        .otherwise(_TEXT)
    )
    return F.struct(text.alias("text"), kind.alias("kind"), F.lower(F.regexp_extract(text, _TAG, 1)).alias("tag"))


def _ends(tokens: Column, wanted: list[str]) -> Column:
    """Map from the place of an element's start tag to the place where it ends."""
    n = F.size(tokens)
    places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    empty = F.struct(
        F.array().cast("array<struct<tag:string,at:int>>").alias("stack"),
        F.array().cast("array<struct<at:int,end:int>>").alias("ends"),
    )

    def ended(stack: Column, at: Column) -> Column:
        mine = F.filter(stack, lambda s: s["tag"].isin(*wanted))
        return F.transform(mine, lambda s: F.struct(s["at"].alias("at"), at.alias("end")))

    def step(state: Column, i: Column) -> Column:
        token, stack = F.get(tokens, i), state["stack"]
        opens = (token["kind"] == _OPEN) & ~token["tag"].isin(*VOID_TAGS) & ~token["text"].endswith("/>")
        entry = F.array(F.struct(token["tag"].alias("tag"), i.alias("at")))
        pushed = F.struct(F.concat(stack, entry).alias("stack"), state["ends"].alias("ends"))
        level = F.array_max(F.transform(stack, lambda s, j: F.when(s["tag"] == token["tag"], j)))
        popped = F.struct(
            F.slice(stack, F.lit(1), level).alias("stack"),
            F.concat(state["ends"], ended(F.slice(stack, level + 1, F.size(stack)), i)).alias("ends"),
        )
        closes = (token["kind"] == _CLOSE) & F.exists(stack, lambda s: s["tag"] == token["tag"])
        return F.when(opens, pushed).when(closes, popped).otherwise(state)

    def rest(state: Column) -> Column:
        return F.map_from_entries(F.concat(state["ends"], ended(state["stack"], n)))

    return F.aggregate(places, empty, step, rest)


def _attribute(tag: Column, name: str) -> Column:
    """The value of a tag's first attribute of that name; '' without a value, null if
    there is none."""
    inside = F.regexp_replace(tag, r"^<[A-Za-z][^\s/>]*|/?>$", "")
    found = F.filter(
        F.regexp_extract_all(inside, F.lit(_ATTRIBUTE), F.lit(0)),
        lambda a: F.lower(F.regexp_extract(a, r"^([^\s=]+)", 1)) == name.lower(),
    )
    first = F.get(found, F.lit(0))
    value = F.concat(*[F.regexp_extract(first, _VALUE, g) for g in (1, 2, 3)])
    return unescape_basic(value)


def _values(tokens: Column, ends: Column, element: Element) -> Column:
    """The values of one element, in the order of its start tags."""

    def is_wanted(token: Column) -> Column:
        fits = (token["kind"] == _OPEN) & (token["tag"] == element.tag.lower())
        if element.class_name is not None:
            classes = F.split(F.coalesce(_attribute(token["text"], "class"), F.lit("")), r"\s+")
            fits = fits & F.array_contains(classes, element.class_name)
        return fits

    marked = F.transform(tokens, lambda t, i: F.when(is_wanted(t), i))
    starts = F.filter(marked, lambda i: i.isNotNull())
    if element.attribute is not None:
        read = F.transform(starts, lambda i: _attribute(F.get(tokens, i)["text"], element.attribute))
        return F.filter(read, lambda v: v.isNotNull())

    def text(i: Column) -> Column:
        inner = F.slice(tokens, i + 2, F.coalesce(F.element_at(ends, i) - i - 1, F.lit(0)))
        return F.array_join(F.transform(F.filter(inner, lambda t: t["kind"] == _TEXT), lambda t: unescape_basic(t["text"])), "")

    return F.transform(starts, text)


def page_elements(
    pages: DataFrame, elements: dict[str, Element] | None = None, id_col: str = "page_id", html_col: str = "html"
) -> DataFrame:
    """(page id, element, pos, value): a row per wanted element of each page."""
    elements = elements or ELEMENTS
    wanted = sorted({e.tag.lower() for e in elements.values() if e.attribute is None}) or [""]
    cut = F.regexp_extract_all(F.col(html_col), F.lit(_TOKEN), F.lit(0))
    tokens = pages.select(id_col, F.transform(cut, _token).alias("_tokens"))
    folded = tokens.withColumn("_ends", _ends(F.col("_tokens"), wanted))
    found = F.array(
        *[
            F.struct(F.lit(name).alias("element"), _values(F.col("_tokens"), F.col("_ends"), Element(*e)).alias("values"))
            for name, e in elements.items()
        ]
    )
    per_element = folded.select(id_col, F.explode(found).alias("e")).select(id_col, "e.element", "e.values")
    return per_element.select(id_col, "element", F.posexplode("values").alias("pos", "value")).select(
        id_col, "element", F.col("pos").cast("long").alias("pos"), "value"
    )
