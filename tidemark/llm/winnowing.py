"""Document fingerprints by winnowing (DataFrame only).

The words of a text are hashed, ``k`` consecutive words make a gram, and of every
``w`` consecutive grams the one with the smallest hash is kept with its position,
the rightmost of equal ones.  So any run of ``k + w - 1`` equal words in two texts
shares a kept gram, at known positions.

``k`` and ``w`` are powers of two: gram hashes and window minima are rolled up by
doubling, each step one pass over an array (a gram of 2n words from two of n, a
minimum over 2n grams from two over n).  A kept gram is one long: 33 bits of hash
over the complement of its position, so that the smaller number is the smaller
hash, or the later position.

Defined results: a null text is empty; a text with fewer than ``k`` words has one
gram of all its words, one without words has none; with fewer than ``w`` grams all
are one window; two texts without grams are alike (1.0), one with and one without
are not (0.0).  An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import SPACE_CLASS, materialise, text_of

K = 4
W = 8
POSITION_BITS = 30
_LAST = (1 << POSITION_BITS) - 1


def _tail(column: str, n: int) -> Column:
    """An array without its first n entries."""
    return F.slice(F.col(column), n + 1, F.greatest(F.size(column) - n, F.lit(0)))


def _head(column: str, n: int) -> Column:
    return F.slice(F.col(column), 1, F.greatest(F.size(column) - n, F.lit(0)))


def fingerprint(df: DataFrame, text_col: str, out: str, k: int = K, w: int = W) -> DataFrame:
    """Adds ``out``: the kept grams, as longs (see ``gram_hash`` and
    ``gram_position``), in the order of their windows."""
    if k & (k - 1) or w & (w - 1):
        raise ValueError("k and w are powers of two")
    a, b = f"_{out}_a", f"_{out}_b"
    words = F.filter(F.split(F.col(text_col), SPACE_CLASS + "+"), lambda x: x != "")
    df = df.withColumn(a, F.transform(words, lambda x: F.xxhash64(x)))
    # too few words: one gram of them all
    df = df.withColumn(b, F.when(F.size(a) < k, F.when(F.size(a) > 0, F.array(F.xxhash64(F.col(a)))).otherwise(F.array().cast("array<long>"))))
    n = 1
    while n < k:
        df = df.withColumn(a, F.zip_with(_head(a, n), _tail(a, n), lambda x, y: F.xxhash64(x, y)))
        n *= 2
    df = df.withColumn(a, F.coalesce(F.col(b), F.col(a))).drop(b)
    packed = F.transform(
        F.col(a),
        lambda x, i: F.shiftleft(F.shiftrightunsigned(x, 31), POSITION_BITS).bitwiseOR(F.lit(_LAST) - i.cast("long")),
    )
    df = df.withColumn(a, packed)
    df = df.withColumn(b, F.when(F.size(a) < w, F.when(F.size(a) > 0, F.array(F.array_min(a))).otherwise(F.col(a))))
    n = 1
    while n < w:
        df = df.withColumn(a, F.zip_with(_head(a, n), _tail(a, n), lambda x, y: F.least(x, y)))
        n *= 2
    return df.withColumn(out, F.array_distinct(F.coalesce(F.col(b), F.col(a)))).drop(a, b)


def gram_hash(kept: Column) -> Column:
    return F.shiftrightunsigned(kept, POSITION_BITS)


def gram_position(kept: Column) -> Column:
    """The place of a gram's first word in the text, from 0."""
    return F.lit(_LAST) - kept.bitwiseAND(F.lit(_LAST))


def positions(kept: Column) -> Column:
    """The places of a fingerprint's grams, ascending: no ``w`` successive grams
    are without one of them."""
    return F.transform(kept, lambda x: gram_position(x).cast("int"))


def gram_set(kept: Column) -> Column:
    """The distinct hashes of a fingerprint."""
    return F.array_distinct(F.transform(kept, gram_hash))


def likeness(x: Column, y: Column) -> Column:
    """Twice the shared hashes over all hashes of two gram sets (Dice), 0 to 1."""
    both = F.size(x) + F.size(y)
    return F.when(both == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(x, y)) / both)


def digest(grams: Column) -> Column:
    """SHA-256 of a gram set: equal for equal sets."""
    return F.sha2(F.array_join(F.array_sort(grams), ","), 256)


def successors(values: DataFrame, fan: int = 4096) -> DataFrame:
    """(v, next_v) for distinct longs ``v``: the next larger one, null after the
    largest.  Values meet in groups of ``fan`` consecutive numbers; the successor
    of a group's last one is the first of the next group that there is, found the
    same way a level up, so no window holds more than ``fan`` rows."""
    lo, hi = values.agg(F.min("v"), F.max("v")).head()
    if lo is None or hi - lo < fan:  # so there are at most ``fan`` of them
        alone = Window.partitionBy(F.lit(0)).orderBy("v")
        return values.withColumn("next_v", F.lead("v").over(alone))
    group = F.floor(F.col("v") / F.lit(fan).cast("decimal(20,0)")).cast("long")
    grouped = values.withColumn("g", group)
    firsts = grouped.groupBy("g").agg(F.min("v").alias("first_v"))
    above = successors(firsts.select(F.col("g").alias("v")), fan)
    after = above.join(firsts.select(F.col("g").alias("next_v"), F.col("first_v").alias("after_v")), "next_v").select(
        F.col("v").alias("g"), "after_v"
    )
    own = Window.partitionBy("g").orderBy("v")
    return (
        grouped.withColumn("own_next", F.lead("v").over(own))
        .join(after, "g", "left")
        .select("v", F.coalesce("own_next", "after_v").alias("next_v"))
    )


RESULT = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "positions"]


def _measured(pairs: DataFrame, keep: list[str], k: int, w: int) -> DataFrame:
    """The result columns from text and next_text, and the columns to keep."""
    pairs = pairs.withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    own_part = F.left("text", F.col("n_chars").cast("int") - half)
    pairs = pairs.withColumn("edited", F.concat(own_part, F.left("next_text", half)))
    for text, grams in (("text", "own_g"), ("next_text", "next_g"), ("edited", "edited_g")):
        pairs = fingerprint(pairs, text, "kept", k, w).withColumn(grams, gram_set(F.col("kept")))
        if text == "text":
            pairs = pairs.withColumn("positions", positions(F.col("kept")))
        pairs = pairs.drop("kept")
    return pairs.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        digest(F.col("own_g")).alias("fingerprint"),
        digest(F.col("edited_g")).alias("edited_fingerprint"),
        likeness(F.col("own_g"), F.col("edited_g")).alias("near_edited"),
        likeness(F.col("own_g"), F.col("next_g")).alias("near_next"),
        "positions",
        *keep,
    )


def edited_likeness(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, w: int = W, block: int = 256
) -> DataFrame:
    """Fingerprints of every text and of its edited text: the last half of its code
    points replaced by the first as many (or all) of the next document (ascending
    id, null ids last, rows of equal id by text hash; after the last: the first).

    Rows meet in blocks of consecutive ids, so the texts are shuffled once and no
    window is longer than a block (a block of which the ids leave holes is short,
    never lost).  The last row of a block waits, with its text, for the first one
    of the next block that there is.

    ``positions`` holds the places of the text's kept grams."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    null_block = (1 << 62) // block
    at = F.floor(F.col("doc_id") / F.lit(block).cast("decimal(20,0)")).cast("long")
    rows = rows.withColumn("block", F.coalesce(at, F.lit(null_block))).withColumn("tie", F.xxhash64("text"))
    ordered = Window.partitionBy("block").orderBy(F.col("doc_id").asc_nulls_last(), F.col("tie"))
    inner = rows.withColumn("next_text", F.lead("text").over(ordered)).withColumn("place", F.row_number().over(ordered))
    last, first = F.col("next_text").isNull(), F.col("place") == 1
    inner = inner.withColumn("waits", last).withColumn("wait_text", F.when(last, F.col("text")))
    inner = inner.withColumn("head_text", F.when(first, F.col("text"))).withColumn("next_text", F.coalesce("next_text", F.lit("")))
    staged = materialise(_measured(inner, ["block", "waits", "wait_text", "head_text"], k, w), "winnowed-blocks")
    blocks = materialise(staged.select(F.col("block").alias("v")).distinct(), "id-blocks")
    first_block = blocks.agg(F.min("v")).head()[0]
    chain = successors(blocks).select(
        F.col("v").alias("to"), F.coalesce("next_v", F.lit(first_block).cast("long")).alias("block")
    )
    heads = staged.filter("head_text IS NOT NULL").select("block", F.col("head_text").alias("next_text"))
    heads = heads.join(chain, "block").select(F.col("to").alias("block"), "next_text")
    waiting = staged.filter("waits").select("doc_id", F.col("wait_text").alias("text"), "block").join(heads, "block")
    return staged.filter("NOT waits").select(*RESULT).unionByName(_measured(waiting, [], k, w))
