"""SimHash near-dedup with pigeonring filtering.

Fingerprints: 64 bits, bit j set if more than half of the shingle hashes (XXH64)
have it set.  Two documents link if their fingerprints differ in at most ``t``
bits; components of the links are the groups.

Pigeonring: the 64 bits are cut into ``m = t + 1`` segments on a ring.  If two
fingerprints differ in at most t bits, then for some start the cumulative
differences of the 1, 2, ... consecutive segments stay within 1, 2, ... times t/m,
rounded down: 0, 1, ..., t.  So there is a start whose segment is equal and whose
next segment differs in one bit at most.  Both are the key of an index join: every
distinct fingerprint is filed under (start, segment, next segment), and looked up
under the same and under each next segment with one of its zero bits set (of two
segments one bit apart, one has a zero where the other has a one).  Candidates are
then held against the budgets of longer chains and at last against the full
Hamming distance, within the join, so rejected candidates are never rows.

Copies of a fingerprint are collapsed before the search.  A distinct fingerprint
has at most 1 + 64 + ... partners within t bits, so no group of copies makes a
quadratic number of links.

Defined results: a null or empty text, or one of white space only, has fingerprint
zero, which links like any other; a null doc_id belongs to a component but never
names it (a component of null ids has a null component_id); rows with equal ids or
texts are separate rows of one component; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, own_names, ship_package, text_of
from tidemark.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
#: Bytes of a text whose shingles are hashed together.
PIECE = 1 << 20


def _piece_words(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some at a time."""
    start = 0
    while start < len(data):
        end = start + PIECE
        if end < len(data):
            cuts = [data.rfind(s, start, end) for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")]
            cut = max(cuts)
            while cut <= start and end < len(data):  # a word longer than a piece
                after = [p for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c") if (p := data.find(s, end)) >= 0]
                cut = end = min(after, default=len(data))
            end = cut if cut > start else end
        yield data[start:end].split()
        start = end


def shingle_hashes(text: str, words_per_shingle: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """XXH64 of all shingles, repeats included, as arrays of unsigned integers."""
    import xxhash

    k, digest = words_per_shingle, xxhash.xxh64_intdigest
    carry: list[bytes] = []
    made = False
    for words in _piece_words(text.encode().lower()):  # bytes: A-Z only
        words = carry + words
        if len(words) >= k:
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            starts = [0, *ends[: len(words) - k].tolist()]
            stops = (ends[k - 1 :] - 1).tolist()
            made = True
            yield np.array([digest(joined[a:b], SEED) for a, b in zip(starts, stops)], np.uint64)
        carry = words[-(k - 1) :] if k > 1 else []
    if not made and carry:
        yield np.array([digest(b" ".join(carry), SEED)], np.uint64)


def fingerprint(text: str, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """64 bits as a signed integer."""
    ones, total = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text, words_per_shingle):
        total += len(hashes)
        for at in range(0, len(hashes), 4096):
            part = hashes[at : at + 4096]
            bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
    value = sum(1 << j for j in np.flatnonzero(2 * ones > total).tolist())
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, words_per_shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash and fp of every row."""
    ship_package(docs.sparkSession)

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: fingerprint(t, words_per_shingle)).astype("int64")

    text = text_of(text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), fp(text).alias("fp"))


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of the ring's segments."""
    m = max_bits + 1
    cuts = [64 * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _segment(fp: Column, first: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << width) - 1)) if width < 64 else fp


def _chains_hold(x: Column, y: Column, start: Column, max_bits: int) -> Column:
    """The cumulative differences from ``start`` on stay within their budgets."""
    ring = segments(max_bits)
    m = len(ring)
    diff = x.bitwiseXOR(y)
    counts = [F.bit_count(_segment(diff, a, w)) for a, w in ring]
    tests = []
    for s in range(m):
        chain = [
            sum((counts[(s + i) % m] for i in range(1, length)), counts[s]) <= length * max_bits // m
            for length in range(1, m + 1)
        ]
        tests.append((start == s) & reduce(lambda p, q: p & q, chain))
    return reduce(lambda p, q: p | q, tests)


def links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints ``fp`` within ``max_bits``; each pair
    once or more."""
    ring = segments(max_bits)
    m, fp = len(ring), F.col("fp")

    def key(s: int, second: Column | None = None) -> Column:
        (a, w), (b, v) = ring[s], ring[(s + 1) % m]
        second = _segment(fp, b, v) if second is None else second
        return F.struct(F.lit(s).alias("start"), _segment(fp, a, w).alias("one"), second.alias("two"))

    if m == 1:  # equal fingerprints only
        return distinct.select(fp.alias("a"), fp.alias("b")).limit(0)
    filed = distinct.select(fp.alias("b"), F.inline(F.array(*[key(s) for s in range(m)])))

    def one_bit_more(s: int) -> Column:
        """The keys from start ``s`` with one zero of the next segment set."""
        (b, v) = ring[(s + 1) % m]
        second = _segment(fp, b, v)
        bit_values = F.array(*[F.lit(1 << j).cast("long") for j in range(v)])
        zeros = F.filter(bit_values, lambda bit: second.bitwiseAND(bit) == 0)
        return F.transform(zeros, lambda bit: key(s, second.bitwiseOR(bit)))

    asked_keys = [part for s in range(m) for part in (F.array(key(s)), one_bit_more(s))]
    asked = distinct.select(fp.alias("a"), F.inline(F.concat(*asked_keys)))
    x, y = asked.alias("x"), filed.alias("y")
    near = (F.bit_count(F.col("x.a").bitwiseXOR(F.col("y.b"))) <= max_bits) & (F.col("x.a") != F.col("y.b"))
    ringed = _chains_hold(F.col("x.a"), F.col("y.b"), F.col("x.start"), max_bits)
    same = (F.col("x.start") == F.col("y.start")) & (F.col("x.one") == F.col("y.one")) & (F.col("x.two") == F.col("y.two"))
    return x.join(y, same & ringed & near).select("a", "b")


def near_groups(
    docs: DataFrame,
    words_per_shingle: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, fingerprint, component_id, text_hash and ``first``: true for the row
    of a component with the smallest (doc_id, text_hash), null ids last."""
    rows = materialise(fingerprints(docs, words_per_shingle, id_col, text_col), "fingerprints")
    rank = F.struct(F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("d"), F.col("text_hash").alias("t"))
    distinct = materialise(rows.groupBy("fp").agg(F.min(rank).alias("least")), "distinct-fingerprints")
    roots = components(links(distinct, max_bits))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    first = rooted.groupBy("root").agg(F.min("least").alias("first"))
    classes = rooted.join(first, "root").select("fp", "first")
    return rows.join(classes, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first.d").alias("component_id"),
        "text_hash",
        rank.eqNullSafe(F.col("first")).alias("first"),
    )


def keep_first_of_groups(
    docs: DataFrame,
    words_per_shingle: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with one document of each component; columns unchanged.  Rows that
    repeat the id and text of the one that stays count as that document: one is
    kept."""
    first = near_groups(docs, words_per_shingle, max_bits, id_col, text_col).filter("first")
    k_id, k_h, k_n, h = own_names(docs, "k_id", "k_h", "k_n", "d_h")
    stay = materialise(
        first.groupBy(F.col("doc_id").alias(k_id), F.col("text_hash").alias(k_h)).agg(F.count(F.lit(1)).alias(k_n)),
        "first-of-groups",
    )
    keyed = docs.withColumn(h, F.xxhash64(text_of(text_col)))
    same = keyed[id_col].cast("long").eqNullSafe(F.col(k_id)) & (F.col(h) == F.col(k_h))
    joined = keyed.join(stay, same)
    single = joined.filter(F.col(k_n) == 1).select(*[docs[c] for c in docs.columns])
    if stay.filter(F.col(k_n) > 1).isEmpty():
        return single
    repeats = joined.filter(F.col(k_n) > 1).dropDuplicates([k_id, k_h]).select(*[docs[c] for c in docs.columns])
    return single.unionByName(repeats)
