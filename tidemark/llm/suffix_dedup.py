"""Suffix-array dedup of repeated passages.

Every byte covered by a ``LENGTH``-byte string that also starts earlier (in a
document of smaller id, or earlier in the same one) is removed.

A suffix array of the corpus does not fit one machine, and suffixes that differ
early need not meet.  So windows (strings of ``LENGTH`` bytes) are brought together
by content: each one's anchor is its gram of ``GRAM`` bytes with the smallest hash,
the rightmost of equal ones.  Equal windows have equal anchors, and successive
windows share theirs, so the unit is a *context*: the bytes of successive windows
with one anchor.

1. Contexts of every text are listed by (anchor hash, context hash).  Equal contexts
   collapse, within a task before the shuffle and then per anchor: the earliest
   stays, the windows of the others start later than its own.
2. Anchors that still have several different contexts need their order.  The bytes
   of those contexts, cut from their documents, are sorted by the linear grouping
   construction (``suffix_sort``), which puts equal windows next to each other.
   Large sets of contexts of one anchor are split again by longer anchors, so
   neither a frequent gram nor a frequent passage makes a long string.
3. Of each run of equal windows all but the earliest are marked; marked windows of
   a document are merged, and its remaining bytes are hashed.

Long texts are taken in pieces of windows (with the bytes they need), so all of a
text is compared and memory stays bounded.  Rows travel as compressed blocks of
columns, keyed by hash buckets whose number follows the volume of the input.

Defined results: a null text is empty; texts shorter than ``LENGTH`` bytes lose
nothing; null ids come after all others; rows of equal id are ordered by text, and
of rows equal in id and text the first keeps its bytes; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, partitions_for, ship_package, text_of
from tidemark.llm.suffix_sort import _ranges, sort_suffixes

LENGTH = 100
GRAM = 40
#: Longer anchors for large sets of contexts; the last one is the whole window.
LONGER = (80, 94, LENGTH)
#: Bytes of contexts that are sorted as one string.
STRING = 4096
#: Symbols that are sorted together, in many strings.
TOGETHER = 1 << 19
#: Bytes of text that a task looks at together.
PIECE = 1 << 20
#: Bytes of text per hash bucket.
BUCKET = 8 << 20
NO_ID = np.int64(2**63 - 1)

RUN = (("h", "<u8"), ("c", "<u8"), ("doc", "<i8"), ("key", "<i8"), ("pos", "<u4"), ("m", "u1"))
SPAN = (("doc", "<i8"), ("key", "<i8"), ("start", "<u4"), ("end", "<u4"))
WANT = (("h", "<u8"), ("doc", "<i8"), ("key", "<i8"), ("pos", "<u4"), ("m", "u1"))

_A = np.uint64(0xD1342543DE82EF95)
_TABLE = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_A), -1, 2**64))
    up, down = np.full(n, _A), np.full(n, inverse)
    up[:1] = down[:1] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


_POWERS = [*_powers(1)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class Hashes:
    """Hashes of any part of a buffer, from sums of its bytes times powers."""

    def __init__(self, buffer: np.ndarray):
        n = len(buffer)
        if len(_POWERS[0]) < n + 1:
            _POWERS[:] = _powers(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_TABLE[buffer] * _POWERS[0][:n], out=self.sums[1:])

    def grams(self, k: int) -> np.ndarray:
        n = len(self.sums) - k
        return _mix((self.sums[k:] - self.sums[:n]) * _POWERS[1][:n])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * _POWERS[1][start])


def _slide(x: np.ndarray, w: int) -> np.ndarray:
    """Minima over w successive entries."""
    n = 1
    while 2 * n <= w:
        x = np.minimum(x[:-n], x[n:])
        n *= 2
    return np.minimum(x[: len(x) - (w - n)], x[w - n :]) if n < w else x


def contexts(buffer: np.ndarray, ends: np.ndarray, gram: int) -> tuple[np.ndarray, ...]:
    """Contexts of texts laid end to end: anchor hash, context hash, text number,
    place of the first window in the buffer, number of windows."""
    n = len(buffer)
    none = np.empty(0, np.int64)
    if n < LENGTH:
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none
    hashes = Hashes(buffer)
    h = hashes.grams(gram)
    low = np.uint64(0xFFFFFFFF)
    packed = (h & ~low) | (low - np.arange(len(h), dtype=np.uint64))
    anchor = (low - (_slide(packed, LENGTH - gram + 1) & low)).astype(np.int64)  # of the window at each place
    number = np.repeat(np.arange(len(ends)), np.diff(np.concatenate([[0], ends])))
    at = np.flatnonzero(np.arange(len(anchor)) + LENGTH <= ends[number[: len(anchor)]])
    if not len(at):
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none
    a, t = anchor[at], number[at]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (a[1:] != a[:-1]) | (t[1:] != t[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(fresh)
    m = np.diff(np.append(first, len(at)))
    start, a = at[first], a[first]
    c = _mix(hashes.of(start, start + m + LENGTH - 1) + (m * 256 + (a - start)).astype(np.uint64))
    return h[a], c, t[first], start, m


def collapse(h, c, doc, key, pos) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which contexts are the earliest of equal ones, which of those stand with
    others under their anchor, and which come later than an equal one (rows that
    repeat an id and text are no later)."""
    n = len(h)
    by = np.lexsort((pos, key, doc, c, h))
    hs, cs = h[by], c[by]
    new_h = np.ones(n, bool)
    new_h[1:] = hs[1:] != hs[:-1]
    new = new_h.copy()
    new[1:] |= cs[1:] != cs[:-1]
    heads = np.flatnonzero(new_h)
    several = np.add.reduceat(new, heads) > 1 if n else np.empty(0, bool)
    several = np.repeat(several, np.diff(np.append(heads, n)))
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0)) if n else by
    same = np.ones(n, bool)
    for x in (doc, key, pos):
        same &= x[by] == x[by][head]
    first, among, again = np.empty(n, bool), np.empty(n, bool), np.empty(n, bool)
    first[by], among[by], again[by] = new, new & several, ~same
    return first, among, again


def merge(doc, key, start, end) -> tuple[np.ndarray, ...]:
    """Spans of each document, merged where they touch or overlap."""
    by = np.lexsort((start, key, doc))
    doc, key, start, end = doc[by], key[by], start[by].astype(np.int64), end[by].astype(np.int64)
    if not len(doc):
        return doc, key, start, end
    other = np.ones(len(doc), bool)
    other[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
    group = np.cumsum(other) - 1
    lift = group * (1 << 33)  # so that ends of one document never reach the next one's
    reach = np.maximum.accumulate(end + lift)
    fresh = other.copy()
    fresh[1:] |= start[1:] + lift[1:] > reach[:-1]
    heads = np.flatnonzero(fresh)
    last = np.append(heads[1:], len(doc)) - 1
    return doc[heads], key[heads], start[heads], reach[last] - lift[last]


def pack(layout, *columns) -> bytes:
    data = b"".join(np.ascontiguousarray(col, dtype).tobytes() for (_, dtype), col in zip(layout, columns))
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unpack(layout, blocks) -> list[np.ndarray]:
    width = sum(np.dtype(dtype).itemsize for _, dtype in layout)
    parts: list[list[np.ndarray]] = [[] for _ in layout]
    for block in blocks:
        size = int.from_bytes(block[:8], "little")
        data, at = pa.decompress(block[8:], size, codec="zstd", asbytes=True), 0
        for part, (_, dtype) in zip(parts, layout):
            part.append(np.frombuffer(data, dtype, size // width, at))
            at += part[-1].nbytes
    return [np.concatenate(p) if p else np.empty(0, dtype) for p, (_, dtype) in zip(parts, layout)]


def _bucket_of(values: np.ndarray, buckets: int) -> np.ndarray:
    return (_mix(values.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _by_bucket(kind: str, layout, bucket: np.ndarray, columns) -> pd.DataFrame:
    """One packed row per bucket."""
    by = np.argsort(bucket, kind="stable")
    bucket = bucket[by]
    heads = np.flatnonzero(np.diff(bucket, prepend=-1))
    rows = []
    for a, b in zip(heads, np.append(heads[1:], len(bucket))):
        rows.append((kind, int(bucket[a]), pack(layout, *[np.asarray(col)[by[a:b]] for col in columns])))
    return pd.DataFrame(rows, columns=["kind", "bucket", "block"])


BLOCKS = "kind string, bucket long, block binary"


def _text_pieces(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """Texts, some together: (doc, key, place in the text, bytes).  A long text
    comes in pieces that share the bytes of their last windows."""
    some, size = [], 0
    for batch in batches:
        for doc, key, text in zip(batch["doc"].tolist(), batch["key"].tolist(), batch["text"].tolist()):
            data = text.encode()
            for at in range(0, max(1, len(data) - LENGTH + 1), PIECE):
                part = data[at : at + PIECE + LENGTH - 1]
                some.append((doc, key, at, part))
                size += len(part)
                if size >= PIECE:
                    yield some
                    some, size = [], 0
    if some:
        yield some


def list_contexts(buckets: int):
    """Contexts of texts by anchor, and spans of those that a task sees again."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in _text_pieces(batches):
            docs, keys = np.array([s[0] for s in some]), np.array([s[1] for s in some])
            offset, lens = np.array([s[2] for s in some]), np.array([len(s[3]) for s in some])
            ends = np.cumsum(lens)
            h, c, t, start, m = contexts(np.frombuffer(b"".join(s[3] for s in some), np.uint8), ends, GRAM)
            pos = start - (ends - lens)[t] + offset[t]
            doc, key = docs[t], keys[t]
            first, _, again = collapse(h, c, doc, key, pos)
            spans = merge(doc[again], key[again], pos[again], pos[again] + m[again] + LENGTH - 1)
            if len(spans[0]):
                yield _by_bucket("span", SPAN, _bucket_of(spans[0], buckets), spans)
            kept = [x[first] for x in (h, c, doc, key, pos, m)]
            yield _by_bucket("run", RUN, _bucket_of(kept[0], buckets), kept)

    return run


def settle_contexts(buckets: int):
    """Per bucket of anchors: spans of repeated contexts, and the contexts whose
    bytes are needed."""

    def run(key_, group: pd.DataFrame) -> pd.DataFrame:
        kind, _ = key_
        if kind == "span":
            return group[["kind", "bucket", "block"]]
        h, c, doc, key, pos, m = unpack(RUN, group["block"])
        order = np.argsort(h, kind="stable")
        hs = h[order]
        same = np.zeros(len(hs), bool)
        same[1:] |= hs[1:] == hs[:-1]
        same[:-1] |= hs[1:] == hs[:-1]
        at = order[same]  # anchors seen once have nothing to say
        h, c, doc, key, pos, m = (x[at] for x in (h, c, doc, key, pos, m))
        _, among, again = collapse(h, c, doc, key, pos)
        width = m[again].astype(np.int64) + LENGTH - 1
        spans = merge(doc[again], key[again], pos[again], pos[again] + width)
        want = [x[among] for x in (h, doc, key, pos, m)]
        return pd.concat(
            [_by_bucket("span", SPAN, _bucket_of(spans[0], buckets), spans), _by_bucket("want", WANT, _bucket_of(want[1], buckets), want)]
        )

    return run


def _texts_by_key(texts: pd.DataFrame) -> dict[tuple[int, int], bytes]:
    return {(d, k): t.encode() for d, k, t in zip(texts["doc"].tolist(), texts["key"].tolist(), texts["text"].tolist())}


CUT = (*WANT, ("size", "<u4"))


def cut_contexts(buckets: int):
    """Per bucket of documents: the bytes of the contexts asked for, by anchor."""

    def run(texts: pd.DataFrame, wants: pd.DataFrame) -> pd.DataFrame:
        if not len(wants):
            return pd.DataFrame({"bucket": [], "block": [], "bytes": []})
        h, doc, key, pos, m = unpack(WANT, wants["block"])
        data = _texts_by_key(texts)
        out, to = [], _bucket_of(h, buckets)
        by = np.lexsort((h, to))
        heads = np.flatnonzero(np.diff(to[by], prepend=-1))
        for a, b in zip(heads, np.append(heads[1:], len(by))):
            at = by[a:b]
            size = m[at].astype(np.int64) + LENGTH - 1
            cut = [data[d, k][p : p + s] for d, k, p, s in zip(doc[at].tolist(), key[at].tolist(), pos[at].tolist(), size.tolist())]
            block = pack(CUT, h[at], doc[at], key[at], pos[at], m[at], size)
            joined = b"".join(cut)
            out.append((int(to[by[a]]), block, len(joined).to_bytes(8, "little") + pa.compress(joined, codec="zstd", asbytes=True)))
        return pd.DataFrame(out, columns=["bucket", "block", "bytes"])

    return run


def repeated_windows(buffer, ends, group, doc, key, pos, longer=LONGER) -> list[tuple[np.ndarray, ...]]:
    """Spans (doc, key, start, end) of windows that are not the earliest of their
    kind, in contexts laid end to end; ``group`` numbers those of one anchor and
    does not decrease."""
    if not len(ends):
        return []
    lens = np.diff(np.concatenate([[0], ends]))
    starts = ends - lens
    heads = np.flatnonzero(np.diff(group, prepend=-1))
    total = np.add.reduceat(lens + 1, heads)
    large = np.repeat((total > STRING) & bool(longer), np.diff(np.append(heads, len(group))))
    out = []
    if large.any():
        out += _split(buffer, starts, lens, group, doc, key, pos, large, longer)
    small = np.flatnonzero(~large)
    # strings of about the same length together
    size = np.repeat(total, np.diff(np.append(heads, len(group))))[small]
    small = small[np.lexsort((group[small], size))]
    upto = np.cumsum(lens[small] + 1)
    while len(small):
        n = min(int(np.searchsorted(upto, TOGETHER)) + 1, len(small))
        while n < len(small) and group[small[n]] == group[small[n - 1]]:
            n += 1
        out.append(_sorted_windows(buffer, *(x[small[:n]] for x in (starts, lens, group, doc, key, pos))))
        small, upto = small[n:], upto[n:] - upto[n - 1]
    return out


def _split(buffer, starts, lens, group, doc, key, pos, large, longer) -> list[tuple[np.ndarray, ...]]:
    """Contexts of large groups again by longer anchors within their group."""
    at = np.flatnonzero(large)
    own = buffer[_ranges(starts[at], lens[at])]
    ends = np.cumsum(lens[at])
    h, c, t, start, m = contexts(own, ends, longer[0])
    h = _mix(h + group[at][t].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    doc, key, pos = doc[at][t], key[at][t], pos[at][t] + (start - (ends - lens[at])[t])
    _, among, again = collapse(h, c, doc, key, pos)
    out = [(doc[again], key[again], pos[again], pos[again] + m[again] + LENGTH - 1)]
    keep = np.flatnonzero(among)
    keep = keep[np.argsort(h[keep], kind="stable")]
    size = m[keep] + LENGTH - 1
    number = np.cumsum(np.diff(h[keep], prepend=h[keep][:1]) != 0) if len(keep) else np.empty(0, np.int64)
    return out + repeated_windows(
        own[_ranges(start[keep], size)], np.cumsum(size), number, doc[keep], key[keep], pos[keep], longer[1:]
    )


def _sorted_windows(buffer, starts, lens, group, doc, key, pos) -> tuple[np.ndarray, ...]:
    """The contexts of each group as one string (a separator after each, the end
    marked by the smallest symbol), sorted; equal windows are neighbours."""
    n = len(starts)
    text = np.ones(int(lens.sum()) + n, np.int16)
    base = np.cumsum(lens + 1) - (lens + 1)
    text[_ranges(base, lens)] = buffer[_ranges(starts, lens)].astype(np.int16) + 2
    last = np.flatnonzero(np.append(group[1:] != group[:-1], True))
    ends = (base + lens + 1)[last]
    text[ends - 1] = 0
    order = sort_suffixes(text, ends)
    # the windows among the suffixes
    owner = np.full(len(text), -1, np.int64)
    m = lens - LENGTH + 1
    owner[_ranges(base, m)] = np.repeat(np.arange(n), m)
    w = order[owner[order] >= 0]
    o = owner[w]
    equal = np.zeros(len(w), bool)
    same = np.flatnonzero(group[o[1:]] == group[o[:-1]])
    for at in range(0, len(same), 1 << 17):
        i = same[at : at + (1 << 17)]
        i = i[text[w[i] + LENGTH - 1] == text[w[i + 1] + LENGTH - 1]]
        span = np.arange(LENGTH)
        for j in range(0, len(i), 1 << 15):
            k = i[j : j + (1 << 15)]
            equal[k + 1] = (text[w[k][:, None] + span] == text[w[k + 1][:, None] + span]).all(axis=1)
    run = np.cumsum(~equal)
    d, k, p = doc[o], key[o], pos[o] + (w - base[o])
    by = np.lexsort((p, k, d, run))
    later = np.zeros(len(by), bool)
    later[1:] = run[by][1:] == run[by][:-1]
    at = by[later]
    return merge(d[at], k[at], p[at], p[at] + LENGTH)


def sort_contexts(buckets: int):
    """Per bucket of anchors: spans of windows that stand earlier as well."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        h, doc, key, pos, _, size = unpack(CUT, group["block"])
        size = size.astype(np.int64)
        data = np.frombuffer(
            b"".join(pa.decompress(b[8:], int.from_bytes(b[:8], "little"), codec="zstd", asbytes=True) for b in group["bytes"]), np.uint8
        )
        starts = np.cumsum(size) - size
        by = np.argsort(h, kind="stable")
        number = np.cumsum(np.diff(h[by], prepend=h[by][:1]) != 0)
        found = repeated_windows(data[_ranges(starts[by], size[by])], np.cumsum(size[by]), number, doc[by], key[by], pos[by].astype(np.int64))
        spans = [np.concatenate(x) for x in zip(*found)] if found else [np.empty(0, np.int64)] * 4
        spans = merge(*spans)
        return _by_bucket("span", SPAN, _bucket_of(spans[0], buckets), spans)

    return run


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>"


def finish(texts: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
    """Per bucket of documents: what is left of each."""
    doc, key, start, end = merge(*unpack(SPAN, blocks["block"]))
    spans: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for d, k, a, b in zip(doc.tolist(), key.tolist(), start.tolist(), end.tolist()):
        spans.setdefault((d, k), []).append((a, b))
    seen, rows = set(), []
    for d, k, text in zip(texts["doc"].tolist(), texts["key"].tolist(), texts["text"].tolist()):
        data = text.encode()
        own = spans.get((d, k), [])
        if (d, k) in seen and len(data) >= LENGTH:
            own = [(0, len(data))]
        seen.add((d, k))
        left = hashlib.sha256()
        at = 0
        for a, b in own:
            left.update(data[at:a])
            at = b
        left.update(data[at:])
        rows.append((
            None if d == NO_ID else d, len(data), sum(b - a for a, b in own), len(own), left.hexdigest(),
            [{"start": a, "end": b} for a, b in own],
        ))
    out = pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])
    out["doc_id"] = out["doc_id"].astype("Int64")
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed spans (in
    bytes of the UTF-8 text) of every row."""
    spark = docs.sparkSession
    ship_package(spark)
    text = text_of(text_col)
    texts = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(int(NO_ID))).alias("doc"), F.xxhash64(text).alias("key"), text.alias("text")
    )
    volume = texts.agg(F.sum(F.octet_length("text"))).head()[0]
    buckets = partitions_for(spark, volume, BUCKET)
    listed = texts.mapInPandas(list_contexts(buckets), BLOCKS)
    settled = materialise(listed.groupBy("kind", "bucket").applyInPandas(settle_contexts(buckets), BLOCKS), "contexts")

    def bucketed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(bucket=_bucket_of(batch["doc"].to_numpy(), buckets))

    placed = texts.mapInPandas(bucketed, "doc long, key long, text string, bucket long")
    wants = settled.filter("kind = 'want'")
    cut = placed.groupBy("bucket").cogroup(wants.groupBy("bucket")).applyInPandas(
        cut_contexts(buckets), "bucket long, block binary, bytes binary"
    )
    ordered = materialise(cut.groupBy("bucket").applyInPandas(sort_contexts(buckets), BLOCKS), "ordered-contexts")
    spans = settled.filter("kind = 'span'").unionByName(ordered)
    return placed.groupBy("bucket").cogroup(spans.groupBy("bucket")).applyInPandas(finish, RESULT)
