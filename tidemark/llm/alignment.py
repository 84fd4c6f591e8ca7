"""Alignment of two tokenizers over a corpus, each distinct text aligned once.

Tokenizer A is a byte-level BPE (JSON file) and encodes space + text; B is a
sentencepiece BPE and encodes the text, to which it adds the space itself.

1. *Exact-text deduplication.*  Rows are grouped by their full text (combined before
   the shuffle), which leaves each distinct text once with its multiplicity.
2. *Alignment.*  Texts are taken in chunks of about ``CHUNK`` bytes.  The tokens' byte
   lengths are summed up; byte offsets at which tokens of both end cut the text into
   groups, and the two tokens that end there are linked.  Written per text: its
   measures and its linked id pairs, as positions in the chunk's list of pairs.
   Written per chunk: that list, each pair with its links times the multiplicities.
3. *Counts.*  The chunks' lists add up to the corpus count of every id pair and the
   highest count of every B id.  They are joined back to the chunks' lists, not to
   the texts' pairs, so a frequent pair has one row per chunk; no count table is
   broadcast.  A chunk's texts meet its counts in a cogroup, bounded by the chunk.
4. *Join.*  The measures return to the rows by the SHA-256 of the text.  That no two
   distinct texts share a digest is checked on the measures before.

Both sides of the joins are plain shuffles, so AQE splits a hot text or pair.

Texts are cut into pieces before single spaces between two other characters: neither
tokenizer joins across such a space, so the ids are those of the whole text, tokens of
both end there, and equal pieces are encoded and aligned once.  That holds for a
byte-level A with its usual pattern and for a B without pieces that have an inner space;
with other models (checked on loading) a text is one piece.

Defined results.  Null and empty texts, and texts whose tokens of A or B don't spell
space + text, have zeros and an empty ``groups_sha256``; they take no part in counts.
Very long texts are a chunk of their own.  Repeated rows and ids each return a row and
each count as a copy; a null id stays null.  Equal counts are all the highest.  Other
columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.byte_bpe import byte_characters
from tidemark.llm.common import ship_package
from tidemark.session import materialise

#: Bytes of text that are aligned together.
CHUNK = 4 << 20
#: Aligned pieces after which a worker begins a new generation of those it keeps (two
#: are kept), and the characters beyond which a piece is not kept.
KNOWN, LONG = 150_000, 200
SPACE = "▁"
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Tokens of A and B, linked pairs (A id * size of B + B id), groups as text.
Aligned = tuple[int, int, list[int], str]
NOTHING: Aligned = (0, 0, [], "")
_STATE: dict = {}

MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
_ALIGNED = (
    "chunk long, key binary, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "at array<int>, times array<int>, a array<int>, b array<int>, count array<long>"
)


class Aligner:
    """Both tokenizers of one worker, what their tokens spell, and aligned pieces."""

    def __init__(self, a_json: str, b_proto: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_proto)
        byte = {c: i for i, c in enumerate(byte_characters())}
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(SPACE, " ").encode())
        model = json.loads(a_json)
        pre = model.get("pre_tokenizer") or {}
        by_words = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not model.get("normalizer")
        inner = any(SPACE in self.b.id_to_piece(i).lstrip(SPACE) for i in range(self.b.get_piece_size()))
        self.cuts = by_words and not inner
        self.length_a, self.length_b = (np.array([len(t) for t in ts], np.int64) for ts in (self.bytes_a, self.bytes_b))
        # an id as text, followed by what stands after it
        self.comma_a, self.last_a = (np.array([f"{i}{c}" for i in range(len(self.bytes_a))], object) for c in ",|")
        self.comma_b, self.last_b = (np.array([f"{i}{c}" for i in range(len(self.bytes_b))], object) for c in ",;")
        self.known: dict[str, Aligned | None] = {}
        self.before: dict[str, Aligned | None] = {}

    def cut(self, text: str) -> list[str]:
        """The text in pieces, without the single spaces between them (the encoding
        of a piece begins with a space)."""
        return _CUT.split(text) if self.cuts else [text]

    def encode(self, pieces: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and of B for each piece."""
        found = self.a.encode_batch_fast([" " + p for p in pieces], add_special_tokens=False)
        return [e.ids for e in found], self.b.encode(pieces, num_threads=1)

    def group(self, texts: list[str], ids_a: list[list[int]], ids_b: list[list[int]]) -> list[Aligned | None]:
        """Each text's id lists cut at the byte offsets where tokens of both end; None
        if they don't spell space + text."""
        good = []
        for i, text in enumerate(texts):
            spelt_a, spelt_b = b"".join([self.bytes_a[t] for t in ids_a[i]]), b"".join([self.bytes_b[t] for t in ids_b[i]])
            if spelt_a == spelt_b and spelt_a[1:] == text.encode() and spelt_a[:1] == b" ":
                good.append(i)
        out: list[Aligned | None] = [None] * len(texts)
        if not good:
            return out
        a, b = (np.fromiter((t for i in good for t in ids[i]), np.int64) for ids in (ids_a, ids_b))
        n_a, n_b = (np.array([len(ids[i]) for i in good]) for ids in (ids_a, ids_b))
        text_end_a, text_end_b = np.cumsum(n_a), np.cumsum(n_b)
        # the texts stand one after the other: both lists spell the same bytes
        end_a, end_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        found = np.searchsorted(end_b, end_a)
        last_a = np.flatnonzero(end_b[found] == end_a)
        last_b = found[last_a]
        links = (a[last_a] * len(self.bytes_b) + b[last_b]).tolist()
        # ids as text in the order of the groups: A's of a group, then B's
        order = np.empty(len(a) + len(b), object)
        group_a, group_b = np.searchsorted(last_a, np.arange(len(a))), np.searchsorted(last_b, np.arange(len(b)))
        before_b, upto_a = np.concatenate(([0], last_b + 1)), last_a + 1
        where_a = np.arange(len(a)) + before_b[group_a]
        where_b = np.arange(len(b)) + upto_a[group_b]
        order[where_a], order[where_b] = self.comma_a[a], self.comma_b[b]
        order[where_a[last_a]], order[where_b[last_b]] = self.last_a[a[last_a]], self.last_b[b[last_b]]
        order = order.tolist()
        ends = (text_end_a + text_end_b).tolist()
        group_ends = np.searchsorted(last_a, text_end_a).tolist()
        begin = begin_group = 0
        for i, x, y, end, end_group in zip(good, n_a.tolist(), n_b.tolist(), ends, group_ends):
            out[i] = (x, y, links[begin_group:end_group], "".join(order[begin:end])[:-1])
            begin, begin_group = end, end_group
        return out

    def pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[Aligned], list[str]]:
        """Of the texts: the place of each piece among the distinct pieces, the
        number of pieces of each text, and the distinct pieces aligned.  A text with a
        piece that can't be aligned alone is aligned as a whole."""
        place: dict[str, int] = {}
        lists = []
        for text in texts:
            lists.append([place.setdefault(p, len(place)) for p in self.cut(text)])
        if len(self.known) > KNOWN:
            self.before, self.known = self.known, {}
        here = {p: self.known[p] if p in self.known else self.before[p] for p in place if p in self.known or p in self.before}
        new = [p for p in place if p not in here]
        here.update(zip(new, self.group(new, *self.encode(new))))
        self.known.update((p, x) for p, x in here.items() if len(p) <= LONG)
        found = [here[p] for p in place]
        if None in found:
            odd = {i for i, x in enumerate(found) if x is None}
            for k, text in enumerate(texts):
                if not odd.isdisjoint(lists[k]):
                    a, b = self.encode([text]) if len(lists[k]) == 1 else self._joined(text)
                    lists[k] = [len(found)]
                    found += self.group([text], a, b)
        flat = np.fromiter((i for each in lists for i in each), np.int64)
        return flat, np.array([len(each) for each in lists]), [x or NOTHING for x in found], lists

    def _joined(self, text: str) -> tuple[list[list[int]], list[list[int]]]:
        a, b = self.encode(self.cut(text))
        return [sum(a, [])], [sum(b, [])]

    def align(self, chunk: int, keys: list[bytes], texts: list[str], copies: list[int]) -> Iterator[tuple]:
        """Rows of one chunk: its pairs, then its texts."""
        flat, sizes, found, lists = self.pieces(texts)
        text_of = np.repeat(np.arange(len(texts)), sizes)
        n_a, n_b, n_links = (
            np.bincount(text_of, np.array(per, float)[flat], len(texts)).astype(np.int64)
            for per in ([x[0] for x in found], [x[1] for x in found], [len(x[2]) for x in found])
        )
        # links of a text: those of its distinct pieces, times the piece's occurrences
        cells, occurrences = np.unique(text_of * len(found) + flat, return_counts=True)
        text_of, piece_of = cells // len(found), cells % len(found)
        links = np.array([len(x[2]) for x in found], np.int64)
        starts = np.cumsum(links) - links
        codes, at = np.unique(np.array([c for x in found for c in x[2]], np.int64), return_inverse=True)
        lengths = links[piece_of]
        inner = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        pair = at[np.repeat(starts[piece_of], lengths) + inner]
        occurrences = np.repeat(occurrences, lengths)
        cells, back = np.unique(np.repeat(text_of, lengths) * max(len(codes), 1) + pair, return_inverse=True)
        times = np.bincount(back, occurrences, len(cells)).astype(np.int64)
        text_of, pair = cells // max(len(codes), 1), cells % max(len(codes), 1)
        bounds = np.searchsorted(text_of, np.arange(len(texts) + 1))
        if len(codes):
            count = np.zeros(len(codes), np.int64)
            np.add.at(count, pair, times * np.array(copies, np.int64)[text_of])
            pair_a, pair_b = codes // len(self.bytes_b), codes % len(self.bytes_b)
            yield (chunk, None, None, None, None, None, None, None, None, pair_a, pair_b, count)
        written = [x[3] for x in found]
        for k, key in enumerate(keys):
            groups = ";".join(map(written.__getitem__, lists[k]))
            digest = hashlib.sha256(groups.encode()).hexdigest() if n_a[k] else ""
            mine = slice(bounds[k], bounds[k + 1])
            yield (
                chunk, key, int(n_a[k]), int(n_b[k]), int(n_links[k]), int(n_links[k]), digest,
                pair[mine], times[mine], None, None, None,
            )


def _aligner(shared, key: str) -> Aligner:
    if _STATE.get("key") != key:
        _STATE.update(key=key, aligner=Aligner(*shared.value))
    return _STATE["aligner"]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in _ALIGNED.split(", ")]
    types = [pa.int64(), pa.binary(), *[pa.int64()] * 4, pa.string(), *[pa.list_(pa.int32())] * 4, pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names=names)


def aligned_texts(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text") -> DataFrame:
    """The written rows of step 2, for the distinct texts of ``docs``."""
    spark = docs.sparkSession
    ship_package(spark)
    with open(a_path, encoding="utf-8") as f:
        a_json = f.read()
    with open(b_path, "rb") as f:
        b_proto = f.read()
    key = hashlib.sha256(a_json.encode() + b_proto).hexdigest()
    shared = spark.sparkContext.broadcast((a_json, b_proto))  # two vocabulary files
    texts = (
        docs.select(F.col(text_col).cast("string").alias("text"))
        .filter("text <> ''")
        .groupBy("text")
        .agg(F.count(F.lit(1)).alias("copies"))
    )

    def run(batches):
        from pyspark import TaskContext

        aligner, chunk = _aligner(shared, key), TaskContext.get().partitionId() << 32
        keys, waiting, copies, size = [], [], [], 0
        for batch in batches:
            for text, n in zip(batch.column("text"), batch.column("copies").to_pylist()):
                text = text.as_py()
                raw = text.encode()
                if waiting and size + len(raw) > CHUNK:
                    yield _rows(list(aligner.align(chunk, keys, waiting, copies)))
                    keys, waiting, copies, size, chunk = [], [], [], 0, chunk + 1
                keys.append(hashlib.sha256(raw).digest())
                waiting.append(text)
                copies.append(n)
                size += len(raw)
        if waiting:
            yield _rows(list(aligner.align(chunk, keys, waiting, copies)))

    return materialise(texts.mapInArrow(run, _ALIGNED), "aligned")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a, b, count, best): links of every id pair over the corpus; best is true where
    no pair of the same B id has more."""
    chunk_pairs = aligned.filter("key is null").select(F.explode(F.arrays_zip("a", "b", "count")).alias("p"))
    counts = chunk_pairs.groupBy(F.col("p.a").alias("a"), F.col("p.b").alias("b")).agg(F.sum("p.count").alias("count"))
    counts = materialise(counts, "pair-counts")
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))
    return counts.join(highest, "b").select("a", "b", "count", (F.col("count") == F.col("highest")).alias("best"))


def text_measures(aligned: DataFrame) -> DataFrame:
    """A row per distinct text: key, the measures and groups_sha256."""
    counts = pair_counts(aligned)
    pairs = aligned.filter("key is null").select("chunk", F.posexplode(F.arrays_zip("a", "b")).alias("at", "p"))
    pairs = pairs.select("chunk", "at", F.col("p.a").alias("a"), F.col("p.b").alias("b"))
    pairs = pairs.join(counts, ["a", "b"]).select(F.col("chunk").alias("of_chunk"), "at", "count", "best")
    texts = aligned.filter("key is not null").select(
        "chunk", "key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "at", "times"
    )

    def weigh(texts: pa.Table, pairs: pa.Table) -> pa.Table:
        at = pairs.column("at").to_numpy()
        count, best = (np.zeros(len(at) + 1, np.int64) for _ in range(2))
        count[at] = pairs.column("count").to_numpy()
        best[at] = pairs.column("best").to_numpy().astype(np.int64)
        lists = texts.column("at").combine_chunks()
        cells, times = (texts.column(c).combine_chunks().flatten().to_numpy().astype(np.int64) for c in ("at", "times"))
        sums = []
        for each in (best, count):
            upto = np.concatenate(([0], np.cumsum(each[cells] * times)))
            ends = np.cumsum(lists.value_lengths().to_numpy())
            sums.append(np.diff(upto[ends], prepend=0) if len(ends) else ends)
        return texts.drop_columns(["chunk", "at", "times"]).append_column("n_best", pa.array(sums[0], pa.int64())).append_column(
            "count_sum", pa.array(sums[1], pa.int64())
        )

    schema = (
        "key binary, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    )
    return texts.groupBy("chunk").cogroup(pairs.groupBy("of_chunk")).applyInArrow(weigh, schema)


def align_documents(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    measures = materialise(text_measures(aligned_texts(docs, a_path, b_path, text_col)), "text-measures")
    if not measures.groupBy("key").count().filter("count > 1").isEmpty():
        raise ArithmeticError("two distinct texts have one SHA-256")
    key = F.when(F.col(text_col) != "", F.unhex(F.sha2(F.col(text_col).cast("string").cast("binary"), 256)))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), key.alias("key"))
    joined = rows.join(measures, "key", "left")
    return joined.select(
        "doc_id",
        *[F.coalesce(F.col(m), F.lit(0)).cast("long").alias(m) for m in MEASURES],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )
