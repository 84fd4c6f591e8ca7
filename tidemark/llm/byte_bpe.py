"""Byte-level BPE with a sentencepiece model made from a rank file.

The rank file (base64 token, rank per line) is turned into a sentencepiece BPE
model without training: every token's bytes are mapped to printable characters,
the piece's score is its negative rank (so the merge of lowest rank wins, leftmost
first), and normalisation is the identity.  Texts are cut into pre-tokens by the
vocabulary's pattern; each is encoded on its own, and decoding maps ids back to
bytes.

The model is made on the driver and broadcast (its size is that of the
vocabulary); workers load it once.  Long texts are cut in streaming fashion, so a
worker holds one text and its ids at a time.

Defined results: a null or empty text has no tokens; rows with equal ids or texts
are encoded one by one; other columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ship_package, text_of

#: Cached pre-tokens per worker; the cache starts anew when it is full.
CACHE = 400_000
#: Characters that are cut and encoded together.
STRETCH = 1 << 20
_STATE: dict = {}


def byte_characters() -> list[str]:
    """A printable character for each byte: visible Latin-1 stands for itself,
    the others follow from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, spare = [], 0x100
    for byte in range(256):
        if byte in visible:
            out.append(chr(byte))
        else:
            out.append(chr(spare))
            spare += 1
    return out


def read_ranks(spark: SparkSession, path: str) -> list[bytes]:
    """Tokens in the order of their ranks."""
    ranks: dict[int, bytes] = {}
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                token, rank = line.split()
                ranks[int(rank)] = base64.b64decode(token)
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("the ranks are not gapless")
    return [ranks[i] for i in range(len(ranks))]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(tag: int, n: int) -> bytes:
    return _varint(tag << 3) + _varint(n)


def _block(tag: int, data: bytes) -> bytes:
    return _varint(tag << 3 | 2) + _varint(len(data)) + data


def model_proto(tokens: list[bytes]) -> bytes:
    """The serialised model: pieces in rank order, then the unknown piece."""
    char = byte_characters()
    out = bytearray()
    for rank, token in enumerate(tokens):
        piece = "".join(char[b] for b in token).encode()
        out += _block(1, _block(1, piece) + _varint(2 << 3 | 5) + struct.pack("<f", -float(rank)) + _number(3, 1))
    out += _block(1, _block(1, b"<unk>") + _varint(2 << 3 | 5) + struct.pack("<f", 0.0) + _number(3, 2))
    trainer = _number(3, 2) + _number(4, len(tokens) + 1)  # model type BPE, vocabulary size
    trainer += _number(40, len(tokens))  # id of the unknown piece
    out += _block(2, trainer)
    normalizer = _block(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)  # no dummy prefix, spaces stay
    out += _block(3, normalizer)
    return bytes(out)


def pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Codec:
    """Encoder and decoder of one worker."""

    def __init__(self, proto: bytes, tokens: list[bytes], pattern: str):
        import regex
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.tokens = tokens
        self.whole = {t: struct.pack("<I", i) for i, t in enumerate(tokens)}
        self.char = dict(enumerate(byte_characters()))
        # White space as Unicode names it, whatever the regex library adds
        self.pattern = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}"))
        self.cache: dict[str, bytes] = {}

    def _learn(self, pieces: set[str]) -> None:
        """Encode the pre-tokens that the cache lacks, all in one call.  A full
        cache starts anew, and then every pre-token asked for is encoded."""
        if len(self.cache) > CACHE:
            self.cache.clear()
        new = [p for p in pieces if p not in self.cache]
        if not new:
            return
        raws = [p.encode() for p in new]
        ids = self.model.encode([raw.decode("latin-1").translate(self.char) for raw in raws], num_threads=1)
        whole = self.whole.get
        self.cache.update((p, whole(raw) or pack(found)) for p, raw, found in zip(new, raws, ids))

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of some short texts, as little-endian unsigned 32-bit integers."""
        cut = [self.pattern.findall(t) for t in texts]
        self._learn(set().union(*cut))
        get = self.cache.__getitem__
        return [b"".join(map(get, pieces)) for pieces in cut]

    def encode(self, text: str) -> bytes:
        """Ids of one text; a long one is cut piece by piece."""
        if len(text) <= STRETCH:
            return self.encode_many([text])[0]
        out, some, size = bytearray(), [], 0

        def flush() -> None:
            self._learn(set(some))
            out.extend(b"".join(map(self.cache.__getitem__, some)))

        for m in self.pattern.finditer(text):
            some.append(m[0])
            size += len(m[0])
            if size > STRETCH:
                flush()
                some, size = [], 0
        flush()
        return bytes(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, memoryview(ids).cast("I")))


def _codec(shared, key: str, pattern: str) -> Codec:
    if _STATE.get("key") != key:
        proto, tokens = shared.value
        _STATE.update(key=key, codec=Codec(proto, tokens, pattern))
    return _STATE["codec"]


def encode_documents(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row; with
    ``keep_ids`` also the ids (array of int) and the decoded text."""
    spark = docs.sparkSession
    ship_package(spark)
    tokens = read_ranks(spark, ranks_path)
    proto = model_proto(tokens)
    key = hashlib.sha256(proto + pattern.encode()).hexdigest()
    shared = spark.sparkContext.broadcast((proto, tokens))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if keep_ids:
        schema += ", ids array<int>, decoded string"

    def encoded(codec: Codec, batch: pd.DataFrame):
        ids, texts, some, size = batch["doc_id"].tolist(), batch["text"].tolist(), [], 0
        for i, text in enumerate(texts):
            if len(text) > STRETCH:
                yield ids[i], text, codec.encode(text)
                continue
            some.append(i)
            size += len(text)
            if size > STRETCH or i == len(texts) - 1:
                yield from ((ids[j], texts[j], e) for j, e in zip(some, codec.encode_many([texts[j] for j in some])))
                some, size = [], 0
        if some:
            yield from ((ids[j], texts[j], e) for j, e in zip(some, codec.encode_many([texts[j] for j in some])))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = _codec(shared, key, pattern)
        for batch in batches:
            rows = []
            for doc_id, _, ids in encoded(codec, batch):
                decoded = codec.decode(ids)
                row = [
                    doc_id, len(ids) // 4,
                    hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest(),
                ]
                if keep_ids:
                    row += [list(memoryview(ids).cast("I")), decoded.decode("utf-8", "replace")]
                rows.append(row)
            names = [c.split()[0] for c in schema.split(", ")]
            out = pd.DataFrame(rows, columns=names)
            out["doc_id"] = pd.array([None if pd.isna(v) else int(v) for v in out["doc_id"]], dtype="Int64")
            yield out

    narrow = docs.select(F.col(id_col).cast("string").alias("doc_id"), text_of(text_col).alias("text"))
    return narrow.mapInPandas(run, schema)
