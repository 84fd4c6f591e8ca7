"""Quality classifier: logistic regression on hashed word n-grams, trained with
follow-the-regularised-leader (FTRL-proximal) updates.

A text is cut into words and runs of punctuation.  Each token has a hash of its
own and one of its shape (case, repetition, punctuation); token uni- and bigrams
and shape bi- and trigrams are hashed into ``2 ** bits`` columns, counted
and scaled to unit length.  The score is the logistic function of the sparse dot
product with the weights.

Training uses at most ``max_rows`` labelled texts (those whose id hashes
smallest), hashed by Spark tasks; one task then runs the updates over that bounded
set.  Only the weights (``2 ** bits`` numbers) are broadcast.  Scoring reads every
whole text; the tokens of a very long one are hashed in blocks, and the last tokens of
a block are carried into the next, so no n-gram is lost at a border.

Defined results: a null text is empty, and an empty text scores by the bias alone;
labels that are null, or whose id is null or absent, are not learned from; labels
given several times count once if they agree and are left out if they don't; with
no label to learn from every score is 0.5; rows are scored one by one, so equal
texts score alike; other columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ship_package, text_of

BITS = 18
#: Bound of the training sample.
MAX_ROWS = 6_000
EPOCHS = 3
#: Texts of more characters are hashed in blocks of ``BLOCK`` tokens.
PIECE = 1 << 18
BLOCK = 1 << 16
#: Tokens carried over: a shape trigram reaches back two, a repeat one more.
CARRIED = 3
_TOKEN = re.compile(r"\w+|[^\w\s]+")
_MULT = np.uint64(0x9E3779B97F4A7C15)


def held_out(id_col: str = "doc_id") -> Column:
    """The remainder by which rows are kept out of training."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 3 == 1


def _token_hashes(token: str) -> tuple[int, int]:
    """Hashes of a token and of its shape."""
    import xxhash

    if token[0].isalnum() or token[0] == "_":
        if token.isdigit():
            shape = "9"
        elif token.isupper():
            shape = "AA" if len(token) > 1 else "A"
        elif token.islower():
            shape = "a"
        elif token.istitle():
            shape = "Aa"
        else:
            shape = "aA"
    else:
        shape = token if len(token) <= 4 else token[0] * 4
    return xxhash.xxh64_intdigest(token), xxhash.xxh64_intdigest(shape, seed=1)


class Vocabulary(dict):
    """Tokens seen by a worker, numbered; their hashes stand in two arrays.  It
    starts anew when it is full."""

    FULL = 200_000

    def __init__(self) -> None:
        super().__init__()
        self.word, self.shape = np.empty(self.FULL * 2, np.uint64), np.empty(self.FULL * 2, np.uint64)

    def __missing__(self, token: str) -> int:
        at = len(self)
        if at == len(self.word):
            self.word = np.concatenate([self.word, np.empty_like(self.word)])
            self.shape = np.concatenate([self.shape, np.empty_like(self.shape)])
        self.word[at], self.shape[at] = _token_hashes(token)
        self[token] = at
        return at

    def of(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self) > self.FULL:
            self.clear()
        at = np.array(list(map(self.__getitem__, tokens)), np.int32)
        return self.word[at], self.shape[at]


_SEEN = Vocabulary()


def _columns(tokens: list[str], bits: int, carried: int = 0) -> np.ndarray:
    """Column numbers of all n-grams that end after the first ``carried`` tokens,
    repeats included."""
    if len(tokens) <= carried:
        return np.empty(0, np.int32)
    word, shape = _SEEN.of(tokens)
    shape[1:][word[1:] == word[:-1]] = np.uint64(12345)  # the word before, again
    grams = [
        word[carried:],
        ((word[:-1] * _MULT) ^ (word[1:] + _MULT))[max(carried - 1, 0) :],
        ((shape[:-1] * _MULT) ^ (shape[1:] + np.uint64(1)))[max(carried - 1, 0) :],
        (((shape[:-2] * _MULT) ^ shape[1:-1]) * _MULT ^ (shape[2:] + np.uint64(2)))[max(carried - 2, 0) :],
    ]
    mixed = np.concatenate([g * np.uint64(2 * i + 3) for i, g in enumerate(grams)])
    mixed = (mixed ^ (mixed >> np.uint64(29))) * _MULT
    return (mixed >> np.uint64(64 - bits)).astype(np.int32)


def token_blocks(text: str, size: int) -> Iterator[tuple[list[str], int]]:
    """The tokens of a text in blocks of ``size``, each led by up to ``CARRIED``
    tokens of the blocks before it; with the number of those."""
    found, carried = _TOKEN.finditer(text), []
    while block := [m.group() for m in islice(found, size)]:
        yield carried + block, len(carried)
        carried = (carried + block)[-CARRIED:]


def features(text: str, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct columns of a whole text and their values (unit length)."""
    if len(text) <= PIECE:
        columns, counts = np.unique(_columns(_TOKEN.findall(text), bits), return_counts=True)
    else:
        total = np.zeros(1 << bits, np.int64)
        for tokens, carried in token_blocks(text, BLOCK):
            total += np.bincount(_columns(tokens, bits, carried), minlength=1 << bits)
        columns = np.flatnonzero(total)
        counts = total[columns]
    values = np.log1p(counts)
    norm = np.sqrt((values**2).sum())
    return columns, values / norm if norm else values


class Ftrl:
    """Follow-the-regularised-leader with per-coordinate rates."""

    def __init__(self, bits: int = BITS, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros((1 << bits) + 1)  # the last one is the bias
        self.n = np.zeros((1 << bits) + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def update(self, columns: np.ndarray, values: np.ndarray, label: int) -> None:
        at = np.append(columns, len(self.z) - 1)
        x = np.append(values, 1.0)
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
        g = (p - label) * x
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def train(examples: list[tuple[int, np.ndarray, np.ndarray, int]], bits: int, epochs: int) -> np.ndarray:
    """Weights (bias last) after passes over (key, columns, values, label), each
    pass in an order drawn from its number."""
    model = Ftrl(bits)
    examples = sorted(examples, key=lambda e: e[0])
    for epoch in range(epochs):
        for i in np.random.default_rng(epoch).permutation(len(examples)):
            model.update(*examples[i][1:])
    return model.weights(np.arange(len(model.z)))


def learn_weights(
    docs: DataFrame, labels: DataFrame, bits: int = BITS, max_rows: int = MAX_ROWS, epochs: int = EPOCHS
) -> np.ndarray:
    """Weights learned from rows that are not held out.  The sample and its
    hashed features are bounded by ``max_rows``; one task trains."""
    ship_package(docs.sparkSession)
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
        .filter("doc_id IS NOT NULL AND label IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .filter("label = other")
        .filter(~held_out())
        .select("doc_id", "label", F.xxhash64("doc_id").alias("order"))
        .orderBy("order", "doc_id")
        .limit(max_rows)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    sample = texts.join(F.broadcast(known), "doc_id").select("order", "label", "text")

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for order, label, text in zip(batch["order"], batch["label"], batch["text"]):
                columns, values = features(text, bits)
                yield pd.DataFrame(
                    {"order": [order], "label": [label], "columns": [columns.astype("<i4").tobytes()],
                     "values": [values.astype("<f4").tobytes()]}
                )

    def trained(_, group: pd.DataFrame) -> pd.DataFrame:
        examples = [
            (o, np.frombuffer(c, "<i4").astype(np.int64), np.frombuffer(v, "<f4").astype(float), int(y))
            for o, y, c, v in zip(group["order"], group["label"], group["columns"], group["values"])
        ]
        return pd.DataFrame({"weights": [train(examples, bits, epochs).astype("<f8").tobytes()]})

    rows = (
        sample.mapInPandas(hashed, "order long, label int, columns binary, values binary")
        # an id may be repeated by any number of rows: rows are limited, not only ids
        .orderBy("order", F.xxhash64("columns", "values"))
        .limit(max_rows)
        .groupBy(F.lit(0).alias("one"))
        .applyInPandas(trained, "weights binary")
        .collect()
    )
    return np.frombuffer(bytes(rows[0]["weights"]), "<f8") if rows else np.zeros((1 << bits) + 1)


def score_text(text: str, weights: np.ndarray, bits: int = BITS) -> float:
    columns, values = features(text, bits)
    z = float(weights[columns] @ values + weights[-1])
    return float(1 / (1 + np.exp(-np.clip(z, -35, 35))))


def score_documents(
    docs: DataFrame, weights: np.ndarray, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(np.asarray(weights, float))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "held_out": batch["held_out"],
                 "score": [score_text(t, shared.value, bits) for t in batch["text"]]}
            )

    narrow = docs.select(F.col(id_col).cast("string").alias("doc_id"), held_out(id_col).alias("held_out"), text_of(text_col).alias("text"))
    scored = narrow.mapInPandas(run, "doc_id string, held_out boolean, score double")
    return scored.select(
        F.col("doc_id").cast("long").alias("doc_id"), "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, weights: np.ndarray, bits: int = BITS, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` with a score of at least 0.5; columns unchanged."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(np.asarray(weights, float))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: score_text(t, shared.value, bits)).astype(float)

    return docs.filter(score(text_of(text_col)) >= 0.5)
