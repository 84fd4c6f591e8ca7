"""Two-pass n-grams and k-means on sparse rows against plain versions."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions.text import prefixes, windows
from tidemark.operators import text

DOCS = ["doc"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(21)
    out = ["", "a", "😀", "a😀b😀", "zz\n z", "é" * 7]
    return out + ["".join(rng.choice("abc 😀é") for _ in range(rng.randint(1, 60))) for _ in range(60)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc int, text string").repartition(4)


def _grams(t):
    return [t[i : i + n] for n in range(1, 5) for i in range(len(t) - n + 1)]


def test_prefixes_of_windows_are_the_grams(spark, texts, docs):
    rows = docs.select("doc", F.explode(windows(F.col("text"), 4)).alias("w"))
    rows = rows.select("doc", F.explode(prefixes(F.col("w"), 1, 4)).alias("g")).filter("g IS NOT NULL").collect()
    got = collections.Counter((r.doc, r.g) for r in rows)
    assert got == collections.Counter((i, g) for i, t in enumerate(texts) for g in _grams(t))


def test_counts_within_the_vocabulary(spark, texts, docs):
    kept, vocab = text.restricted_counts(docs, DOCS, "text", 30)
    total = collections.Counter(g for t in texts for g in _grams(t))
    top = sorted(total, key=lambda g: (-total[g], g))[:30]
    assert {r.gram: r.corpus_count for r in vocab.collect()} == {g: total[g] for g in top}
    want = {(i, " ".join(g)): n for i, t in enumerate(texts) for g, n in collections.Counter(_grams(t)).items() if g in top}
    assert {(r.doc, r.term): r.term_count for r in kept.collect()} == want
    # the one written table is the vocabulary; the counts come from two scans of the texts
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan


def test_lloyd_steps_equal_plain(spark, texts, docs):
    got, centres, vocab = text.fixed_start_clusters(docs, DOCS, "text", k=3, steps=4, max_features=25)
    terms = [r.gram for r in vocab.orderBy("term_index").collect()]
    x = np.array([[collections.Counter(_grams(t))[g] for g in terms] for t in texts], float)
    plain = np.array([x.mean(axis=0) * (2 * j + 1) / 3 for j in range(3)])

    def nearest(rows):
        return np.round((plain**2).sum(axis=1) - 2 * rows @ plain.T, text.DIGITS).argmin(axis=1)

    for _ in range(4):
        owner = nearest(x)
        plain = np.array([x[owner == j].mean(axis=0) if (owner == j).any() else plain[j] for j in range(3)])
    assert {r.doc: r.cluster for r in got.collect()} == dict(enumerate(nearest(x).tolist()))
    stored = {r.term_index: r.weights for r in centres.collect()}
    assert np.allclose([stored[i] for i in range(len(terms))], plain.T)
    # new documents, counted with the stored vocabulary and given to the stored centres
    new = spark.createDataFrame([(1, "abc abc"), (2, ""), (3, "unseen: xyz"), (4, texts[-1] * 3)], "doc int, text string")
    counts = text.counts_within(new, DOCS, "text", vocab)
    assigned = {r.doc: r.cluster for r in text.assign_to_centres(new, DOCS, counts, centres, 3).collect()}
    rows = np.array([[collections.Counter(_grams(r.text))[g] for g in terms] for r in new.orderBy("doc").collect()], float)
    assert assigned == dict(zip([1, 2, 3, 4], nearest(rows).tolist()))


def test_mllib_vectors_are_sparse(spark, docs):
    fitted = text.fit_comment_clusters(docs, DOCS, "text", max_features=25)
    assert {type(r.features).__name__ for r in fitted.training_vectors.collect()} == {"SparseVector"}
    assert fitted.assign(docs, DOCS, "text").count() == docs.count()
    empty = docs.filter("false")
    assert text.restricted_counts(empty, DOCS, "text")[0].count() == 0
    assert text.fixed_start_clusters(empty, DOCS, "text")[0].count() == 0
