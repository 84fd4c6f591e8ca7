"""J7: character n-gram counts, top-k vocabulary, sublinear TF-IDF, k-means.

Two passes over the texts.  The first counts n-grams over the corpus only: a row per
position with the longest n-gram there, combined before the shuffle, and the shorter
ones as prefixes of what is left.  The vocabulary is a top-k (each partition keeps its
own k best, then one merge); k is a parameter with a fixed bound, which is also what
makes broadcasting it safe.  The second pass keeps the n-grams of the vocabulary as it
meets them and counts them per document, so nothing larger than documents x k is
shuffled or written.

k-means runs on the sparse (document, term, count) rows: a Lloyd step is a join with the
centres (k numbers per term) and two grouped sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import characters, normalise, prefixes, spaced, substrings, windows
from tidemark.session import materialise

# Vocabulary size, n-gram range and cluster count of the job.
MAX_FEATURES = 250
NGRAM_RANGE = (1, 4)
N_CLUSTERS = 2
SEED = 42


def documents(df: DataFrame, text_col: str, normalise_text: bool = False, partitions: int | None = None) -> DataFrame:
    """Rows with a non-NULL text (NULL comments are dropped first).
    ``partitions`` spreads an input of few file splits before the n-grams."""
    out = df.filter(F.col(text_col).isNotNull())
    if partitions:
        out = out.repartition(partitions)
    if normalise_text:
        out = out.withColumn(text_col, normalise(F.col(text_col)))
    return out


def term_counts(
    df: DataFrame, doc_cols: Sequence[str], text_col: str, ngram_range: tuple[int, int] = NGRAM_RANGE
) -> DataFrame:
    """(doc..., gram, term_count) for every n-gram present in a document,
    with the n-gram still as its raw substring (see ``substrings``).

    A row per occurrence, combined per (document, gram) before the shuffle."""
    doc_cols = list(doc_cols)
    # the characters are a column of their own, cut once per document
    chars = df.select(*doc_cols, characters(F.col(text_col)).alias("_chars"))
    grams = chars.select(*doc_cols, F.explode(substrings(F.col("_chars"), *ngram_range)).alias("gram"))
    return grams.groupBy(*doc_cols, "gram").agg(F.count(F.lit(1)).alias("term_count"))


def corpus_counts(df: DataFrame, text_col: str, ngram_range: tuple[int, int] = NGRAM_RANGE) -> DataFrame:
    """(gram, term_count) over all texts: pass one."""
    low, high = ngram_range
    longest = df.select(F.explode(windows(F.col(text_col), high)).alias("_w")).groupBy("_w").agg(F.count(F.lit(1)).alias("_n"))
    grams = longest.select(F.explode(prefixes(F.col("_w"), low, high)).alias("gram"), "_n")
    return grams.filter("gram IS NOT NULL").groupBy("gram").agg(F.sum("_n").alias("term_count"))


def vocabulary(counts: DataFrame, max_features: int = MAX_FEATURES) -> DataFrame:
    """The ``max_features`` most frequent terms over the corpus; ties broken
    by the term (code-point order), as the reference vectorizer does.
    Returns (gram, term, corpus_count, term_index)."""
    totals = counts.groupBy("gram").agg(F.sum("term_count").alias("corpus_count"))
    # raw substrings order like their spaced terms, so the tie-break holds
    top = totals.orderBy(F.col("corpus_count").desc(), F.col("gram")).limit(max_features)
    # <= max_features rows: a window without PARTITION BY is bounded here
    return top.withColumns(
        {
            "term": spaced(F.col("gram")),
            "term_index": (F.row_number().over(Window.orderBy(F.col("gram"))) - 1).cast("int"),
        }
    )


def counts_within(
    df: DataFrame, doc_cols: Sequence[str], text_col: str, vocab: DataFrame, ngram_range: tuple[int, int] = NGRAM_RANGE
) -> DataFrame:
    """(doc..., term, term_index, term_count) of the vocabulary's terms: pass two.  Other
    n-grams end at the broadcast vocabulary (``max_features`` rows at most)."""
    positions = df.select(*doc_cols, F.explode(windows(F.col(text_col), ngram_range[1])).alias("_w"))
    grams = positions.select(*doc_cols, F.explode(prefixes(F.col("_w"), *ngram_range)).alias("gram"))
    found = grams.join(F.broadcast(vocab.select("gram", "term", "term_index")), "gram")
    return found.groupBy(*doc_cols, "term", "term_index").agg(F.count(F.lit(1)).alias("term_count"))


def restricted_counts(df: DataFrame, doc_cols: Sequence[str], text_col: str, max_features: int = MAX_FEATURES):
    """Sparse count matrix over the vocabulary, and the vocabulary itself (written)."""
    vocab = materialise(vocabulary(corpus_counts(df, text_col), max_features), "vocabulary")
    return counts_within(df, doc_cols, text_col, vocab), vocab


def tfidf(df: DataFrame, doc_cols: Sequence[str], text_col: str, max_features: int = MAX_FEATURES) -> DataFrame:
    """Sublinear TF-IDF, L2-normalised per document:
    w = (1 + ln tf) * (ln((1 + n) / (1 + df)) + 1), n = number of documents."""
    doc_cols = list(doc_cols)
    n_docs = df.count()
    kept = materialise(restricted_counts(df, doc_cols, text_col, max_features)[0], "term-counts")  # read twice
    doc_freq = kept.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = doc_freq.withColumn(
        "idf", F.log((F.lit(1.0 + n_docs)) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    )
    weighted = kept.join(F.broadcast(idf.select("term", "idf")), "term").withColumn(
        "w", (F.lit(1.0) + F.log(F.col("term_count").cast("double"))) * F.col("idf")
    )
    # a document has at most max_features entries, so a per-document window
    # is bounded by the vocabulary size
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(*doc_cols)))
    return weighted.select(*doc_cols, "term", (F.col("w") / norm).alias("tfidf"))


def _count_vectors(df: DataFrame, doc_cols: list[str], text_col: str, terms: list[str]) -> DataFrame:
    """Sparse count vectors over the vocabulary, without a shuffle."""
    from pyspark.ml.feature import CountVectorizerModel

    low, high = NGRAM_RANGE
    grams = F.flatten(F.transform(windows(F.col(text_col), high), lambda w: F.array_compact(prefixes(w, low, high))))
    docs = df.select(*doc_cols, grams.alias("_grams"))
    model = CountVectorizerModel.from_vocabulary(terms or [""], inputCol="_grams", outputCol="features")
    return model.transform(docs).drop("_grams")


class CommentClusters:
    """A fitted clustering: the vocabulary (``max_features`` terms at most) and the MLlib
    k-means model."""

    def __init__(self, terms: list[str], model, training_vectors: DataFrame | None = None):
        self.terms, self.model = terms, model
        self.training_vectors = training_vectors

    def assign(self, df: DataFrame, doc_cols: Sequence[str], text_col: str) -> DataFrame:
        """Cluster of each (new) document, vectorised with the fitted
        vocabulary (n-grams outside it are ignored)."""
        doc_cols = list(doc_cols)
        vectors = _count_vectors(df, doc_cols, text_col, self.terms)
        return self.model.transform(vectors).select(*doc_cols, F.col("cluster").cast("int").alias("cluster"))


def fit_comment_clusters(
    df: DataFrame,
    doc_cols: Sequence[str],
    text_col: str,
    k: int = N_CLUSTERS,
    seed: int = SEED,
    max_features: int = MAX_FEATURES,
) -> CommentClusters:
    """Fit k-means (MLlib, distributed) on the n-gram count vectors."""
    from pyspark.ml.clustering import KMeans

    doc_cols = list(doc_cols)
    vocab = vocabulary(corpus_counts(df, text_col), max_features)
    terms = [r["gram"] for r in vocab.orderBy("term_index").collect()]  # <= max_features
    # read by every k-means iteration: written once
    vectors = materialise(_count_vectors(df, doc_cols, text_col, terms), "features")
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(vectors)
    return CommentClusters(terms, model, vectors)


def kmeans_clusters(
    df: DataFrame,
    doc_cols: Sequence[str],
    text_col: str,
    k: int = N_CLUSTERS,
    seed: int = SEED,
    max_features: int = MAX_FEATURES,
) -> DataFrame:
    """Fit on the documents and assign every one of them (their feature
    vectors are already written, so they are not counted again)."""
    fitted = fit_comment_clusters(df, doc_cols, text_col, k, seed, max_features)
    return fitted.model.transform(fitted.training_vectors).select(
        *doc_cols, F.col("cluster").cast("int").alias("cluster")
    )


# --------------------------------------------------- k-means on sparse rows
#: Digits to which squared distances are compared, so that a tie is a tie on any engine.
DIGITS = 6


def scaled_mean_centres(counts: DataFrame, n_docs: int, k: int = N_CLUSTERS) -> DataFrame:
    """Fixed start: the documents' mean times (2j + 1) / k, j = 0..k-1, as sparse
    (term_index, weights): one array of k weights per term."""
    mean = F.sum("term_count") / F.lit(float(max(n_docs, 1)))
    return counts.groupBy("term_index").agg(
        F.array(*[mean * F.lit((2.0 * j + 1.0) / k) for j in range(k)]).alias("weights")
    )


def assign_to_centres(docs: DataFrame, doc_cols: Sequence[str], counts: DataFrame, centres: DataFrame, k: int) -> DataFrame:
    """(doc..., cluster) of every document: the nearest centre (ties: the lower number).

    |d - c|^2 = |d|^2 - 2 d.c + |c|^2, and |d|^2 is the same for all centres.  The centres
    have at most ``max_features`` rows, so they are broadcast; the products are added up
    before the shuffle.  A document without any term is judged by |c|^2 alone."""
    doc_cols = list(doc_cols)
    lengths = centres.agg(*[F.sum(F.col("weights")[j] * F.col("weights")[j]).alias(f"_c{j}") for j in range(k)])
    products = counts.join(F.broadcast(centres), "term_index").groupBy(*doc_cols).agg(
        *[F.sum(F.col("term_count") * F.col("weights")[j]).alias(f"_d{j}") for j in range(k)]
    )
    c = lengths.head()  # k numbers
    far = [F.round(F.lit(c[j] or 0.0) - 2 * F.coalesce(F.col(f"_d{j}"), F.lit(0.0)), DIGITS) for j in range(k)]
    nearest = F.array_min(F.array(*[F.struct(f.alias("d"), F.lit(j).alias("j")) for j, f in enumerate(far)]))["j"]
    keys = [F.col(x).alias(f"_key{i}") for i, x in enumerate(doc_cols)]
    same = [F.col(x).eqNullSafe(F.col(f"_key{i}")) for i, x in enumerate(doc_cols)]
    sums = products.select(*keys, *[f"_d{j}" for j in range(k)])
    return docs.select(*doc_cols).join(sums, same, "left").select(*doc_cols, nearest.cast("int").alias("cluster"))


def lloyd(docs: DataFrame, doc_cols: Sequence[str], counts: DataFrame, centres: DataFrame, k: int, steps: int) -> DataFrame:
    """The centres after ``steps`` Lloyd steps; a cluster without documents keeps its
    centre.  Each step's centres are written, so lineage stays short."""
    doc_cols = list(doc_cols)
    for _ in range(steps):
        owner = materialise(assign_to_centres(docs, doc_cols, counts, centres, k), "owners")
        sizes = {r["cluster"]: r["n"] for r in owner.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).collect()}  # k rows
        keys = [F.col(x).alias(f"_key{i}") for i, x in enumerate(doc_cols)]
        same = [F.col(x).eqNullSafe(F.col(f"_key{i}")) for i, x in enumerate(doc_cols)]
        sums = counts.join(owner.select(*keys, "cluster"), same).groupBy("term_index").agg(
            *[F.sum(F.when(F.col("cluster") == j, F.col("term_count"))).alias(f"_s{j}") for j in range(k)]
        )
        old = centres.withColumnRenamed("weights", "_old")
        means = [
            F.coalesce(F.col(f"_s{j}"), F.lit(0)) / F.lit(float(sizes[j])) if sizes.get(j) else F.coalesce(F.col("_old")[j], F.lit(0.0))
            for j in range(k)
        ]
        centres = materialise(sums.join(old, "term_index", "full").select("term_index", F.array(*means).alias("weights")), "centres")
    return centres


def fixed_start_clusters(
    df: DataFrame, doc_cols: Sequence[str], text_col: str, k: int = N_CLUSTERS, steps: int = 3, max_features: int = MAX_FEATURES
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """k-means from ``scaled_mean_centres`` in a fixed number of steps: (doc..., cluster)
    of every document, the centres, and the vocabulary with which new documents are
    counted (``counts_within``) and assigned (``assign_to_centres``)."""
    kept, vocab = restricted_counts(df, doc_cols, text_col, max_features)
    counts = materialise(kept.drop("term"), "term-counts")
    centres = materialise(scaled_mean_centres(counts, df.count(), k), "centres")
    centres = lloyd(df, doc_cols, counts, centres, k, steps)
    return assign_to_centres(df, doc_cols, counts, centres, k), centres, vocab
