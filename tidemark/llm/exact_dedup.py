"""Exact dedup through an extendible-hash index on shared files (DataFrame only).

1. *Entries*: one narrow row per document (64-bit hash of the normalised text,
   length, digest), written to the shared folder.
2. *Directory*: distinct hashes are counted per hash prefix.  Starting from one
   bucket, a bucket with more than ``capacity`` of them is split on its next bit,
   for which the directory doubles where it must; a bucket at the last bit chains
   instead.  The directory has at most ``2 ** max_depth`` slots whatever the corpus
   holds: beyond that the capacity grows.  Each bucket belongs to one owner, and an
   owner has all buckets of one key range.
3. *Records*: the directory sends every text to the owner of its bucket, where the
   texts of a bucket that share a hash form a chain and are told apart by their
   bytes.  Texts of a crowded bucket (more than twice ``capacity`` rows, so copies
   or a long chain) are first collapsed where they are read, so a group of copies
   of any size reaches its owner as few rows.  Each owner writes its records as
   one file, sorted by hash.
4. Each entry takes the record of its hash; entries whose hash has a chain of
   several texts are settled by their digest, unique among the records.

Defined results: a null text is empty; all texts without other characters than
white space are equal (the empty text); ties in length go to the smallest doc_id,
a null doc_id comes after all others; of rows that repeat an id and text, one
stays; a long text is compared whole, as one value; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, materialise, own_names, partitions_for, text_of

#: Distinct hashes of a bucket.
CAPACITY = 512
MAX_DEPTH = 20
#: Characters of text per owner.
OWNED = 64 << 20


def normalised(column: str = "text") -> Column:
    return F.translate(text_of(column), SPACES, "")


def _texts(docs: DataFrame, id_col: str, text_col: str, hash_bits: int) -> DataFrame:
    """doc_id, n_chars, norm and its hash; ``hash_bits`` below 64 is for tests of
    chains."""
    base = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.length(text_of(text_col)).cast("long").alias("n_chars"),
        normalised(text_col).alias("norm"),
    )
    return base.withColumn("h", F.shiftrightunsigned(F.xxhash64("norm"), 64 - hash_bits) if hash_bits < 64 else F.xxhash64("norm"))


def _prefix(h: Column, depth: int, hash_bits: int) -> Column:
    """The first ``depth`` bits of the hash."""
    if depth == 0:
        return F.lit(0).cast("long")
    return F.shiftrightunsigned(h, hash_bits - depth)


def directory(entries: DataFrame, owners: int, capacity: int, max_depth: int, hash_bits: int) -> tuple[DataFrame, int]:
    """The directory and its depth in bits: slot, bucket, local_depth, n_keys, n_rows,
    crowded, owner.  A bucket is named by the first ``local_depth`` bits of its hashes:
    the fewest at which it holds no more than ``capacity`` distinct ones."""
    loads = materialise(entries.groupBy("h").agg(F.sum("copies").alias("n_rows")), "hash-loads")
    keys = loads.count()
    capacity = max(capacity, -(-4 * keys // 2**max_depth))
    # some bits more than even splits need, as prefixes fill unevenly
    depth = min(max_depth, hash_bits, math.ceil(math.log2(max(1.0, keys / capacity))) + 4)
    slots = materialise(
        loads.groupBy(_prefix(F.col("h"), depth, hash_bits).alias("slot")).agg(
            F.count(F.lit(1)).alias("n_keys"), F.sum("n_rows").alias("n_rows")
        ),
        "hash-slots",
    )
    # every slot's bucket at every depth, and what it would hold there
    levels = slots.withColumn("local_depth", F.explode(F.sequence(F.lit(0), F.lit(depth)))).withColumn(
        "bucket", F.expr(f"shiftright(slot, {depth} - local_depth)")
    )
    held = levels.groupBy("local_depth", "bucket").agg(F.sum("n_keys").alias("n_keys"), F.sum("n_rows").alias("n_rows"))
    stops = held.filter((F.col("n_keys") <= capacity) | (F.col("local_depth") == depth))
    first = F.min(F.struct("local_depth", "bucket", "n_keys", "n_rows")).alias("b")
    settled = levels.select("slot", "local_depth", "bucket").join(stops, ["local_depth", "bucket"]).groupBy("slot").agg(first)
    start = F.expr(f"shiftleft(b.bucket, {depth} - b.local_depth)")
    owned = settled.select(
        "slot", "b.bucket", "b.local_depth", "b.n_keys", "b.n_rows",
        (F.col("b.n_rows") > 2 * capacity).alias("crowded"),
        F.shiftright(start * F.lit(owners).cast("long"), depth).cast("int").alias("owner"),
    )
    return materialise(owned, "hash-index-directory"), depth


def at_owners(texts: DataFrame, slots: DataFrame, depth: int, hash_bits: int, owners: int) -> DataFrame:
    """One row per distinct text, in the partition of its owner: h, norm, owner, bucket,
    local_depth, best, group_size."""
    # at most 2 ** max_depth rows of five numbers
    lookup = F.broadcast(slots.select(F.col("slot").alias("dir_slot"), "bucket", "local_depth", "crowded", "owner"))
    best = F.struct((-F.col("n_chars")).alias("m"), F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("d"))
    placed = texts.withColumn("dir_slot", _prefix(F.col("h"), depth, hash_bits)).join(lookup, "dir_slot")
    placed = placed.select("h", "norm", "owner", "bucket", "local_depth", "crowded", best.alias("best"), F.lit(1).cast("long").alias("n"))
    key = ["h", "norm", "owner", "bucket", "local_depth"]
    collapse = F.min("best").alias("best"), F.sum("n").alias("n")
    crowded = placed.filter("crowded").groupBy(*key).agg(*collapse)
    sent = placed.filter("NOT crowded").drop("crowded").unionByName(crowded)
    chains = sent.repartitionById(owners, "owner").groupBy(*key).agg(*collapse)
    return chains.withColumnRenamed("n", "group_size")


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    max_depth: int = MAX_DEPTH,
    hash_bits: int = 64,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, h,
    n_chars, bucket, local_depth, owner, copies.  ``copies`` numbers the rows that repeat
    the id and text of a row; they are counted once each."""
    spark = docs.sparkSession
    texts = _texts(docs, id_col, text_col, hash_bits)
    entries = materialise(
        texts.select("doc_id", "n_chars", "h", F.sha2("norm", 256).alias("text_sha256"))
        .groupBy("doc_id", "n_chars", "h", "text_sha256")
        .agg(F.count(F.lit(1)).alias("copies")),
        "hash-entries",
    )
    owners = partitions_for(spark, entries.agg(F.sum(F.col("n_chars") * F.col("copies"))).head()[0], OWNED)
    slots, depth = directory(entries, owners, capacity, max_depth, hash_bits)
    records = materialise(
        at_owners(texts, slots, depth, hash_bits, owners)
        .select(
            "bucket", "local_depth", "owner", "h", F.sha2("norm", 256).alias("text_sha256"), "group_size",
            F.col("best.d").alias("keep_id"), (-F.col("best.m")).alias("keep_chars"),
        )
        .sortWithinPartitions("h"),
        "hash-index-records",
    )
    chains = records.groupBy("h").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1")
    keys = ["h"]
    if not chains.isEmpty():
        keys = ["h", "text_sha256"]  # the digest names the text among those of its chain
        clash = records.groupBy("h", "text_sha256").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1")
        if not clash.isEmpty():
            raise RuntimeError("two different texts share a 64-bit hash and a SHA-256 digest")
    other = records if len(keys) == 2 else records.drop("text_sha256")
    joined = entries.join(other, keys)
    each = joined.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    kept = (F.col("copy") == 1) & F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("keep_chars"))
    return each.select(
        "doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256", "h", "n_chars",
        "bucket", "local_depth", "owner", "copies",
    )


def keep_first_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that ``exact_groups`` drops; columns unchanged."""
    groups = exact_groups(docs, id_col, text_col, **options)
    k_id, k_sha, k_copies, sha = own_names(docs, "k_id", "k_sha", "k_copies", "d_sha")
    stay = groups.filter("kept").select(
        F.col("doc_id").alias(k_id), F.col("text_sha256").alias(k_sha), F.col("copies").alias(k_copies)
    )
    # coalesced, so that the join adds no null filter that would digest every text twice
    keyed = docs.withColumn(sha, F.coalesce(F.sha2(normalised(text_col), 256), F.lit("")))
    same_id = keyed[id_col].cast("long").eqNullSafe(F.col(k_id))
    joined = keyed.join(stay, same_id & (F.col(sha) == F.col(k_sha)))
    single = joined.filter(F.col(k_copies) == 1).select(*[docs[c] for c in docs.columns])
    repeats = joined.filter(F.col(k_copies) > 1)
    if stay.filter(F.col(k_copies) > 1).isEmpty():
        return single
    first = repeats.dropDuplicates([k_id, k_sha]).select(*[docs[c] for c in docs.columns])
    return single.unionByName(first)
