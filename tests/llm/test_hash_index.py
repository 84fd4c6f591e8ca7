"""The extendible-hash index of the exact dedup: buckets, owners, crowded buckets."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup


@pytest.fixture(scope="module")
def corpus(spark):
    """300 different texts and a third of all rows copies of one."""
    rng = random.Random(3)
    rows = [(i, f"text {rng.randrange(10**9)} of {i}") for i in range(300)]
    rows += [(1000 + i, "the hot\ttext") for i in range(150)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def _index(corpus, capacity, owners=8, hash_bits=64, max_depth=20):
    texts = exact_dedup._texts(corpus, "doc_id", "text", hash_bits)
    entries = texts.groupBy("doc_id", "n_chars", "h").agg(F.count(F.lit(1)).alias("copies"))
    slots, depth = exact_dedup.directory(entries, owners, capacity, max_depth, hash_bits)
    return texts, slots, depth


def test_buckets_split_while_overfull(corpus):
    texts, slots, depth = _index(corpus, 16)
    of_bucket = collections.defaultdict(list)
    prefixes = collections.Counter()
    for (h,) in {(r.h,) for r in texts.select("h").collect()}:
        bits = f"{h % 2**64:064b}"
        prefixes.update(bits[:d] for d in range(65))
        of_bucket[bits[:depth]].append(h)
    for r in slots.collect():
        name = f"{r.bucket:0{r.local_depth}b}" if r.local_depth else ""
        assert f"{r.slot:0{depth}b}".startswith(name) and prefixes[name] == r.n_keys <= 16
        assert not name or prefixes[name[:-1]] > 16  # one bit less would be overfull
        assert 0 <= r.owner < 8 and r.crowded == (r.n_rows > 32)
    assert slots.count() == len(of_bucket)
    assert slots.filter("crowded").select("bucket").distinct().count() == 1
    # owners have ranges of keys
    order = [r.owner for r in slots.orderBy("slot").collect()]
    assert order == sorted(order) and len(set(order)) > 1


def test_owner_decides_the_place(corpus):
    texts, slots, depth = _index(corpus, 16)
    found = exact_dedup.at_owners(texts, slots, depth, 64, 8).withColumn("task", F.spark_partition_id())
    rows = found.collect()
    assert all(r.task == r.owner for r in rows)
    assert len(rows) == 301 and max(r.group_size for r in rows) == 150


def test_copies_collapse_before_they_are_sent(spark, corpus):
    """The rows that reach the owners: each other text, and the hot one at most
    once per task that collapsed it."""
    texts, slots, depth = _index(corpus, 16)
    found = exact_dedup.at_owners(texts, slots, depth, 64, 8)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 2 and plan.index("Aggregate") < plan.index("Repartition") < plan.rindex("Aggregate")
    physical = found._jdf.queryExecution().executedPlan().toString()
    # of the collapsed rows of crowded buckets, and to the owners: no third shuffle
    assert physical.count("Exchange hashpartitioning") == 1, physical
    assert physical.count("REPARTITION_BY_NUM") == 1 + texts._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_NUM") * 2, physical


@pytest.mark.parametrize("options", [{}, {"capacity": 1}, {"capacity": 4, "hash_bits": 3}, {"capacity": 2, "max_depth": 2}])
def test_same_groups_whatever_the_buckets(corpus, options):
    got = exact_dedup.exact_groups(corpus, **options).collect()
    assert collections.Counter(r.group_size for r in got) == {1: 300, 150: 150}
    hot = [r for r in got if r.group_size == 150]
    assert {r.keep_id for r in hot} == {1000} and sum(r.kept for r in hot) == 1
    assert len({(r.bucket, r.local_depth, r.owner) for r in hot}) == 1
