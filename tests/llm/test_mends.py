"""Wrapped and named articles, repeated rows in shards, bounds, clashing names, stages."""

import collections

import numpy as np
import pytest

from tidemark.llm import exact_dedup, html_mincut, mixing, quality, sharding, simhash
from tidemark.llm.common import own_names

P = "<p>This is a paragraph of running text with some words in it.</p>"
PLAIN = "This is a paragraph of running text with some words in it."


@pytest.mark.parametrize(
    "html, text",
    [
        (f"<body><form id=f><div>{P * 3}</div></form></body>", "\n".join([PLAIN] * 3)),
        (f"<main><form><div>{P}</div></form></main>", PLAIN),
        ("<body>Hello</body>", "Hello"),
        (f"<article class='post comments-open'><h1>T</h1>{P}</article><div id=comments>{P * 9}</div>", f"T\n{PLAIN}"),
        (f"<article class='post comments-open'>{P}<div class=comments>{P * 9}</div></article>", PLAIN),
        (f"<article>{P * 2}</article><form>{P}</form>", f"{PLAIN}\n{PLAIN}"),
        ("<nav><a href=x>one</a> <a href=y>two</a></nav>", ""),
        (f"<div class=sidebar><article>{P}</article></div>", PLAIN),
        ("", ""),
    ],
)
def test_articles_are_not_lost(html, text):
    assert html_mincut.main_text(html) == text


def test_shards_stay_equal_with_repeated_rows(spark):
    rows = [(7, "x" * 200)] * 1000 + [(i, "y" * 190) for i in range(2000)] + [(None, None)] * 500
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = sharding.shard_documents(df, 24).collect()
    assert collections.Counter((r.doc_id, r.size) for r in got) == collections.Counter((d, len(t or "") + 8) for d, t in rows)
    loads, places = collections.Counter(), collections.defaultdict(list)
    for r in got:
        loads[r.shard] += r.size
        places[r.shard].append(r.slot)
    mean = sum(loads.values()) / 24
    assert len(loads) == 24 and max(loads.values()) < 1.1 * mean and min(loads.values()) > 0.9 * mean
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_the_next_version_moves_named_slots_only(spark, tmp_path):
    docs = spark.range(3000).selectExpr("id AS doc_id", "repeat('ab', cast(id % 50 AS int)) AS text")
    folder = str(tmp_path)
    first = sharding.shard_documents(docs, 6, slots=64, map_folder=folder)
    assert first.agg({"version": "max"}).head()[0] == 1 and sharding.latest_version(spark, folder) == 1
    old = sharding.load_map(spark, folder, 1)
    recs = sharding.records(docs, 64)
    new = sharding.rebalance(spark, folder, recs, 7, slots=64)
    stored = sharding.load_map(spark, folder, sharding.latest_version(spark, folder))
    assert (new.version, stored.version, stored.shards) == (2, 2, 7) and stored.shard_of == new.shard_of
    moved = {s for s in range(64) if old.shard_of[s] != stored.shard_of[s]}
    assert moved == set(new.moved) and 0 < len(moved) < 32 and all(stored.shard_of[s] == 6 for s in moved)


def test_training_rows_are_bounded(spark):
    """An id that many rows repeat: max_rows examples are learned, as from that many rows."""
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 0), (5, 1), (6, 0)], "doc_id long, quality int")
    texts = {i: f"text {i} of some words and more" for i in range(1, 7)}
    rows = [(i, t) for i, t in texts.items() for _ in range(200)]
    many = quality.learn_weights(spark.createDataFrame(rows, "doc_id long, text string"), labels, max_rows=10)
    few = spark.createDataFrame([(i, texts[i]) for i in texts for _ in range(10)], "doc_id long, text string")
    assert np.array_equal(many, quality.learn_weights(few, labels, max_rows=10))
    assert many.any()


CLASH = ["_k_id", "_k_sha", "_k_copies", "_d_sha", "_k_h", "_k_n", "_d_h", "_k_l", "_k_s", "_k_pass", "__k_id", "_K_H"]


def test_helper_names_cannot_clash(spark):
    row = (1, "some text of five words or more", "en", "s", 31, *range(len(CLASH)))
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}{i}` int" for i, c in enumerate(CLASH))
    plain = spark.createDataFrame([row, row, (2, "other words stand in this one", "en", "s", 29, *range(len(CLASH)))], schema)
    df = plain.toDF(*plain.columns[:5], *CLASH[:10], "__k_id", "other")
    assert not set(own_names(df, "k_id", "k_h")) & set(df.columns)
    for stage in (exact_dedup.keep_first_copies, simhash.keep_first_of_groups, mixing.mixed_documents):
        out = stage(df)
        assert out.columns == df.columns and out.count() >= 1  # the mixture takes a part of the tokens
