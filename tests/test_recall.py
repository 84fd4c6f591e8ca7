"""Decile recall against a plain sort, and how many rows it sorts."""

import math
import random

import pytest

from tidemark.operators import evaluation

SCHEMA = "score double, target int, id long"


def _plain(rows):
    key = lambda r: (r[0] is None or math.isnan(r[0]), -(r[0] or 0.0) if r[0] is not None and not math.isnan(r[0]) else 0.0, r[2])
    width = 0.1 * (len(rows) - 1) + 1.0
    buckets = {}
    for at, (s, t, _) in enumerate(sorted(rows, key=key)):
        b = buckets.setdefault(int(at // width), [0, 0, []])
        b[0] += 1
        b[1] += t
        if s is not None and not math.isnan(s):
            b[2].append(s)
    total, so_far, out = sum(b[1] for b in buckets.values()), 0, []
    for q in sorted(buckets):
        n, hits, scores = buckets[q]
        so_far += hits
        recall = math.floor(10_000 * so_far / total + 0.5) / 100 if total else None
        out.append((q, n, hits, min(scores, default=None), max(scores, default=None), so_far, recall))
    return out


def _rows(kind, n):
    rng = random.Random(n)
    draw = {
        "spread": lambda: rng.random(),
        "ties": lambda: float(rng.randint(0, 4)),
        "hot": lambda: 0.5 if rng.random() < 0.4 else rng.random(),
        "odd": lambda: rng.choice([None, math.nan, math.inf, -math.inf, 0.0, -0.0, rng.random()]),
        "none": lambda: None,
    }[kind]
    return [(draw(), rng.randint(0, 1), i) for i in range(n)]


@pytest.mark.parametrize("kind, n", [("spread", 3000), ("ties", 500), ("hot", 1000), ("odd", 700), ("none", 60), ("spread", 1), ("spread", 7), ("hot", 0)])
def test_recall_equals_plain_sort(spark, kind, n):
    rows = _rows(kind, n)
    got = evaluation.recall_by_bucket(spark.createDataFrame(rows, SCHEMA).repartition(4), "score", "target", "id")
    found = got.orderBy("quantile").collect()
    columns = ["quantile", "total", "sum_of_target", "min_of_score", "max_of_score", "sum_target_percentile"]
    want = _plain(rows)
    assert [tuple(r[c] for c in columns) for r in found] == [w[:-1] for w in want]
    assert [r.recall for r in found] == pytest.approx([w[-1] for w in want], abs=0.011) or not any(w[-1] for w in want)


def test_only_rows_near_a_border_are_sorted(spark, monkeypatch):
    sorted_rows = []
    numbered = evaluation.with_row_number

    def counting(df, *args, **options):
        sorted_rows.append(df.count())
        return numbered(df, *args, **options)

    monkeypatch.setattr(evaluation, "with_row_number", counting)
    df = spark.range(100_000).selectExpr("rand(1) AS score", "cast(id % 2 AS int) AS target", "id")
    df = spark.createDataFrame(df.collect(), df.schema)
    assert evaluation.recall_by_bucket(df, "score", "target", "id").count() == 10
    assert 0 < sum(sorted_rows) < 10_000
