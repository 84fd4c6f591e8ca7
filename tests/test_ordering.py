"""Distributed global numbering vs Spark's own single-partition windows."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.ordering import By, distinct_on, top1_rank, with_global_rank, with_prefix_sum, with_row_number


def _data(spark, n=3000, parts=6, seed=7):
    rnd = random.Random(seed)
    data = [
        (i, rnd.choice([None, "a", "b", "c", "d"]), rnd.randint(0, 40) if rnd.random() > 0.05 else None, rnd.random())
        for i in range(n)
    ]
    return spark.createDataFrame(data, "id long, g string, x int, y double").repartition(parts)


def test_row_number_matches_window(spark):
    df = _data(spark)
    ours = with_row_number(df, [By("x", desc=True), By("id")], name="rn")
    ref = df.withColumn("rn", F.row_number().over(Window.orderBy(F.col("x").desc(), "id")))
    assert sorted(ours.select("id", "rn").collect()) == sorted(ref.select("id", "rn").collect())


def test_row_number_total(spark):
    df = _data(spark, n=1234)
    _, total = with_row_number(df, ["id"], with_total=True)
    assert total == 1234


def test_global_rank_matches_window(spark):
    df = _data(spark)
    for dense in (False, True):
        fn = F.dense_rank if dense else F.rank
        ours = with_global_rank(df, [By("g"), By("x", desc=True)], name="r", dense=dense)
        ref = df.withColumn("r", fn().over(Window.orderBy(F.col("g").asc_nulls_first(), F.col("x").desc_nulls_last())))
        assert sorted(ours.select("id", "r").collect()) == sorted(ref.select("id", "r").collect())


def test_prefix_sum(spark):
    df = _data(spark, n=500)
    ours = with_prefix_sum(df, ["id"], F.coalesce(F.col("x"), F.lit(0)), "before").select("id", "before")
    got = dict(ours.collect())
    acc, want = 0, {}
    for r in sorted(df.collect(), key=lambda r: r["id"]):
        want[r["id"]] = acc
        acc += r["x"] or 0
    assert got == want


def test_top1_rank_matches_window_with_nulls_and_mixed_order(spark):
    df = _data(spark)
    orders = [
        [By("x", desc=True)],
        [By("x")],
        [By("x", desc=True, nulls_first=True)],
        [By("x", nulls_first=False)],
        [By("x", desc=True), By("id")],
    ]
    for order in orders:
        ours = top1_rank(df, ["g"], order, name=None).select("id")
        w = Window.partitionBy("g").orderBy(*[b.sort() for b in order])
        ref = df.withColumn("r", F.rank().over(w)).filter("r = 1").select("id")
        assert sorted(ours.collect()) == sorted(ref.collect()), order


def test_distinct_on_fixture(spark):
    # FIXTURES F1 plus the tie case
    data = [(1, 22), (1, 23), (1, 22), (2, 27), (2, 22), (2, 27), (3, 23), (3, 24), (3, 23), (3, 23), (4, 30), (4, 31)]
    t = spark.createDataFrame(data, "customer_id int, order_id int")
    counts = t.groupBy("customer_id", "order_id").agg(F.count(F.lit(1)).alias("total"))
    order = [By("total", desc=True), By("order_id", desc=True)]
    ranked = top1_rank(counts, ["customer_id"], order)
    assert sorted(tuple(r) for r in ranked.select("customer_id", "order_id", "total", "rn").collect()) == [
        (1, 22, 2, 1),
        (2, 27, 2, 1),
        (3, 23, 3, 1),
        (4, 31, 1, 1),
    ]
    d = distinct_on(counts, ["customer_id"], order).select("customer_id", "order_id")
    assert sorted(tuple(r) for r in d.collect()) == [(1, 22), (2, 27), (3, 23), (4, 31)]


def test_top1_equals_distinct_on_when_order_is_total(spark):
    df = _data(spark).filter(F.col("x").isNotNull())
    order = [By("x", desc=True), By("id", desc=True)]
    a = top1_rank(df, ["g"], order, name=None).select("g", "id")
    b = distinct_on(df, ["g"], order).select("g", "id")
    key = lambda r: (r["g"] or "", r["id"])
    assert sorted(a.collect(), key=key) == sorted(b.collect(), key=key)


def test_no_single_partition_exchange(spark):
    df = _data(spark)
    plan = with_global_rank(df, ["x"], "r")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_distinct_on_mixed_directions_brute_force(spark):
    df = _data(spark, n=1500).filter(F.col("x").isNotNull())
    order = [By("x", desc=True), By("y")]  # descending then ascending
    got = {r["g"]: (r["x"], r["y"]) for r in distinct_on(df, ["g"], order).collect()}
    want = {}
    for r in df.collect():
        key = (-r["x"], r["y"])
        if r["g"] not in want or key < want[r["g"]][0]:
            want[r["g"]] = (key, (r["x"], r["y"]))
    assert got == {g: v for g, (_, v) in want.items()}
