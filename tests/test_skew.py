"""A key holding a third of all rows: the join-back of grouped totals is
split by AQE's skew join instead of landing in one task, and the result is
unchanged."""

import datetime as dt
import math

from pyspark.sql import functions as F

from tidemark.operators.attribution import time_decay

CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_hot_prospect_join_is_split(spark):
    old = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    try:
        n, hot = 30000, 7
        reg = dt.datetime(2024, 2, 1)
        clicks = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.col("id") % 997 + 100).alias("prospect_id"),
            F.col("id").alias("event_id"),
            (F.lit(1704067200) + F.col("id") * 60).alias("event_timestamp"),
            F.lit(reg).cast("timestamp_ntz").alias("registration_date"),
            (F.col("id") % 3).cast("int").alias("channel_coeff"),
            F.lit(100.0).alias("value"),
        ).repartition(8)
        out = time_decay(clicks)
        rows = out.collect()  # runs this Dataset's own adaptive plan to its final form
        sums = {}
        for r in rows:
            sums[r["prospect_id"]] = sums.get(r["prospect_id"], 0.0) + r["value_click"]
        assert len(rows) == n and all(math.isclose(s, 100.0, rel_tol=1e-9) for s in sums.values())
        final = out._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in final
        assert "skew=true" in final.lower() or "isskew=true" in final.lower(), final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_value_merge_is_split(spark):
    from tidemark.operators.identity import merge_day

    old = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    try:
        n = 30000
        ts = dt.datetime(2024, 1, 5)
        # every third id shares one household fingerprint; all ids have their own value too
        lab = spark.range(n).select(
            F.col("id").alias("super_id"),
            F.lit(1).alias("user_id_flg"),
            F.lit("fingerprint").alias("name"),
            F.when(F.col("id") % 3 == 0, F.lit("fh-hot")).otherwise(F.concat(F.lit("f"), F.col("id").cast("string"))).alias("value"),
            F.lit(ts).cast("timestamp_ntz").alias("date_insert"),
            F.col("id").alias("date_table"),
        ).unionByName(
            spark.range(n).select(
                F.col("id").alias("super_id"),
                F.lit(1).alias("user_id_flg"),
                F.lit("user_id").alias("name"),
                F.concat(F.lit("u"), F.col("id").cast("string")).alias("value"),
                F.lit(ts).cast("timestamp_ntz").alias("date_insert"),
                F.col("id").alias("date_table"),
            )
        ).repartition(8)
        out = merge_day(lab)
        rows = out.collect()
        ids = {r["value"]: r["super_id"] for r in rows}
        assert ids["fh-hot"] == 0 and ids["u3"] == 0 and ids["u1"] == 1
        final = out._jdf.queryExecution().executedPlan().toString().lower()
        assert "skew=true" in final or "isskew=true" in final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_giant_component_label_join_is_split(spark):
    """A third of the ids carry one label: the join to the label's row is split."""
    from tidemark.operators.identity import adopt_labels_label

    old = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    try:
        n = 30000
        label = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.greatest(F.col("id") - 1, F.lit(0)))
        hop = spark.range(n).select(F.col("id").alias("super_id"), label.alias("label")).groupBy("super_id").agg(F.min("label").alias("label"))
        out = adopt_labels_label(hop)
        got = {r.super_id: r.label for r in out.collect()}
        first = {i: 0 if i % 3 == 0 else max(i - 1, 0) for i in range(n)}
        assert got == {i: min(first[i], first[first[i]]) for i in range(n)}
        final = out._jdf.queryExecution().executedPlan().toString().lower()
        assert "skew=true" in final or "isskew=true" in final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
