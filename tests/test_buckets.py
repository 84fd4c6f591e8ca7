"""Bucketed tables: a change rewrites the buckets it touches and no others."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import contacts
from tidemark.operators import identity as I
from tidemark.operators.buckets import BucketedTable

T0, T1, NOW = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3)
SCHEMA = "phone_from string, phone_to string, n long, load_dttm timestamp_ntz"
KEYS = ["phone_from", "phone_to"]


def _key(rows):
    return sorted(map(str, rows))


def test_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    target = spark.createDataFrame([(f"p{i}", f"q{i % 7}", i, T0) for i in range(200)], SCHEMA)
    staging = spark.createDataFrame([("p3", "q3", 1003, T1), ("new", "q", 5, T1), (None, "q", 6, T1), ("new", "q", 5, T1)], SCHEMA)
    table = BucketedTable(spark, f"{tmp_path}/t", target.schema, KEYS, 32)
    assert table.read().count() == 0
    table.replace(target)
    before = {b: table.files(b) for b in range(32)}
    only = contacts.upsert_table(table, staging, ["n"], "load_dttm", NOW)
    after = {b: table.files(b) for b in range(32)}
    assert len(only) <= 3 and {b for b in range(32) if before[b] != after[b]} == set(only)
    whole = contacts.upsert(target, staging, KEYS, ["n"], "load_dttm", NOW)
    assert _key(table.read().collect()) == _key(whole.collect())
    # the scan of a change opens the touched buckets' partitions only
    plan = table.read(only)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_bucket" in plan.split("PartitionFilters: [")[1]
    # a broken staging table changes nothing
    bad = spark.createDataFrame([("p3", "q3", 1, T1), ("p3", "q3", 2, T1)], SCHEMA)
    with pytest.raises(Exception, match="several staging rows"):
        contacts.upsert_table(table, bad, ["n"], "load_dttm", NOW)
    assert {b: table.files(b) for b in range(32)} == after
    assert contacts.upsert_table(table, staging.filter("false"), ["n"]) == []


def test_a_bucket_left_without_rows_is_emptied(spark, tmp_path):
    df = spark.range(40).select(F.col("id"), F.lit("x").alias("v"))
    table = BucketedTable(spark, f"{tmp_path}/t", df.schema, ["id"], 8)
    table.replace(df)
    gone = df.filter("id = 5")
    only = table.touched(gone)
    table.replace(table.read(only).filter("false"), only)
    assert table.files(only[0]) == set()
    assert table.read().count() == df.filter(~table.bucket().isin(only)).count()


def test_sessions_of_untouched_persons_stay(spark, tmp_path):
    """Persons 1..40 on the first day; the second day touches persons 3 and 4 (which one
    new row joins) and adds a new one."""
    master = I.open_master(spark, f"{tmp_path}/m", 4)
    schema = "super_id long, name string, value string, date_insert timestamp_ntz, date_table long"
    first = [(p, name, f"{name[0]}{p}_{k}", T0, 10 * p + k) for p in range(1, 41) for name, k in (("user_id", 1), ("user_id", 2), ("client_id", 3))]
    second = [(3, "user_id", "u3_9", T1, 500), (3, "client_id", "c4_3", T1, 501), (41, "user_id", "u41", T1, 502)]
    last = None
    store = I.session_store(spark, f"{tmp_path}/s", 64)
    since = None
    for day, rows in ((dt.date(2024, 1, 1), first), (dt.date(2024, 1, 2), second)):
        master.append(spark.createDataFrame(rows, schema), day, last)
        last = master.commit(day, last)
        before = {b: store.files(b) for b in range(64)}
        since = I.extend_sessions(store, master, since)
        assert since == day
        whole = I.user_sessions(master.rows())
        assert _key(I.stored_sessions(store).select(*whole.columns).collect()) == _key(whole.collect())
    changed = {b for b in range(64) if before[b] != store.files(b)}
    touched = spark.createDataFrame([(3,), (4,), (41,)], "super_id long")
    assert changed == set(store.touched(touched))
    assert I.extend_sessions(store, master, since) == since  # nothing new: nothing written
    assert changed == {b for b in range(64) if before[b] != store.files(b)}
