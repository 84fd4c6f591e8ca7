"""Identity resolution: fixture cases, invariants, batch loop vs stream."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from tidemark.operators import identity as I
from tidemark.sources.shards import read_day_shards, write_day_shards

AS_OF = dt.datetime(2024, 2, 1)
D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
SCHEMA = (
    "event_date date, event_timestamp long, event_name string, user_id string, user_pseudo_id string, "
    "fingerprint string, event_params array<struct<key:string,value:string>>"
)
P = [("k", "1")]


def _events(spark):
    rows = [
        # a chain u1 - fA - u2 - fB - u3 - fC - u4: two hops leave 3 persons, the closure 1
        (D1, 1, "view", "u1", "c1", "fA", P),
        (D1, 2, "view", "u2", "c2", "fA", P),
        (D1, 3, "view", "u2", "c2", "fB", P),
        (D1, 4, "view", "u3", "c3", "fB", P),
        (D1, 5, "view", "u3", "c3", "fC", P),
        (D1, 6, "view", "u4", "c4", "fC", P),
        # sentinels: undefined user with a fingerprint, blank user without one,
        # undefined client (dropped), event without params (dropped)
        (D1, 7, "view", "undefined", "c7", "f7", P),
        (D1, 8, "view", "", "c8", "", P),
        (D1, 9, "view", "u9", "undefined", "f9", P),
        (D1, 10, "view", "u10", "c10", "f10", []),
        # day 2: u1 again on a new client (partly known), a new user, u2 again (fully known)
        (D2, 11, "view", "u1", "c11", "", P),
        (D2, 12, "view", "u12", "c12", "f12", P),
        (D2, 13, "view", "u2", "c2", "fA", P),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_clean_and_slice(spark):
    ev = _events(spark)
    app = I.clean_ids(I.click_events(ev, D1))
    got = {r["date_table"]: r for r in app.collect()}
    assert 9 not in got and 10 not in got  # undefined client, no params
    assert got[7]["user_id"] == "undefined" or got[7]["user_id"] == ""
    assert got[8]["fgp"] is None and got[8]["user_id"] == ""


def test_label_and_merge(spark):
    lab = I.label_day(I.clean_ids(I.click_events(_events(spark), D1)), AS_OF)
    assert lab.filter(F.col("value").isNull()).count() == 0
    merged = I.merge_day(lab)
    # every value ends with exactly one person
    assert merged.groupBy("value").agg(F.countDistinct("super_id").alias("n")).filter("n != 1").count() == 0
    persons = {r["value"]: r["super_id"] for r in merged.collect()}
    chain = [persons[v] for v in ["u1", "u2", "u3", "u4"]]
    assert len(set(chain)) == 3  # two hops do not close a 4-link chain
    assert persons["u1"] == persons["u2"] == persons["fA"] == persons["fB"]
    assert persons["c7"] == persons["f7"]  # anonymous client with its fingerprint
    closure = {r["value"]: r["super_id"] for r in I.merge_closure(lab).collect()}
    assert len({closure[v] for v in ["u1", "u2", "u3", "u4", "fA", "fB", "fC"]}) == 1
    assert len(set(closure.values())) <= len(set(persons.values()))


def test_closure_matches_union_find(spark):
    lab = I.label_day(I.clean_ids(I.click_events(_events(spark), D1)), AS_OF)
    pairs = [(r["super_id"], r["value"]) for r in lab.select("super_id", "value").distinct().collect()]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for s, v in pairs:
        a, b = find(("s", s)), find(("v", v))
        if a != b:
            parent[a] = b
    comp_min = {}
    for s, v in pairs:
        root = find(("s", s))
        comp_min[root] = min(comp_min.get(root, s), s)
    want = {v: comp_min[find(("v", v))] for _, v in pairs}
    got = {r["value"]: r["super_id"] for r in I.merge_closure(lab).collect()}
    assert got == want


def test_fold_branches_and_rerun(spark):
    ev = _events(spark)
    master = I.run_days(ev, D1, D1, AS_OF)
    day2 = I.day_pipeline(ev, D2, AS_OF)
    appended = {r["value"]: r["super_id"] for r in I.fold_into_master(day2, master, AS_OF).collect()}
    old = {r["value"]: r["super_id"] for r in master.collect()}
    assert appended["c11"] == old["u1"]  # partly known: old id
    assert appended["u12"] > max(old.values())  # unknown: new id after the max
    assert "c2" not in appended  # fully known: nothing appended
    # folding the same day twice adds no new person the second time
    full = master.unionByName(I.fold_into_master(day2, master, AS_OF))
    again = I.fold_into_master(day2, full, AS_OF)
    assert {r["super_id"] for r in again.collect()} <= {r["super_id"] for r in full.collect()}


def test_user_sessions_ranks(spark):
    master = I.run_days(_events(spark), D1, D2, AS_OF)
    out = I.user_sessions(master)
    assert out.filter(F.col("rank_of_super_id") < 1).count() == 0
    assert out.groupBy("value").agg(F.countDistinct("super_id").alias("n")).filter("n != 1").count() == 0


def test_stream_matches_batch_loop(spark):
    ev = _events(spark)
    root = tempfile.mkdtemp(prefix="tidemark-test-")
    shards = os.path.join(root, "shards")
    write_day_shards(ev, shards)
    assert read_day_shards(spark, shards, D2, D2).count() == 3  # partition pruning by day
    from tidemark.streaming import daily_identity

    q = daily_identity.start(
        spark,
        shards,
        ev.schema,
        os.path.join(root, "master"),
        os.path.join(root, "stream-ckpt"),
        AS_OF,
    )
    q.awaitTermination(300)
    streamed = daily_identity.read_master(spark, os.path.join(root, "master"))
    batch = I.run_days(ev, D1, D2, AS_OF)
    key = lambda r: (r["value"], r["name"], r["super_id"])
    assert sorted(map(key, streamed.collect())) == sorted(map(key, batch.collect()))


def test_closure_long_chain_converges(spark):
    # id i holds values v_i and v_{i+1}: one component of 200 ids, diameter ~400
    n = 200
    rows = [(i, "fingerprint", f"v{i + k}", AS_OF, i) for i in range(1, n + 1) for k in (0, 1)]
    lab = spark.createDataFrame(rows, "super_id long, name string, value string, date_insert timestamp_ntz, date_table long")
    out = I.merge_closure(lab, max_rounds=20)
    assert {r["super_id"] for r in out.collect()} == {1}


def test_closure_extended_by_days_equals_the_whole(spark):
    import random

    rng = random.Random(31)
    schema = "super_id long, name string, value string, date_insert timestamp_ntz, date_table long"
    rows = [(i, "fingerprint", f"v{rng.randint(0, 120)}", AS_OF, i) for i in range(1, 101) for _ in range(2)]
    rows += [(101, "client_id", None, AS_OF, 1), (None, "client_id", "v1", AS_OF, 1)]
    parts = [rows[:70], rows[70:140], rows[140:], rows[:3]]  # the last one is known already
    stored = spark.createDataFrame([], "value string, super_id long")
    for part in parts:
        stored = I.extend_closure(stored, spark.createDataFrame(part, schema))
    got = {r.value: r.super_id for r in stored.collect()}
    whole = I.merge_closure(spark.createDataFrame(rows, schema).filter("super_id IS NOT NULL AND value IS NOT NULL"))
    assert stored.count() == len(got) and got == {r.value: r.super_id for r in whole.collect()}


def test_bucketed_master_matches_snapshots(spark):
    ev = _events(spark)
    plain = I.run_days(ev, D1, D2, AS_OF, bucket_master=False)
    bucketed = I.run_days(ev, D1, D2, AS_OF, bucket_master=True)
    key = lambda r: (r["value"], r["name"], r["super_id"])
    assert sorted(map(key, bucketed.collect())) == sorted(map(key, plain.collect()))


def test_stream_batch_retry_is_idempotent(spark):
    from tidemark.streaming import daily_identity

    ev = _events(spark)
    root = tempfile.mkdtemp(prefix="tidemark-test-")
    master_root = os.path.join(root, "master")
    fold = daily_identity.batch_folder(master_root, AS_OF)
    fold(ev.filter(F.col("event_date") == D1), 0)
    fold(ev.filter(F.col("event_date") == D2), 1)
    once = sorted(map(tuple, daily_identity.read_master(spark, master_root).collect()))
    fold(ev.filter(F.col("event_date") == D2), 1)  # epoch 1 replayed after a failure
    again = sorted(map(tuple, daily_identity.read_master(spark, master_root).collect()))
    assert once == again
    batch = sorted(map(tuple, I.run_days(ev, D1, D2, AS_OF).select(*I.MASTER_COLUMNS).collect()))
    assert [r[:3] for r in once] == [r[:3] for r in batch]


def test_stream_batch_that_died_halfway_is_finished(spark, monkeypatch):
    import pytest

    from tidemark.operators.master import Master
    from tidemark.streaming import daily_identity

    ev = _events(spark)
    root = tempfile.mkdtemp(prefix="tidemark-test-")
    fold = daily_identity.batch_folder(root, AS_OF)
    commit = Master.commit

    def dies_on_the_second_day(self, day, last):
        if day == D2:
            raise RuntimeError("driver lost between append and commit")
        return commit(self, day, last)

    with monkeypatch.context() as m:
        m.setattr(Master, "commit", dies_on_the_second_day)
        with pytest.raises(RuntimeError, match="driver lost"):
            fold(ev, 0)
    kept = I.open_master(spark, root)
    assert kept.mark() == D1 and kept.rows().filter(F.col("value") == "u12").count() == 0
    fold(ev, 0)
    batch = sorted(map(tuple, I.run_days(ev, D1, D2, AS_OF).select(*I.MASTER_COLUMNS).collect()))
    assert sorted(map(tuple, daily_identity.read_master(spark, root).collect())) == batch
    # a late day is refused, and the batch loop goes on where the stream stopped
    with pytest.raises(ValueError, match="folded up to"):
        fold(ev.filter(F.col("event_date") == D1), 1)
    fold(ev.filter("event_date IS NULL"), 2)
    assert I.advance_master(ev, kept, AS_OF) is None
    d3 = D2 + dt.timedelta(days=1)
    more = spark.createDataFrame([(d3, 20, "view", "u20", "c1", "", P)], SCHEMA)
    assert I.advance_master(ev.unionByName(more), kept, AS_OF) == (d3, d3)
    known = {r.value: r.super_id for r in kept.rows().collect()}
    assert known["u20"] == known["c1"]


def test_day_loop_removes_its_intermediates(spark):
    from tidemark.session import checkpoint_dir

    root = checkpoint_dir(spark).replace("file:", "")
    tables = os.path.join(root, "tables")
    before = set(os.listdir(tables)) if os.path.isdir(tables) else set()
    master = I.run_days(_events(spark), D1, D2, AS_OF, bucket_master=False)
    assert master.count() > 0  # kept day tables are still readable
    new = set(os.listdir(tables)) - before
    assert new and all(name.startswith("appended-") for name in new), sorted(new)
