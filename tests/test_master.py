"""The persistent master: day commits, restarts, salted values."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tidemark.operators import identity as I
from tidemark.operators.master import Master
from tidemark.plans import inputs

AS_OF = dt.datetime(2024, 2, 1)
DAY = [dt.date(2024, 1, d) for d in range(1, 10)]


@pytest.fixture(scope="module")
def events(spark):
    return inputs.identity_events(spark, SF001).filter("event_date <= DATE '2024-01-04'")


@pytest.fixture(scope="module")
def whole(spark, events):
    """Four turns without a persistent master."""
    return _rows(I.run_days(events, DAY[0], DAY[3], AS_OF, bucket_master=False))


def _rows(df):
    return sorted(map(str, df.select(*I.MASTER_COLUMNS).collect()))


def _until(events, day):
    return events.filter(F.col("event_date") <= F.lit(day))


def test_goes_on_from_its_mark(spark, events, whole, tmp_path):
    master = I.open_master(spark, str(tmp_path), 4)
    assert master.mark() is None and master.rows().count() == 0
    assert I.advance_master(_until(events, DAY[1]), master, AS_OF) == (DAY[0], DAY[1])
    files = set(master.rows().inputFiles())
    # another session knows the folder only
    spark.sql(f"DROP TABLE {master.table}")
    again = I.open_master(spark, str(tmp_path), 4)
    assert again.mark() == DAY[1]
    assert I.advance_master(events, again, AS_OF) == (DAY[2], DAY[3])
    after = set(again.rows().inputFiles())
    assert files <= after and len(after - files) <= 2 * 4
    assert _rows(again.rows()) == whole
    assert I.advance_master(events, again, AS_OF) is None
    last = again.last_commit()
    assert last.top == again.rows().agg(F.max("super_id")).head()[0]
    assert last.rows == again.rows_of(DAY[3]).count() and last.files


def test_a_day_between_append_and_commit_is_folded_again(spark, events, whole, tmp_path, monkeypatch):
    master = I.open_master(spark, str(tmp_path), 4)
    commit = Master.commit

    def dies(self, day, last):
        if day == DAY[2]:
            raise KeyboardInterrupt
        return commit(self, day, last)

    monkeypatch.setattr(Master, "commit", dies)
    with pytest.raises(KeyboardInterrupt):
        I.advance_master(events, master, AS_OF)
    monkeypatch.undo()
    assert os.path.isdir(tmp_path / "rows" / f"day={DAY[2]}")  # its rows were written,
    assert master.mark() == DAY[1]  # but are not there
    assert master.rows().count() == I.run_days(events, DAY[0], DAY[1], AS_OF, bucket_master=False).count()
    assert I.advance_master(events, master, AS_OF) == (DAY[2], DAY[3])
    assert _rows(master.rows()) == whole


def test_a_day_without_new_rows_is_a_commit(spark, events, tmp_path):
    master = I.open_master(spark, str(tmp_path), 2)
    day = events.filter(F.col("event_date") == F.lit(DAY[0]))
    twice = day.unionByName(day.withColumn("event_date", F.lit(DAY[1])))  # the same events on the next day
    empty = twice.unionByName(day.withColumn("event_date", F.lit(DAY[3])).withColumn("event_params", F.expr("slice(event_params, 1, 0)")))
    assert I.advance_master(empty, master, AS_OF) == (DAY[0], DAY[3])
    assert master.mark() == DAY[3] and master.last_commit().rows == 0
    assert master.last_commit().top == master.rows().agg(F.max("super_id")).head()[0]
    assert I.advance_master(empty, master, AS_OF) is None


def test_backlog_equals_days_apart(spark, events):
    """Labelling many days at once gives each day the groups of its own labelling."""
    merged = I.days_pipeline(events, DAY[0], DAY[2], AS_OF)
    for day in DAY[:3]:
        def groups(df):
            members = {}
            for r in df.collect():
                members.setdefault(r.super_id, set()).add((r.name, r.value, r.date_table))
            return [members[k] for k in sorted(members)]

        assert groups(merged.filter(F.col("day") == F.lit(day))) == groups(I.day_pipeline(events, day, AS_OF))


COLUMNS = "super_id bigint, name string, value string, date_insert timestamp_ntz, date_table bigint"


def test_a_heavy_value_is_read_by_several_tasks(spark, tmp_path):
    """A third of the rows hold one value.  From the day after it was found heavy, its
    rows are in several buckets, and looking it up reads them in several tasks."""
    master = Master(spark, str(tmp_path), COLUMNS, 8, heavy_rows=100, salts=8)
    plain = Master(spark, str(tmp_path / "plain"), COLUMNS, 8)
    last = last_plain = None
    for k, day in enumerate(DAY[:4]):
        ids = spark.range(k * 900, k * 900 + 900)
        value = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), (F.col("id") % 50).cast("string")))
        rows = ids.select(
            F.col("id").alias("super_id"), F.lit("fingerprint").alias("name"), value.alias("value"),
            F.lit(AS_OF).cast("timestamp_ntz").alias("date_insert"), F.col("id").alias("date_table"),
        )
        master.append(rows, day, last)
        last = master.commit(day, last)
        plain.append(rows, day, last_plain)
        last_plain = plain.commit(day, last_plain)
    assert last.heavy == {"hot": 8} and last_plain.heavy == {}
    assert _rows(master.rows()) == _rows(plain.rows())
    values = spark.createDataFrame([("hot",), ("v1",), ("absent",), ("hot",)], "value string")
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        hits, flat = master.hits(values, last), plain.hits(values, last_plain)
        assert _rows(hits) == _rows(flat) and hits.count() == 4 * 300 + 4 * 12
        spread = hits.filter("value = 'hot'").groupBy(F.spark_partition_id()).count().collect()
        together = flat.filter("value = 'hot'").groupBy(F.spark_partition_id()).count().collect()
        assert len(spread) >= 4 and len(together) == 1
        plan = hits._jdf.queryExecution().executedPlan().toString()
        scan = [line for line in plan.splitlines() if "FileScan parquet" in line and master.table in line]
        assert scan and "SelectedBucketsCount: 8 out of 8" in scan[0]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _odd_events(spark, seed):
    """Few ids over some days: persons that share values for days, known in part or in
    whole, rows that come twice, and days on which nobody has a group (no ids)."""
    import random

    pick = random.Random(seed)
    rows = []
    for k, day in enumerate(DAY[:5]):
        for i in range(14):
            nobody = k == 2
            user = "" if nobody else pick.choice(["", "undefined", "u1", f"u{pick.randrange(9)}"])
            print_ = "" if nobody else pick.choice(["", "undefined", f"f{pick.randrange(12 + 2 * k)}"])
            client = pick.choice(["undefined", f"c{pick.randrange(10 + 3 * k)}", f"c{pick.randrange(6)}"])
            at = int(dt.datetime.combine(day, dt.time()).timestamp()) * 1_000_000 + i % 5
            rows.append((day, at, "view", user, client, print_, ["p"]))
    rows += rows[::7]
    columns = "event_date date, event_timestamp long, event_name string, user_id string, user_pseudo_id string, fingerprint string, event_params array<string>"
    return spark.createDataFrame(rows, columns)


def test_a_backlog_is_folded_in_spans(spark, monkeypatch):
    """Days folded together add what a turn for each adds; the master is looked up once a
    span, and a day without groups (the third) has its own: 3 times instead of 5."""
    events = _odd_events(spark, 1)
    before = spark.createDataFrame([(5, "client_id", "c1", AS_OF, 1), (7, "client_id", "c1", AS_OF, 1), (9, "user_id", "u3", AS_OF, 2)], I.MASTER_SCHEMA)
    looked_up, hits = [], Master.hits
    monkeypatch.setattr(Master, "hits", lambda self, values, last: looked_up.append(last) or hits(self, values, last))
    for master in (None, before):
        by_turns = I.run_days(events, DAY[0], DAY[4], AS_OF, master=master, bucket_master=False)
        looked_up.clear()
        together = I.run_days(events, DAY[0], DAY[4], AS_OF, master=master, bucket_master=4)
        assert len(looked_up) == 3
        assert _rows(together) == _rows(by_turns)
        assert together.count() > 30


def test_ids_reach_over_several_persons(spark):
    """c1's id goes on to c2 by f1, to c3 by f2, ... one person further each day, though
    the persons between got larger ids first."""
    rows = [(DAY[0], i, "view", "", f"c{i}", f"f{i}", ["p"]) for i in range(9)]
    rows += [(DAY[k], 100 * k + i, "view", "", c, f, ["p"]) for k in range(1, 5) for i, (c, f) in enumerate([(f"c{k}", f"f{k - 1}"), (f"x{k}", f"f{k}")])]
    columns = "event_date date, event_timestamp long, event_name string, user_id string, user_pseudo_id string, fingerprint string, event_params array<string>"
    events = spark.createDataFrame(rows, columns)
    by_turns = I.run_days(events, DAY[0], DAY[4], AS_OF, bucket_master=False)
    together = I.run_days(events, DAY[0], DAY[4], AS_OF, bucket_master=4)
    assert _rows(together) == _rows(by_turns)
