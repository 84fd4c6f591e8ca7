"""Cases of the review: CSV rule, shard rule, exact numbering, NaN, zero totals,
NULL merge keys, bucket bounds, and the persistent master."""

import datetime as dt
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import contacts, evaluation, identity, reshape
from tidemark.operators.ordering import By, with_global_rank, with_prefix_sums
from tidemark.plans import inputs
from tidemark.sources import io, shards
from tests.conftest import SF001, SF01

BIG = 2**53


def test_numbering_is_exact_beside_nulls(spark):
    df = spark.createDataFrame([(BIG + 1,), (None,), (BIG + 3,), (3,)], "k long")
    ranks = {r.k: r["rank"] for r in with_global_rank(df, [By("k")]).collect()}
    assert ranks == {None: 1, 3: 2, BIG + 1: 3, BIG + 3: 4}
    sums = {r.k: r.before for r in with_prefix_sums(df, [By("k")], {"before": F.lit(1)}).collect()}
    assert sums == {None: 0, 3: 1, BIG + 1: 2, BIG + 3: 3}


def test_csv_rows_equal_pandas(spark, tmp_path):
    path = os.path.join(tmp_path, "in.csv")
    with open(path, "w") as f:
        f.write('a,b,c\n1,2,3\n1,2,3,\n1,2,3,,5\n4,"x ""q"", y",6\n7,"line\nend",9\n8,9\n')
    schema = T.StructType([T.StructField(c, T.StringType()) for c in "abc"])
    got = sorted(tuple(r) for r in io.read_csv_skip_bad_lines(spark, path, schema, multi_line=True).collect())
    want = pd.read_csv(path, dtype=str, on_bad_lines="skip", index_col=False)
    want = [tuple(None if pd.isna(v) else v for v in r) for r in want.itertuples(index=False)]
    # a surplus field is a bad line even if it is empty
    assert got == [("1", "2", "3"), ("4", 'x "q", y', "6"), ("7", "line\nend", "9"), ("8", "9", None)]
    assert set(got) <= set(want)


def test_suffix_shards_by_first_digits(spark, tmp_path):
    for name, v in (("20240105", 1), ("intraday_20240106", 2), ("20240105_fresh", 3), ("20240109", 4), ("notes", 5)):
        spark.createDataFrame([(v,)], "v int").coalesce(1).write.parquet(f"{tmp_path}/events_{name}")
    read = lambda a, b: sorted(r.v for r in shards.read_suffix_shards(spark, str(tmp_path), "events_", a, b).collect())
    assert read(dt.date(2024, 1, 5), dt.date(2024, 1, 6)) == [1, 2, 3]
    assert read(dt.date(2023, 1, 1), dt.date(2023, 1, 2)) == []


def test_small_rules(spark):
    wide = spark.createDataFrame([(1.0, "x"), (float("nan"), None)], "f double, s string")
    assert sorted(tuple(r) for r in reshape.melt_name_value(wide).collect()) == [("f", "1.0"), ("s", "x")]
    scored = spark.createDataFrame([(i, float(i), 0) for i in range(5)], "id int, score double, target int")
    assert {r.recall for r in evaluation.recall_by_bucket(scored, "score", "target", "id").collect()} == {None}
    target = spark.createDataFrame([(1, "a"), (None, "n")], "k int, v string")
    staging = spark.createDataFrame([(1, "b"), (None, "p"), (None, "q")], "k int, v string")
    got = contacts.upsert(target, staging, ["k"], ["v"]).collect()
    assert sorted((r.k or 0, r.v) for r in got) == [(0, "n"), (0, "p"), (0, "q"), (1, "b")]


def test_bucket_count_is_bounded(spark):
    events = inputs.identity_events(spark, SF001)
    with pytest.raises(ValueError, match="maxBuckets"):
        identity.run_days(events, dt.date(2024, 1, 5), dt.date(2024, 1, 5), dt.datetime(2024, 2, 1), bucket_master=200_000)


def test_contact_thresholds_are_arguments(spark):
    calls = spark.createDataFrame(
        [(1, "a", "b", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 9), 40)],
        "call_id long, phone_from string, phone_to string, created timestamp_ntz, call_start timestamp_ntz, duration int",
    )
    as_of = dt.datetime(2024, 1, 3)
    assert [r["is_finished"] for r in contacts.contact_facts(calls, as_of).collect()] == [0]
    limits = contacts.Thresholds(unreachable_seconds=10, succeeded_seconds=30, finish_wait_days=1)
    row = contacts.contact_facts(calls, as_of, limits).head()
    assert (row["is_finished"], row["is_succeeded"], row["is_unreachable"]) == (1, 1, 0)


def test_text_plan_stays_on_the_jvm(spark):
    from tidemark.operators import text

    docs = text.documents(spark.read.parquet(f"{SF01}/conversations.parquet"), "text")
    plan = text.term_counts(docs, ["conv_id", "turn"], "text")._jdf.queryExecution().toString()
    assert "Python" not in plan and "InPandas" not in plan and "partial_count" in plan


def test_registered_day_loop_has_a_turn_per_day(spark):
    """Three turns of the registered loop against their twin; the same days in two
    turns give other rows."""
    import __spark_entry__ as entry
    from tests.conftest import SF001
    from tests.oracle_compare import compare, duck
    from tidemark.plans import queries as q

    con = duck(SF001)
    sql = q._with(*q._all_days_sql(3)) + "SELECT * FROM m3"
    res = compare(spark, con, "identity_all_days", lambda s, d: entry.queries()["identity_all_days"](s, d, days=3), sql, SF001)
    assert res["match"], res
    whole = con.execute(entry.oracle_sql()["identity_all_days"]).df()
    two = con.execute(entry.oracle_sql()["identity_two_days"]).df()
    assert len(whole) != len(two)
