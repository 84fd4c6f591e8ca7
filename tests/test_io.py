"""Sources and sinks: CSV with bad lines, load modes, incremental window."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.reshape import melt_name_value
from tidemark.sources import io


def test_csv_skip_bad_lines_and_melt(spark):
    d = tempfile.mkdtemp(prefix="tidemark-test-")
    p = os.path.join(d, "in.csv")
    with open(p, "w") as fh:
        fh.write('a,b,c\n1,2,3\n4,5\n6,7,8,9\n10,11,12\n"q,r",2,3\n')
    schema = T.StructType([T.StructField(c, T.StringType()) for c in "abc"])
    for multi_line in (True, False):
        df = io.read_csv_skip_bad_lines(spark, p, schema, multi_line=multi_line)
        assert sorted(tuple(r) for r in df.collect()) == sorted(
            [("1", "2", "3"), ("4", "5", None), ("10", "11", "12"), ("q,r", "2", "3")]
        )
        assert df.select("a").count() == 4  # pruned reads drop the long row too
    long = melt_name_value(df)
    assert long.count() == 11


def test_write_modes(spark):
    d = os.path.join(tempfile.mkdtemp(prefix="tidemark-test-"), "t")
    df = spark.range(3)
    io.write_table(df, d, "WRITE_TRUNCATE")
    io.write_table(df, d, "WRITE_APPEND")
    assert spark.read.parquet(d).count() == 6
    io.write_table(df, d, "WRITE_TRUNCATE")
    assert spark.read.parquet(d).count() == 3
    with pytest.raises(ValueError):
        io.write_table(df, d, "WRITE_SOMETIMES")


def test_next_load_date_and_window(spark):
    t = spark.createDataFrame([(dt.datetime(2024, 1, 10, 5),), (dt.datetime(2024, 1, 3),)], "date timestamp_ntz")
    assert io.next_load_date(t).first()["date"] == dt.date(2024, 1, 11)
    empty = t.filter(F.lit(False))
    assert io.next_load_date(empty).first()["date"] is None
    src = spark.createDataFrame([(dt.datetime(2024, 1, d, 1),) for d in range(1, 21)], "date timestamp_ntz")
    w = io.load_window(src, t, "date", dt.date(2024, 1, 15))
    assert sorted(r["date"].day for r in w.collect()) == [11, 12, 13, 14]
    with pytest.raises(ValueError):
        io.load_window(src, empty, "date", dt.date(2024, 1, 15))


def test_conform_insert_column_list(spark):
    from tidemark import schemas

    df = spark.createDataFrame([("a", "b")], "phone_1 string, phone_2 string")
    out = io.conform(df, schemas.FACT_CONTACTS)
    assert out.columns == schemas.FACT_CONTACTS.fieldNames()
    row = out.first()
    assert row["phone_1"] == "a" and row["Total_Calls_cnt"] is None
    with pytest.raises(ValueError):
        io.conform(spark.createDataFrame([(1,)], "nope int"), schemas.FACT_CONTACTS)


def test_suffix_shards(spark):
    from tidemark.sources.shards import read_suffix_shards

    root = tempfile.mkdtemp(prefix="tidemark-test-")
    for name, n in [("events_20240105", 2), ("events_intraday_20240105", 1), ("events_20240106", 3), ("events_v2_20240105", 4)]:
        spark.range(n).write.parquet(os.path.join(root, name))
    got = read_suffix_shards(spark, root, "events_", dt.date(2024, 1, 5), dt.date(2024, 1, 5))
    suffixes = sorted(r["_table_suffix"] for r in got.collect())
    # 'v2_20240105' extracts '2' as its first digit run, so it is outside the range
    assert suffixes == ["20240105", "20240105", "intraday_20240105"]
    both = read_suffix_shards(spark, root, "events_", dt.date(2024, 1, 5), dt.date(2024, 1, 6))
    assert both.count() == 6


def test_cluster_conf_sizes_partitions():
    from tidemark.session import cluster_conf

    big = cluster_conf(100 * 2**40)
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (256 << 20)
    small = cluster_conf(10 << 20, executors=10, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 80  # two waves of the cores


def test_ingest_csv_end_to_end(spark):
    d = tempfile.mkdtemp(prefix="tidemark-test-")
    p = os.path.join(d, "in.csv")
    with open(p, "w") as fh:
        fh.write('a,b,c\n1,2,3\n4,5\n6,7,8,9\n10,11,12\n"q,r",2,3\n')
    schema = T.StructType([T.StructField(c, T.StringType()) for c in "abc"])
    target, nv = os.path.join(d, "t"), os.path.join(d, "nv")
    loaded = io.ingest_csv(spark, p, schema, target, name_value_target=nv, multi_line=True)
    assert loaded.count() == 4
    assert spark.read.parquet(nv).count() == 11
    io.ingest_csv(spark, p, schema, target, multi_line=True)  # drop-then-load: still 4 rows
    assert spark.read.parquet(target).count() == 4
