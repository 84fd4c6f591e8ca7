"""Day-sharded event tables (one folder per day, like a ``events_YYYYMMDD``
wildcard table): written with ``partitionBy`` and read back with a filter on
the partition column, which Spark turns into partition pruning (only the
folders of the requested days are listed and read)."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_day_shards(df: DataFrame, root: str, date_col: str = "event_date", mode: str = "append") -> None:
    df.write.mode(mode).partitionBy(date_col).parquet(root)


def read_day_shards(
    spark: SparkSession,
    root: str,
    start: dt.date | None = None,
    end: dt.date | None = None,
    date_col: str = "event_date",
) -> DataFrame:
    """Shards whose day lies in [start, end] (both inclusive; None = open)."""
    df = spark.read.parquet(root)
    if start is not None:
        df = df.filter(F.col(date_col) >= F.lit(start))
    if end is not None:
        df = df.filter(F.col(date_col) <= F.lit(end))
    return df


def read_suffix_shards(
    spark: SparkSession,
    root: str,
    prefix: str,
    start: dt.date,
    end: dt.date,
    suffix_col: str = "_table_suffix",
) -> DataFrame:
    """Wildcard table ``<prefix>*`` whose shard suffix's first run of digits
    lies in [start, end] as yyyymmdd, wherever it stands in the suffix
    (``intraday_YYYYMMDD``, ``YYYYMMDD_fresh``).  The folder names are listed
    and judged first, so only shards of the range are read; a range without
    any gives no rows (in the schema of the shards there are)."""
    if end < start:
        raise ValueError("empty day range")
    first, last = start.strftime("%Y%m%d"), end.strftime("%Y%m%d")
    base = f"{root.rstrip('/')}/"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
    shards = [n for n in names if n.startswith(prefix)]
    if not shards:
        raise FileNotFoundError(f"no shard {prefix}* under {root}")
    digits = {n: re.search("[0-9]+", n[len(prefix):]) for n in shards}
    wanted = [n for n in shards if digits[n] and first <= digits[n][0] <= last]
    df = spark.read.parquet(*[base + n for n in wanted or shards[:1]])
    folder = F.regexp_extract(F.col("_metadata.file_path"), rf"/{re.escape(prefix)}([^/]*)/[^/]*$", 1)
    df = df.withColumn(suffix_col, folder)
    return df if wanted else df.limit(0)
