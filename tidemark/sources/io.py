"""Ingest and load: CSV with bad lines skipped, write modes, high-water-mark
incremental windows (J10 ingest, J11, SNK-1..4)."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.time import ntz_literal

# The load dispositions of the original uploader, mapped to
# Spark save modes.
WRITE_MODES = {
    "WRITE_TRUNCATE": "overwrite",
    "WRITE_APPEND": "append",
    "overwrite": "overwrite",
    "append": "append",
}

_RECORD = "_record_of_other_length"


def read_csv_skip_bad_lines(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", header: bool = True, *, multi_line: bool
) -> DataFrame:
    """CSV read that drops rows with *more* fields than the schema and keeps
    rows with fewer (missing fields become NULL), as a pandas reader with bad
    lines skipped does.  Quotes inside quoted fields are doubled.

    A record whose number of fields is not the schema's comes back whole in an
    extra column; its separators outside quotes are counted, so ``1,2,3,`` is
    seen to have four fields.  ``multi_line`` has no default, as it decides the cost:
    with it a quoted field may hold line ends, for which each file is read whole by
    one task; without it files are split and read by many."""
    probe = T.StructType(list(schema.fields) + [T.StructField(_RECORD, T.StringType(), True)])
    df = (
        spark.read.option("header", header)
        .option("sep", sep)
        .option("mode", "PERMISSIVE")
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("columnPruning", False)  # a pruned parse doesn't see how long a record is
        .option("columnNameOfCorruptRecord", _RECORD)
        .schema(probe)
        .csv(path)
    )
    unquoted = F.regexp_replace(F.col(_RECORD), '"[^"]*"', "")
    fields = F.size(F.split(unquoted, re.escape(sep), -1))
    # the second condition always holds; Spark refuses to parse for the extra column alone
    first = F.coalesce(F.col(schema.fields[0].name).cast("string"), F.lit(""))
    good = F.col(_RECORD).isNull() | (fields <= len(schema.fields))
    return df.filter(good & (first != F.lit("\x00\x01"))).drop(_RECORD)


def save_mode(disposition: str) -> str:
    try:
        return WRITE_MODES[disposition]
    except KeyError:
        raise ValueError(f"unknown write disposition {disposition!r}") from None


def write_table(
    df: DataFrame, path: str, disposition: str = "WRITE_APPEND", partition_by: list[str] | None = None
) -> None:
    """Load a frame as snappy parquet, replacing or appending."""
    writer = df.write.mode(save_mode(disposition)).option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def next_load_date(target: DataFrame, date_col: str = "date") -> DataFrame:
    """One row, column ``date``: the day after the newest date in ``target``
    (NULL for an empty target; the caller then supplies a start date)."""
    return target.agg(F.date_add(F.to_date(F.max(F.col(date_col))), 1).alias("date"))


def load_window(
    source: DataFrame,
    target: DataFrame,
    date_col: str,
    as_of: dt.date,
    start_if_empty: dt.date | None = None,
) -> DataFrame:
    """Rows of ``source`` dated from the target's next load date through the
    day before ``as_of`` (the scrape window [max+1, yesterday]).

    The start date is one scalar read from the target; the slice is a range
    predicate on the raw column so it reaches the parquet scan."""
    start = next_load_date(target, date_col).first()["date"] or start_if_empty
    if start is None:
        raise ValueError("target is empty: give start_if_empty")
    end = as_of  # exclusive: the window ends the day before as_of
    col = F.col(date_col)
    lo = ntz_literal(dt.datetime.combine(start, dt.time()))
    hi = ntz_literal(dt.datetime.combine(end, dt.time()))
    return source.filter((col >= lo) & (col < hi))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """INSERT with a column list: the target's columns in its order, values
    cast to its types, columns the source does not give as typed NULLs.
    Source columns unknown to the target are an error."""
    unknown = [c for c in df.columns if c not in schema.fieldNames()]
    if unknown:
        raise ValueError(f"columns not in the target: {unknown}")
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def ingest_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    target: str,
    disposition: str = "WRITE_TRUNCATE",
    name_value_target: str | None = None,
    sep: str = ",",
    *,
    multi_line: bool,
) -> DataFrame:
    """J10 end to end: read a CSV with bad lines skipped, load it into
    ``target`` (drop-then-load by default), and optionally also load its
    (column_name, column_value) form with NULLs dropped.  Returns the loaded
    table as read back from ``target``."""
    from tidemark.operators.reshape import melt_name_value

    df = read_csv_skip_bad_lines(spark, path, schema, sep=sep, multi_line=multi_line)
    write_table(df, target, disposition)
    loaded = spark.read.schema(schema).parquet(target)
    if name_value_target:
        write_table(melt_name_value(loaded), name_value_target, disposition)
    return loaded
