"""J1i as a Structured Streaming job: new day shards of the event stream are
picked up as they land and each day is folded into the master table.

``readStream`` over the shard folder -> ``foreachBatch``: the days of a micro-batch are
labelled, merged and folded in one pass into the persistent master
(``operators.master``), a commit each, in order.  A batch is recorded in the master before its
first day is folded, so one that Spark runs again (a lost driver, a failed attempt)
is known: its committed days are left out, the others folded from committed rows.
Nothing is appended twice; days of the batch without a commit are repeated.  The match shuffles the
batch's values only, as in the batch loop, which may continue the same master.

A day must land whole and in order, as the daily export writes it: a batch that brings
a day at or before the master's last one raises, and nothing of it is folded.  Rows
without a date belong to no day.  ``trigger(availableNow=True)`` processes what is
there and stops (the daily-run mode of the original loop).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import identity
from tidemark.session import materialise, scratch_scope


def read_master(spark: SparkSession, master_root: str) -> DataFrame:
    """The committed rows of the master (none before the first batch)."""
    return identity.open_master(spark, master_root).rows()


def batch_folder(master_root: str, as_of: dt.datetime, date_col: str = "event_date"):
    """The ``foreachBatch`` body: fold the days of a micro-batch into the master."""

    def fold_batch(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        with scratch_scope(spark):
            batch = materialise(batch, "micro_batch")
            first, last = batch.agg(F.min(date_col), F.max(date_col)).head()
            if first is None:
                return
            master = identity.open_master(spark, master_root)
            master.begin_batch(epoch_id, first, last)
            identity.fold_days(batch, master, first, last, as_of, date_col)

    return fold_batch


def start(
    spark: SparkSession,
    shards_root: str,
    schema: T.StructType,
    master_root: str,
    checkpoint_location: str,
    as_of: dt.datetime,
    date_col: str = "event_date",
    files_per_batch: int | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.parquet(shards_root)

    fold_batch = batch_folder(master_root, as_of, date_col)

    writer = stream.writeStream.foreachBatch(fold_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
