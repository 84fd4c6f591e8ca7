"""A table in a folder, one partition per hash bucket of its keys, of which a change
rewrites only the buckets that it touches.

The buckets are ordinary partitions (``_bucket=<n>``), so a read of some buckets is
partition pruning and a rewrite is a dynamic partition overwrite: the new files are
staged and replace a bucket's files when all tasks have succeeded.  A failed job leaves
the table as it was.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "_bucket"


class BucketedTable:
    """Rows with ``schema`` in ``folder``, placed by a hash of ``keys``."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, keys: Sequence[str], buckets: int):
        self.spark, self.folder, self.schema, self.keys, self.buckets = spark, folder, schema, list(keys), buckets

    def bucket(self):
        """The bucket of a row, by its key columns."""
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _fs(self, name: str = ""):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def files(self, bucket: int) -> set[str]:
        """The names of a bucket's files."""
        fs, path = self._fs(f"{BUCKET}={bucket}")
        return {s.getPath().getName() for s in fs.listStatus(path)} if fs.exists(path) else set()

    def read(self, only: Sequence[int] | None = None) -> DataFrame:
        """All rows, or those of some buckets (no other bucket is opened)."""
        fs, path = self._fs()
        if not fs.exists(path):
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())]))
        rows = rows.parquet(self.folder)
        if only is not None:
            rows = rows.filter(F.col(BUCKET).isin(*only) if only else F.lit(False))
        return rows.select(*self.schema.names)

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets in which the keys of ``rows`` lie (at most ``buckets`` numbers)."""
        return sorted(r[0] for r in rows.select(self.bucket()).distinct().collect())

    def replace(self, rows: DataFrame, only: Sequence[int] | None = None) -> None:
        """Write the whole new content of the buckets ``only`` (default: of those that
        occur in ``rows``); the others stay as they are.  A bucket of ``only`` without
        rows is emptied.  Buckets are rebalanced by AQE, so a full one is several files."""
        before = {b: self.files(b) for b in only or []}
        placed = rows.select(*self.schema.names, self.bucket().alias(BUCKET))
        (
            placed.hint("rebalance", BUCKET)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BUCKET)
            .parquet(self.folder)
        )
        for bucket, names in before.items():
            if names and self.files(bucket) == names:  # nothing was written for it
                fs, path = self._fs(f"{BUCKET}={bucket}")
                fs.delete(path, True)
