"""The persistent master of the day loop (J1): a folder with day commits.

``<folder>/rows``     the master's rows: a Parquet table with one partition per day,
                      bucketed by (value, salt) within it;
``<folder>/batches``  one small file per micro-batch of the streaming form, written first;
``<folder>/commits``  one small JSON file per folded day, written last (to another name
                      first, then renamed): day, number of rows, largest id of the master
                      so far, files, and the heavy values.

A day counts once its commit is there.  Rows of a later day that never got one (a driver
that died between append and commit) are invisible and removed when the day is folded
again.  A backlog is written by one job and its days are committed after it, so a restart
repeats the days of the backlog that have no commit, as it repeats their labelling.  The
high-water mark and the largest id come from the last commit: no scan of the master, and a
day that added no row is a commit too.

The day-to-master match is a bucketed join: only the day's values are shuffled.  A bucket
cannot be split by AQE, so a value that gets many rows is *salted*: once a value has
``heavy_rows`` rows in a day, later rows of it are dealt over ``salts`` buckets, and the
day's value is looked up in each of them.  Earlier rows stay where they are (salt 0 is one
of the salts).  The list of heavy values holds at most rows / ``heavy_rows`` of them.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import delete_path

#: Rows of one value in one day from which it is dealt over ``SALTS`` buckets.
HEAVY_ROWS, SALTS = 1_000_000, 64
#: The day under which rows given at the start are committed.
BEGINNING = dt.date(1, 1, 1)


@dataclass
class Commit:
    """What is known once a day is folded."""

    day: str
    rows: int
    top: int | None
    files: list[str] = field(default_factory=list)
    heavy: dict[str, int] = field(default_factory=dict)  # value -> salts


class Master:
    """The master in ``folder``; it is made if it is not there.  ``columns`` is the DDL
    of its rows, with ``super_id``, ``name`` and ``value`` among them."""

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        columns: str,
        buckets: int,
        heavy_rows: int = HEAVY_ROWS,
        salts: int = SALTS,
    ):
        self.spark, self.folder, self.heavy_rows, self.salts = spark, folder.rstrip("/"), heavy_rows, salts
        self.columns = [c.split()[0] for c in columns.split(", ")]
        self.rows_path, self.commits_path = f"{self.folder}/rows", f"{self.folder}/commits"
        self._seen: dict[str, tuple] = {}  # days looked at and not yet committed
        made = self._read_json("layout.json")
        self.buckets = made["buckets"] if made else buckets
        if not made:
            self._write_json("layout.json", {"buckets": buckets})
        self.table = f"tidemark_master_{uuid.uuid5(uuid.NAMESPACE_URL, self.folder).hex}"
        fs, target = self._fs(self.rows_path)
        fs.mkdirs(target)
        if not spark.catalog.tableExists(self.table):
            spark.sql(
                f"CREATE TABLE {self.table} ({columns}, salt INT, day STRING) USING parquet "
                f"PARTITIONED BY (day) CLUSTERED BY (value, salt) SORTED BY (value) INTO {self.buckets} BUCKETS "
                f"LOCATION '{self.rows_path}'"
            )
            spark.sql(f"MSCK REPAIR TABLE {self.table}")

    # ------------------------------------------------------------- small files
    def _fs(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), target

    def _read_json(self, name: str) -> dict | None:
        fs, target = self._fs(f"{self.folder}/{name}")
        if not fs.exists(target):
            return None
        return json.loads(self.spark.read.text(target.toString(), wholetext=True).head()[0])

    def _write_json(self, name: str, content: dict) -> None:
        """Written under another name first: a reader sees all of it or none."""
        fs, target = self._fs(f"{self.folder}/{name}")
        _, draft = self._fs(f"{self.folder}/_draft-{uuid.uuid4().hex}")
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        fs.mkdirs(target.getParent())
        if not fs.rename(draft, target):
            raise OSError(f"{target} was not committed")

    # ------------------------------------------------------------------ state
    def last_commit(self) -> Commit | None:
        fs, target = self._fs(self.commits_path)
        if not fs.exists(target):
            return None
        names = sorted(s.getPath().getName() for s in fs.listStatus(target))
        return Commit(**self._read_json(f"commits/{names[-1]}")) if names else None

    def mark(self) -> dt.date | None:
        """The last folded day (None before the first)."""
        last = self.last_commit()
        day = dt.date.fromisoformat(last.day) if last else None
        return None if day == BEGINNING else day

    def _committed(self, last: Commit | None) -> DataFrame:
        until = last.day if last else ""
        return self.spark.table(self.table).filter(F.col("day") <= until)

    def rows(self) -> DataFrame:
        """The rows of all committed days."""
        return self._committed(self.last_commit()).select(*self.columns)

    def rows_of(self, day: dt.date) -> DataFrame:
        """The rows that a committed day added."""
        return self._committed(self.last_commit()).filter(F.col("day") == day.isoformat()).select(*self.columns)

    def rows_after(self, day: dt.date) -> DataFrame:
        """The rows that committed days after ``day`` added."""
        return self._committed(self.last_commit()).filter(F.col("day") > day.isoformat()).select(*self.columns)

    # ------------------------------------------------------------------- salts
    def _with_salts(self, df: DataFrame, last: Commit | None) -> DataFrame:
        """``df`` with the number of salts of its value (1 unless it is heavy)."""
        if last is None or not last.heavy:
            return df.withColumn("_salts", F.lit(1))
        heavy = self.spark.createDataFrame(list(last.heavy.items()), "_heavy string, _salts int")
        joined = df.join(heavy, F.col("value") == F.col("_heavy"), "left").drop("_heavy")
        return joined.withColumn("_salts", F.coalesce("_salts", F.lit(1)))

    def hits(self, values: DataFrame, last: Commit | None) -> DataFrame:
        """Rows of committed days, with their salt, whose value is one of ``values``.
        Only the values are shuffled, each to the buckets of its salts."""
        wanted = self._with_salts(values, last).select(
            "value", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("salt")
        )
        return self._committed(last).join(wanted, ["value", "salt"], "left_semi")

    # ------------------------------------------------------------------- turns
    def begin_batch(self, batch: int, first: dt.date, last: dt.date) -> bool:
        """Record a batch of days before any is folded.  True if it was recorded before,
        so this is another attempt at it.  A new batch must start after the mark: a day
        that was folded already cannot take more rows."""
        name = f"batches/{batch}-{first.isoformat()}-{last.isoformat()}.json"
        fs, target = self._fs(f"{self.folder}/{name}")
        if fs.exists(target):
            return True
        mark = self.mark()
        if mark is not None and first <= mark:
            raise ValueError(f"batch {batch} brings rows of {first}, but the master is folded up to {mark}")
        self._write_json(name, {"batch": batch, "first": first.isoformat(), "last": last.isoformat()})
        return False

    def append(self, rows: DataFrame, day: dt.date, last: Commit | None) -> None:
        """Write a day's rows without committing them (``append_days``)."""
        self.append_days(rows.withColumn("day", F.lit(day.isoformat())), [day], last)

    def append_days(self, rows: DataFrame, days: Sequence[dt.date], last: Commit | None) -> None:
        """Write the rows of some days (their ``day``) without committing them, instead of
        any that an earlier attempt left; a file per day and bucket at most."""
        for name in (day.isoformat() for day in days):
            self._seen.pop(name, None)
            fs, target = self._fs(f"{self.rows_path}/day={name}")
            if fs.exists(target):
                self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS PARTITION (day = '{name}')")
                delete_path(self.spark, f"{self.rows_path}/day={name}")
        salted = self._with_salts(rows, last)
        salt = F.pmod(F.xxhash64("super_id", "name"), F.col("_salts")).cast("int")
        (
            salted.select(*self.columns, salt.alias("salt"), F.col("day").cast("string").alias("day"))
            .repartition(self.buckets, "value", "salt")
            .write.mode("append")
            .insertInto(self.table)
        )

    def look_at(self, days: Sequence[dt.date]) -> None:
        """Read what was written for some days in one job; their commits use it."""
        paths = [p for p in (f"{self.rows_path}/day={d.isoformat()}" for d in days) if self._exists(p)]
        self._seen |= {d.isoformat(): (0, None, []) for d in days}
        if not paths:
            return
        written = self.spark.read.schema(self.spark.table(self.table).schema).option("basePath", self.rows_path)
        per_value = written.parquet(*paths).groupBy("day", "value").agg(
            F.count(F.lit(1)).alias("n"), F.max("super_id").alias("top")
        )
        found = F.collect_list(F.when(F.col("n") >= self.heavy_rows, F.col("value")))  # rows / heavy_rows at most
        totals = per_value.groupBy("day").agg(F.sum("n"), F.max("top"), found)
        self._seen |= {r[0]: tuple(r)[1:] for r in totals.collect()}  # a row per day

    def _exists(self, path: str) -> bool:
        fs, target = self._fs(path)
        return fs.exists(target)

    def commit(self, day: dt.date, last: Commit | None) -> Commit:
        """Record the day from what was written for it.  The commit is the last write."""
        name = day.isoformat()
        if name not in self._seen:
            self.look_at([day])
        n, highest, many = self._seen.pop(name)
        heavy, top, files = dict(last.heavy) if last else {}, last.top if last else None, []
        heavy.update(dict.fromkeys(many, self.salts))
        top = max((t for t in (top, highest) if t is not None), default=None)
        fs, target = self._fs(f"{self.rows_path}/day={name}")
        if fs.exists(target):
            files = sorted(s.getPath().getName() for s in fs.listStatus(target) if s.getPath().getName().startswith("part-"))
        record = Commit(name, n, top, files, heavy)
        self._write_json(f"commits/{record.day}.json", asdict(record))
        return record
