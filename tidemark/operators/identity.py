"""J1: identity resolution of users, cookies (client ids) and fingerprints into
persons (``super_id``), one day at a time, folded into a master table.

Data flow per day (names follow the original tables):

* ``click_events``  day slice of the event stream, params exploded, distinct;
* ``clean_ids``     sentinel cleaning ('' / 'undefined' mean missing);
* ``label_day``     provisional person ids (``id_with_collisions``);
* ``merge_day``     two hops of min-label propagation (``last_day``);
* ``fold_into_master`` rows appended to the master (``name_value``);
* ``run_days``      the day loop; ``user_sessions`` ranks users in a person;
* ``merge_closure`` full connected components (the fixpoint of ``merge_day``).

Scale notes.  The original numbers rows with windows that have no PARTITION
BY (a single task).  Here every such rank is a distributed rank
(``with_global_rank`` / ``with_prefix_sums``), and ``rank() over (order by
user_id)`` / ``max(rank) over (partition by client)`` are replaced by the
order-equivalent keys themselves (only their order reaches the output).
Per-value minima are ``groupBy`` + join (partial aggregation absorbs a hot
shared fingerprint); the master is semi-filtered by the day's values before
the day-to-master join.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.buckets import BucketedTable
from tidemark.operators.contacts import ts_literal
from tidemark.operators.grouping import join_on_keys
from tidemark.operators.master import BEGINNING, HEAVY_ROWS, SALTS, Commit, Master
from tidemark.operators.ordering import By, with_global_rank, with_prefix_sums
from tidemark.session import delete_path, materialise, materialise_at, scratch_path, scratch_scope

# Sentinels and attribute names of the original tables.
UNDEFINED = "undefined"
NAME_USER, NAME_CLIENT, NAME_FINGERPRINT = "user_id", "client_id", "fingerprint"

MASTER_SCHEMA = T.StructType(
    [
        T.StructField("super_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("date_insert", T.TimestampNTZType()),
        T.StructField("date_table", T.LongType()),
    ]
)
MASTER_COLUMNS = [f.name for f in MASTER_SCHEMA.fields]
MASTER_DDL = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in MASTER_SCHEMA.fields)


def empty_master(spark) -> DataFrame:
    return spark.createDataFrame([], MASTER_SCHEMA)


# ------------------------------------------------------------------ J1a / J1b
def click_events(events: DataFrame, day: dt.date | None = None, date_col: str = "event_date") -> DataFrame:
    """Distinct (event_timestamp, event_name, user_id, user_pseudo_id,
    fingerprint) of one day.  Events without params drop out, as in an inner
    unnest of the array.  ``day=None`` keeps every day."""
    src = events if day is None else events.filter(F.col(date_col) == F.lit(day))
    return (
        src.filter(F.size("event_params") > 0)
        .select("event_timestamp", "event_name", "user_id", "user_pseudo_id", "fingerprint")
        .distinct()
    )


def days_events(events: DataFrame, start: dt.date, end: dt.date, date_col: str = "event_date") -> DataFrame:
    """``click_events`` of each day of ``start..end``, told apart by ``day``."""
    src = events.filter(F.col(date_col).between(F.lit(start), F.lit(end)) & (F.size("event_params") > 0))
    ids = ("event_timestamp", "event_name", "user_id", "user_pseudo_id", "fingerprint")
    return src.select(F.col(date_col).alias("day"), *ids).distinct()


def clean_ids(clicks: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(fgp, user_id, client_id, date_table): '' fingerprint -> NULL,
    'undefined' user -> '', rows with an 'undefined' (or NULL) client dropped."""
    return clicks.select(
        *by,
        F.when(F.col("fingerprint") == "", None).otherwise(F.col("fingerprint")).alias("fgp"),
        F.when(F.col("user_id") == UNDEFINED, "").otherwise(F.col("user_id")).alias("user_id"),
        F.col("user_pseudo_id").alias("client_id"),
        F.col("event_timestamp").alias("date_table"),
    ).filter(F.col("client_id") != UNDEFINED)


# ------------------------------------------------------------------ J1c..J1f
def _blank(c):
    return c.isNull() | (c == "") | (c == UNDEFINED)


def label_day(app: DataFrame, as_of: dt.datetime, by: Sequence[str] = ()) -> DataFrame:
    """``id_with_collisions``: (super_id, user_id_flg, name, value,
    date_insert, date_table).

    Known users: one provisional group per user id.  Anonymous clients with a
    fingerprint: one group per client, keyed by the client's greatest
    fingerprint.  Groups are numbered by a global rank over (known first,
    key), counting rows.  Anonymous clients without a fingerprint become
    singletons numbered after the largest group id by (value, date_table).

    With ``by`` (the day) many days are labelled at once, each apart from the others,
    with one sort for all: ids are unique over the days and have the same order within
    a day as its own labelling gives, which is all that the merge and the fold use."""
    by = list(by)
    # the day's click table is read by four branches below: written once
    app = materialise(app, "app")
    fgp0 = F.when(F.col("fgp") == UNDEFINED, "").otherwise(F.col("fgp"))
    known = app.filter(~_blank(F.col("user_id"))).withColumn("fgp", fgp0)
    anon = app.filter(_blank(F.col("user_id")) & (F.col("client_id") != UNDEFINED)).withColumn("fgp", fgp0)

    def melt(df, kind, key, flg, pairs):
        """One scan: each row becomes one (name, value) row per attribute."""
        cells = F.array(*[F.struct(F.lit(n).alias("name"), v.alias("value")) for n, v in pairs])
        return df.select(
            *by,
            F.lit(kind).alias("_kind"),
            key.alias("_key"),
            F.inline(cells),
            F.lit(flg).alias("user_id_flg"),
            "date_table",
        )

    uid, cid, fgp = F.col("user_id"), F.col("client_id"), F.col("fgp")
    known_rows = melt(known, 0, uid, 1, [(NAME_USER, uid), (NAME_CLIENT, cid), (NAME_FINGERPRINT, fgp)])
    # max(rank over fgp, NULL first) per client == rank of max(fgp) per client
    client_key = anon.groupBy(*by, "client_id").agg(F.max("fgp").alias("_maxfgp"))
    keyed = join_on_keys(anon, client_key, [*by, "client_id"], "left")
    has_fp = fgp.isNotNull() & (fgp != "")
    # NULL client values fall to the value filter below, as in the original
    anon_rows = melt(keyed.filter(has_fp), 1, F.col("_maxfgp"), 0, [(NAME_CLIENT, cid), (NAME_FINGERPRINT, fgp)])
    singles = (
        anon.filter(F.coalesce(fgp, F.lit("")) == "")
        .select(*by, F.lit(NAME_CLIENT).alias("name"), cid.alias("value"), F.lit(0).alias("user_id_flg"), "date_table")
        .distinct()
    )

    # names differ across melted attributes, so one distinct equals the
    # original per-projection GROUP BYs; read by the rank pass and its join-back
    grouped = materialise(
        known_rows.unionByName(anon_rows).filter(F.col("value") != "").distinct(), "name_value"
    )
    # One distributed sort numbers both: group keys (kinds 0/1, weighted by
    # their row counts, so id = 1 + rows before = rank) and then singletons
    # (kind 2, by value and date_table, weight 1: row_number).
    keys = grouped.groupBy(*by, "_kind", "_key").agg(F.count(F.lit(1)).alias("_n"))
    elements = keys.select(
        *by, "_kind", "_key", F.lit(None).cast("string").alias("value"), F.lit(None).cast("long").alias("date_table"),
        "_n", F.lit(None).cast("int").alias("user_id_flg"), F.lit(None).cast("string").alias("name"),
    ).unionByName(singles.select(*by, F.lit(2).alias("_kind"), F.lit(None).cast("string").alias("_key"), "value",
                                 "date_table", F.lit(0).cast("long").alias("_n"), "user_id_flg", "name"))
    # (the result reads the written, numbered table: cheap to read twice)
    order = [*map(By, by), By("_kind"), By("_key"), By("value"), By("date_table")]
    is_single = (F.col("_kind") == 2).cast("long")
    weights = {"_bk": F.col("_n") + (is_single if by else F.lit(0)), "_bs": is_single}
    numbered = with_prefix_sums(elements, order, weights)
    as_keys = [(F.col(c), f"_k{i}") for i, c in enumerate([*by, "_kind", "_key"])]
    key_ids = numbered.filter(F.col("_kind") < 2).select(*[c.alias(k) for c, k in as_keys], (F.col("_bk") + 1).alias("super_id"))
    ranked = grouped.join(key_ids, [c.eqNullSafe(F.col(k)) for c, k in as_keys]).drop(*[k for _, k in as_keys])
    single_ids = numbered.filter(F.col("_kind") == 2)
    if by:
        # as in a day's own labelling, singletons of a day without groups have no id
        days = key_ids.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(by)]).distinct().withColumn("_any", F.lit(True))
        single_ids = join_on_keys(single_ids, days, by, "left").withColumn("super_id", F.when(F.col("_any"), F.col("_bk") + 1))
    else:
        top = key_ids.agg(F.max("super_id")).first()[0]  # one scalar from the small key table
        single_id = (F.col("_bs") + 1 + F.lit(top)).cast("long") if top is not None else F.lit(None).cast("long")
        single_ids = single_ids.withColumn("super_id", single_id)
    now = ts_literal(as_of)
    cols = [
        *by,
        "super_id",
        F.col("user_id_flg").cast("int").alias("user_id_flg"),
        "name",
        "value",
        now.alias("date_insert"),
        "date_table",
    ]
    return materialise(
        ranked.filter(F.col("value").isNotNull())
        .select(*cols)
        .unionByName(single_ids.filter(F.col("value").isNotNull()).select(*cols))
    )


# ------------------------------------------------------------------ J1g
def merge_day(labelled: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``last_day``: two hops of min-label propagation between ids and values.

    r(v) = min id holding v; m(s) = min r(v) over values of s; each value
    takes min m(s) over ids holding it.  date_table = first seen per
    (name, value).  Not a closure: chains longer than two hops keep several
    ids (``merge_closure`` finishes them).  ``by`` as in ``label_day``."""
    by = list(by)
    # read by three branches: written once.  A minimum needs no distinct pairs.
    cells = materialise(
        labelled.groupBy(*by, "super_id", "name", "value", "date_insert").agg(F.min("date_table").alias("date_table")),
        "cells",
    )
    pairs = cells.select(*by, "super_id", "value")
    # join_on_keys re-shuffles the grouped side under each join, which lets
    # AQE split the partition of a hot value (a shared fingerprint)
    r = pairs.groupBy(*by, "value").agg(F.min("super_id").alias("_r"))
    m = join_on_keys(pairs.filter(F.col("super_id").isNotNull()), r, [*by, "value"]).groupBy("super_id").agg(F.min("_r").alias("_m"))
    # values without an id keep none
    rows = (
        join_on_keys(cells, m, ["super_id"], "left")
        .groupBy(*by, "name", "value", "date_insert")
        .agg(F.min("_m").alias("_m"), F.min("date_table").alias("date_table"))
    )
    # a value has a row per name and insert time by now, so these windows are small
    of_value, of_name = Window.partitionBy(*by, "value"), Window.partitionBy(*by, "value", "name")
    return rows.withColumns(
        {"super_id": F.min("_m").over(of_value), "date_table": F.min("date_table").over(of_name)}
    ).select(*by, *MASTER_COLUMNS)


# ------------------------------------------------------------------ J1h
def fold_into_master(day: DataFrame, master: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Rows the day appends to the master.

    Per day-person: total = distinct joined rows, known = rows whose value is
    already in the master.  Partly known persons: all rows appended under the
    smallest matching old id.  Unknown persons: new id = max old id (1 if the
    master is empty) + rank by day id.  Fully known persons add nothing (so a
    fully known person linking two old persons is not merged here)."""
    top = master.agg(F.max("super_id")).first()[0]  # one scalar
    # null-safe form: the day's values are re-shuffled right under the
    # join, so AQE can split a hot value (day values are never NULL)
    hits = join_on_keys(master, day.select("value"), ["value"], "left_semi").withColumn("salt", F.lit(0))
    return fold_hits(day, hits, top, as_of)


#: Day ids of one range, in which ``fold_hits`` numbers them with a window.
RANGE = 1 << 16
#: ``fold_hits`` as one statement (analysed once a day).  Unknown persons are numbered by
#: two running sums: over the ranges of ids in use (one row each), and inside a range.
_FOLD = """
WITH old AS (SELECT DISTINCT value, name, super_id, salt FROM {hits}),
matched AS (
  SELECT DISTINCT d.super_id AS person, d.name, d.value, d.date_insert, d.date_table,
         o.name AS old_name, o.value AS old_value, o.super_id AS old_id
  FROM {day} d LEFT JOIN old o ON d.value = o.value),
persons AS (
  SELECT person, count(person) AS total, count(old_value) AS known, min(old_id) AS old_id, count(*) AS n,
         coalesce(person, -1) DIV {width} AS id_range
  FROM matched GROUP BY person),
ranges AS (SELECT id_range, sum(n) AS n FROM persons WHERE known = 0 GROUP BY id_range),
starts AS (SELECT id_range, sum(n) OVER (ORDER BY id_range) - n AS earlier FROM ranges),
fresh AS (
  SELECT p.person, earlier + sum(n) OVER (PARTITION BY p.id_range ORDER BY p.person) - n + 1 AS place
  FROM persons p JOIN starts s ON p.id_range = s.id_range WHERE known = 0),
goals AS (
  SELECT person, old_id AS goal FROM persons WHERE total > known AND known > 0
  UNION ALL SELECT person, place + {top} FROM fresh)
SELECT CAST(goal AS BIGINT) AS super_id, name, value, {now} AS date_insert, date_table
FROM matched m JOIN goals g ON m.person <=> g.person
"""


def fold_hits(day: DataFrame, hits: DataFrame, top: int | None, as_of: dt.datetime) -> DataFrame:
    """``fold_into_master`` given the master's rows that may hold the day's values (with
    their ``salt``) and the master's largest id (None if it is empty).  One plan
    without a written table; an unknown person's rank counts the rows of the unknown
    persons before it."""
    now = f"TIMESTAMP_NTZ '{as_of.isoformat(sep=' ')}'"
    return day.sparkSession.sql(
        _FOLD.replace("{now}", now), day=day, hits=hits, top=1 if top is None else int(top), width=RANGE
    )


#: ``fold_span``: what each value and person of the span is to the master.  A value has at
#: most a row per name and day, so a window over a value is small.
_VALUES = """
WITH held AS (SELECT value, min(super_id) AS held_id FROM {hits} GROUP BY value),
seen AS (
  SELECT *, min(day) OVER (PARTITION BY value) < day AS earlier FROM {days})
SELECT s.day, s.super_id AS person, s.name, s.value, s.date_table, earlier OR h.value IS NOT NULL AS known, held_id
FROM seen s LEFT JOIN held h ON s.value = h.value
"""
_PERSONS = """
SELECT day, person, count(*) AS n, count_if(known) AS known, min(held_id) AS held_id
FROM {values} GROUP BY day, person HAVING count(*) > count_if(known)
"""
#: Numbers unknown persons day after day: after a day the largest id is that of its last
#: unknown person.  Windows run over the days, the id ranges of a day, and inside a range.
_FRESH = """
WITH fresh AS (SELECT day, person, n, person DIV {width} AS id_range FROM {persons} WHERE known = 0),
ranges AS (SELECT day, id_range, sum(n) AS n, max_by(n, person) AS n_last FROM fresh GROUP BY day, id_range),
days AS (SELECT day, sum(n) - max_by(n_last, id_range) + 1 AS step FROM ranges GROUP BY day),
tops AS (SELECT day, {top} + sum(step) OVER (ORDER BY day) - step AS top FROM days),
starts AS (
  SELECT r.day, id_range, top + sum(n) OVER (PARTITION BY r.day ORDER BY id_range) - n AS earlier
  FROM ranges r JOIN tops t ON r.day = t.day)
SELECT f.person,
  CAST(earlier + sum(n) OVER (PARTITION BY f.day, f.id_range ORDER BY f.person) - n + 1 AS BIGINT) AS new_id
FROM fresh f JOIN starts s ON f.day = s.day AND f.id_range = s.id_range
"""
#: The appended rows: as in ``fold_hits`` a row comes once per name and id that its value
#: has in the master before the day.
_APPENDED = """
WITH owned AS (SELECT a.*, g.goal FROM {rows} a JOIN {goals} g ON a.person = g.person),
old AS (
  SELECT value, name, super_id, min(day) AS day
  FROM (SELECT value, name, goal AS super_id, day FROM owned
        UNION ALL SELECT value, name, super_id, DATE '0001-01-01' FROM {hits})
  GROUP BY value, name, super_id)
SELECT a.day, a.goal AS super_id, a.name, a.value, {now} AS date_insert, a.date_table
FROM owned a LEFT JOIN old o ON a.value = o.value AND o.day < a.day
"""


def fold_span(days: DataFrame, hits: DataFrame, top: int | None, as_of: dt.datetime) -> DataFrame:
    """``fold_hits`` of many days at once: the rows that each day appends, with ``day``.

    ``days`` are merged days as ``days_pipeline`` makes them, without persons that have no
    id: a value has one person a day, and persons have ids of their own over all days,
    rising with the day.  ``hits`` and ``top`` describe the master before the first day.

    A day leaves all its values in the master, so a value is known on a day if the master
    or an earlier day holds it.  That tells fully known, partly known and unknown persons
    apart without a turn per day, and gives the unknown ones their ids.  A partly known
    person takes the smallest id that reaches it from its values' persons of earlier days
    (``_reached_ids``)."""
    spark = days.sparkSession
    values = materialise(spark.sql(_VALUES, days=days, hits=hits), "span-values")
    persons = materialise(spark.sql(_PERSONS, values=values), "span-persons")
    fresh = spark.sql(_FRESH, persons=persons, top=1 if top is None else int(top), width=RANGE)
    rows = materialise(
        join_on_keys(values.drop("known", "held_id"), persons.select("person"), ["person"], "left_semi"), "span-rows"
    )
    goals = join_on_keys(persons.select("person", "known", "held_id"), fresh, ["person"], "left").select(
        "person", (F.col("known") > 0).alias("partly"), F.coalesce("new_id", "held_id").alias("goal")
    )
    now = f"TIMESTAMP_NTZ '{as_of.isoformat(sep=' ')}'"
    return spark.sql(
        _APPENDED.replace("{now}", now), rows=rows, goals=_reached_ids(rows, goals), hits=hits.select("value", "name", "super_id")
    )


def _reached_ids(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """(person, goal) with the smallest id that reaches each partly known person.

    Along the days of a value the smallest id never rises, so a person looks at the last
    person before it that brought rows of the value.  Only persons whose goal fell in a
    round are followed in the next; there are no more rounds than days."""
    before = Window.partitionBy("value").orderBy("day")
    links = (
        rows.select("value", "day", "person").distinct()
        .withColumn("source", F.lag("person").over(before))
        .filter("source IS NOT NULL").select("person", "source").distinct()
    )
    links, goals = materialise(links, "span-links"), materialise(goals, "span-goals")
    fell = goals.filter("goal IS NOT NULL")
    while True:
        sent = fell.select(F.col("person").alias("source"), F.col("goal").alias("_sent"))
        offers = links.join(sent, "source").groupBy("person").agg(F.min("_sent").alias("_offer"))
        lower = F.col("partly") & (F.col("goal").isNull() | (F.col("_offer") < F.col("goal")))
        fell = goals.join(offers, "person").filter(lower).select("person", F.col("_offer").alias("goal"))
        fell = materialise(fell, "span-fell")
        if fell.isEmpty():
            return goals.select("person", "goal")
        better = join_on_keys(goals, fell.withColumnRenamed("goal", "_new"), ["person"], "left")
        goals = materialise(better.select("person", "partly", F.coalesce("_new", "goal").alias("goal")), "span-goals")


# ------------------------------------------------------------------ J1i
def day_pipeline(events: DataFrame, day: dt.date, as_of: dt.datetime, date_col: str = "event_date") -> DataFrame:
    """Events of one day -> the merged day (``last_day``), materialised (the
    fold reads it twice)."""
    return materialise(merge_day(label_day(clean_ids(click_events(events, day, date_col)), as_of)))


def days_pipeline(events: DataFrame, start: dt.date, end: dt.date, as_of: dt.datetime, date_col: str = "event_date") -> DataFrame:
    """``day_pipeline`` of all days of ``start..end`` at once, told apart by ``day``.
    A day's labelling and merge don't depend on the master, so a backlog is done in
    one pass."""
    by = ["day"]
    labelled = label_day(clean_ids(days_events(events, start, end, date_col), by), as_of, by)
    return materialise(merge_day(labelled, by), "merged-days")


def run_days(
    events: DataFrame,
    start: dt.date,
    end: dt.date,
    as_of: dt.datetime,
    master: DataFrame | None = None,
    date_col: str = "event_date",
    bucket_master: int | bool | None = True,
) -> DataFrame:
    """Process days ``start..end`` in order, each folded into the master.

    Default (``bucket_master=True``): the master is kept in a new folder of the
    checkpoint folder (``operators.master``: bucketed by value, with day commits), so
    the daily day-to-master match shuffles only the day's values, never the growing
    master.  A number sets the bucket count, up to
    ``spark.sql.sources.bucketing.maxBuckets``; with fewer buckets than
    ``spark.sql.shuffle.partitions`` Spark may shuffle the bucketed side as well.
    ``True`` takes the smaller of the two settings.  With ``bucket_master=False``
    each day's appended rows are written as a snapshot and the master is their union."""
    spark = events.sparkSession
    if bucket_master:
        kept = open_master(spark, scratch_path(spark, "master"), bucket_master)
        if master is not None:
            kept.append(master, BEGINNING, None)
            kept.commit(BEGINNING, None)
        fold_days(events, kept, start, end, as_of, date_col)
        return kept.rows()
    master = master if master is not None else empty_master(spark)
    day = start
    while day <= end:
        # the day's intermediate tables are deleted once its rows are written
        with scratch_scope(spark):
            merged = day_pipeline(events, day, as_of, date_col)
            appended = materialise(fold_into_master(merged, master, as_of), "appended", keep=True)
        master = master.unionByName(appended)
        day += dt.timedelta(days=1)
    return master


def bucket_count(spark, asked: int | bool) -> int:
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
    if asked is True:
        return min(int(spark.conf.get("spark.sql.shuffle.partitions")), most)
    if not 0 < int(asked) <= most:
        raise ValueError(f"{asked} buckets; spark.sql.sources.bucketing.maxBuckets is {most}")
    return int(asked)


def open_master(
    spark, folder: str, buckets: int | bool = True, heavy_rows: int = HEAVY_ROWS, salts: int = SALTS
) -> Master:
    """The persistent master in ``folder``, made if it is not there."""
    return Master(spark, folder, MASTER_DDL, bucket_count(spark, buckets), heavy_rows, salts)


def fold_days(
    events: DataFrame, master: Master, start: dt.date, end: dt.date, as_of: dt.datetime, date_col: str = "event_date"
) -> list[Commit]:
    """Fold days ``start..end`` into the master, a commit each.  Days up to the
    master's mark are done and left out.

    The days are folded together (``fold_span``), written by one job and then committed in
    turn.  A day with persons without ids (no group that day) can leave values out of the
    master, so it has a turn of its own (``fold_hits``) between the spans."""
    spark, done = events.sparkSession, []
    last = master.last_commit()
    mark = master.mark()
    day = max(start, mark + dt.timedelta(days=1)) if mark else start
    if day > end:
        return done
    with scratch_scope(spark):
        merged = days_pipeline(events, day, end, as_of, date_col)
        # a row per day at most
        alone = {r[0] for r in merged.filter("super_id IS NULL").select("day").distinct().collect()}
        while day <= end:
            span = [day]
            while day not in alone and span[-1] < end and span[-1] + dt.timedelta(days=1) not in alone:
                span.append(span[-1] + dt.timedelta(days=1))
            rows = merged.filter(F.col("day").between(F.lit(span[0]), F.lit(span[-1])))
            hits = master.hits(rows.select("value"), last)
            top = last.top if last else None
            # reads committed days and the written merge only, so a failed attempt can
            # be repeated from the same tables
            if day in alone:
                master.append(fold_hits(rows.select(*MASTER_COLUMNS), hits, top, as_of), day, last)
            else:
                hits = materialise(hits.select("value", "name", "super_id").distinct(), "span-hits")
                master.append_days(fold_span(rows, hits, top, as_of), span, last)
            master.look_at(span)
            for day in span:
                last = master.commit(day, last)
                done.append(last)
            day = span[-1] + dt.timedelta(days=1)
    return done


def advance_master(
    events: DataFrame,
    master: Master,
    as_of: dt.datetime,
    first_day: dt.date | None = None,
    date_col: str = "event_date",
) -> tuple[dt.date, dt.date] | None:
    """Fold every unprocessed day into the persistent master.

    The days run from the one after the master's mark (its last commit, whether or
    not that day added rows) to the last day of ``events``; ``first_day`` is only for
    a master without commits (default: the first day of ``events``).  Returns the
    days folded, or None."""
    mark = master.mark()
    lo, hi = events.agg(F.min(date_col), F.max(date_col)).head()
    start = mark + dt.timedelta(days=1) if mark else first_day or lo
    if hi is None or start > hi:
        return None
    fold_days(events, master, start, hi, as_of, date_col)
    return start, hi


# ------------------------------------------------------------------ J1j
def session_rows(master: DataFrame) -> DataFrame:
    """Each name and value once, with the smallest id, first insert and first-seen time
    of the value's rows."""
    per_value = master.groupBy("value").agg(
        F.min("super_id").alias("_sid"),
        F.min("date_insert").alias("_di"),
        F.min("date_table").alias("_dt"),
    )
    return join_on_keys(master.select("name", "value"), per_value, ["value"], "left").select(
        F.col("_sid").alias("super_id"),
        "name",
        "value",
        F.col("_di").alias("date_insert"),
        F.col("_dt").alias("date_table"),
    ).distinct()


def user_sessions(master: DataFrame) -> DataFrame:
    """``name_value_x_rank``: successive users inside a person.

    Each value takes the smallest id, first insert and first-seen time of its
    rows.  User rows are ranked (dense) by first-seen time inside the person;
    every row carries the last rank at or before it on the person's timeline
    (date_table, value; ties included), 1 if none.  user_id_rank numbers
    (person, user in effect) pairs globally, and a returning user keeps the
    first rank of its pair.

    No per-person window: the carried rank is monotone along the timeline, so
    it equals the number of user *dates* whose first user row lies at or
    before the row, and the user in effect is the user row whose global index
    equals the number of user rows at or before it.  Both counts come from
    one distributed prefix sum over (person, date_table, value, kind), in
    which a person holding a third of all rows spans many range partitions;
    the person's starting counts come from a grouped minimum."""
    return rank_sessions(session_rows(master))


def rank_sessions(rows: DataFrame) -> DataFrame:
    """``user_sessions`` of ``session_rows``."""
    users = rows.filter(F.col("name") == NAME_USER).select("super_id", "date_table", "value").distinct()
    first_at_date = users.groupBy("super_id", "date_table").agg(F.min("value").alias("_first"))
    markers = join_on_keys(users, first_at_date, ["super_id", "date_table"]).select(
        "super_id",
        "date_table",
        "value",
        F.lit(0).alias("_kind"),
        (F.col("value") == F.col("_first")).cast("long").alias("_wd"),
        F.lit(1).cast("long").alias("_wu"),
    )
    elements = rows.select(
        "super_id", "date_table", "value", F.lit(1).alias("_kind"), F.lit(0).cast("long").alias("_wd"),
        F.lit(0).cast("long").alias("_wu"), "name", "date_insert",
    ).unionByName(markers, allowMissingColumns=True)
    # the result reads the written, numbered table (cheap to read three times)
    counted = with_prefix_sums(
        elements,
        [By("super_id"), By("date_table"), By("value"), By("_kind")],
        {"_bd": F.col("_wd"), "_bu": F.col("_wu")},
    )
    start = counted.groupBy("super_id").agg(F.min("_bd").alias("_bd0"), F.min("_bu").alias("_bu0"))
    user_index = counted.filter(F.col("_kind") == 0).select(
        (F.col("_bu") + 1).alias("_idx"), F.col("value").alias("_user")
    )
    timeline = join_on_keys(counted.filter(F.col("_kind") == 1), start, ["super_id"], "left")
    dates_before = F.col("_bd") - F.col("_bd0")
    timeline = timeline.withColumns(
        {
            "rank_of_super_id": F.when(dates_before == 0, F.lit(1)).otherwise(dates_before).cast("long"),
            "_idx": F.when(F.col("_bu") > F.col("_bu0"), F.col("_bu")),
        }
    ).join(user_index, "_idx", "left")
    ranked = with_global_rank(timeline, [By("super_id"), By("_user")], name="user_id_rank", dense=True)
    out = ranked.select(
        "super_id", "name", "value", "date_insert", "date_table", "rank_of_super_id", "user_id_rank"
    ).distinct()
    first = out.groupBy("user_id_rank").agg(F.min("rank_of_super_id").alias("_first"))
    return join_on_keys(out, first, ["user_id_rank"], "left").select(
        "super_id",
        "name",
        "value",
        "date_insert",
        "date_table",
        F.col("_first").alias("rank_of_super_id"),
        "user_id_rank",
    )


SESSION_SCHEMA = T.StructType(
    [*MASTER_SCHEMA.fields, T.StructField("rank_of_super_id", T.LongType()), T.StructField("user_place", T.LongType())]
)


def session_store(spark, folder: str, buckets: int) -> BucketedTable:
    """Sessions kept over increments, in buckets of persons.  ``user_place`` numbers the
    users in effect inside a person: the global rank is that plus the places of all
    persons before, which is added when reading (``stored_sessions``), so a new person
    shifts the ranks of others without a rewrite of their rows."""
    return BucketedTable(spark, folder, SESSION_SCHEMA, ["super_id"], buckets)


def _placed(rows: DataFrame) -> DataFrame:
    """``rank_sessions`` with the place inside the person instead of the global rank."""
    ranked = rank_sessions(rows)
    first = ranked.groupBy("super_id").agg(F.min("user_id_rank").alias("_first"))
    placed = join_on_keys(ranked, first, ["super_id"], "left")
    return placed.withColumn("user_place", F.col("user_id_rank") - F.col("_first") + 1).select(*SESSION_SCHEMA.names)


def extend_sessions(store: BucketedTable, master: Master, since: dt.date | None) -> dt.date | None:
    """Bring the store from day ``since`` (None: empty) to the master's mark, which is
    returned.  Only persons that have, or had, a value of the new rows are ranked
    again, and only their buckets rewritten."""
    last = master.last_commit()
    if since is None:
        store.replace(_placed(session_rows(master.rows())))
        return master.mark()
    since_day = since.isoformat()
    added = master.rows_after(since).select("value").distinct()
    known = materialise(master.hits(added, last).select(*MASTER_COLUMNS, "day"), "touched-values")
    now = session_rows(known)
    before = known.filter(F.col("day") <= since_day).groupBy("value").agg(F.min("super_id").alias("super_id"))
    persons = materialise(now.select("super_id").unionByName(before.select("super_id")).distinct(), "persons")
    only = store.touched(persons)
    if not only:
        return master.mark()
    old = materialise(store.read(only), "old-sessions")  # of these buckets: of touched persons and others
    rest = join_on_keys(old, persons, ["super_id"], "left_anti")
    same = join_on_keys(join_on_keys(old, persons, ["super_id"], "left_semi"), now.select("value"), ["value"], "left_anti")
    again = _placed(same.select(*MASTER_COLUMNS).unionByName(now))
    store.replace(again.unionByName(rest), only)
    return master.mark()


def stored_sessions(store: BucketedTable) -> DataFrame:
    """``user_sessions`` from the store: the offsets are a running sum over persons."""
    rows = store.read()
    persons = rows.groupBy("super_id").agg(F.max("user_place").alias("_places"))
    offsets = with_prefix_sums(persons, [By("super_id")], {"_before": F.col("_places")}).select("super_id", "_before")
    return join_on_keys(rows, offsets, ["super_id"], "left").select(
        *MASTER_COLUMNS, "rank_of_super_id", (F.col("_before") + F.col("user_place")).alias("user_id_rank")
    )


# ------------------------------------------------------------------ J1k
def _edges(labelled: DataFrame) -> DataFrame:
    known = F.col("super_id").isNotNull() & F.col("value").isNotNull()
    return labelled.select("super_id", "value").filter(known).distinct()


def adopt_labels_label(labels: DataFrame) -> DataFrame:
    """Pointer jumping: an id (super_id, label) adopts its label's label.  In a giant
    component all rows carry one label; the null-safe join puts a shuffle under
    both sides, so AQE splits that label's partition."""
    parent = labels.select(F.col("super_id").alias("label"), F.col("label").alias("_grand"))
    return join_on_keys(labels, parent, ["label"], "left").select(
        "super_id", F.least(F.col("label"), F.coalesce(F.col("_grand"), F.col("label"))).alias("label")
    )


def component_labels(edges: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """(super_id, label) of every id of the id-value edges: the smallest id reachable
    through shared values.

    Each round is one min-label hop through the values (partial
    aggregation on both group-bys) followed by pointer jumping, so long chains need
    about log2(diameter) rounds.  Labels are written to the checkpoint folder every
    round.  A label never grows, so the loop stops when their sum stays.
    ``max_rounds``, if given, raises beyond that many rounds."""
    spark = edges.sparkSession
    labels, labels_path = materialise_at(
        edges.select("super_id").distinct().withColumn("label", F.col("super_id")), "labels", keep=True
    )

    def total(of: DataFrame):
        return of.agg(F.sum(F.col("label").cast("decimal(38,0)"))).head()[0]

    before, rounds = total(labels), 0
    while True:
        if max_rounds is not None and rounds >= max_rounds:
            raise RuntimeError("merge_closure did not converge")
        rounds += 1
        vlabel = edges.join(labels, "super_id").groupBy("value").agg(F.min("label").alias("vlabel"))
        hop = join_on_keys(edges, vlabel, ["value"]).groupBy("super_id").agg(F.min("vlabel").alias("label"))
        new, new_path = materialise_at(adopt_labels_label(hop), "labels", keep=True)
        after = total(new)
        delete_path(spark, labels_path)  # the previous round's labels are no longer read
        labels, labels_path = new, new_path
        if after == before:
            return labels
        before = after


def merge_closure(labelled: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """Connected components of the id-value graph: every value gets the
    smallest id reachable through shared values (the fixpoint of
    ``merge_day``)."""
    edges = materialise(_edges(labelled), "pairs")
    labels = component_labels(edges, max_rounds)
    comp = join_on_keys(edges, labels, ["super_id"]).groupBy("value").agg(F.min("label").alias("super_id"))
    first_seen = labelled.groupBy("name", "value").agg(F.min("date_table").alias("date_table"))
    rows = labelled.select("name", "value", "date_insert").distinct()
    out = join_on_keys(rows, comp, ["value"], "left")
    out = join_on_keys(out, first_seen, ["name", "value"], "left")
    return out.select(*MASTER_COLUMNS).distinct()


def extend_closure(stored: DataFrame, labelled: DataFrame) -> DataFrame:
    """Fold new id-value rows into stored components (value, super_id), without
    computing those anew: (value, super_id) of all values.

    A stored component takes part as one id, linked to those of its values that the new
    rows hold, so the iteration runs over the new rows and the components they touch.
    The stored values are then relabelled by one join; ids of ``labelled`` must be
    distinct from those of earlier calls, unless they mean the same person."""
    edges = _edges(labelled)
    touched = join_on_keys(stored.select("super_id", "value"), edges.select("value"), ["value"], "left_semi")
    edges = materialise(edges.unionByName(touched).distinct(), "pairs")
    labels = component_labels(edges)
    found = join_on_keys(edges, labels, ["super_id"]).groupBy("value").agg(F.min("label").alias("super_id"))
    renamed = labels.filter("label < super_id").select("super_id", "label")
    kept = join_on_keys(stored.select("super_id", "value"), renamed, ["super_id"], "left").select(
        "value", F.coalesce("label", "super_id").alias("super_id")
    )
    new_values = join_on_keys(found, stored.select("value"), ["value"], "left_anti")
    return kept.unionByName(new_values.select("value", "super_id"))
