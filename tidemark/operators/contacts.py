"""J3: phone calls folded into contacts (unordered phone pairs), and upsert.

A contact is the unordered pair of the two phones.  Call outcomes per contact:
succeeded = some call longer than ``succeeded_s``; unreachable = no call
longer than ``unreachable_s``; declined = neither.  A contact is finished when
its last call start + a call duration + ``wait_days`` is before ``as_of``.

Everything is computed from one ``groupBy(pair)`` (partial aggregation, so a
pair holding a third of all calls is combined map-side); there are no
whole-partition windows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import ntz_literal
from tidemark.operators.buckets import BucketedTable
from tidemark.session import materialise


class Thresholds(NamedTuple):
    """A call longer than ``succeeded_seconds`` succeeded, one of at most
    ``unreachable_seconds`` did not reach anybody, and a contact is finished
    ``finish_wait_days`` after its last call.  The defaults are fixed values."""

    unreachable_seconds: int = 20
    succeeded_seconds: int = 60
    finish_wait_days: int = 3


THRESHOLDS = Thresholds()


def ts_literal(value: dt.datetime | dt.date | str) -> Column:
    """A TIMESTAMP_NTZ literal (the test tables' timestamp type)."""
    return ntz_literal(value)


def pair_columns(a: str = "phone_from", b: str = "phone_to") -> tuple[Column, Column]:
    """Unordered pair as (smaller, larger).  A NULL comparison falls to the
    second operand, as IIF does (unlike least/greatest, which skip NULLs)."""
    x, y = F.col(a), F.col(b)
    return F.when(x < y, x).otherwise(y), F.when(x > y, x).otherwise(y)


def _plus_seconds(ts: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, ts)


def _pair_aggregates(calls: DataFrame, limits: Thresholds) -> DataFrame:
    p1, p2 = pair_columns()
    order = F.struct(F.col("call_start"), F.col("call_id"))
    dur = F.col("duration")
    return (
        calls.withColumns({"phone_1": p1, "phone_2": p2})
        .groupBy("phone_1", "phone_2")
        .agg(
            F.count(F.lit(1)).alias("_total"),
            F.count_if(dur > limits.succeeded_seconds).alias("_n_succ"),
            F.count_if(dur > limits.unreachable_seconds).alias("_n_reach"),
            F.count_if(dur <= limits.unreachable_seconds).alias("_n_unreach"),
            # last call by start time, call_id breaks ties
            F.max_by(F.struct(F.col("call_start"), dur), order).alias("_last"),
            F.min(dur).alias("_min_dur"),
            F.max(dur).alias("_max_dur"),
            F.count_if(dur.isNull()).alias("_n_null_dur"),
            F.min("created").alias("created_datetime"),
            F.min("call_start").alias("first_call_start_datetime"),
        )
        .withColumns(
            {
                "Total_Calls_cnt_candidate": F.col("_total"),
                "is_succeeded_candidat": (F.col("_n_succ") > 0).cast("int"),
                "is_unreachable_candidate": (1 - (F.col("_n_reach") > 0).cast("int")),
                "Unreachable_Calls_cnt_candidate": F.col("_n_unreach"),
                "finish_date_datetime_candidate": _plus_seconds(
                    F.col("_last.call_start"), F.col("_last.duration")
                ),
            }
        )
    )


def _finished_if(duration: Column, as_of: Column, limits: Thresholds) -> Column:
    """1 when last start + duration + wait < as_of (NULL counts as not)."""
    when = F.timestamp_add("DAY", F.lit(limits.finish_wait_days), _plus_seconds(F.col("_last.call_start"), duration))
    return F.coalesce(when < as_of, F.lit(False))


def _outcomes(df: DataFrame) -> DataFrame:
    fin = F.col("is_finished") == 1
    succ = F.col("is_succeeded_candidat") == 1
    unr = F.col("is_unreachable_candidate") == 1
    one = F.col("Total_Calls_cnt_candidate") == 1

    def flag(c):
        return F.when(c, F.lit(1)).otherwise(F.lit(0))

    df = df.withColumns(
        {
            "Total_Calls_cnt": F.when(fin, F.col("Total_Calls_cnt_candidate")),
            "finish_date_datetime": F.when(fin, F.col("finish_date_datetime_candidate")),
            "First_Call_Success": flag(succ & one & fin),
            "First_Call_Response": flag(one & fin),
            "is_succeeded": flag(succ & fin),
            "is_unreachable": flag(unr & fin),
            "is_declined": flag(~succ & ~unr & fin),
            "Unreachable_Calls_cnt": F.when(fin, F.col("Unreachable_Calls_cnt_candidate")),
            "contact_stage_id": F.when(fin, F.lit(1)).otherwise(F.lit(2)),
        }
    )
    return df.withColumn(
        "contact_result_id",
        F.when(F.col("is_succeeded") == 1, F.lit(1))
        .when(F.col("is_declined") == 1, F.lit(2))
        .when(F.col("is_unreachable") == 1, F.lit(3)),
    )


CALLS_WINDOW_COLUMNS = [
    "phone1",
    "phone2",
    "Total_Calls_cnt_candidate",
    "is_succeeded_candidat",
    "is_unreachable_candidate",
    "Unreachable_Calls_cnt_candidate",
    "is_finished",
    "finish_date_datetime_candidate",
    "Total_Calls_cnt",
    "finish_date_datetime",
    "First_Call_Success",
    "First_Call_Response",
    "is_succeeded",
    "is_unreachable",
    "is_declined",
    "Unreachable_Calls_cnt",
    "contact_stage_id",
    "contact_result_id",
]


def contact_calls(calls: DataFrame, as_of, limits: Thresholds = THRESHOLDS) -> DataFrame:
    """J3a, as written: ``is_finished`` uses each call's own duration with the
    last call's start, then ``DISTINCT`` over the contact-level columns, so a
    contact yields one row per distinct ``is_finished`` value (1 or 2 rows).

    Which values occur follows from the pair's min/max duration (the test is
    monotone in the duration), so the rows come straight from the aggregate."""
    now = ts_literal(as_of)
    agg = _pair_aggregates(calls, limits)
    has_finished = _finished_if(F.col("_min_dur"), now, limits) & F.col("_min_dur").isNotNull()
    has_open = (F.col("_n_null_dur") > 0) | ~_finished_if(F.col("_max_dur"), now, limits)
    rows = agg.withColumn(
        "is_finished",
        F.explode(F.array_compact(F.array(F.when(has_open, F.lit(0)), F.when(has_finished, F.lit(1))))),
    )
    return _outcomes(rows).withColumnsRenamed({"phone_1": "phone1", "phone_2": "phone2"}).select(
        *CALLS_WINDOW_COLUMNS
    )


def contact_first_touch(calls: DataFrame) -> DataFrame:
    """J3b: first creation and first call start per contact."""
    p1, p2 = pair_columns()
    return (
        calls.withColumns({"phone_1": p1, "phone_2": p2})
        .groupBy("phone_1", "phone_2")
        .agg(
            F.min("created").alias("created_datetime"),
            F.min("call_start").alias("first_call_start_datetime"),
        )
    )


CONTACT_FACT_COLUMNS = [
    "phone_1",
    "phone_2",
    "created_datetime",
    "first_call_start_datetime",
    "finish_date_datetime",
    "contact_stage_id",
    "contact_result_id",
    "is_finished",
    "is_succeeded",
    "is_declined",
    "is_unreachable",
    "Unreachable_Calls_cnt",
    "Total_Calls_cnt",
    "First_Call_Response",
    "First_Call_Success",
]


def contact_facts(calls: DataFrame, as_of, limits: Thresholds = THRESHOLDS) -> DataFrame:
    """J3c: one row per contact; finished is judged on the last call."""
    now = ts_literal(as_of)
    agg = _pair_aggregates(calls, limits).withColumn(
        "is_finished", _finished_if(F.col("_last.duration"), now, limits).cast("int")
    )
    return _outcomes(agg).select(*CONTACT_FACT_COLUMNS)


def upsert(
    target: DataFrame,
    staging: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    load_col: str | None = None,
    now=None,
) -> DataFrame:
    """J3d: MERGE staging into target, returned as the new snapshot.

    Staging is de-duplicated (``SELECT DISTINCT``); a key still holding two
    different rows fails the job, as MERGE does.  Matched rows take the
    staging values of ``update_cols`` and ``load_col`` = ``now``; unmatched
    staging rows are inserted with their own values (keys included); other
    target rows are kept.  NULL keys never match."""
    keys = list(keys)
    others = [c for c in staging.columns if c not in keys]
    # rows with a NULL key match nothing and are inserted as they are
    whole = staging.distinct()
    no_null = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    loose = whole.filter(~no_null).select(
        *[F.col(c) if c in staging.columns else F.lit(None).cast(target.schema[c].dataType).alias(c) for c in target.columns]
    )
    staged = whole.filter(no_null).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), *[F.max(c).alias(c) for c in others]
    )
    guard = F.when(F.col("s._n") > 1, F.raise_error(F.lit("MERGE: several staging rows for one key")))
    t, s = target.withColumn("_present", F.lit(True)).alias("t"), staged.alias("s")
    cond = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    joined = t.join(s, cond, "full_outer")
    matched = F.col("t._present").isNotNull() & F.col("s._n").isNotNull()
    t_only = F.col("s._n").isNull()
    out_cols = []
    for c in target.columns:
        if c in keys:
            # the duplicate-key guard rides on the first key (always output)
            staged_key = F.coalesce(guard, F.col(f"s.{c}")) if c == keys[0] else F.col(f"s.{c}")
            out_cols.append(F.when(t_only, F.col(f"t.{c}")).otherwise(staged_key).alias(c))
        elif c == load_col and now is not None:
            staged_val = F.when(matched, ts_literal(now)).otherwise(F.col(f"s.{c}"))
            out_cols.append(F.when(t_only, F.col(f"t.{c}")).otherwise(staged_val).alias(c))
        elif c in update_cols:
            out_cols.append(F.when(t_only, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c))
        elif c in others:
            out_cols.append(F.when(matched | t_only, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c))
        else:
            out_cols.append(F.col(f"t.{c}").alias(c))
    return joined.select(*out_cols).unionByName(loose)


def upsert_table(
    target: BucketedTable, staging: DataFrame, update_cols: Sequence[str], load_col: str | None = None, now=None
) -> list[int]:
    """``upsert`` into a stored table, in place: only the buckets that hold a staging key
    are read and rewritten.  Returns those buckets.  If staging breaks the MERGE rule
    the job fails before any file is replaced."""
    staged = materialise(staging.distinct(), "staging")  # read for its buckets, and for the merge
    only = target.touched(staged)
    if only:
        target.replace(upsert(target.read(only), staged, target.keys, update_cols, load_col, now), only)
    return only
