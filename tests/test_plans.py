"""Plan shape: filters reach the scan, no per-key or single-task windows."""

import datetime as dt

import __spark_entry__ as entry
from tests.conftest import SF001
from tidemark.operators import identity
from tidemark.plans import inputs

Q = entry.queries()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_date_window_reaches_parquet_scan(spark):
    plan = _plan(Q["load_window"](spark, SF001))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan and "LessThan(ts," in plan
    ev = inputs.identity_events(spark, SF001, dt.date(2024, 1, 5), dt.date(2024, 1, 5))
    assert "GreaterThanOrEqual(ts," in _plan(ev)


def test_columns_pruned_at_scan(spark):
    plan = _plan(Q["contact_first_touch"](spark, SF001))
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "event_type" not in scan and "props" in scan


def test_no_windows_in_grouped_jobs(spark):
    for name in ("time_decay_attribution", "contact_calls_window", "contact_facts", "top1_rank", "distinct_on"):
        assert "Window" not in _plan(Q[name](spark, SF001)), name


def test_identity_labelling_has_no_single_partition_exchange(spark):
    ev = inputs.identity_events(spark, SF001, dt.date(2024, 1, 5), dt.date(2024, 1, 5))
    lab = identity.label_day(identity.clean_ids(identity.click_events(ev, dt.date(2024, 1, 5))), dt.datetime(2024, 2, 1))
    merged = identity.merge_day(lab)
    for df in (lab, merged):
        plan = _plan(df)
        assert "SinglePartition" not in plan and "Window" not in plan


def test_user_sessions_has_no_window(spark):
    ev = inputs.identity_events(spark, SF001, dt.date(2024, 1, 5), dt.date(2024, 1, 6))
    master = identity.run_days(ev, dt.date(2024, 1, 5), dt.date(2024, 1, 6), dt.datetime(2024, 2, 1))
    plan = _plan(identity.user_sessions(master))
    assert "Window" not in plan and "SinglePartition" not in plan
