"""Reshaping jobs: J9 campaign slice, J10 name/value melt, J12 event payloads,
J14 column profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The campaign hierarchy, top to bottom.
HIERARCHY = ["source", "medium", "campaign", "ad_group_id", "ad_id"]


def campaign_slice(
    df: DataFrame, key: str, value, depth: int = len(HIERARCHY), keep: Sequence[str] = ("pos",)
) -> DataFrame:
    """Rows whose level ``key`` equals ``value``, projected through the first
    ``depth`` levels of the hierarchy.  Rows stay rows (one per match, with
    their position column) instead of per-level lists, so nothing is gathered
    into one place."""
    if key not in HIERARCHY:
        raise ValueError(f"{key!r} is not a hierarchy level")
    if not 1 <= depth <= len(HIERARCHY):
        raise ValueError("depth must be between 1 and 5")
    levels = HIERARCHY[:depth]
    return df.filter(F.col(key) == F.lit(value)).select(*[c for c in keep if c in df.columns], *levels)


def melt_name_value(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    name_col: str = "column_name",
    value_col: str = "column_value",
) -> DataFrame:
    """Wide -> (column_name, column_value) with NULL and NaN values dropped.  Values
    are cast to string first so columns of different types can share one
    value column."""
    cols = list(columns or df.columns)
    floats = {c for c, kind in df.dtypes if kind in ("float", "double")}
    present = {c: F.nullif(F.col(c), F.lit(float("nan"))) if c in floats else F.col(c) for c in cols}
    as_text = df.select(*[present[c].cast("string").alias(c) for c in cols])
    long = as_text.unpivot([], cols, name_col, value_col)
    return long.filter(F.col(value_col).isNotNull())


def event_payloads(
    clients: DataFrame,
    event_name,
    client_col: str = "client_id",
    params: Sequence[str] = ("param_name_1", "param_name_2"),
) -> DataFrame:
    """One JSON payload per client: the client id and one event whose
    parameters are ``event_<param>`` (the measurement-protocol body).  The
    HTTP send is not part of this library."""
    param_struct = F.struct(*[F.col(p).alias(f"event_{p}") for p in params])
    event = F.struct(F.lit(event_name).alias("name"), param_struct.alias("params"))
    body = F.struct(F.col(client_col).alias("client_id"), F.array(event).alias("events"))
    return clients.select(F.col(client_col).alias("client_id"), F.to_json(body).alias("payload"))


def profile(df: DataFrame) -> DataFrame:
    """Column profile: position, name, Spark type, non-NULL and NULL counts.
    One aggregation over the table, then a stack of its single row."""
    fields = df.schema.fields
    agg = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.col(f.name)).alias(f"_c{i}") for i, f in enumerate(fields)],
    )
    entries = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"_c{i}").alias("non_null_count"),
            (F.col("_rows") - F.col(f"_c{i}")).alias("null_count"),
        )
        for i, f in enumerate(fields)
    ]
    return agg.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
