"""Joining grouped totals back to rows, without per-key windows.

``sum(x) over (partition by k)`` buffers every row of a key in one task; a key
holding a third of the data would run as one task.  Here totals come from a
``groupBy`` (partial aggregation on the map side, so a hot key is combined
before the shuffle) and are joined back.  The join-back side has one row per
key; AQE turns it into a broadcast when its runtime size is small and splits a
hot key's partition of the row side otherwise (skew join).  The null-safe key
form also places a fresh shuffle of the grouped side directly under the join,
which AQE's skew split needs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on_keys(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", null_safe: bool = True
) -> DataFrame:
    """Equi-join on same-named keys; NULL keys match each other when
    ``null_safe`` (the grouping semantics of ``PARTITION BY``)."""
    keys = list(keys)
    if not null_safe:
        return left.join(right, keys, how)
    renamed = right.select(
        *[F.col(k).alias(f"_jk{i}") for i, k in enumerate(keys)],
        *[c for c in right.columns if c not in keys],
    )
    cond = [F.col(k).eqNullSafe(F.col(f"_jk{i}")) for i, k in enumerate(keys)]
    out = left.join(renamed, cond, how)
    return out.drop(*[f"_jk{i}" for i in range(len(keys))])

