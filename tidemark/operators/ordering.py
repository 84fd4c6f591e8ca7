"""Global order operators that never funnel all rows into one task.

SQL writes global numbering as a window without ``PARTITION BY``
(``rank() over (order by x)``, ``row_number() over ()``); Spark plans those as
a single-partition exchange, i.e. one task sorts the whole input.  Here the
same results come from a range-partitioned sort whose rows record their
partition and in-partition position before being written once to the shared
checkpoint folder; a second prefix sum over the per-partition totals (one row
per partition) gives each partition its offset, as a written table that is
joined by partition id.  The driver sees no row of either.

Top-1-per-group is written as a grouped ``max``/``min`` over a struct (partial
aggregation on the map side, so a group holding a third of the rows is
combined before the shuffle) plus an equi-join back on group and order keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import materialise

# Bits of monotonically_increasing_id() that hold the row position.
_ROW_BITS = 33


@dataclass(frozen=True)
class By:
    """One sort key.  ``nulls_first=None`` means SQL/Spark default placement:
    first when ascending, last when descending."""

    col: str
    desc: bool = False
    nulls_first: bool | None = None

    @property
    def nulls_go_first(self) -> bool:
        return (not self.desc) if self.nulls_first is None else self.nulls_first

    @property
    def default_nulls(self) -> bool:
        return self.nulls_go_first == (not self.desc)

    def sort(self) -> Column:
        c = F.col(self.col)
        if self.desc:
            return c.desc_nulls_first() if self.nulls_go_first else c.desc_nulls_last()
        return c.asc_nulls_first() if self.nulls_go_first else c.asc_nulls_last()


OrderSpec = Sequence["str | By"]


def as_by(spec: str | By) -> By:
    return spec if isinstance(spec, By) else By(spec)


def _norm(order: OrderSpec) -> list[By]:
    out = [as_by(o) for o in order]
    if not out:
        raise ValueError("an order needs at least one key")
    return out


def _numbered_table(
    df: DataFrame, order: list[By], weights: dict[str, Column] | None
) -> tuple[DataFrame, DataFrame]:
    """Sort with range partitioning; inside each sorted partition record the
    partition id (``_pid``) and, per weight, the exclusive running sum
    (``_local_<name>``); write that as a table.  Positions are columns of the
    written table, so nothing later depends on how files are read back.

    Returns the table, and per partition (``_at``) and weight the exclusive prefix of
    the partition totals (``_off_<name>``) and the total (``_sum_<name>``)."""
    sorted_df = df.orderBy(*[b.sort() for b in order])
    if weights is None:
        names = ["n"]
        mask = (1 << _ROW_BITS) - 1
        staged = sorted_df.withColumns(
            {
                "_pid": F.spark_partition_id(),
                "_local_n": F.monotonically_increasing_id().bitwiseAND(F.lit(mask)),
                "_w_n": F.lit(1).cast("long"),
            }
        )
    else:
        names = list(weights)
        weighted = sorted_df.withColumns({f"_w_{k}": w.cast("long") for k, w in weights.items()})
        schema = T.StructType(
            weighted.schema.fields
            + [T.StructField("_pid", T.IntegerType(), False)]
            + [T.StructField(f"_local_{k}", T.LongType(), False) for k in names]
        )

        def running(batches):
            import pyarrow as pa
            from pyspark import TaskContext

            pid = TaskContext.get().partitionId()
            acc = dict.fromkeys(names, 0)
            for batch in batches:  # Arrow columns pass through untouched
                added = [pa.array(np.full(batch.num_rows, pid, np.int32))]
                for k in names:
                    w = batch.column(batch.schema.get_field_index(f"_w_{k}")).fill_null(0).to_numpy(zero_copy_only=False)
                    csum = np.cumsum(w, dtype=np.int64)
                    added.append(pa.array(csum - w + acc[k]))
                    if len(csum):
                        acc[k] += int(csum[-1])
                yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=schema.names)

        staged = weighted.mapInArrow(running, schema)
    table = materialise(staged, "numbered")
    totals = table.groupBy(F.col("_pid").alias("_at")).agg(*[F.sum(f"_w_{k}").alias(f"_sum_{k}") for k in names])
    # one row per partition of the sort: a bound fixed by the plan, not by the data
    before = Window.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumns({f"_off_{k}": F.coalesce(F.sum(f"_sum_{k}").over(before), F.lit(0)) for k in names})
    return table, materialise(offsets, "offsets")


def _with_offsets(table: DataFrame, offsets: DataFrame, out: dict[str, str], start: int) -> DataFrame:
    """Add ``out[name]`` = partition offset + in-partition running sum + start."""
    names = list(out)
    # one row per partition: size bounded by the plan, safe to broadcast
    joined = table.join(F.broadcast(offsets), F.col("_pid") == F.col("_at")).withColumns(
        {
            out[k]: (F.col(f"_off_{k}") + F.col(f"_local_{k}") + F.lit(start)).cast("long")
            for k in names
        }
    )
    helpers = ["_pid", "_at"] + [f"{p}_{k}" for k in names for p in ("_off", "_local", "_w", "_sum")]
    return joined.drop(*helpers)


def with_row_number(
    df: DataFrame, order: OrderSpec, name: str = "row_number", start: int = 1, with_total: bool = False
):
    """``row_number() over (order by ...)`` without a single-partition window.

    The order should be total (add a tie key); otherwise tied rows are numbered
    in the order the sort left them, as SQL does.  With ``with_total`` the row
    count (known from the partition totals) is returned too."""
    table, offsets = _numbered_table(df, _norm(order), None)
    out = _with_offsets(table, offsets, {"n": name}, start)
    return (out, int(offsets.agg(F.coalesce(F.sum("_sum_n"), F.lit(0))).head()[0])) if with_total else out


def with_prefix_sums(df: DataFrame, order: OrderSpec, weights: dict[str, Column]) -> DataFrame:
    """For each ``name -> weight``, add column ``name`` = sum of the weight
    over all rows strictly before the row in the global order (exclusive
    running sums), computed partition-parallel in one sort."""
    table, offsets = _numbered_table(df, _norm(order), dict(weights))
    return _with_offsets(table, offsets, {k: k for k in weights}, 0)


def with_prefix_sum(
    df: DataFrame, order: OrderSpec, weight: Column, name: str = "before"
) -> DataFrame:
    """Exclusive running sum of one weight over the global order."""
    return with_prefix_sums(df, order, {name: weight})


def _key_join(df: DataFrame, keyed: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Null-safe equi-join of ``df`` with ``keyed`` whose key columns are named
    ``_k0.._kn``; the helper columns are dropped afterwards."""
    cond = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    out = df.join(keyed, cond, how)
    return out.drop(*[f"_k{i}" for i in range(len(keys))])


def with_global_rank(
    df: DataFrame, order: OrderSpec, name: str = "rank", dense: bool = False, with_max: bool = False
):
    """``rank()`` / ``dense_rank()`` over a global order.

    Rows are first combined to distinct keys with their counts (partial
    aggregation), the keys are numbered with a weighted prefix sum
    (rank = 1 + rows before), and the rank is joined back on the key.  With
    ``with_max`` the largest rank (read from the small key table) is returned
    too (None for an empty input)."""
    order = _norm(order)
    keys = [b.col for b in order]
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    weight = F.lit(1) if dense else F.col("_n")
    ranked = with_prefix_sum(counted, order, weight, "_before")
    ranked = ranked.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        (F.col("_before") + 1).cast("long").alias(name),
    )
    out = _key_join(df, ranked, keys)
    if with_max:
        return out, ranked.agg(F.max(name)).first()[0]
    return out


def _runs(order: list[By]) -> list[list[By]]:
    runs: list[list[By]] = []
    for b in order:
        if runs and runs[-1][0].desc == b.desc:
            runs[-1].append(b)
        else:
            runs.append([b])
    return runs


def _extreme_struct(run: list[By], extra: Sequence[str] = ()) -> tuple[Column, list[str]]:
    """Struct whose max (desc run) or min (asc run) is the first row in the
    run's order.  Non-default null placement gets an ``isNull`` indicator."""
    fields, names = [], []
    for j, b in enumerate(run):
        if not b.default_nulls:
            fields.append(F.col(b.col).isNull().alias(f"_n{j}"))
        fields.append(F.col(b.col).alias(f"_o{j}"))
        names.append(f"_o{j}")
    for c in extra:
        fields.append(F.col(c).alias(c))
    agg = F.max if run[0].desc else F.min
    return agg(F.struct(*fields)), names


def top1_rank(
    df: DataFrame, group: Sequence[str], order: OrderSpec, name: str | None = "rn"
) -> DataFrame:
    """Rows with ``rank() over (partition by group order by order) = 1``;
    ties on the order keys are all kept, as ``rank`` does."""
    order = _norm(order)
    group = list(group)
    survivors = df
    for run in _runs(order):
        best_struct, names = _extreme_struct(run)
        best = survivors.groupBy(*group).agg(best_struct.alias("_best"))
        keys = group + [b.col for b in run]
        best = best.select(
            *[F.col(g).alias(f"_k{i}") for i, g in enumerate(group)],
            *[
                F.col(f"_best.{n}").alias(f"_k{len(group) + j}")
                for j, n in enumerate(names)
            ],
        )
        survivors = _key_join(survivors, best, keys)
    if name:
        survivors = survivors.withColumn(name, F.lit(1).cast("long"))
    return survivors


def distinct_on(df: DataFrame, keys: Sequence[str], order: OrderSpec) -> DataFrame:
    """``SELECT DISTINCT ON (keys) * ... ORDER BY keys, order``: one row per key.

    Ties left by ``order`` are broken by the remaining columns (ascending for an
    ascending order, descending for a descending one) so the pick is
    deterministic.  A uniform order is a single partial aggregation."""
    order = _norm(order)
    keys = list(keys)
    columns = df.columns
    order_cols = [b.col for b in order]
    rest = [c for c in columns if c not in keys and c not in order_cols]
    runs = _runs(order)
    if len(runs) == 1:
        best_struct, names = _extreme_struct(runs[0], extra=rest)
        out = df.groupBy(*keys).agg(best_struct.alias("_r"))
        rename = {f"_o{j}": b.col for j, b in enumerate(order)}
        return out.select(
            *keys,
            *[F.col(f"_r.{n}").alias(rename[n]) for n in names],
            *[F.col(f"_r.{c}").alias(c) for c in rest],
        ).select(*columns)
    tops = top1_rank(df, keys, order, name=None)
    out = tops.groupBy(*keys).agg(F.max(F.struct(*[F.col(c) for c in columns if c not in keys])).alias("_r"))
    return out.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in columns if c not in keys]).select(*columns)
