"""J2: time-decay plus channel attribution of a conversion value to clicks.

Per click of a prospect:

* ``date_difference_click_reg`` = days from click to registration, 0 -> 1;
* ``weight_of_click`` = (sum of the prospect's differences) - own difference,
  0 -> 1, so nearer clicks weigh more and a lone click weighs 1;
* ``weight_of_channel`` from ``channel_coeff`` (fixed table below);
* both weights are normalised within the prospect and the credit is
  ``0.5 * value * channel_coef + 0.5 * value * time_coef`` (NULL value = 0).

All input columns and intermediates are kept (``select *`` in the original).
Division by a zero total gives NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import utc_date_of_epoch_seconds
from tidemark.operators.grouping import join_on_keys
from tidemark.session import materialise

# channel_coeff -> weight_of_channel (others give NULL).
CHANNEL_WEIGHTS = {0: 1.0 / 6.0, 1: 2.0 / 6.0, 2: 3.0 / 6.0}


def _channel_weight(col):
    expr = None
    for code, weight in CHANNEL_WEIGHTS.items():
        expr = (F.when if expr is None else expr.when)(col == code, F.lit(weight))
    return expr


def time_decay(
    clicks: DataFrame,
    prospect: str = "prospect_id",
    event_seconds: str = "event_timestamp",
    registration: str = "registration_date",
    channel: str = "channel_coeff",
    value: str = "value",
) -> DataFrame:
    d = "date_difference_click_reg"
    # the click's UTC date (the original takes DATE() of a timestamp in UTC)
    days = F.datediff(F.to_date(F.col(registration)), utc_date_of_epoch_seconds(F.col(event_seconds)))
    base = clicks.withColumns(
        {
            "weight_of_channel": _channel_weight(F.col(channel)),
            d: F.when(days == 0, F.lit(1)).otherwise(days).cast("long"),
        }
    )
    # read twice, for the totals and for the rows: written once
    base = materialise(base, "clicks")
    # Per-prospect totals without windows and without a second join: first
    # combine clicks per (prospect, day gap) -- map-side partial aggregation,
    # so a prospect holding a third of all clicks shrinks to one row per gap
    # and task -- then gather each prospect's gaps (bounded by the number of
    # distinct day gaps, not by its clicks).  From them: S = sum of gaps,
    # n = clicks with a gap, and c = clicks whose gap equals S (their weight
    # S - d = 0 is forced to 1), so sum of weights = (n - 1) * S + c.
    per_gap = base.groupBy(prospect, d).agg(
        F.count(F.lit(1)).alias("_m"), F.sum("weight_of_channel").alias("_cw")
    )
    per = per_gap.groupBy(prospect).agg(
        F.collect_list(F.struct(F.col(d).alias("d"), F.col("_m").alias("m"))).alias("_gaps"),
        F.sum("_cw").alias("summ_weight_of_channel_clicks"),
    )
    gaps = F.filter(F.col("_gaps"), lambda g: g["d"].isNotNull())
    total = F.aggregate(gaps, F.lit(0).cast("long"), lambda acc, g: acc + g["d"] * g["m"])
    count = F.aggregate(gaps, F.lit(0).cast("long"), lambda acc, g: acc + g["m"])
    totals = per.withColumns(
        {"_s": F.when(F.size(gaps) > 0, total), "_n": count}
    ).withColumn(
        "_c",
        F.aggregate(gaps, F.lit(0).cast("long"), lambda acc, g: acc + F.when(g["d"] == F.col("_s"), g["m"]).otherwise(0)),
    ).withColumn(
        "summ_weight_of_clicks",
        ((F.col("_n") - 1) * F.col("_s") + F.col("_c")).cast("long"),
    ).drop("_gaps")
    out = join_on_keys(base, totals.drop("_n", "_c"), [prospect], "left")
    gap = F.col("_s") - F.col(d)
    value0 = F.coalesce(F.col(value), F.lit(0.0))
    out = out.withColumn(
        "weight_of_click", F.when(gap == 0, F.lit(1)).otherwise(gap).cast("long")
    ).withColumns(
        {
            # try_divide: a zero total gives NULL instead of an error
            "time_coef_click": F.try_divide(
                F.col("weight_of_click").cast("double"), F.col("summ_weight_of_clicks").cast("double")
            ),
            "channel_coef_click": F.try_divide(
                F.col("weight_of_channel"), F.col("summ_weight_of_channel_clicks")
            ),
        }
    ).withColumn(
        "value_click",
        F.lit(0.5) * value0 * F.col("channel_coef_click") + F.lit(0.5) * value0 * F.col("time_coef_click"),
    )
    cols = clicks.columns + [
        "weight_of_channel",
        d,
        "weight_of_click",
        "summ_weight_of_clicks",
        "time_coef_click",
        "summ_weight_of_channel_clicks",
        "channel_coef_click",
        "value_click",
    ]
    return out.select(*cols)
