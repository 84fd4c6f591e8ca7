"""J5 classifier metrics, J6 decile recall table, J8 product metrics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordering import By, with_row_number
from tidemark.session import materialise

# Verdict texts of the model comparison, spelled as the original.
FIRST_BETTER = "First test better than second"
SECOND_BETTER = "Second test better then first"
EQUAL = "Tests are equals"


def _ratio0(num, den):
    """num / den with a zero (or NULL) denominator giving 0, as the metric
    library does (the hand-written form would give NaN)."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def model_metrics(df: DataFrame, y_true: str, predictions: Sequence[str]) -> DataFrame:
    """Confusion matrix (tn, fp, fn, tp), precision, recall and F1 per model.

    The prediction columns are unpivoted so all models share one scan and one
    aggregation (partial, map-side)."""
    long = df.select(y_true, *predictions).unpivot(
        [y_true], list(predictions), "model", "y_pred"
    )
    y, p = F.col(y_true), F.col("y_pred")
    counts = long.groupBy("model").agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    out = counts.withColumns(
        {"precision": _ratio0(tp, tp + fp), "recall": _ratio0(tp, tp + fn)}
    )
    pr, rc = F.col("precision"), F.col("recall")
    return out.withColumn("f1", _ratio0(F.lit(2.0) * pr * rc, pr + rc))


def model_compare(metrics: DataFrame, first: str, second: str) -> DataFrame:
    """One row: both F1 scores and the verdict text."""
    f1 = metrics.groupBy().agg(
        F.max(F.when(F.col("model") == first, F.col("f1"))).alias("f1_first"),
        F.max(F.when(F.col("model") == second, F.col("f1"))).alias("f1_second"),
    )
    a, b = F.col("f1_first"), F.col("f1_second")
    return f1.withColumn(
        "verdict",
        F.when(a > b, F.lit(FIRST_BETTER)).when(a < b, F.lit(SECOND_BETTER)).when(a == b, F.lit(EQUAL)),
    )


#: Half the width of the score range taken around each decile border, as a share of the rows.
AROUND = 0.002


def recall_by_bucket(df: DataFrame, score: str, target: str, tie: str) -> DataFrame:
    """Decile table with cumulative recall.

    Rows are numbered 0.. in descending score (NaN/NULL last, ``tie`` breaks
    ties); bucket = floor(id / (0.1 * (n - 1) + 1)) with a double 0.1, i.e. the
    10% linear-interpolation quantile of the index.

    Only rows near a border are sorted: a quantile sketch proposes a narrow score
    range around each border, one grouped pass counts the rows between all range
    ends exactly, and a range whose first and last row fall into one bucket is
    summed up whole.  The rest, those that hold a border, are numbered by a
    partition-parallel sort.  The sketch decides how many rows are sorted, never
    a result: a poor one makes more ranges hold a border.  At most 22 ranges come
    to the driver; the result has at most 11 rows, so the final running sum runs
    on a bounded input."""
    clean = df.withColumn(score, F.when(F.isnan(F.col(score)), None).otherwise(F.col(score)))
    ranked = clean.withColumn("_range", _score_range(clean, score))
    measures = [
        F.count(F.lit(1)).alias("total"),
        F.sum(F.col(target)).cast("long").alias("sum_of_target"),
        F.min(score).alias("min_of_score"),
        F.max(score).alias("max_of_score"),
    ]
    ranges = materialise(ranked.groupBy("_range").agg(*measures), "score-ranges")
    counts = [(r["_range"], r["total"]) for r in ranges.select("_range", "total").orderBy("_range").collect()]
    width = 0.1 * float(sum(c for _, c in counts) - 1) + 1.0
    whole, shifts, above, numbered = {}, {}, 0, 0
    for number, count in counts:
        first, last = above // width, (above + count - 1) // width
        if first == last:
            whole[number] = int(first)
        else:  # its rows' index among the numbered ones, moved by the rows above it that are not
            shifts[number] = above - numbered
            numbered += count
        above += count

    parts = []
    if whole:
        parts.append(ranges.withColumn("quantile", _by_range(whole)).drop("_range").filter("quantile IS NOT NULL"))
    if shifts:
        near = ranked.filter(F.col("_range").isin(list(shifts)))
        near = with_row_number(near, [By(score, desc=True, nulls_first=False), By(tie)], name="_id", start=0)
        at = (F.col("_id") + _by_range(shifts)) / F.lit(width)
        parts.append(near.withColumn("quantile", F.floor(at).cast("long")).groupBy("quantile").agg(*measures))
    if not parts:
        parts.append(ranges.withColumn("quantile", F.col("_range").cast("long")).drop("_range"))
    buckets = reduce(DataFrame.unionByName, parts).groupBy("quantile").agg(
        F.sum("total").alias("total"),
        F.sum("sum_of_target").alias("sum_of_target"),
        F.min("min_of_score").alias("min_of_score"),
        F.max("max_of_score").alias("max_of_score"),
    )
    w = Window.orderBy("quantile").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy(F.lit(0))
    out = buckets.withColumn("sum_target_percentile", F.sum("sum_of_target").over(w).cast("long"))
    return out.withColumn(
        "recall",
        F.round(
            F.try_divide(F.lit(100.0) * F.col("sum_target_percentile"), F.sum("sum_of_target").over(everything).cast("double")), 2
        ),
    )


def _score_range(df: DataFrame, score: str) -> Column:
    """The number of the range that a row's score is in, in descending order (a null
    score: the last), from range ends beside the decile borders."""
    shares = sorted({k / 10 + side for k in range(1, 10) for side in (-AROUND, AROUND)})
    ends = df.agg(F.percentile_approx(score, shares, 10_000).alias("ends")).head()["ends"] or []
    below = [F.when(F.col(score) < F.lit(end), 1).otherwise(0) for end in sorted(set(ends))]
    return F.when(F.col(score).isNull(), F.lit(len(below) + 1)).otherwise(sum(below, F.lit(0)))


def _by_range(values: dict[int, int]) -> Column:
    """The value of a row's range; null where it has none."""
    return F.coalesce(*[F.when(F.col("_range") == number, F.lit(value).cast("long")) for number, value in values.items()])


def product_metrics(users: DataFrame, orders: str = "orders", revenue: str = "revenue") -> DataFrame:
    """AOV, ARPU, ARPPU and paying share over a per-user table; paying means
    at least one order.  ARPU = ARPPU * paying share."""
    agg = users.agg(
        F.count(F.lit(1)).alias("users"),
        F.count_if(F.col(orders) > 0).alias("paying_users"),
        F.sum(orders).cast("long").alias("orders"),
        F.sum(F.col(revenue).cast("double")).alias("revenue"),
    )
    rev = F.col("revenue")
    return agg.withColumns(
        {
            "aov": F.try_divide(rev, F.col("orders").cast("double")),
            "arpu": F.try_divide(rev, F.col("users").cast("double")),
            "arppu": F.try_divide(rev, F.col("paying_users").cast("double")),
            "paying_share": F.try_divide(F.col("paying_users").cast("double"), F.col("users").cast("double")),
        }
    )
