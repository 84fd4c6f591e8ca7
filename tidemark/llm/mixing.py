"""Mixing sources to target weights by hierarchical budgeting (DataFrame only).

Sources form a tree domain > language > source.  A token budget is handed down the
tree: at every node it is shared among the children by weight, but no child gets
more than its subtree can supply in ``max_epochs`` passes; what a child lacks goes
to its siblings, again by weight, and only what all of them lack is a shortage of
the node itself, which its own siblings make up a level higher.  Because capacities
are summed up the tree first, one pass from the root down does this.

Sharing is exact in integers: children are ordered by capacity per weight, and
those below the water level are filled; a window over the children of one node
does it, on the table of leaves (one row per source, never per document).

Within a leaf, epoch e visits the documents in the order of
``md5(seed:e:doc_id)``.  A leaf's budget is that many whole epochs and a prefix of
the next: documents in order as long as their tokens fit.  The prefix is found in
two steps, so that a leaf with a third of all rows needs no window over its rows:
tokens are summed per first three digits of the order, whole steps below the
budget are taken, and only rows of the one step that crosses it are ranked.

Tokens are words (runs of characters other than white space).

Defined results: a null text has no tokens; a null language or source is the value
``(none)``; documents without tokens are taken while their place in the order lies
within the budget; equal orders (repeated or null ids) go by text hash, and rows
equal in both are taken or left together; a budget beyond all supply takes
everything ``max_epochs`` times; weights default to 1, a weight of 0 takes nothing;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import WORD_CLASS, materialise, own_names, text_of

SEED = 20240501
STEP_DIGITS = 3
NONE = "(none)"
LEVELS = ("domain", "lang", "source")
#: Target weights of the registered query (whole numbers; 1 where not named).
WEIGHTS = {
    "domain": {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1},
    "lang": {"en": 5, "de": 2, "fr": 2, "es": 1},
    "source": {"src0": 2},
}
#: Budget as a share of the tokens there are, in hundredths.
BUDGET_PERCENT = 80
#: Passes over a source at most: short ones are repeated to reach their weight.
MAX_EPOCHS = 4


def domain_of(source: Column) -> Column:
    """The domain of a source where documents have none: one of four, by hash."""
    digit = F.conv(F.substring(F.md5(source), 1, 1), 16, 10).cast("int")
    return F.concat(F.lit("domain"), F.floor(digit / 4).cast("int").cast("string"))


def weight_of(level: str, weights: dict[str, dict[str, int]]) -> Column:
    known = weights.get(level, {})
    if any(not isinstance(w, int) or w < 0 for w in known.values()):
        raise ValueError("weights are whole numbers, 0 or more")
    if not known:
        return F.lit(1)
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(known.items())])
    return F.coalesce(F.try_element_at(table, F.col(level)), F.lit(1))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, domain, lang, source, n_tokens of every row."""
    text = text_of(text_col)
    source = F.coalesce(F.col("source").cast("string"), F.lit(NONE))
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(text).alias("text_hash"),
        domain_of(source).alias("domain"),
        F.coalesce(F.col("lang").cast("string"), F.lit(NONE)).alias("lang"),
        source.alias("source"),
        F.regexp_count(text, F.lit(WORD_CLASS)).cast("long").alias("n_tokens"),
    )


def _share(children: DataFrame, parent: list[str], level: str, weights: dict, budget: Column) -> DataFrame:
    """Adds ``given``: the part of ``budget`` (that of the parent) for each child
    (with its capacity ``cap``).  All products are whole numbers of 38 digits."""
    d = "decimal(18,0)"
    df = children.withColumn("w", weight_of(level, weights).cast(d)).withColumn("cap", F.col("cap").cast(d))
    df = df.withColumn("budget", budget.cast(d)).withColumn("usable", F.when(F.col("w") > 0, F.col("cap")).otherwise(F.lit(0).cast(d)))
    if not parent:
        df = df.withColumn("_top", F.lit(0))
        parent = ["_top"]
    by_fill = F.when(F.col("w") > 0, F.col("usable").cast("double") / F.col("w").cast("double")).otherwise(F.lit(-1.0))
    whole = Window.partitionBy(*parent)
    before = whole.orderBy(by_fill, level).rowsBetween(Window.unboundedPreceding, -1)
    df = (
        df.withColumn("c0", F.coalesce(F.sum("usable").over(before), F.lit(0)).cast(d))
        .withColumn("w0", F.coalesce(F.sum("w").over(before), F.lit(0)).cast(d))
        .withColumn("w_all", F.sum("w").over(whole).cast(d))
    )
    rest, rest_w = (F.col("budget") - F.col("c0")).cast(d), (F.col("w_all") - F.col("w0")).cast(d)
    # filled: its capacity lies below its share of what is left at its turn
    df = df.withColumn("full", (F.col("w") == 0) | ((F.col("usable") * rest_w) <= (F.col("w") * rest)))
    # the level of the others: what is left after the filled ones
    df = df.withColumn("c_full", F.sum(F.when(F.col("full"), F.col("usable")).otherwise(F.lit(0).cast(d))).over(whole).cast(d))
    df = df.withColumn("w_open", F.sum(F.when(F.col("full"), F.lit(0).cast(d)).otherwise(F.col("w"))).over(whole).cast(d))
    left = F.greatest((F.col("budget") - F.col("c_full")).cast(d), F.lit(0).cast(d))
    df = df.withColumn("share", (F.col("w") * left).cast("decimal(37,0)"))
    given = F.when(F.col("full"), F.col("usable").cast("long")).otherwise(F.expr("share div w_open"))
    return df.withColumn("given", given).drop("w", "budget", "usable", "c0", "w0", "w_all", "full", "c_full", "w_open", "share", "_top")


def budgets(leaves: DataFrame, weights: dict, budget_tokens: int, max_epochs: int) -> DataFrame:
    """domain, lang, source, supply, given for every leaf (leaves: ... supply)."""
    leaves = leaves.withColumn("cap", F.col("supply") * F.lit(max_epochs))
    given = None
    for depth, level in enumerate(LEVELS):
        path = list(LEVELS[: depth + 1])
        nodes = leaves.groupBy(*path).agg(F.sum("cap").alias("cap"))
        if given is None:
            shared = _share(nodes, [], level, weights, F.lit(budget_tokens))
        else:
            shared = _share(nodes.join(given, path[:-1]), path[:-1], level, weights, F.col("parent_given"))
        given = shared.select(*path, F.col("given").alias("parent_given"))
    return leaves.join(given.withColumnRenamed("parent_given", "given"), list(LEVELS)).drop("cap")


def mix(
    docs: DataFrame,
    weights: dict[str, dict[str, int]] = WEIGHTS,
    budget_percent: int = BUDGET_PERCENT,
    budget_tokens: int | None = None,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document that is taken: doc_id, domain, lang, source, n_tokens,
    copies (how often) and text_hash.  The narrow measures are written once."""
    rows = materialise(measured(docs, id_col, text_col), "mixing-rows")
    leaf = list(LEVELS)
    leaves = rows.groupBy(*leaf).agg(F.sum("n_tokens").alias("supply"))
    if budget_tokens is None:
        budget_tokens = (leaves.agg(F.sum("supply")).head()[0] or 0) * budget_percent // 100
    plan = materialise(
        budgets(leaves, weights, budget_tokens, max_epochs)
        .withColumn("epochs", F.when(F.col("supply") > 0, F.expr("given div supply")).otherwise(0).cast("long"))
        .withColumn("rest", F.col("given") - F.col("epochs") * F.col("supply")),
        "mixing-budgets",
    )
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epochs").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    placed = rows.join(plan, leaf).withColumn("order", order).withColumn("step", F.substring("order", 1, STEP_DIGITS))
    steps = placed.groupBy(*leaf, "step", "rest").agg(F.sum("n_tokens").alias("tokens"))
    so_far = Window.partitionBy(*leaf).orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    steps = (
        steps.withColumn("upto", F.sum("tokens").over(so_far))
        .withColumn("before", F.col("upto") - F.col("tokens"))
        .select(
            *leaf, "step", "before",
            F.when(F.col("upto") <= F.col("rest"), "whole").when(F.col("before") <= F.col("rest"), "cut").otherwise("none").alias("how"),
        )
    )
    staged = placed.join(steps, [*leaf, "step"])
    keep = [*leaf, "doc_id", "text_hash", "n_tokens", "epochs"]
    whole = staged.filter("how <> 'cut'").withColumn("extra", (F.col("how") == "whole").cast("long"))
    # one step of a leaf at most is cut; equal orders are taken or left together: a range frame
    in_step = Window.partitionBy(*leaf, "step").orderBy("order", "text_hash").rangeBetween(Window.unboundedPreceding, 0)
    end = F.col("before") + F.sum("n_tokens").over(in_step)
    cut = staged.filter("how = 'cut'").withColumn("extra", (end <= F.col("rest")).cast("long"))
    out = whole.select(*keep, "extra").unionByName(cut.select(*keep, "extra"))
    return (
        out.withColumn("copies", F.col("epochs") + F.col("extra"))
        .filter("copies > 0")
        .select("doc_id", *leaf, "n_tokens", "copies", "text_hash")
    )


def reached_shares(docs: DataFrame, taken: DataFrame, weights: dict[str, dict[str, int]] = WEIGHTS, **columns) -> DataFrame:
    """level, domain, lang, source, target, reached of every node of the tree: its
    part of its parent by weight, and of the tokens that ``taken`` (of ``mix``) has
    of the parent."""
    leaf = list(LEVELS)
    got = taken.groupBy(*leaf).agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"))
    leaves = measured(docs, **columns).select(*leaf).distinct().join(got, leaf, "left").fillna(0, ["tokens"])
    out = None
    for depth, level in enumerate(LEVELS):
        path = leaf[: depth + 1]
        nodes = leaves.groupBy(*path).agg(F.sum("tokens").alias("tokens")).withColumn("w", weight_of(level, weights))
        whole = Window.partitionBy(*path[:-1]) if depth else Window.partitionBy(F.lit(0))
        names = [F.col(c) if c in path else F.lit(None).cast("string").alias(c) for c in leaf]
        parts = [F.try_divide(F.col(c), F.sum(c).over(whole)).alias(n) for c, n in (("w", "target"), ("tokens", "reached"))]
        nodes = nodes.select(F.lit(level).alias("level"), *names, *parts)
        out = nodes if out is None else out.unionByName(nodes)
    return out


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that the mixture takes, each as often as it is taken;
    columns unchanged."""
    k_id, k_h, k_l, k_s, k_n, k_pass, h = own_names(docs, "k_id", "k_h", "k_l", "k_s", "k_n", "k_pass", "d_h")
    taken = mix(docs, id_col=id_col, text_col=text_col, **options).groupBy(
        F.col("doc_id").alias(k_id), F.col("text_hash").alias(k_h), F.col("lang").alias(k_l), F.col("source").alias(k_s)
    ).agg(F.max("copies").alias(k_n))
    keyed = docs.withColumn(h, F.xxhash64(text_of(text_col)))
    same = keyed[id_col].cast("long").eqNullSafe(F.col(k_id)) & (F.col(h) == F.col(k_h))
    # rows equal in both may be of leaves with other numbers of copies
    for name, key in (("lang", k_l), ("source", k_s)):
        same = same & (F.coalesce(keyed[name].cast("string"), F.lit(NONE)) == F.col(key))
    joined = keyed.join(taken, same)
    if options.get("max_epochs", MAX_EPOCHS) > 1:
        joined = joined.withColumn(k_pass, F.explode(F.sequence(F.lit(1).cast("long"), F.col(k_n))))
    return joined.select(*[docs[c] for c in docs.columns])
