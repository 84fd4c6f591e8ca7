"""URL filters: a list of host and path rules, and association rules for the rest.

*Listed rules* judge the URLs that they fit (a host with its subdomains, a path by its
beginning; the longest rule wins).  They are column expressions, so no join is needed.

*Mined rules* judge the URLs that no listed rule fits.  ``labels`` of the given tables
hold documents, not pages, so the labelled URLs are those that a listed rule judges;
``mine`` takes any labelled table.

1. A URL's tokens are its scheme, host labels (the last one apart), path segments,
   file ending and names of query parameters.  Rows are counted per token and label;
   tokens below the support are left out, as no rule can hold them.
2. Combinations of tokens are grown by one token at a time from all tokens of the rows
   (equal rows are counted once, with their number).  A combination goes on for a label
   while it has the label's support and each of its tokens rules out a row of the other
   label.  Where one rules out none, the combination without it is as confident, and so it
   is for all larger ones: no rule of step 3 is left out, and no row, token or size is cut.
   Tokens that always meet (a long URL that comes often) stay single.
3. Rules that end in a label stay if they reach the support and confidence and are more
   confident than each rule with one token less.
4. Matching by inverted index: a rule is listed under its rarest token.  The distinct
   URLs' tokens are joined with that index, and a candidate fits if the URL holds all
   its tokens.  The most confident rule decides (then support, fewer tokens, order).
   Where none fits, the verdict is the more frequent label (ties and none: allow).

Every row of the labelled URLs is mined.  Numbers that reach the driver: the rows per
label.  Nothing is broadcast but what Spark measures to be small.

Defined results.  A null URL, or one without ``://``, has an empty host and path, no
tokens and the last verdict.  Very long URLs are kept whole; all their tokens count.
Repeated rows and ids each return a row and each count as one in the mining; a null id
stays null.  Other columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise

#: The rules of the list, as (verdict, host, beginning of the path).
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
ALLOW, BLOCK = "allow", "block"
#: Least share of the labelled rows (and least rows) with a rule's tokens and label.
SUPPORT, LEAST_ROWS = 0.002, 5
CONFIDENCE = 0.7


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; empty without ``://``."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    whole = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(whole, parts, 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(whole, parts, 2)


def listed(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (host and path of the rule, else null) and its verdict."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, decision).otherwise(verdict)
    return name, verdict


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """The distinct tokens of a URL, in order of the alphabet."""
    labels = F.split(host, r"\.")
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    query = F.split(F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1), "&")
    names = F.filter(F.transform(query, lambda q: F.regexp_extract(q, r"(?s)^([^=]*)", 1)), lambda n: n != "")
    scheme = F.regexp_extract(url, r"^([^/?#]*?)://", 1)
    ending = F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1)

    def named(kind: str, values: Column) -> Column:
        return F.transform(values, lambda v: F.concat(F.lit(kind + ":"), v))

    found = F.concat(
        named("host", F.slice(labels, 1, F.greatest(F.size(labels) - 1, F.lit(0)))),
        named("last", F.slice(labels, -1, 1)),
        named("path", segments),
        named("query", names),
        named("scheme", F.array(scheme)),
        named("ending", F.filter(F.array(ending), lambda e: e != "")),
    )
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_sort(F.array_distinct(found)))


def _transactions(labelled: DataFrame, stats: DataFrame) -> DataFrame:
    """(items, n, n_block): the sets of supported tokens that rows hold, in order of the
    alphabet, with their rows."""
    supported = (
        labelled.select("row", "verdict", F.explode("tokens").alias("token"))
        .join(stats.select("token"), "token")
        .groupBy("row", "verdict")
        .agg(F.array_sort(F.collect_list("token")).alias("items"))
    )
    return supported.groupBy("items").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("verdict") == BLOCK).alias("n_block")
    )


def _grown(transactions: DataFrame, least_rows: int) -> list[DataFrame]:
    """Per size, the combinations (tokens, n, n_block) that can be a rule, and for which
    label (``allow``, ``block``)."""

    def longer(held: DataFrame) -> DataFrame:
        """Each occurrence with one more of the row's later tokens."""
        more = held.select("n", "n_block", "tokens", "rest", F.posexplode("rest").alias("at", "token"))
        return more.select(
            "n", "n_block", F.concat("tokens", F.array("token")).alias("tokens"),
            F.expr("slice(rest, at + 2, size(rest))").alias("rest"),
        )

    held = transactions.select("n", "n_block", F.array().cast("array<string>").alias("tokens"), F.col("items").alias("rest"))
    levels: list[DataFrame] = []
    while True:
        held = materialise(longer(held), "occurrences")
        found = held.groupBy("tokens").agg(F.sum("n").alias("n"), F.sum("n_block").alias("n_block"))
        supported = {"allow": F.col("n") - F.col("n_block") >= least_rows, "block": F.col("n_block") >= least_rows}
        found = found.withColumns(supported).filter("allow OR block")
        if levels:
            less = levels[-1].select(
                F.col("tokens").alias("less"), F.col("n").alias("_n"), F.col("n_block").alias("_b"),
                F.col("allow").alias("_allow"), F.col("block").alias("_block"),
            )
            found = (
                found.withColumn("less", F.explode(F.transform("tokens", lambda x: F.array_remove("tokens", x))))
                .join(less, "less")
                .groupBy("tokens", "n", "n_block")
                .agg(
                    (F.count_if(F.expr("allow AND _allow AND n_block < _b")) == F.size("tokens")).alias("allow"),
                    (F.count_if(F.expr("block AND _block AND n - n_block < _n - _b")) == F.size("tokens")).alias("block"),
                )
                .filter("allow OR block")
            )
        levels.append(materialise(found, "combinations"))
        going = levels[-1].filter("(allow AND n_block > 0) OR (block AND n_block < n)").select("tokens")
        if going.isEmpty():
            return levels
        held = held.join(going, "tokens").filter(F.size("rest") > 0)


def mine(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, least_rows: int = LEAST_ROWS):
    """Rules (tokens, verdict, confidence, support, token: the rarest) from rows with
    ``tokens`` and a ``verdict``, and the verdict where no rule fits."""
    spark = labelled.sparkSession
    labelled = materialise(
        labelled.select("tokens", "verdict", F.monotonically_increasing_id().alias("row")), "labelled-urls"
    )
    n, blocked = labelled.agg(F.count(F.lit(1)), F.count_if(F.col("verdict") == BLOCK)).head()
    none = spark.createDataFrame([], "tokens array<string>, verdict string, confidence double, support double, token string")
    if not n:
        return none, ALLOW
    stats = (
        labelled.select("verdict", F.explode("tokens").alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("verdict") == BLOCK).alias("n_block"))
    )
    least = max(support, least_rows / n)
    stats = materialise(stats.filter(F.col("n") >= least * n), "token-counts")
    transactions = materialise(_transactions(labelled, stats), "transactions")
    rows = transactions.agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]
    combinations = reduce(DataFrame.unionByName, _grown(transactions, math.ceil(min(least, 1.0) * rows)))
    sides = F.array(
        F.struct(F.lit(ALLOW).alias("verdict"), F.col("allow").alias("is_rule"), (F.col("n") - F.col("n_block")).alias("right")),
        F.struct(F.lit(BLOCK).alias("verdict"), F.col("block").alias("is_rule"), F.col("n_block").alias("right")),
    )
    rules = (
        combinations.select("tokens", "n", F.inline(sides))
        .filter("is_rule")
        .select("tokens", "verdict", (F.col("right") / F.col("n")).alias("confidence"), (F.col("right") / F.lit(rows)).alias("support"))
        .filter(F.col("confidence") >= confidence)
    )
    rules = materialise(_telling(materialise(rules, "rules")), "telling-rules")
    rarest = (
        rules.select("tokens", "verdict", F.explode("tokens").alias("token"))
        .join(stats.select("token", "n"), "token")
        .groupBy("tokens", "verdict")
        .agg(F.min(F.struct("n", "token")).alias("least"))
        .select(F.col("tokens").alias("_t"), F.col("verdict").alias("_v"), F.col("least.token").alias("token"))
    )
    indexed = rules.join(rarest, (F.col("tokens") == F.col("_t")) & (F.col("verdict") == F.col("_v"))).drop("_t", "_v")
    return materialise(indexed, "rule-index"), BLOCK if 2 * blocked > n else ALLOW


def _telling(rules: DataFrame) -> DataFrame:
    """Rules more confident than each rule of one token less with their verdict."""
    shorter = rules.select(
        F.col("tokens").alias("_t"), F.col("verdict").alias("_v"),
        F.explode(F.transform("tokens", lambda x: F.array_remove("tokens", x))).alias("less"),
    )
    general = rules.select(F.col("tokens").alias("less"), F.col("verdict").alias("_v"), F.col("confidence").alias("c"))
    best = shorter.join(general, ["less", "_v"]).groupBy("_t", "_v").agg(F.max("c").alias("general"))
    joined = rules.join(best, (F.col("tokens") == F.col("_t")) & (F.col("verdict") == F.col("_v")), "left")
    return joined.filter(F.col("general").isNull() | (F.col("confidence") > F.col("general"))).drop("_t", "_v", "general")


def match(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, verdict, because, confidence) of the URLs (url, tokens) that a rule fits."""
    index = rules.select(
        "token", F.col("tokens").alias("because"), F.col("verdict").alias("mined"), "confidence", "support"
    )
    candidates = urls.select("url", "tokens", F.explode("tokens").alias("token")).join(index, "token")
    fitting = candidates.filter(F.size(F.array_except("because", "tokens")) == 0)
    order = F.struct(-F.col("confidence"), -F.col("support"), F.size("because"), "because", "mined")
    best = fitting.groupBy("url").agg(
        F.min_by(F.struct("mined", "because", "confidence"), order).alias("best")
    )
    return best.select("url", "best.*")


def judge(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict of every row, and the tokens (because) and
    confidence of the mined rule that decided, if one did."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    rows = rows.withColumns({"host": host, "path": path})
    rule, verdict = listed(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "given": verdict})
    tokens = url_tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens")
    mined, otherwise = mine(rows.filter("given is not null").select(tokens, F.col("given").alias("verdict")))
    open_urls = rows.filter("given is null and host <> ''").select("url", "host", "path").distinct()
    found = match(open_urls.select("url", tokens), mined)
    joined = rows.join(found.withColumnRenamed("url", "_url"), F.col("given").isNull() & (F.col("url") == F.col("_url")), "left")
    return joined.select(
        "page_id", "host", "path", "rule",
        F.coalesce("given", "mined", F.lit(otherwise)).alias("verdict"),
        "because", "confidence",
    )
