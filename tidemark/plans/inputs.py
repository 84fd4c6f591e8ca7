"""Test tables -> job inputs, each with its DuckDB twin (a CTE body).

The Spark function and the SQL text below it define the same relation; the
SQL twins are spliced into the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.time import epoch_micros, epoch_seconds, ntz_literal
from tidemark.sources.tables import table

# ------------------------------------------------------------ J2 clicks
CHANNEL_OF_EVENT = {"view": 0, "click": 1, "purchase": 2}


def clicks(spark: SparkSession, sf: str) -> DataFrame:
    """prospect = user; registration = the user's last signup (its value is
    the conversion value); clicks = view/click/purchase up to registration."""
    ev = table(spark, sf, "events")
    signups = (
        ev.filter(F.col("event_type") == "signup")
        .groupBy("user_id")
        .agg(
            F.max("ts").alias("registration_date"),
            F.max_by("value", F.struct("ts", "event_id")).alias("conversion_value"),
        )
    )
    channel = None
    for name, code in CHANNEL_OF_EVENT.items():
        channel = (F.when if channel is None else channel.when)(F.col("event_type") == name, F.lit(code))
    touches = ev.filter(F.col("event_type").isin(*CHANNEL_OF_EVENT))
    return touches.join(signups, "user_id").filter(F.col("ts") <= F.col("registration_date")).select(
        F.col("user_id").alias("prospect_id"),
        "event_id",
        epoch_seconds(F.col("ts")).alias("event_timestamp"),
        "registration_date",
        channel.alias("channel_coeff"),
        F.col("conversion_value").alias("value"),
    )


CLICKS_SQL = """
signups AS (
  SELECT user_id, max(ts) AS registration_date, arg_max(value, ts) AS conversion_value
  FROM events WHERE event_type = 'signup' GROUP BY user_id),
clicks AS (
  SELECT e.user_id AS prospect_id, e.event_id,
         CAST(epoch_us(e.ts) // 1000000 AS BIGINT) AS event_timestamp,
         s.registration_date,
         CAST(CASE e.event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'purchase' THEN 2 END AS INTEGER)
           AS channel_coeff,
         s.conversion_value AS value
  FROM events e JOIN signups s ON e.user_id = s.user_id
  WHERE e.event_type IN ('view', 'click', 'purchase') AND e.ts <= s.registration_date)
"""


# ------------------------------------------------------------ J3 calls
PHONE_FORMAT = "%05d"


def calls(spark: SparkSession, sf: str) -> DataFrame:
    """phone_from = user, phone_to = props.k mod 20 (zero-padded text),
    call_start = created = ts, duration = value truncated to whole seconds."""
    ev = table(spark, sf, "events")
    k = F.get_json_object(F.col("props"), "$.k").cast("long")
    return ev.select(
        F.col("event_id").alias("call_id"),
        F.format_string(PHONE_FORMAT, F.col("user_id")).alias("phone_from"),
        F.format_string(PHONE_FORMAT, k % 20).alias("phone_to"),
        F.col("ts").alias("call_start"),
        F.col("ts").alias("created"),
        F.col("value").cast("int").alias("duration"),
    )


CALLS_SQL = """
calls AS (
  SELECT event_id AS call_id,
         printf('%05d', user_id) AS phone_from,
         printf('%05d', CAST(json_extract_string(props, '$.k') AS BIGINT) % 20) AS phone_to,
         ts AS call_start, ts AS created,
         CAST(trunc(value) AS INTEGER) AS duration
  FROM events)
"""


# ------------------------------------------------------------ J5 / J6
def classifier_input(spark: SparkSession, sf: str) -> DataFrame:
    """y = quality label; model 1 predicts long documents (>= 300 chars),
    model 2 predicts English ones."""
    lab = table(spark, sf, "labels")
    doc = table(spark, sf, "documents").select("doc_id", "n_chars", "lang")
    return lab.join(doc, "doc_id").select(
        F.col("quality").alias("y_true"),
        (F.col("n_chars") >= 300).cast("int").alias("y_pred1"),
        (F.col("lang") == "en").cast("int").alias("y_pred2"),
    )


CLASSIFIER_SQL = """
scored AS (
  SELECT l.quality AS y_true,
         CAST(d.n_chars >= 300 AS INTEGER) AS y_pred1,
         CAST(d.lang = 'en' AS INTEGER) AS y_pred2
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)
"""


def scores(spark: SparkSession, sf: str) -> DataFrame:
    lab = table(spark, sf, "labels")
    doc = table(spark, sf, "documents").select("doc_id", "n_chars")
    return lab.join(doc, "doc_id").select(
        "doc_id", F.col("n_chars").cast("double").alias("predict"), F.col("quality").alias("target")
    )


SCORES_SQL = """
scores AS (
  SELECT l.doc_id, CAST(d.n_chars AS DOUBLE) AS predict, l.quality AS target
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)
"""


# ------------------------------------------------------------ J8 users
def paying_users(spark: SparkSession, sf: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Every customer with the count and value of their orders; ``start`` and
    ``end`` (exclusive) bound the order time, by default all orders count."""
    cust = table(spark, sf, "customer").select("c_custkey")
    od = table(spark, sf, "orders")
    if start is not None:
        od = od.filter(F.col("o_orderdate") >= ntz_literal(start))
    if end is not None:
        od = od.filter(F.col("o_orderdate") < ntz_literal(end))
    per = od.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"), F.sum("o_totalprice").alias("revenue"))
    return cust.join(per, cust.c_custkey == per.o_custkey, "left").select(
        F.col("c_custkey").alias("user_id"),
        F.coalesce(F.col("orders"), F.lit(0)).alias("orders"),
        F.coalesce(F.col("revenue"), F.lit(0.0)).alias("revenue"),
    )


USERS_SQL = """
per AS (
  SELECT o_custkey, count(*) AS orders, sum(o_totalprice) AS revenue FROM orders GROUP BY o_custkey),
users AS (
  SELECT c.c_custkey AS user_id, coalesce(p.orders, 0) AS orders, coalesce(p.revenue, 0.0) AS revenue
  FROM customer c LEFT JOIN per p ON c.c_custkey = p.o_custkey)
"""


# ------------------------------------------------------------ J9 campaigns
def campaigns(spark: SparkSession, sf: str) -> DataFrame:
    """source = region, medium = nation, campaign = market segment,
    ad group = nation key + segment, ad = customer; position = customer key."""
    cust = table(spark, sf, "customer")
    nat = table(spark, sf, "nation")
    reg = table(spark, sf, "region")
    return (
        cust.join(nat, cust.c_nationkey == nat.n_nationkey)
        .join(reg, nat.n_regionkey == reg.r_regionkey)
        .select(
            F.col("c_custkey").alias("pos"),
            F.col("r_name").alias("source"),
            F.col("n_name").alias("medium"),
            F.col("c_mktsegment").alias("campaign"),
            F.concat_ws("_", F.col("c_nationkey").cast("string"), F.col("c_mktsegment")).alias("ad_group_id"),
            F.col("c_custkey").cast("string").alias("ad_id"),
        )
    )


CAMPAIGNS_SQL = """
campaigns AS (
  SELECT c.c_custkey AS pos, r.r_name AS source, n.n_name AS medium, c.c_mktsegment AS campaign,
         CAST(c.c_nationkey AS VARCHAR) || '_' || c.c_mktsegment AS ad_group_id,
         CAST(c.c_custkey AS VARCHAR) AS ad_id
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)
"""


# ------------------------------------------------------------ J12 clients
def payload_clients(spark: SparkSession, sf: str) -> DataFrame:
    """One row per client: its last event type and its number of events."""
    ev = table(spark, sf, "events")
    return ev.groupBy("user_id").agg(
        F.max_by("event_type", F.struct("ts", "event_id")).alias("param_name_1"),
        F.count(F.lit(1)).alias("param_name_2"),
    ).select(
        F.concat(F.lit("c"), F.col("user_id").cast("string")).alias("client_id"), "param_name_1", "param_name_2"
    )


CLIENTS_SQL = """
clients AS (
  SELECT 'c' || CAST(user_id AS VARCHAR) AS client_id,
         arg_max(event_type, ts) AS param_name_1, count(*) AS param_name_2
  FROM events GROUP BY user_id)
"""


# ------------------------------------------------------------ J1 identity events
def identity_events(spark: SparkSession, sf: str, start=None, end=None) -> DataFrame:
    """The event stream in the shape of a web-analytics export:
    user_id = 'u<id>' on signup/purchase, 'undefined' on error, '' otherwise;
    client (user_pseudo_id) = 'c<id>_<event_id mod 3>', 'undefined' for one
    event in 97; fingerprint = '' for one event in 11, a household value
    'fh<id div 2>' when props.k = 7, else 'f<id>_<k mod 3>'; params = props.

    ``start``/``end`` (dates, inclusive) become a range predicate on the raw
    timestamp, which reaches the parquet scan."""
    ev = table(spark, sf, "events")
    if start is not None:
        import datetime as _dt

        lo = _dt.datetime.combine(start, _dt.time())
        hi = _dt.datetime.combine(end + _dt.timedelta(days=1), _dt.time())
        ev = ev.filter((F.col("ts") >= ntz_literal(lo)) & (F.col("ts") < ntz_literal(hi)))
    k = F.get_json_object(F.col("props"), "$.k").cast("long")
    uid = F.col("user_id").cast("string")
    et = F.col("event_type")
    return ev.select(
        F.to_date("ts").alias("event_date"),
        epoch_micros(F.col("ts")).alias("event_timestamp"),
        et.alias("event_name"),
        F.when(et.isin("signup", "purchase"), F.concat(F.lit("u"), uid))
        .when(et == "error", F.lit("undefined"))
        .otherwise(F.lit(""))
        .alias("user_id"),
        F.when(F.col("event_id") % 97 == 0, F.lit("undefined"))
        .otherwise(F.concat(F.lit("c"), uid, F.lit("_"), (F.col("event_id") % 3).cast("string")))
        .alias("user_pseudo_id"),
        F.when(F.col("event_id") % 11 == 0, F.lit(""))
        .when(k == 7, F.concat(F.lit("fh"), F.floor(F.col("user_id") / 2).cast("long").cast("string")))
        .otherwise(F.concat(F.lit("f"), uid, F.lit("_"), (k % 3).cast("string")))
        .alias("fingerprint"),
        F.map_entries(F.from_json(F.col("props"), "map<string,string>")).alias("event_params"),
    )
