"""Round trips of the sources and sinks: a whole given table is written in the
form to the shared folder and read back by the library.  Building such a frame
runs the writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import text as _text
from tidemark.plans.catalogue import register
from tidemark.plans.queries import _DOC_COLS, _TERMS_SQL, LOAD_AS_OF, LOADED_UNTIL
from tidemark.operators.contacts import ts_literal
from tidemark.session import scratch_path
from tidemark.sources import io as _io
from tidemark.sources import shards as _shards
from tidemark.sources.tables import few_splits, table


# ---------------------------------------------------------------- SRC-3: bad lines
@register(
    "csv_bad_lines",
    """
WITH labelled AS (
  SELECT c_custkey, c_name || chr(10) || 'in "' || c_mktsegment || '", ' || c_nationkey AS label, c_mktsegment FROM customer)
SELECT c_custkey, label, c_mktsegment FROM labelled
UNION ALL SELECT c_custkey, label, NULL FROM labelled
""",
)
def q_csv_bad_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Three records per customer: whole, one field short (kept) and one field
    long (dropped); a field holds separators, doubled quotes and a line end."""
    label = F.concat("c_name", F.lit('\nin ""'), "c_mktsegment", F.lit('"", '), F.col("c_nationkey").cast("string"))
    start = F.concat(F.col("c_custkey").cast("string"), F.lit(',"'), label, F.lit('"'))
    whole = F.concat(start, F.lit(","), "c_mktsegment")
    records = F.array(whole, start, F.concat(whole, F.lit(",")))
    path = scratch_path(spark, "customer-csv")
    table(spark, sf, "customer").select(F.explode(records).alias("value")).write.text(path)
    schema = spark.createDataFrame([], "c_custkey long, label string, c_mktsegment string").schema
    return _io.read_csv_skip_bad_lines(spark, path, schema, header=False, multi_line=True)


# ---------------------------------------------------------------- SRC-4 / SRC-5: other delimiters
@register("tsv_round_trip", "SELECT * FROM orders")
def q_tsv(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    path = scratch_path(spark, "orders-tsv")
    orders.write.option("sep", "\t").option("header", True).csv(path)
    return _io.read_csv_skip_bad_lines(spark, path, orders.schema, sep="\t", multi_line=False)


# ---------------------------------------------------------------- SRC-6: comments without NULLs
@register("csv_comments", "SELECT conv_id, turn, role, text FROM conversations WHERE text IS NOT NULL")
def q_csv_comments(spark: SparkSession, sf: str) -> DataFrame:
    source = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    path = scratch_path(spark, "conversations-csv")
    (
        source.write.option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    read = _io.read_csv_skip_bad_lines(spark, path, source.schema, header=False, multi_line=True)
    return _text.documents(read, "text")


# ---------------------------------------------------------------- SRC-1: wildcard shards
@register(
    "suffix_shards",
    """
SELECT event_id, user_id, event_type, value,
       if(event_type = 'error', 'intraday_', '') || strftime(ts, '%Y%m%d') AS suffix
FROM events
""",
)
def q_suffix_shards(spark: SparkSession, sf: str) -> DataFrame:
    """Every day's shard, some named ``intraday_`` before the day."""
    events = table(spark, sf, "events")
    day = F.date_format("ts", "yyyyMMdd")
    shard = F.when(F.col("event_type") == "error", F.concat(F.lit("intraday_"), day)).otherwise(day)
    root = scratch_path(spark, "event-shards")
    columns = ["event_id", "user_id", "event_type", "value"]
    events.select(*columns, shard.alias("events")).write.partitionBy("events").parquet(root)
    first, last = events.agg(F.to_date(F.min("ts")), F.to_date(F.max("ts"))).head()
    read = _shards.read_suffix_shards(spark, root, "events=", first, last, "suffix")
    return read.select(*columns, "suffix")


# ---------------------------------------------------------------- SNK-1..4
@register("sink_dispositions", "SELECT * FROM orders UNION ALL SELECT * FROM orders")
def q_sinks(spark: SparkSession, sf: str) -> DataFrame:
    """Loaded, loaded anew (the first load goes) and appended once."""
    orders = table(spark, sf, "orders")
    path = scratch_path(spark, "orders-loaded")
    for disposition in ("WRITE_TRUNCATE", "WRITE_TRUNCATE", "WRITE_APPEND"):
        _io.write_table(orders, path, disposition)
    return spark.read.schema(orders.schema).parquet(path)


# ---------------------------------------------------------------- J11b: the window appended
@register(
    "incremental_append",
    """
WITH loaded AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-10')
SELECT * FROM loaded
UNION ALL
SELECT * FROM events
WHERE ts >= (SELECT CAST(CAST(max(ts) AS DATE) + 1 AS TIMESTAMP) FROM loaded) AND ts < TIMESTAMP '2024-01-20'
""",
)
def q_incremental_append(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    path = scratch_path(spark, "events-loaded")
    _io.write_table(events.filter(F.col("ts") < ts_literal(LOADED_UNTIL)), path, "WRITE_TRUNCATE")
    target = spark.read.schema(events.schema).parquet(path)
    _io.write_table(_io.load_window(events, target, "ts", LOAD_AS_OF), path, "WRITE_APPEND")
    return spark.read.schema(events.schema).parquet(path)


# ---------------------------------------------------------------- J10 end to end
@register(
    "csv_ingest_name_value",
    """
SELECT column_name, column_value FROM (
  SELECT 'c_custkey' AS column_name, CAST(c_custkey AS VARCHAR) AS column_value FROM customer
  UNION ALL SELECT 'c_name', c_name FROM customer
  UNION ALL SELECT 'c_mktsegment', c_mktsegment FROM customer)
WHERE column_value IS NOT NULL
""",
)
def q_csv_ingest(spark: SparkSession, sf: str) -> DataFrame:
    source = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    path, loaded, melted = (scratch_path(spark, f"customer-{n}") for n in ("upload", "loaded", "melted"))
    source.write.option("header", True).csv(path)
    _io.ingest_csv(spark, path, source.schema, loaded, name_value_target=melted, multi_line=True)
    return spark.read.parquet(melted)


# ---------------------------------------------------------------- J7a
_RAW_DOCS = "SELECT conv_id, turn, text FROM conversations"
_PLAIN_DOCS = "SELECT conv_id, turn, regexp_replace(lower(text), '[[:punct:]]', ' ', 'g') AS text FROM conversations"


@register(
    "comment_terms_normalised",
    "WITH " + _TERMS_SQL.replace(_RAW_DOCS, _PLAIN_DOCS) + "SELECT conv_id, turn, term, term_count FROM kept",
)
def q_comment_terms_normalised(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations")
    docs = _text.documents(rows, "text", normalise_text=True, partitions=few_splits(rows))
    kept, _ = _text.restricted_counts(docs, _DOC_COLS, "text")
    return kept.select(*_DOC_COLS, "term", "term_count")
