"""The registered queries of the corpus operators, and SQL twins where SQL can
express them.  Each reads its whole table and runs with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import alignment, byte_bpe, exact_dedup, html_mincut, mixing, pii, quality, sharding, simhash
from tidemark.llm import suffix_dedup, url_rules, whitening, winnowing
from tidemark.llm.common import documents
from tidemark.sources.tables import table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
SHARDS = 24


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir)).drop("spans")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.score_documents(docs, quality.learn_weights(docs, table(spark, sf_dir, "labels")))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(documents(spark, sf_dir), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "version",
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_mincut.extract_pages(table(spark, sf_dir, "pages"))


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.edited_likeness(documents(spark, sf_dir))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).drop("text_hash")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(documents(spark, sf_dir))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in pii.KINDS],
        F.sha2(pii.spans_text(F.col("base")), 256).alias("base_sha256"),
        pii.spans_text(F.col("spans")).alias("spans"),
    )


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return byte_bpe.encode_documents(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return alignment.align_documents(
        documents(spark, sf_dir), public_tokenizers.path(TOKENIZER_A), public_tokenizers.path(TOKENIZER_B)
    )


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_suffix_dedup, op2_quality_classifier, op3_sharding, op4_simhash, op5_html_extraction, op6_winnowing,
        op7_mixing, op8_exact_dedup, op9_pii, op10_byte_bpe, op11_embedding_whitening, op12_tokenizer_alignment,
        op13_url_filters,
    )
}

_EXACT_DEDUP_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS tx,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(tx) DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(tx) DESC, doc_id) AS kept,
       sha256(norm) AS text_sha256
FROM t
"""


def _weights_sql(level: str) -> str:
    cases = " ".join(f"WHEN '{name}' THEN {w}" for name, w in mixing.WEIGHTS.get(level, {}).items())
    return f"CASE {level} {cases} ELSE 1 END" if cases else "1"


def _level_sql(name: str, level: str, path: list[str], parent: str | None) -> str:
    """Shares of one level.  A child is filled if the level at which the water
    stands, were it the last to be filled, covers its capacity."""
    above = path[:-1]
    over = "PARTITION BY " + ", ".join(above) if above else ""
    joined = f"JOIN {parent} USING ({', '.join(above)})" if parent else "CROSS JOIN total"
    budget = "given" if parent else "budget"
    columns = ", ".join(path)
    return f"""
{name}_n AS (
  SELECT n.*, {_weights_sql(level)}::HUGEINT AS w, p.budget FROM
    (SELECT {columns}, sum(cap)::HUGEINT AS cap FROM leaves GROUP BY {columns}) n
    JOIN (SELECT {', '.join(above + [budget + ' AS budget']) } FROM {parent or 'total'}) p
      ON {' AND '.join(f'n.{c} = p.{c}' for c in above) or 'true'}
),
{name}_c AS (
  SELECT *, coalesce(sum(cap) OVER before, 0)::HUGEINT AS c0, coalesce(sum(w) OVER before, 0)::HUGEINT AS w0,
         sum(w) OVER ({over})::HUGEINT AS w_all
  FROM {name}_n
  WINDOW before AS ({over} ORDER BY cap::DOUBLE / w::DOUBLE, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
{name}_f AS (SELECT *, cap * (w_all - w0) <= w * (budget - c0) AS filled FROM {name}_c),
{name}_s AS (
  SELECT *, coalesce(sum(cap) FILTER (filled) OVER ({over}), 0)::HUGEINT AS c_full,
         coalesce(sum(w) FILTER (NOT filled) OVER ({over}), 0)::HUGEINT AS w_open
  FROM {name}_f
),
{name} AS (
  SELECT {columns}, CASE WHEN filled THEN cap ELSE (w * greatest(budget - c_full, 0)) // w_open END AS given FROM {name}_s
)"""


_MIXING_SQL = rf"""
WITH rows_ AS (
  SELECT doc_id, coalesce(lang, '{mixing.NONE}') AS lang, coalesce(source, '{mixing.NONE}') AS source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens
  FROM documents
),
r AS (
  SELECT *, 'domain' || (instr('0123456789abcdef', substr(md5(source), 1, 1)) - 1) // 4 AS domain FROM rows_
),
leaves AS (
  SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS supply, sum(n_tokens)::HUGEINT * {mixing.MAX_EPOCHS} AS cap
  FROM r GROUP BY ALL
),
total AS (SELECT (sum(supply)::HUGEINT * {mixing.BUDGET_PERCENT}) // 100 AS budget FROM leaves),
{_level_sql('lv1', 'domain', ['domain'], None)},
{_level_sql('lv2', 'lang', ['domain', 'lang'], 'lv1')},
{_level_sql('lv3', 'source', ['domain', 'lang', 'source'], 'lv2')},
plan AS (
  SELECT l.domain, l.lang, l.source, given,
         CASE WHEN supply > 0 THEN given // supply ELSE 0 END AS epochs,
         CASE WHEN supply > 0 THEN given % supply ELSE given END AS rest
  FROM leaves l JOIN lv3 USING (domain, lang, source)
),
placed AS (
  SELECT r.*, epochs, rest,
         sum(n_tokens) OVER (PARTITION BY domain, lang, source
           ORDER BY md5('{mixing.SEED}:' || epochs || ':' || coalesce(doc_id::VARCHAR, 'null'))
           RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM r JOIN plan USING (domain, lang, source)
)
SELECT doc_id, domain, lang, source, n_tokens, (epochs + (upto <= rest)::INT)::BIGINT AS copies
FROM placed WHERE epochs + (upto <= rest)::INT > 0
"""

ORACLE_SQL = {"op8_exact_dedup": _EXACT_DEDUP_SQL.strip(), "op7_mixing": _MIXING_SQL.strip()}
