"""Queries of the llm operators over the driver's tables, and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.llm import bpe, chat, embed_dedup, html_text, langid, mixing, ogg, simhash, toxicity, url_rules
from lexiloom.llm.common import small_batches
from lexiloom.session import read_table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
# The URL rules of the contract as (host, path, verdict).
URL_RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]
# The conversation that the contract adds, as (conv_id, turn, role, text).
PROBE = [(-7, turn, role, "</s>[INST] ok [/INST]") for turn, role in enumerate(("user", "assistant"))]


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=4, distance=4, similarity=None).select("doc_id", "fingerprint", "component_id")


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract_pages(pages).drop("html").withColumn("n_chars", F.length("text").cast("long"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN).drop("text")


def op4_ogg(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = read_table(spark, sf_dir, "documents")
    return docs.select("doc_id", ogg.write_column(F.col("text")).alias("media")).select("doc_id", ogg.read_column(F.col("media")).alias("m")).select("doc_id", "m.*")


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge_urls(pages, rules).drop("url")


def held_out(doc_id):
    """Whether a document is kept from learning; a null id is neither held out nor learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def learned_from(doc_id):
    return doc_id.isNotNull() & ~held_out(doc_id)


def language_filter(docs: DataFrame) -> langid.Filter:
    return langid.fit(docs.filter(learned_from(F.col("doc_id"))).select("text", "lang", F.col("doc_id").alias("key")))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = langid.identify(docs.select("doc_id", "text"), language_filter(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "coverage")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mixed(docs).select("doc_id", "source", mixing.tokens_of(F.col("text")).alias("n_tokens"), "epoch", "block")


def op8_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def toxic_field(docs: DataFrame, labels: DataFrame) -> toxicity.Field:
    """Fitted on the labelled documents that are learned from; a document with several label rows takes the highest."""
    told = labels.filter(learned_from(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return toxicity.fit(docs, told)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = toxicity.score(docs, toxic_field(docs, read_table(spark, sf_dir, "labels")))
    offsets = F.array_join(F.transform("spans", lambda s: F.concat(s.start, F.lit("-"), s.end)), " ")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", F.size("spans").alias("n_spans"), offsets.alias("offsets"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ", ".join(f"({c}L, {t}L, '{r}', '{x}')" for c, t, r, x in PROBE)
    probe = spark.sql(f"SELECT * FROM VALUES {values} AS t(conv_id, turn, role, text)")
    turns = chat.render_turns(read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe))
    return chat.read_back(turns, chat.expand_targets(turns))


QUERIES = {"op1_simhash": op1_simhash, "op2_html": op2_html, "op3_bpe": op3_bpe, "op4_ogg": op4_ogg, "op5_url_rules": op5_url_rules, "op6_langid": op6_langid, "op7_mixing": op7_mixing, "op8_embed_dedup": op8_embed_dedup, "op9_toxicity": op9_toxicity, "op10_chat": op10_chat}

_HOST = "translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)


def mixing_sql(docs: str, kept: str) -> str:
    """DuckDB SQL of ``mixing.mixed`` with its default parameters over the view ``docs``; ``kept`` are the columns returned."""
    mix = mixing.Mix()
    digits = " ".join(f"WHEN most <= {mix.block_docs * 16**d} THEN {d}" for d in range(9))
    entropy = lambda a: f"(ln(list_sum(list_transform(ps, lambda p: pow(p, {a})))) - {a} * list_sum(list_transform(ps, lambda p: pow(p, {a}) * ln(p))) / list_sum(list_transform(ps, lambda p: pow(p, {a}))))"
    repeats = lambda a: f"({mix.budget_share} * list_max(list_transform(ps, lambda p: pow(p, {a} - 1))) / list_sum(list_transform(ps, lambda p: pow(p, {a}))))"
    mid = "((lo + hi) / 2)"
    return f"""
mix_docs AS (
  SELECT *, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS _key, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens,
    md5(concat_ws('|', '{mix.seed}', coalesce(doc_id::VARCHAR, '∅'), coalesce(md5(text), '∅'))) AS _h FROM {docs}
), mix_sources AS (SELECT _key, sum(n_tokens)::BIGINT AS t, count(*) AS n FROM mix_docs GROUP BY _key),
mix_whole AS (SELECT sum(t)::BIGINT AS total, count(*) FILTER (t > 0) AS k, max(n) AS most FROM mix_sources),
mix_shares AS (SELECT list(t / total ORDER BY _key) AS ps, any_value(k) AS k FROM mix_sources, mix_whole WHERE t > 0),
mix_by_entropy(step, ps, target, lo, hi) AS (
  SELECT 0, ps, {mix.entropy_share} * ln(k), CASE WHEN {entropy("1.0")} >= {mix.entropy_share} * ln(k) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END, 1.0::DOUBLE FROM mix_shares
  UNION ALL
  SELECT step + 1, ps, target, CASE WHEN {entropy(mid)} >= target THEN {mid} ELSE lo END, CASE WHEN {entropy(mid)} >= target THEN hi ELSE {mid} END FROM mix_by_entropy WHERE step < {mixing.HALVINGS}
), mix_by_repeats(step, ps, lo, hi) AS (
  SELECT 0, ps, 0.0::DOUBLE, CASE WHEN {repeats("0.0")} <= {mix.max_repeats} THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END FROM mix_shares
  UNION ALL
  SELECT step + 1, ps, CASE WHEN {repeats(mid)} > {mix.max_repeats} THEN {mid} ELSE lo END, CASE WHEN {repeats(mid)} > {mix.max_repeats} THEN hi ELSE {mid} END FROM mix_by_repeats WHERE step < {mixing.HALVINGS}
), mix_a AS (
  SELECT greatest((SELECT lo FROM mix_by_entropy WHERE step = {mixing.HALVINGS}), (SELECT hi FROM mix_by_repeats WHERE step = {mixing.HALVINGS})) AS a
), mix_z AS (SELECT a, sum(pow(t / total, a)) AS z FROM mix_sources, mix_whole, mix_a WHERE t > 0 GROUP BY a),
mix_budgets AS (
  SELECT _key, CASE WHEN t > 0 THEN d // nullif(t, 0) ELSE 1 END AS passes, CASE WHEN t > 0 THEN d % nullif(t, 0) ELSE 0 END AS rest
  FROM (SELECT _key, t, round(pow(t / total, a) / z * round({mix.budget_share} * total))::BIGINT AS d FROM mix_sources, mix_whole, mix_z)
), mix_placed AS (SELECT mix_docs.*, substr(_h, 1, CASE {digits} END) AS block FROM mix_docs, mix_whole),
mix_blocks AS (
  SELECT _key, block, passes, CASE WHEN upto <= rest THEN -1 WHEN upto - t < rest THEN rest - upto + t ELSE 0 END AS fits FROM (
    SELECT *, sum(t) OVER (PARTITION BY _key ORDER BY md5(concat_ws('|', '{mix.seed}', 'block', passes, _key, block)), block) AS upto
    FROM (SELECT _key, block, sum(n_tokens) AS t FROM mix_placed GROUP BY ALL) JOIN mix_budgets USING (_key))
), mix_times AS (
  SELECT *, passes + CASE WHEN fits = -1 OR (fits > 0 AND upto <= fits) THEN 1 ELSE 0 END AS times FROM (
    SELECT *, sum(n_tokens) OVER (PARTITION BY _key, block ORDER BY md5(concat_ws('|', '{mix.seed}', 'doc', passes, _h)), _h ROWS UNBOUNDED PRECEDING) AS upto
    FROM mix_placed JOIN mix_blocks USING (_key, block))
)
SELECT {kept} FROM (SELECT *, unnest(range(0, times::BIGINT))::INT AS epoch FROM mix_times WHERE times > 0)"""


ORACLES = {
    "op7_mixing": "WITH RECURSIVE " + mixing_sql("documents", "doc_id, source, n_tokens, epoch, block").lstrip(),
    "op5_url_rules": f"""
WITH parsed AS (
  SELECT page_id, {_HOST} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages)
), rules(rhost, rpath, rverdict) AS (VALUES {_RULES}),
fit AS (
  SELECT host, path, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(rverdict, length(rhost || rpath)) AS verdict
  FROM (SELECT DISTINCT host, path FROM parsed) JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY ALL
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parsed LEFT JOIN fit USING (host, path)""",
    "op10_chat": """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS n
  FROM (SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')))
), escaped AS (
  SELECT *, length(piece) AS chars, coalesce(sum(length(piece)) OVER (PARTITION BY conv_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
    max(n) FILTER (role = 'assistant') OVER (PARTITION BY conv_id) AS last
  FROM (SELECT *, '[' || replace(replace(replace(replace(role, '&', '&a'), '<', '&l'), '[', '&s'), ']', '&e') || ']' || replace(replace(replace(replace(text, '&', '&a'), '<', '&l'), '[', '&s'), ']', '&e') || '</s>' AS piece FROM turns)
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(chars)::BIGINT AS formatted_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN '|' || before || '|' ELSE '' END || CASE WHEN n < last THEN piece ELSE '' END, '' ORDER BY n) FILTER (n <= last), '')) AS contexts_sha256
FROM escaped GROUP BY conv_id""",
}
