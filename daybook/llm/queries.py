"""The thirteen registered operators over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import chat_format, exact_dedup, html_extract, jaccard_join, language_id, lexical_search, mixing, packing, pq_dedup, quality, sentencepiece_bpe, sharding, token_alignment
from daybook.llm.common import table

MIX_ENTROPY = 0.999  # of the entropy of equal weights
MIX_EPOCHS = 1.5  # readings of a source per reading of the largest one


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_code,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), g AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_code DESC, doc_id NULLS LAST) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM n
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM g
"""

# Fixed value: the conversation that the contract adds to the table.
CONTROL_TEXT = r"\### Assistant: </turn> ok"


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat_format.table_turns(table(spark, sf_dir, "conversations"))
    # conversation -7 arrives in another layout, as a JSON record of messages
    record = spark.range(1).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.to_json(
            F.struct(F.array(*(F.struct(F.lit(r).alias("role"), F.lit(CONTROL_TEXT).alias("content")) for r in ("user", "assistant"))).alias("messages"))
        ).alias("record"),
    )
    turns = turns.unionByName(chat_format.record_turns(record, "conv_id", "record"))
    return chat_format.digest(chat_format.format_chats(turns))


OP8_SQL = r"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
  SELECT *, replace(replace(replace(text, '\', '\\'), '<turn', '<\turn'), '</turn', '<\/turn') AS esc FROM rows_
), g AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
    sum(length('<turn ' || url_encode(role) || '>') + 1 + length(esc) + length('</turn>') + 1) AS formatted_chars
  FROM e GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM g
"""


def op10_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.schedule(table(spark, sf_dir, "documents"), target_entropy=MIX_ENTROPY, max_epochs=MIX_EPOCHS)


def mix_sql(block_tokens: int) -> str:
    return rf"""
WITH t AS (
  SELECT doc_id, source, text, coalesce('s:' || source, 'null') AS skey,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) + 1 AS n_tokens,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS u
  FROM documents
), s AS (
  SELECT skey, CAST(sum(n_tokens) AS BIGINT) AS tokens, count(*) AS docs FROM t GROUP BY skey
), q AS (
  SELECT skey, tokens, tokens / CAST(sum(tokens) OVER () AS DOUBLE) AS p, max(tokens) OVER () AS high, min(tokens) OVER () AS low,
         count(*) OVER () AS n
  FROM s
), grid AS (
  SELECT k, ln(sum(z)) - a * sum(z * ln(p)) / sum(z) AS h
  FROM (SELECT k, k / 1048576.0::DOUBLE AS a, p, pow(p, k / 1048576.0::DOUBLE) AS z FROM q, range(0, 1048577) r(k))
  GROUP BY k, a
), best AS (
  SELECT CASE WHEN max(high) = min(low) THEN 1.0::DOUBLE ELSE greatest(
           (SELECT coalesce(max(k), 0) FROM grid WHERE h >= {MIX_ENTROPY} * (SELECT ln(max(n)) FROM q) - 1e-12),
           (SELECT min(k) FROM range(0, 1048577) r(k)
            WHERE pow((SELECT min(low) / max(high)::DOUBLE FROM q), k / 1048576.0::DOUBLE - 1) <= {MIX_EPOCHS})) / 1048576.0::DOUBLE END AS exponent
  FROM q
), plan AS (
  SELECT skey, tokens, CAST(floor(tokens * pow(tokens / CAST(high AS DOUBLE), exponent - 1)) AS BIGINT) AS budget, exponent,
         CAST(ceil(tokens / {block_tokens}.0) AS BIGINT) AS blocks
  FROM q, best
), placed AS (
  SELECT t.*, p.tokens, p.budget, p.exponent, p.budget // p.tokens AS whole_epochs, p.budget % p.tokens AS rest,
         CAST('0x' || substr(md5('mix:block:' || u), 1, 7) AS BIGINT) % p.blocks AS block
  FROM t JOIN plan p USING (skey)
), b AS (
  SELECT skey, block, sum(n_tokens) AS size, any_value(tokens) AS tokens, any_value(whole_epochs) AS whole_epochs, any_value(rest) AS rest
  FROM placed GROUP BY skey, block
), turns AS (
  SELECT skey, block, epoch, size, tokens, whole_epochs, rest,
         row_number() OVER w - 1 AS slot, coalesce(sum(size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_
  FROM (SELECT *, unnest(range(0, whole_epochs + 1)) AS epoch FROM b)
  WINDOW w AS (PARTITION BY skey, epoch ORDER BY md5('mix:' || skey || ':' || epoch || ':' || block))
), paid AS (
  SELECT doc_id, source, n_tokens, epoch, block, slot, epoch * r.tokens + before_ AS start, budget, exponent,
         r.epoch < r.whole_epochs AS whole, before_, r.rest,
         sum(n_tokens) OVER (PARTITION BY skey, epoch, block ORDER BY u, n_tokens ROWS UNBOUNDED PRECEDING) AS upto
  FROM placed JOIN turns r USING (skey, block)
)
SELECT doc_id, source, n_tokens, epoch, block, slot, CAST(start AS BIGINT) AS start, budget, exponent
FROM paid WHERE whole OR before_ + upto <= rest
"""


OP10_SQL = mix_sql(1 << 22)


def op1_pq_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


OP1_SQL = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), ok AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), link AS (
  SELECT a.r AS a, b.r AS b FROM ok a JOIN ok b ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach AS (
  SELECT r AS a, r AS b FROM v UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), comp AS (
  SELECT reach.a AS r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.b GROUP BY reach.a
), n AS (SELECT a AS r, count(*) AS n_links FROM link GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN comp USING (r) LEFT JOIN n USING (r)
"""


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op3_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def vocabulary() -> str:
    """The public byte-level vocabulary, installed on every node."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary())


def op5_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.kd_shards(table(spark, sf_dir, "documents"), shards=8)


def pieces_model() -> str:
    """The public SentencePiece model, installed on every node."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.digests(table(spark, sf_dir, "documents"), pieces_model())


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
), t AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(words) AS term FROM d) GROUP BY r, term
), s AS (
  SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(len(words)) AS BIGINT) AS total FROM d WHERE len(words) > 0
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM t, s GROUP BY term, docs
), i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), m AS (
  SELECT r, doc_id, 100 - 50 + (50 * len(words) * docs) // total AS m FROM d, s
), scored AS (
  SELECT item_id, r, any_value(doc_id) AS doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM i JOIN w USING (term) JOIN t USING (term) JOIN m USING (r) GROUP BY item_id, r
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 50
"""


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(table(spark, sf_dir, "documents"), vocabulary(), pieces_model())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pq_dedup,
        op2_language_id,
        op3_quality_gam,
        op4_best_fit_packing,
        op5_kd_shards,
        op6_jaccard_join,
        op7_exact_dedup,
        op8_chat_format,
        op9_html_text,
        op10_temperature_mix,
        op11_sentencepiece,
        op12_lexical_search,
        op13_token_alignment,
    )
}

SQL: dict[str, str] = {"op1_pq_dedup": OP1_SQL, "op7_exact_dedup": OP7_SQL, "op8_chat_format": OP8_SQL, "op10_temperature_mix": OP10_SQL, "op12_lexical_search": OP12_SQL}
