"""Registered queries of the training-data operators, and their oracle SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide.llm import (
    alignment,
    bpe,
    chat,
    classifier,
    edits,
    importance,
    mixing,
    naming,
    neardup,
    packing,
    pii,
    rules,
    warc,
)
from voltide.llm.tables import table


SURROGATE_KEY = b"voltide surrogates"


def op1_archive_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.round_trip(table(spark, sf_dir, "pages"))
    return index.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "rank"
    )


def op2_chat_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return chat.digests(chat.assemble(rows.unionByName(added), ranks), ranks)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, SURROGATE_KEY, count="n_replaced")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op6_subword_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = classifier.fit(docs, table(spark, sf_dir, "labels"), "quality")
    return classifier.score_documents(docs, model)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.apply_rules(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "n_lines",
        "n_stop_words",
        "base_failed",
        "kept",
    )


def op8_weighted_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.groups(table(spark, sf_dir, "documents")).drop("words_id")


def op9_edited_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document before and after four drawn edits."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", edits.drawn_edits(F.col("doc_id"), text).alias("edits")
    )
    edited = edits.apply_edits(edits.plant(docs, ranks), ranks)
    return edited.select(
        "doc_id",
        "n_tokens",
        "n_tokens_edited",
        "n_chars_encoded",
        F.length("text").cast("long").alias("n_chars_edited"),
        F.sha2("text", 256).alias("edited_sha256"),
    )


def op10_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naming.groups(table(spark, sf_dir, "documents"))


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.draw(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


QUERIES = {
    "op1_archive_index": op1_archive_index,
    "op2_chat_assembly": op2_chat_assembly,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_surrogates": op4_surrogates,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_subword_classifier": op6_subword_classifier,
    "op7_quality_rules": op7_quality_rules,
    "op8_weighted_near_duplicates": op8_weighted_near_duplicates,
    "op9_edited_token_counts": op9_edited_token_counts,
    "op10_block_naming": op10_block_naming,
    "op11_source_mix": op11_source_mix,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_token_alignment": op13_token_alignment,
}

# ---- oracle -------------------------------------------------------------------------------------

BLANKS = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"
STOPS = ", ".join(f"'{word}'" for word in rules.STOP_FORMS)
HOST = r"regexp_replace(lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]+)', 1)), '^www\d*\.', '')"
PORT = r"regexp_extract(url, '^[A-Za-z]+://[^/?#:]+(:\d+)', 1)"
PATH = r"regexp_extract(url, '^[A-Za-z]+://[^/?#]+([^?#]*)', 1)"
QUERY = r"regexp_extract(url, '^[^?#]*(\?[^#]*)', 1)"
CONTROL = r"[<\[]\\*(?:\|\w{1,40}\|>|/?s>|<SYS>>|</SYS>>|/?INST\]|(?:unk|pad|bos|eos|mask)>|(?:start|end)_of_turn>|/?think>)"
MARKS = len(chat.TURN + chat.TEXT + chat.END)


def _kept_sql() -> str:
    parts = []
    for row in rules.THRESHOLDS:
        part, whole = rules.RATIOS[row.ratio]
        ratio = f"CASE WHEN {whole} > 0 THEN {part} / {whole}::DOUBLE ELSE 0.0 END"
        bounds = [f"{ratio} {sign} {limit}" for sign, limit in ((">=", row.low), ("<=", row.high)) if abs(limit) < 1e9]
        parts.append(f"(({' AND '.join(bounds)}) OR n_words < {row.from_words})")
    return " AND ".join(parts)


ORACLE: dict[str, str] = {
    "op1_archive_index": f"""
    WITH p AS (SELECT page_id, url, encode(coalesce(html, '')) AS payload FROM pages),
    d AS (SELECT page_id, url, octet_length(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_digest FROM p),
    f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM d),
    k AS (SELECT page_id, payload_bytes, payload_digest,
                 CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
                 CASE WHEN first <> page_id THEN first END AS refers_to,
                 lower(array_to_string(list_reverse(string_split({HOST}, '.')), ',')
                       || CASE WHEN {PORT} IN ('', ':80', ':443') THEN '' ELSE {PORT} END || ')'
                       || CASE WHEN {PATH} = '' THEN '/' ELSE {PATH} END
                       || CASE WHEN {QUERY} = '?' THEN '' ELSE {QUERY} END) AS url_key,
                 strftime(make_timestamp((1700000000 + page_id) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS captured
          FROM f)
    SELECT *, row_number() OVER (ORDER BY url_key, captured, page_id) - 1 AS rank FROM k""",
    "op2_chat_assembly": rf"""
    WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
               UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
    e AS (SELECT *, len(regexp_extract_all(role || chr(10) || text, '{CONTROL}')) AS escapes FROM c)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
           sum(length(role) + length(text) + escapes + {MARKS})::BIGINT AS formatted_chars
    FROM e GROUP BY conv_id""",
    "op7_quality_rules": rf"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    w AS (SELECT doc_id, t, regexp_extract_all(t, '{WORDS}') AS ws,
                 list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '{WORDS}')) AS ls FROM d),
    s AS (SELECT doc_id, pos, array_to_string(ws[pos + 1:pos + 5], ' ') AS win
          FROM (SELECT doc_id, ws, unnest(range(len(ws) - 4)) AS pos FROM w)),
    o AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, win) AS n FROM s),
    r AS (SELECT doc_id, count(DISTINCT pos + k)::BIGINT AS n_repeat_words FROM o, range(5) x(k) WHERE n > 1 GROUP BY 1),
    m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
                 len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
                 (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
                 coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines,
                 len(list_filter(ws, lambda x: x IN ({STOPS})))::BIGINT AS n_stop_words
          FROM w LEFT JOIN r ON r.doc_id = w.doc_id),
    b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
    SELECT *, NOT base_failed AND {_kept_sql()} AS kept FROM b""",
    "op10_block_naming": rf"""
    WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{BLANKS}', ' ', 'g') AS t FROM documents),
    g AS (SELECT doc_id, t, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM n)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM g""",
    "op11_source_mix": rf"""
    WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORDS}'))::BIGINT AS size,
                      ('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS h
               FROM documents),
    s AS (SELECT source, sum(size)::DOUBLE AS size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS turn
          FROM d GROUP BY source),
    w AS (SELECT source, size, 2.0::DOUBLE * size AS cap, ([3.0, 1.0, 2.0]::DOUBLE[])[turn + 1] AS weight FROM s),
    k AS (SELECT *, coalesce(sum(cap) OVER before, 0) AS capped, sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS free,
                 row_number() OVER (ORDER BY cap / weight, source) AS place
          FROM w WINDOW before AS (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    l AS (SELECT (1.5::DOUBLE * (SELECT sum(size) FROM w) - capped) / free AS level
          FROM k WHERE weight * ((1.5::DOUBLE * (SELECT sum(size) FROM w) - capped) / free) <= cap ORDER BY place LIMIT 1),
    t AS (SELECT source, size AS source_size, least(cap, weight * level) AS target FROM w, l),
    g AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS passes FROM t),
    r AS (SELECT d.*, source_size, target, passes, target - passes * source_size AS goal,
                 sum(size) OVER (PARTITION BY d.source ORDER BY h RANGE UNBOUNDED PRECEDING) AS upto,
                 sum(size) OVER (PARTITION BY d.source, h) AS here
          FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
    SELECT doc_id, size, source_size::BIGINT AS source_size, target,
           (size * (passes + CASE WHEN upto <= goal OR (upto - here <= goal AND upto - goal < goal - (upto - here))
                                  THEN 1 ELSE 0 END))::BIGINT AS taken
    FROM r""",
}
