"""Registered queries of this subpackage, over the whole given tables, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe, chat, exact_dedup, language, lines, mixing, neighbours, ngrams, runs, simhash, spans, spelling, warc
from .common import table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(spark, f"{sf_dir}/documents.parquet")


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.nearest(rows, F.col("vec_id") % 20 == 0)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.warc_round_trip(spark, table(spark, sf_dir, "pages"))
    return found.select(
        F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language.identify(docs).select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "'</s>[INST] ok [/INST]' AS text"
    probe = spark.range(1).selectExpr("-1L AS conv_id", "0L AS turn", "'user' AS role", hard).unionAll(
        spark.range(1).selectExpr("-1L AS conv_id", "1L AS turn", "'assistant' AS role", hard)
    )
    return chat.chat_digests(chat.format_chats(rows.unionByName(probe)))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    shared = bpe.codec(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    return bpe.bpe_digests(table(spark, sf_dir, "documents").select("doc_id", "text"), shared).drop("text")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "line_no", "first_doc_id", "first_line_no")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = "crc32(CAST(coalesce(CAST(doc_id AS STRING), '') AS BINARY)) % 10 = 0 AS held_out"
    docs = table(spark, sf_dir, "documents").selectExpr("doc_id", "text", held_out)
    model = ngrams.train(docs.where("NOT held_out"))
    return ngrams.score(docs, model).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )


#: Tenths of the documents get a part that repeats: from word a on, the first p words from there over and over.
_PERIODIC = r"""
    concat_ws(' ', slice(w, 1, CAST(a AS INT)), slice(
        flatten(array_repeat(slice(w, CAST(a + 1 AS INT), CAST(p AS INT)), CAST((n - a) div p + 1 AS INT))), 1, CAST(n - a AS INT)))
"""


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "text", "crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) AS h",
        r"filter(split(text, '[\\x20\\x09-\\x0D]+'), x -> x <> '') AS w",
    ).selectExpr("*", "h div 10 AS g", "CAST(size(w) AS BIGINT) AS n").selectExpr("*", "g % greatest(n, 1) AS a")
    docs = docs.selectExpr("*", "1 + (n - a) div (3 + g % 8) AS p")
    texts = docs.selectExpr("doc_id", f"CASE WHEN h % 10 = 0 AND n > 0 THEN {_PERIODIC} ELSE text END AS text")
    most = """
        array_sort(runs, (x, y) -> CASE
            WHEN x.length * y.period > y.length * x.period THEN -1 WHEN x.length * y.period < y.length * x.period THEN 1
            WHEN x.start < y.start THEN -1 WHEN x.start > y.start THEN 1 ELSE CAST(x.period - y.period AS INT) END)
    """
    found = runs.periodic_runs(texts).selectExpr("*", f"get({most}, 0) AS top")
    written = "transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n'))"
    return found.selectExpr(
        "doc_id", "CAST(size(runs) AS BIGINT) AS n_runs", "top.start", "top.length", "top.period",
        "1000 * top.length div top.period AS exponent_milli",
        f"sha2(array_join({written}, ''), 256) AS runs_sha256", "sha2(collapsed, 256) AS collapsed_sha256",
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    lowered = "translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    found = table(spark, sf_dir, "documents").selectExpr(
        "coalesce(CAST(doc_id AS STRING), '') AS id", r"explode(regexp_extract_all(text, '[A-Za-z\\u00C0-\\u00FF]+', 0)) AS run"
    ).where(F.length("run") >= spelling.MIN_LENGTH).selectExpr("id", f"{lowered} AS run")
    hashed = found.selectExpr("run", "crc32(CAST(concat(id, ':', run) AS BINARY)) AS h").selectExpr(
        "run", "h % 31 = 0 AS marred", "CAST(h % length(run) AS INT) AS at"
    )
    words = hashed.selectExpr("IF(marred, concat(left(run, at), substring(run, at + 2)), run) AS word")
    counted = words.where(F.length("word") >= spelling.MIN_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return spelling.spelling_variants(counted.where("n >= 2"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_exact_dedup, op2_nearest_neighbours, op3_mixing, op4_warc, op5_language, op6_substring_dedup,
    op7_chat_formatting, op8_byte_bpe, op9_line_dedup, op10_simhash, op11_lm_scoring, op12_periodic_runs,
    op13_spelling_variants, pipeline,
)}

_CONTROLS = r"([<\[])(\\*)(/?INST\]|<SYS>>|</SYS>>|<ROLE>>|</ROLE>>|</TEXT>>|/?s>)"

ORACLE = {
    "op4_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        g AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS newest, sha1(encode(html)) AS h FROM p)
        SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
               array_to_string([
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(('0x' || h[i // 4 * 5 + 1 : i // 4 * 5 + 5])::BIGINT >> (15 - 5 * (i % 4))::BIGINT & 31) + 1]
                   for i in range(32)
               ], '') AS payload_digest,
               CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> newest THEN newest END AS refers_to
        FROM g
    """,
    "op1_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
        )
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept, sha256(t) AS text_sha256
        FROM t WINDOW same AS (PARTITION BY t)
    """,
    "op7_chat_formatting": rf"""
        WITH r AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, i, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(i, r)
        ), f AS (
            SELECT *, role || chr(10) || text || chr(10) AS whole, CASE role
                       WHEN 'system' THEN '<<SYS>>' || e || '<</SYS>>'
                       WHEN 'user' THEN '[INST]' || e || '[/INST]'
                       WHEN 'assistant' THEN '<s>' || e || '</s>'
                       ELSE '<<ROLE>>' || role || '<</ROLE>>' || e || '<</TEXT>>' END AS formatted,
                   lag(role, 1, 'start') OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
                   lead(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) IS NULL AS is_last
            FROM (SELECT *, regexp_replace(text, '{_CONTROLS}', '\1\\\2\3', 'g') AS e FROM r)
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(whole, '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(length(formatted)) AS BIGINT) AS formatted_chars,
               bool_and((before || '|' || role) IN
                   ('start|system', 'start|user', 'system|user', 'user|assistant', 'assistant|user')
                   AND (NOT is_last OR role = 'assistant')) AS in_order
        FROM f GROUP BY conv_id
    """,
}
