"""The registered query of each operator of this subpackage, with production parameters, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, chat_format, exact_dedup, html_extract, jpeg, langid, packing, pivot_search, repair, simhash, suffix_dedup, toxicity, whitening


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), words=4, radius=4)


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_texts(_table(spark, sf_dir, "pages"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.format_chats(_table(spark, sf_dir, "conversations"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))


def op10_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jpeg.media_digests(_table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten_embeddings(_table(spark, sf_dir, "embeddings"), k=8)


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_conversations(_table(spark, sf_dir, "conversations"))


def op13_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_search.top_k(_table(spark, sf_dir, "embeddings"), k=10, every=100)


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id, op2_simhash_near_dedup, op3_bpe_round_trip, op4_exact_dedup, op5_html_extraction,
        op6_toxicity, op7_chat_formatting, op8_packing, op9_suffix_dedup, op10_media_columns,
        op11_embedding_whitening, op12_structure_repair, op13_exact_top_k,
    )
}

ORACLES = {
    "op4_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    # The tables have no tool calls; a message with one would need its JSON parsed, which the operator's tests cover.
    "op7_chat_formatting": """
        SELECT conv_id, turn, turn AS order_turn, CAST(0 AS BIGINT) AS order_sub, coalesce(role, 'unknown') AS role,
               CAST(0 AS BIGINT) AS n_calls, CAST(0 AS BIGINT) AS n_valid, CAST(0 AS BIGINT) AS n_linked, false AS is_linked_result,
               '{"content":' || CAST(to_json(coalesce(text, '')) AS VARCHAR) || ',"role":' || CAST(to_json(coalesce(role, 'unknown')) AS VARCHAR) || '}' AS message_json
        FROM conversations""",
    # Not by the agenda: a fold over each conversation's rows, which holds the cheapest (cost, audit, text) of the four states.
    "op12_structure_repair": """
        WITH places AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS place
            FROM conversations),
        hashed AS (
            SELECT *, xor(list_reduce(list_transform(string_split(place, ''), lambda s: CAST(ord(s) AS BIGINT)),
                lambda c, b: list_reduce(range(8), lambda r, k: xor(r >> 1, 3988292384 * (r & 1)), xor(c, b)), CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS h
            FROM places),
        rows_ AS (
            SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
                   CASE WHEN h = 1 THEN '' WHEN h = 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN h = 3 THEN 2 ELSE 1 END)) AS copy
            FROM hashed WHERE h <> 0),
        marked AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again, rtrim(text, E' \t\n\x0b\x0c\r') AS sound,
                   lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(role || E'\n' || text), copy) || left(role, 1) AS pair
            FROM rows_),
        judged AS (
            SELECT *, CASE WHEN sound = '' THEN 1 WHEN again THEN 2 WHEN right(sound, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault FROM marked),
        talks AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
                   count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
                   list({'r': left(role, 1), 'gone': fault IN (1, 2), 'more': CASE WHEN fault = 3 THEN 5 ELSE 0 END, 'role': role, 'text': text}
                        ORDER BY turn NULLS FIRST, role, sha256(role || E'\n' || text), copy) AS l
            FROM judged GROUP BY conv_id),
        -- v: the four states; none: one that can't be reached
        folded AS (
            SELECT *, list_reduce(l, lambda v, x: list_transform([list_transform([
                {'c': v[1].c + 2, 'a': v[1].a || 'D', 't': v[1].t},
                list_min([{'c': v[2].c + 2, 'a': v[2].a || 'D', 't': v[2].t},
                          {'c': CASE WHEN x.r = 's' AND NOT x.gone THEN v[1].c + x.more ELSE 1000000 END, 'a': v[1].a || 'K', 't': [x.role || ':' || x.text]}]),
                list_min([{'c': v[3].c + 2, 'a': v[3].a || 'D', 't': v[3].t},
                          {'c': CASE WHEN x.gone THEN 1000000 WHEN x.r = 'u' THEN v[1].c + x.more ELSE v[1].c + x.more + 1 END, 'a': v[1].a || CASE WHEN x.r = 'u' THEN 'K' ELSE 'R' END, 't': list_append(v[1].t, CASE WHEN x.r = 'u' THEN x.role ELSE 'user' END || ':' || x.text)},
                          {'c': CASE WHEN x.gone THEN 1000000 WHEN x.r = 'u' THEN v[2].c + x.more ELSE v[2].c + x.more + 1 END, 'a': v[2].a || CASE WHEN x.r = 'u' THEN 'K' ELSE 'R' END, 't': list_append(v[2].t, CASE WHEN x.r = 'u' THEN x.role ELSE 'user' END || ':' || x.text)},
                          {'c': CASE WHEN x.gone THEN 1000000 WHEN x.r = 'u' THEN v[4].c + x.more ELSE v[4].c + x.more + 1 END, 'a': v[4].a || CASE WHEN x.r = 'u' THEN 'K' ELSE 'R' END, 't': list_append(v[4].t, CASE WHEN x.r = 'u' THEN x.role ELSE 'user' END || ':' || x.text)}]),
                list_min([{'c': v[4].c + 2, 'a': v[4].a || 'D', 't': v[4].t},
                          {'c': CASE WHEN x.gone THEN 1000000 WHEN x.r = 'a' THEN v[3].c + x.more ELSE v[3].c + x.more + 1 END, 'a': v[3].a || CASE WHEN x.r = 'a' THEN 'K' ELSE 'R' END, 't': list_append(v[3].t, CASE WHEN x.r = 'a' THEN x.role ELSE 'assistant' END || ':' || x.text)}])
                ], lambda w: w)], lambda n: [n[1], n[2],
                    list_min([n[3], {'c': n[1].c + 5, 'a': n[1].a || 'I', 't': list_append(n[1].t, 'user:')}, {'c': n[2].c + 5, 'a': n[2].a || 'I', 't': list_append(n[2].t, 'user:')}, {'c': n[4].c + 5, 'a': n[4].a || 'I', 't': list_append(n[4].t, 'user:')}]),
                    list_min([n[4], {'c': n[3].c + 5, 'a': n[3].a || 'I', 't': list_append(n[3].t, 'assistant:')},
                              {'c': n[1].c + 10, 'a': n[1].a || 'II', 't': list_concat(n[1].t, ['user:', 'assistant:'])}, {'c': n[2].c + 10, 'a': n[2].a || 'II', 't': list_concat(n[2].t, ['user:', 'assistant:'])}])])[1],
                [{'c': 0, 'a': '', 't': CAST([] AS VARCHAR[])}, {'c': 1000000, 'a': '', 't': CAST([] AS VARCHAR[])},
                 {'c': 5, 'a': 'I', 't': ['user:']}, {'c': 10, 'a': 'II', 't': ['user:', 'assistant:']}]) AS v
            FROM talks),
        goals AS (SELECT *, list_min([v[1], v[4]]) AS goal FROM folded)
        SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
               coalesce(illegal, 0) AS illegal, CAST(coalesce(goal.c, 0) AS BIGINT) AS cost, coalesce(goal.a, '') AS audit, sha256(coalesce(array_to_string(goal.t, E'\n'), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN goals g ON c.conv_id IS NOT DISTINCT FROM g.conv_id""",
    "op13_exact_top_k": """
        WITH whole AS (
            SELECT vec_id, row_number() OVER () AS row_, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        pairs AS (
            SELECT q.vec_id AS query_id, q.row_ AS asked, c.vec_id, c.row_, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND q.row_ <> c.row_)
        SELECT query_id, CAST(row_number() OVER (PARTITION BY asked ORDER BY score DESC, vec_id NULLS LAST, row_) AS INTEGER) AS rank, vec_id, score
        FROM pairs QUALIFY rank <= 10""",
}
