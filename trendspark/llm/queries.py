"""Registered queries of the operators: each applies one of them to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from trendspark.llm import (bpe_codec, decontamination, embedding_dedup, fingerprints, lexical_search, near_dedup, packing, quality, secret_scan, sharding,
                            suffix_dedup, warc, whitening)
from trendspark.llm.common import table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_digests(table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_components(table(spark, sf_dir, "documents"), percent=80, width=2)


def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op7_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(table(spark, sf_dir, "documents"))


def op8_quality_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op10_differencing_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitening_digests(table(spark, sf_dir, "embeddings"), components=8)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def op13_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_secret_forest": op3_secret_forest,
    "op4_embedding_near_dedup": op4_embedding_near_dedup,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_bpe_round_trip": op6_bpe_round_trip,
    "op7_minhash_fingerprints": op7_minhash_fingerprints,
    "op8_quality_network": op8_quality_network,
    "op9_warc_archives": op9_warc_archives,
    "op10_differencing_shards": op10_differencing_shards,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_ranked_search": op12_ranked_search,
    "op13_benchmark_decontamination": op13_benchmark_decontamination,
}

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = f"regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLES: dict[str, str] = {
    "op9_warc_archives": """
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM largest AND largest IS NOT NULL
                    THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM largest THEN largest END AS refers_to
        FROM (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
                     max(page_id) OVER (PARTITION BY coalesce(html, '')) AS largest
              FROM pages)""",
    "op12_ranked_search": f"""
        WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS t FROM documents),
        i AS (SELECT row_number() OVER () AS iid, item_id, {_TERMS} AS t FROM benchmark),
        s AS (SELECT CAST(count(*) FILTER (len(t) > 0) AS BIGINT) AS nn, CAST(sum(len(t)) AS BIGINT) AS ll FROM d),
        q AS (SELECT iid, item_id, term, count(*) AS c FROM (SELECT iid, item_id, unnest(t) AS term FROM i) GROUP BY ALL),
        p AS (SELECT rid, doc_id, n, term, count(*) AS tf FROM (SELECT rid, doc_id, CAST(len(t) AS BIGINT) AS n, unnest(t) AS term FROM d)
              WHERE term IN (SELECT term FROM q) GROUP BY ALL),
        w AS (SELECT term, CAST(floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY term, nn),
        scores AS (SELECT iid, item_id, doc_id, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * nn) // ll)))) AS BIGINT) AS score
                   FROM q JOIN p USING (term) JOIN w USING (term), s GROUP BY iid, item_id, rid, doc_id)
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0) WHERE rank <= 20""",
    "op13_benchmark_decontamination": f"""
        WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS t FROM documents),
        dw AS (SELECT rid, unnest(t) AS word, generate_subscripts(t, 1) AS pos FROM d),
        i AS (SELECT row_number() OVER () AS iid, item_id, {_TERMS} AS t FROM benchmark),
        iw AS (SELECT iid, item_id, least(10, len(t)) AS k, unnest(t) AS word, generate_subscripts(t, 1) AS pos FROM i),
        -- windows of k words; those that run over the end are shorter and go
        win AS (SELECT DISTINCT item_id, k, words FROM (
                SELECT item_id, k, string_agg(word, ' ') OVER o AS words, count(*) OVER o AS n
                FROM iw WINDOW o AS (PARTITION BY iid ORDER BY pos ROWS BETWEEN CURRENT ROW AND k - 1 FOLLOWING)) WHERE n = k),
        dwin AS (SELECT rid, pos, k, words FROM (
                SELECT rid, pos, k, string_agg(word, ' ') OVER o AS words, count(*) OVER o AS n
                FROM dw, (SELECT DISTINCT k FROM win) WINDOW o AS (PARTITION BY rid, k ORDER BY pos ROWS BETWEEN CURRENT ROW AND k - 1 FOLLOWING)) WHERE n = k),
        m AS (SELECT rid, pos, k, item_id FROM dwin JOIN win USING (k, words)),
        hits AS (SELECT rid, count(DISTINCT hit) AS n FROM (SELECT rid, unnest(range(pos, pos + k)) AS hit FROM m) GROUP BY rid),
        ids AS (SELECT rid, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
                FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS id FROM m WHERE item_id IS NOT NULL) GROUP BY rid)
        SELECT doc_id, CAST(len(t) AS BIGINT) AS n_words, coalesce(hits.n, 0) AS n_hit, coalesce(ids.n, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(hits.n, 0) > 0 AS contaminated
        FROM d LEFT JOIN hits USING (rid) LEFT JOIN ids USING (rid)""",
}
