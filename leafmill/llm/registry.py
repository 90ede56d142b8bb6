"""The queries of this subpackage over the driver's tables, and their SQL."""

from __future__ import annotations

import secrets

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import bpe
from .common import frame
from .exact_dedup import exact_dedup
from .langid import language_id
from .line_dedup import PASSAGE_WORDS, SINGLE_WORDS, line_dedup
from .mixing import mix
from .near_dedup import near_dedup
from .pii import pseudonymise
from .token_files import count_tokens, write_token_files
from .topk import topk
from .warc import read_warc, write_warc


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_token_files(frame(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    counted = count_tokens(files.select("path", "bytes"))
    order = files.select(F.col("path").alias("m_path"), F.posexplode("doc_ids").alias("m_ordinal", "doc_id"))
    met = counted.join(order, (F.col("path") == F.col("m_path")) & (F.col("ordinal") == F.col("m_ordinal")))
    return met.select("doc_id", "n_tokens")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(frame(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(frame(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = write_warc(frame(spark, sf_dir, "pages"), min_revisit_bytes=0)
    return read_warc(index, keep_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe(frame(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


#: The setting that holds the key of the pseudonyms.
PII_KEY = "spark.leafmill.pii.key"


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a key in the settings, the session draws one and keeps it."""
    if not spark.conf.get(PII_KEY, ""):
        spark.conf.set(PII_KEY, secrets.token_hex(32))
    found = pseudonymise(frame(spark, sf_dir, "documents"), key=spark.conf.get(PII_KEY))
    return found.select("doc_id", "text", F.col("__found").alias("n_found"), F.col("__replaced").alias("n_replaced"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(frame(spark, sf_dir, "documents"), percent=85, width=5)


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk(frame(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(frame(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", F.try_element_at("positions", F.lit(1)).alias("first_position"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(frame(spark, sf_dir, "documents"), passage_words=PASSAGE_WORDS, single_words=SINGLE_WORDS).select("doc_id", "text", F.col("__removed").alias("lines_removed"))


QUERIES = {"op1_token_counts": op1_token_counts, "op2_language_id": op2_language_id, "op3_exact_dedup": op3_exact_dedup, "op4_warc": op4_warc, "op5_bpe": op5_bpe, "op6_pii": op6_pii, "op7_near_dedup": op7_near_dedup, "op8_topk": op8_topk, "op9_mixing": op9_mixing, "op10_line_dedup": op10_line_dedup}

ORACLE_SQL = {
    "op3_exact_dedup": """
        WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM d""",
    "op4_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
        q AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS hex, max(page_id) OVER (PARTITION BY h) AS largest FROM p)
        SELECT page_id, payload_bytes,
               array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   ((('0x' || substr(hex, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::BIGINT + 1, 1)), '') AS payload_digest,
               CASE WHEN page_id < largest THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id < largest THEN largest END AS refers_to
        FROM q""",
    "op7_near_dedup": r"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
        s AS (SELECT doc_id, CASE WHEN len(words) = 0 THEN []::VARCHAR[] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                                  ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(list_slice(words, i, i + 4), ' '))) END AS shingles FROM w),
        u AS (SELECT doc_id, unnest(shingles) AS shingle FROM s),
        c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM u a JOIN u b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
        l AS (SELECT a, b FROM c JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE 100 * shared >= 85 * (len(x.shingles) + len(y.shingles) - shared)),
        e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
        r AS (SELECT doc_id, doc_id AS other FROM s UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.other = e.a)
        SELECT doc_id, any_value(len(shingles)) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept FROM r JOIN s USING (doc_id) GROUP BY doc_id""",
    "op8_topk": """
        WITH v AS MATERIALIZED (SELECT row_number() OVER () AS rn, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.rn, q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
              FROM v q JOIN v c ON q.rn <> c.rn AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY rn ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op9_mixing": r"""
        WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                          md5('0:' || coalesce(doc_id::VARCHAR, '')) AS key FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
        r AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rk FROM s),
        w AS (SELECT *, ([3.0, 1.0, 2.0]::DOUBLE[])[(rk - 1) % 3 + 1] AS weight, ([0.8, -0.8, 0.0]::DOUBLE[])[(rk - 1) % 3 + 1] AS g,
                     2.0::DOUBLE * source_size AS most, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS all_words FROM r),
        l AS (SELECT *, (all_words - coalesce(sum(most) OVER (ORDER BY most / weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
                        / sum(weight) OVER (ORDER BY most / weight, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
        f AS (SELECT *, max(CASE WHEN level < most / weight THEN level END) OVER () AS final FROM l),
        t AS (SELECT source, source_size, g, all_words, CASE WHEN level < most / weight THEN final * weight ELSE most END AS target FROM f),
        p AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.g, t.all_words,
                     coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS c
              FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
        k AS (SELECT *, (CASE WHEN size > 0 AND 2.0::DOUBLE * c + size < 2.0::DOUBLE * target THEN 1 ELSE 0 END)
                      + (CASE WHEN size > 0 AND 2.0::DOUBLE * (source_size + c) + size < 2.0::DOUBLE * target THEN 1 ELSE 0 END) AS times,
                     least(c / target, 1.0::DOUBLE) AS y FROM p)
        SELECT doc_id, size, source_size, target, (size * times)::BIGINT AS taken,
               CASE WHEN times > 0 THEN 2.0::DOUBLE * y / ((1.0::DOUBLE - g) + sqrt((1.0::DOUBLE - g) * (1.0::DOUBLE - g) + 4.0::DOUBLE * g * y)) * all_words END AS first_position
        FROM k""",
}
