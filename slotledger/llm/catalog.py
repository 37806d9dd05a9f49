"""The registered queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotledger.llm import (
    bpe,
    decontamination,
    html_text,
    language,
    lexical,
    near_duplicates,
    pii,
    repeated_bytes,
    sharding,
    top_k,
    toxicity,
    warc,
    whitening,
)
from slotledger.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(table(spark, sf_dir, "embeddings"))


ORACLE_SQL["op1_top_k"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
    FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 20
"""


@query
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.personal_spans(table(spark, sf_dir, "documents")))


@query
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


@query
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = repeated_bytes.remove_repeats(table(spark, sf_dir, "documents"), passage_words=repeated_bytes.PASSAGE_WORDS)
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_repeated_words")


@query
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_and_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicate_groups(table(spark, sf_dir, "documents"))


@query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivatives(warc.responses(table(spark, sf_dir, "pages")))


def _warc_sql() -> str:
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    text = f"regexp_replace(html, {quoted(warc.UNSEEN)}, ' ', 'g')"
    text = f"regexp_replace(regexp_replace({text}, {quoted(warc.BREAKS)}, chr(10), 'g'), '{warc.TAGS}', '', 'g')"
    for entity, shown in warc.ENTITIES:
        text = f"replace({text}, {quoted(entity)}, {quoted(shown)})"
    text = f"regexp_replace(regexp_replace({text}, '{warc.SPACES}', ' ', 'g'), '{warc.LINES}', chr(10), 'g')"
    text = f"regexp_replace({text}, '{warc.ENDS}', '', 'g')"
    urn = lambda x: (
        f"(SELECT '<urn:uuid:' || h[1:8] || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32] || '>' "
        f"FROM (SELECT sha256({x}) AS h))"
    )
    return f"""
WITH page AS (
    SELECT page_id, coalesce(url, '') AS target_uri, coalesce(html, '') AS html, chr(13) || chr(10) AS crlf FROM pages),
source AS (
    SELECT *, {urn("'response|' || coalesce(CAST(page_id AS VARCHAR), '') || '|' || target_uri")} AS refers_to,
        'sha256:' || sha256(html) AS payload_digest
    FROM page),
made AS (
    SELECT *, 'metadata' AS type, '{warc.METADATA_TYPE}' AS content_type,
        'http-status-line: HTTP/1.1 200 OK' || crlf || 'http-header-Content-Type: text/html; charset=utf-8' || crlf
        || 'http-header-Content-Length: ' || CAST(strlen(html) AS VARCHAR) || crlf AS block
    FROM source
    UNION ALL
    SELECT *, 'conversion' AS type, '{warc.TEXT_TYPE}' AS content_type, {text} AS block FROM source),
finished AS (
    SELECT *, {urn("type || '|' || refers_to")} AS record_id, CAST(strlen(block) AS BIGINT) AS content_length,
        'sha256:' || sha256(block) AS block_digest
    FROM made)
SELECT page_id, type, record_id, refers_to, target_uri, content_type, content_length, block_digest, payload_digest,
    '{warc.VERSION}' || crlf || 'WARC-Type: ' || type || crlf || 'WARC-Record-ID: ' || record_id || crlf
    || 'WARC-Refers-To: ' || refers_to || crlf || 'WARC-Target-URI: ' || target_uri || crlf || 'WARC-Date: {warc.DATE}' || crlf
    || 'WARC-Source-Payload-Digest: ' || payload_digest || crlf || 'WARC-Block-Digest: ' || block_digest || crlf
    || 'Content-Type: ' || content_type || crlf || 'Content-Length: ' || CAST(content_length AS VARCHAR) || crlf
    || crlf || block || crlf || crlf AS record
FROM finished
"""


ORACLE_SQL["op7_warc"] = _warc_sql()


@query
def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.page_text(table(spark, sf_dir, "pages"))


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


ORACLE_SQL["op9_decontamination"] = r"""
WITH doc AS (
    SELECT doc_id, row_number() OVER () AS k,
        regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents),
item AS (
    SELECT DISTINCT CAST(item_id AS VARCHAR) AS item,
        regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark),
phrase AS (
    SELECT DISTINCT item, least(len(words), 10) AS n, array_to_string(words[i : i + least(len(words), 10) - 1], ' ') AS phrase
    FROM (SELECT item, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM item WHERE len(words) > 0)),
place AS (
    SELECT k, i, n, array_to_string(words[i : i + n - 1], ' ') AS phrase
    FROM (SELECT k, words, n, unnest(range(1, len(words) - n + 2)) AS i
          FROM doc, (SELECT DISTINCT n FROM phrase) WHERE len(words) >= n)),
hit AS (SELECT k, i, n, item FROM place JOIN phrase USING (phrase, n)),
covered AS (SELECT k, count(DISTINCT w) AS n_hit FROM (SELECT k, unnest(range(i, i + n)) AS w FROM hit) GROUP BY k),
found AS (
    SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT k, item FROM hit) GROUP BY k)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (k) LEFT JOIN found USING (k)
"""


@query
def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE_SQL["op12_lexical_search"] = r"""
WITH doc AS (
    SELECT doc_id, row_number() OVER () AS k,
        regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents),
item AS (
    SELECT item_id, row_number() OVER () AS i,
        regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM benchmark),
asked AS (SELECT DISTINCT i, unnest(terms) AS term FROM item),
whole AS (SELECT count(*) AS docs, CAST(sum(len(terms)) AS BIGINT) AS length FROM doc WHERE len(terms) > 0),
posting AS (
    SELECT k, term, count(*) AS tf FROM (SELECT k, unnest(terms) AS term FROM doc) SEMI JOIN asked USING (term) GROUP BY k, term),
weight AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM posting GROUP BY term), whole),
impact AS (
    SELECT k, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(terms) * docs) // length))) AS part
    FROM posting JOIN weight USING (term) JOIN doc USING (k), whole),
scored AS (SELECT i, k, CAST(sum(part) AS BIGINT) AS score FROM asked JOIN impact USING (term) GROUP BY i, k)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (
    SELECT i, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank
    FROM scored JOIN doc USING (k) WHERE score > 0)
JOIN item USING (i) WHERE rank <= 10
"""


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
