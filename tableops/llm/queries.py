"""One registered query per operator, with production parameters over whole tables, and its SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableops.llm.chaining import fuzzy_passages
from tableops.llm.common import documents, outer_id
from tableops.llm.exact_dedup import exact_duplicates
from tableops.llm.filter_audit import audit_documents
from tableops.llm.language_id import identify_languages
from tableops.llm.lexical_search import search
from tableops.llm.license_scan import scan_notices
from tableops.llm.line_dedup import deduplicate_lines
from tableops.llm.ngram_join import jaccard_components
from tableops.llm.packing import pack_documents
from tableops.llm.piece_bpe import encode_documents
from tableops.llm.quality import classify_quality
from tableops.llm.simhash import compare_edited
from tableops.llm.suffix_dedup import find_repeats


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return classify_quality(documents(spark, sf_dir), labels).drop("row_key")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_documents(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.select(
        outer_id("doc_id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2("id_text", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), end_id=1, limit=2048)


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir), k=4, percent=85)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = deduplicate_lines(documents(spark, sf_dir), min_chars=10)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(documents(spark, sf_dir)).drop("row_key")


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_repeats(documents(spark, sf_dir), min_words=50)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edited(documents(spark, sf_dir))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_passages(documents(spark, sf_dir), min_words=50, percent=80)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), top=10)


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_notices(documents(spark, sf_dir))
    joined = {name: F.concat_ws(",", name) for name in ("base_labels", "labels")}
    return found.withColumns(joined).drop("spans")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_packing": op3_packing,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_line_dedup": op6_line_dedup,
    "op7_language_id": op7_language_id,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_simhash": op9_simhash,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_lexical_search": op11_lexical_search,
    "op12_license_scan": op12_license_scan,
    "op13_filter_audit": op13_filter_audit,
}

ORACLE_SQL = {
    "op5_exact_dedup": r"""
        WITH digests AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents
        )
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept, text_sha256
        FROM digests WINDOW same AS (PARTITION BY text_sha256)
    """,
    "op6_line_dedup": """
        WITH lines AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
            FROM documents
        ), keyed AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM lines
        ), holders AS (
            SELECT key, min(doc_id) AS holder FROM keyed WHERE length(key) >= 10 GROUP BY key
        ), marked AS (
            SELECT keyed.*, coalesce(holder, doc_id) = doc_id AS stays FROM keyed LEFT JOIN holders USING (key)
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (stays), '')) AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
    "op11_lexical_search": r"""
        WITH asked AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark
        ), words AS (
            SELECT doc_id, unnest(regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM documents
        ), counts AS (
            SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term
        ), lengths AS (
            SELECT doc_id, CAST(sum(tf) AS BIGINT) AS length FROM counts GROUP BY doc_id
        ), totals AS (
            SELECT count(*) AS docs, CAST(sum(length) AS BIGINT) AS terms FROM lengths
        ), weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM counts CROSS JOIN totals WHERE term IN (SELECT term FROM asked) GROUP BY term
        ), scores AS (
            SELECT item_id, doc_id,
                   CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * length * docs) // terms)))) AS BIGINT) AS score
            FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN lengths USING (doc_id) CROSS JOIN totals
            GROUP BY item_id, doc_id
        ), ranked AS (
            SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
                   doc_id, score
            FROM scores WHERE score > 0
        )
        SELECT * FROM ranked WHERE rank <= 10
    """,
    "op13_filter_audit": r"""
        WITH marks AS (
            SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
            FROM labels GROUP BY doc_id
        ), texts AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ), cells AS (
            SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                   CASE WHEN len(words) < 50 THEN 1 ELSE 0 END
                   + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
                   + CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text) THEN 4 ELSE 0 END
                   + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
                   + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS cell
            FROM texts LEFT JOIN marks USING (doc_id)
        ), counts AS (
            SELECT part, cell, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM cells GROUP BY part, cell
        ), states AS (
            SELECT part, active, coalesce(sum(n) FILTER (cell & active = 0), 0) AS n,
                   coalesce(sum(good) FILTER (cell & active = 0), 0) AS good,
                   coalesce(sum(toxic) FILTER (cell & active = 0), 0) AS toxic
            FROM counts CROSS JOIN (SELECT unnest(range(32)) AS active) GROUP BY part, active
        ), letters AS (
            SELECT unnest(range(5)) AS i, substr('ABCDE', i + 1, 1) AS f, CAST(1 AS BIGINT) << i AS bit
        ), orders AS (
            SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
            FROM letters a, letters b, letters c, letters d, letters e
            WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
        ), steps AS (
            SELECT filter_order, step, bits[step] AS bit, list_sum(bits[1:step - 1]) AS before
            FROM orders CROSS JOIN (SELECT unnest(range(1, 6)) AS step)
        ), gone AS (
            SELECT x.part, filter_order, step, bit, y.n AS kept, x.n - y.n AS removed, x.good - y.good AS good_lost,
                   x.toxic - y.toxic AS toxic_lost
            FROM steps JOIN states x ON x.active = coalesce(before, 0)
            JOIN states y ON y.part = x.part AND y.active = coalesce(before, 0) | bit
        ), each AS (
            SELECT part, bit, coalesce(sum(n) FILTER (cell & bit > 0), 0) AS fails,
                   coalesce(sum(n) FILTER (cell = bit), 0) AS unique_fails
            FROM counts CROSS JOIN letters GROUP BY part, bit
        )
        SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
               CAST(fails - removed AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
               CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
               CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
        FROM gone JOIN each USING (part, bit)
    """,
}
