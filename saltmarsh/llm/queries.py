"""The operators applied to the shared tables, each with its reference SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from saltmarsh.llm import (
    backoff, drift_clusters, exact_copies, host_reputation, main_text, manifest, packing, quality_model, reference_sql, rule_cascade,
    shingle_join, source_mix, token_codes, transducer,
)
from saltmarsh.llm.common import documents
from saltmarsh.llm.encoding import vocabulary_path
from saltmarsh.queries.registry import Entry, Run

ENTRIES: dict[str, Entry] = {}
WORDS = "word_bpe_49k.json"


def query(name: str, sql: str | None = None):
    def add(run: Run) -> Run:
        ENTRIES[name] = Entry(run, sql)
        return run

    return add


@query("op1_token_codes")
def op1_token_codes(spark: SparkSession, folder: str) -> DataFrame:
    return token_codes.token_table(documents(spark, folder), vocabulary_path(WORDS))


@query("op6_packing")
def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed_documents(documents(spark, folder), vocabulary_path(WORDS))


COPIES_SQL = r"""
WITH d AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM d
"""


@query("op8_exact_dedup", COPIES_SQL)
def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_copies.label_copies(documents(spark, folder))


def labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/labels.parquet")


@query("op7_quality_rules")
def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rule_cascade.judge(documents(spark, folder))


@query("op4_quality_classifier")
def op4_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_model.judge(documents(spark, folder), labels(spark, folder))


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/pages.parquet")


URL_RULES = [
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
]

URL_SQL = r"""
WITH cut AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
    SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(substr(rest, length(regexp_extract(rest, '^([^/?#]*)', 1)) + 1), '^([^?#]*)', 1) AS path FROM cut
), rules(rule, name, start, verdict) AS (
    VALUES ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
           ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'), ('com/de/', 'com', '/de/', 'block')
), ruled AS (
    SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
    FROM split LEFT JOIN rules ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, start)
    GROUP BY page_id, host, path
), hosts AS (
    SELECT host, array_to_string(parts[greatest(len(parts) - size, 0) + 1:], '.') AS domain,
           array_to_string(parts[greatest(len(parts) - size + 1, 0) + 1:], '.') AS suffix, n, bad
    FROM (SELECT *, CASE WHEN length(parts[-1]) = 2 AND parts[-2] IN ('ac', 'co', 'com', 'edu', 'gov', 'net', 'org') THEN 3 ELSE 2 END AS size
          FROM (SELECT host, string_split(regexp_replace(host, ':[0-9]*$', ''), '.') AS parts, count(verdict) AS n,
                       count(*) FILTER (WHERE verdict = 'block') AS bad FROM ruled GROUP BY host))
), total AS (SELECT (sum(bad) + 1) / (sum(n) + 2) AS prior FROM hosts),
s1 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, any_value(prior) AS prior FROM hosts, total GROUP BY suffix),
k1 AS (SELECT sum(n * (bad / n - prior) ** 2) AS seen, sum(prior * (1 - prior)) AS noise, sum(prior * (1 - prior) * (n - 1)) AS room FROM s1 WHERE n > 0),
m1 AS (SELECT suffix, (bad + w * prior) / (n + w) AS prior FROM s1,
       (SELECT CASE WHEN room > 0 AND seen > noise THEN least(greatest(room / (seen - noise) - 1, 1), 1e4) ELSE 1e4 END AS w FROM k1)),
s2 AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad, any_value(prior) AS prior FROM hosts JOIN m1 USING (suffix) GROUP BY domain, suffix),
k2 AS (SELECT sum(n * (bad / n - prior) ** 2) AS seen, sum(prior * (1 - prior)) AS noise, sum(prior * (1 - prior) * (n - 1)) AS room FROM s2 WHERE n > 0),
m2 AS (SELECT domain, suffix, (bad + w * prior) / (n + w) AS prior FROM s2,
       (SELECT CASE WHEN room > 0 AND seen > noise THEN least(greatest(room / (seen - noise) - 1, 1), 1e4) ELSE 1e4 END AS w FROM k2)),
s3 AS (SELECT host, n, bad, prior FROM hosts JOIN m2 USING (domain, suffix)),
k3 AS (SELECT sum(n * (bad / n - prior) ** 2) AS seen, sum(prior * (1 - prior)) AS noise, sum(prior * (1 - prior) * (n - 1)) AS room FROM s3 WHERE n > 0),
m3 AS (SELECT host, (bad + w * prior) / (n + w) AS mean, n + w AS weight FROM s3,
       (SELECT CASE WHEN room > 0 AND seen > noise THEN least(greatest(room / (seen - noise) - 1, 1), 1e4) ELSE 1e4 END AS w FROM k3))
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN mean - 1.645 * sqrt(mean * (1 - mean) / (weight + 1)) > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled JOIN m3 USING (host)
"""


@query("op3_url_reputation", URL_SQL)
def op3_url_reputation(spark: SparkSession, folder: str) -> DataFrame:
    return host_reputation.judge(pages(spark, folder), URL_RULES)


@query("op9_main_text")
def op9_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return main_text.extract(pages(spark, folder))


@query("op10_byte_bpe")
def op10_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return transducer.round_trip(documents(spark, folder), vocabulary_path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op2_shingle_join")
def op2_shingle_join(spark: SparkSession, folder: str) -> DataFrame:
    return shingle_join.near_copies(documents(spark, folder))


@query("op5_stupid_backoff")
def op5_stupid_backoff(spark: SparkSession, folder: str) -> DataFrame:
    return backoff.score(documents(spark, folder), vocabulary_path(WORDS), order=3)


@query("op11_merkle_manifest", reference_sql.MANIFEST)
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.verify_documents(documents(spark, folder))


@query("op12_source_mix", reference_sql.MIX)
def op12_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return source_mix.taken(documents(spark, folder))


@query("op13_drift_clusters", reference_sql.clusters())
def op13_drift_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return drift_clusters.cluster(spark.read.parquet(f"{folder}/embeddings.parquet"))
