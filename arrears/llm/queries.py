"""The operators applied to whole tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.llm import block_naming, filter_audit, fuzzy_lines, hamming_join, imatch, nbest, packing, pii, pseudo_likelihood, records, rule_ensemble, warc, whitening
from arrears.llm.common import Scratch, documents
from arrears.llm.tokens import tokenizer_path


def op1_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(documents(spark, sf_dir), Scratch(spark, "op1"))


def op2_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scratch = Scratch(spark, "op2")
    return pseudo_likelihood.scored(docs, pseudo_likelihood.fit(docs, scratch), scratch=scratch)


def op3_hamming_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = hamming_join.near_duplicates(documents(spark, sf_dir), Scratch(spark, "op3"), shingle_words=2, percent=80)
    return near.select("doc_id", "n_shingles", "component_id", "kept")


def op4_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = rule_ensemble.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return rule_ensemble.scored(docs.select("doc_id", "text"), model).select(
        "doc_id", rule_ensemble.held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op5_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    left = fuzzy_lines.without_repeated_lines(docs, Scratch(spark, "op5"), lines_col="n_lines", dropped_col="n_dropped")
    return left.select("doc_id", "n_lines", "n_dropped", F.length("text").cast("bigint").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


def op6_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = records.write_records(documents(spark, sf_dir), Scratch(spark, "op6"), tokenizer_path("byte_bpe_50k.json"), end_id=0)
    return records.read_records(files)


def op7_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbest.encoded(documents(spark, sf_dir), nbest.model_path("piece_bpe_32k.model"), n_best=4)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"), end_id=1)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return pii.found(docs, pii.fit(docs))


def op10_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_naming.exact_groups(documents(spark, sf_dir), Scratch(spark, "op10"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "op11")
    warc.write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), scratch.path("archive"), scratch)
    return warc.read_archives(spark, scratch.path("archive"), with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return whitening.whitened(vectors, whitening.fit(vectors))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"), Scratch(spark, "op13"))


QUERIES = {f.__name__: f for f in (op1_imatch, op2_pseudo_likelihood, op3_hamming_join, op4_rule_ensemble, op5_fuzzy_lines, op6_records, op7_nbest, op8_packing, op9_pii, op10_block_naming,
                                   op11_warc, op12_whitening, op13_filter_audit)}

#: DuckDB SQL of the queries that SQL can express; the others are tested
#: against brute force in tests/llm.
ORACLE = {
    "op10_block_naming": r"""
        WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n_chars,
                          sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
                   FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               row_number() OVER w = 1 AS kept, text_sha256, n_chars
        FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id)""",
    "op11_warc": """
        WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
        g AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p),
        r AS (SELECT *, payload_bytes >= 100 AND first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id AS again FROM g)
        SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN again THEN first_id END AS refers_to FROM r""",
    "op13_filter_audit": r"""
        WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
        w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first_id FROM t),
        f AS (SELECT part, doc_id, [len(words) < 50,
                     100 * len(list_distinct(words)) < 65 * len(words),
                     100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text),
                     regexp_matches(text, '[#$%&*|]'),
                     coalesce(doc_id > first_id, false)] AS fails FROM w),
        l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
        m AS (SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
              FROM f LEFT JOIN l USING (doc_id) GROUP BY 1, 2),
        x(i) AS (VALUES (1), (2), (3), (4), (5)),
        o AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM x a, x b, x c, x d, x e
              WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
        s AS (SELECT o, array_to_string([substr('ABCDE', v, 1) FOR v IN o], '') AS filter_order, i AS step, o[i] AS own, o[1:i - 1] AS earlier FROM o, x),
        j AS (SELECT part, filter_order, step, own, n, good, toxic, fails[own] AS hit,
                     len([v FOR v IN earlier IF fails[v]]) > 0 AS before,
                     len([v FOR v IN fails IF v]) AS failing FROM m, s),
        g AS (SELECT part, filter_order, step, any_value(own) AS own,
                     sum(n) FILTER (NOT before AND NOT hit) AS kept, sum(n) FILTER (hit AND NOT before) AS removed,
                     sum(n) FILTER (hit AND before) AS redundant, sum(n) FILTER (hit AND failing = 1) AS unique_fails,
                     sum(good) FILTER (hit AND NOT before) AS good_lost, sum(toxic) FILTER (hit AND NOT before) AS toxic_lost
              FROM j GROUP BY 1, 2, 3)
        SELECT part, filter_order, CAST(step AS INT) AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
               coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
               coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
               sum(coalesce(removed, 0)) OVER (PARTITION BY part, own)::BIGINT AS shapley
        FROM g""",
}
