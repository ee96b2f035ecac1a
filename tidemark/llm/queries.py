"""Registered queries of the corpus operators: thin calls over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, language_id, minhash, packing, quality, sharding, simhash, suffix_dedup, url_filter, vector_join
from tidemark.llm.common import Scratch, table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.dedup(table(spark, sf_dir, "documents"), Scratch(spark))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op2_vector_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_join.link(table(spark, sf_dir, "embeddings"), Scratch(spark))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), Scratch(spark))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs, ~language_id.held_out())
    return language_id.predict(docs, model).select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), Scratch(spark), words=2)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), ~quality.held_out(), Scratch(spark))
    return quality.score(docs, model).select("doc_id", quality.held_out().alias("held_out"), F.col("quality_score").alias("score"), "predicted")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents")).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.compare_with_edits(table(spark, sf_dir, "documents"), Scratch(spark))


def op10_k_d_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(table(spark, sf_dir, "documents"), Scratch(spark))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_vector_join": op2_vector_join,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_url_filter": op4_url_filter,
    "op5_language_id": op5_language_id,
    "op6_minhash": op6_minhash,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_simhash": op9_simhash,
    "op10_k_d_sharding": op10_k_d_sharding,
}

#: Smallest id reachable over links (a, b) in both directions, for ids that have any.
REACH = "reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a), least AS (SELECT a AS id, least(a, min(b)) AS c FROM reach GROUP BY a)"

ORACLES: dict[str, str] = {
    # each string of 100 bytes by its digest; starts of later copies; their covers as runs; what lies between the runs
    "op1_suffix_dedup": """WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents), n AS (SELECT doc_id, h, CAST(length(h) // 2 AS BIGINT) AS n FROM b),
        s AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS s FROM n, unnest(range(0, n - 99)) AS r(i)),
        later AS (SELECT doc_id, i FROM s QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1),
        marked AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER w + 100 THEN 0 ELSE 1 END AS fresh FROM later WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
        numbered AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM marked),
        spans AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS z FROM numbered GROUP BY doc_id, k),
        parts AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans),
        found AS (SELECT doc_id, sum(z - a) AS gone, count(*) AS spans, max(z) AS last, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept FROM parts JOIN n USING (doc_id) GROUP BY doc_id)
        SELECT doc_id, n AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(concat(coalesce(kept, ''), substr(h, 2 * coalesce(last, 0) + 1)))) AS kept_sha256 FROM n LEFT JOIN found USING (doc_id)""",
    "op2_vector_join": f"""WITH RECURSIVE v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        good AS (SELECT * FROM v WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_inner_product(e, e) > 0),
        link AS (SELECT p.id AS a, q.id AS b FROM good p JOIN good q ON p.id <> q.id AND len(p.e) = len(q.e) AND list_cosine_similarity(p.e, q.e) >= 0.95), {REACH},
        n AS (SELECT a AS id, count(*) AS n FROM link GROUP BY a)
        SELECT v.id AS vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, coalesce(least.c, v.id) AS component_id, coalesce(least.c, v.id) = v.id AS kept FROM v LEFT JOIN n USING (id) LEFT JOIN least USING (id)""",
    "op6_minhash": f"""WITH RECURSIVE w AS (SELECT doc_id AS id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
        s AS (SELECT DISTINCT id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS s FROM (SELECT id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM w WHERE len(w) > 0)),
        n AS (SELECT id, count(*) AS n FROM s GROUP BY id),
        both_sides AS (SELECT p.id AS a, q.id AS b, count(*) AS m FROM s p JOIN s q ON p.s = q.s AND p.id <> q.id GROUP BY 1, 2),
        link AS (SELECT a, b FROM both_sides JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE 100 * m >= 80 * (x.n + y.n - m)), {REACH}
        SELECT w.id AS doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(least.c, w.id) AS component_id, coalesce(least.c, w.id) = w.id AS kept FROM w LEFT JOIN n USING (id) LEFT JOIN least USING (id)""",
}
