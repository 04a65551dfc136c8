"""Registered queries opN_* (whole tables, production parameters) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def _table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from argent.llm.minhash import near_duplicates
    return near_duplicates(_table(spark, sf_dir, "documents", "doc_id", "text"), words=2)


def op2_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from argent.llm.embeddings import near_vectors
    return near_vectors(_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from argent.llm.line_dedup import line_dedup
    return line_dedup(_table(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", "text", "n_lines", "n_removed_lines")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from argent.llm.quality_rules import quality_rules
    out = quality_rules(_table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      "kept", "n_lines", "n_removed_lines", "n_lost_words")


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from argent.llm.lm_score import lm_scores
    good = _table(spark, sf_dir, "labels", "doc_id", "quality").where("quality = 1").select(F.col("doc_id").alias("id"))
    return lm_scores(_table(spark, sf_dir, "documents", "doc_id", "text"), good)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from argent.llm.suffix_dedup import drop_repeats
    return drop_repeats(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from argent.llm.mixing import mixing_plan
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return mixing_plan(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")


def _vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op8_bpe(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    from argent.llm.bpe import bpe_round_trip
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    out = bpe_round_trip(docs, vocabulary or _vocabulary("word_bpe_49k.json"), with_text=False)
    return out.select("doc_id", F.size("token_ids").cast("bigint").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    from argent.llm.html_extract import extract_main_text
    out = extract_main_text(_table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return out.select("page_id", "url", "text", "n_chars")


def op10_token_counts(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    from argent.llm.token_counts import token_counts
    out = token_counts(_table(spark, sf_dir, "documents", "doc_id", "text"), model or _vocabulary("piece_bpe_32k.model"))
    return out.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from argent.llm.warc import archive_pages
    out = archive_pages(_table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from argent.llm.spelling import near_words, word_counts
    return near_words(word_counts(_table(spark, sf_dir, "documents", "doc_id", "text"), drop_one_in=199))


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from argent.llm.negatives import hard_negatives
    vectors = _table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", shifted), F.col("vec_id") % 50 == 0)


QUERIES = {f.__name__: f for f in (op1_minhash, op2_embeddings, op3_line_dedup, op4_quality_rules, op5_lm_scoring, op6_suffix_dedup, op7_mixing, op8_bpe, op9_html_extract, op10_token_counts,
                                  op11_warc, op12_spelling, op13_negatives)}

ORACLES = {
    "op11_warc": r"""
        WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to FROM f""",
    "op13_negatives": r"""
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
                   FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
                     list_sum(list_transform(list_zip(a.e, b.e), lambda z: z[1] * z[2]))::BIGINT AS score
              FROM v a, v b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
        p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
        n AS (SELECT p.*, s.other AS negative_id, s.score AS negative_score,
                     row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other) AS rank
              FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
                AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
        SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3""",
    "op3_line_dedup": r"""
        WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
                   FROM documents),
        f AS (SELECT *, line SIMILAR TO '[\x20\x09-\x0D]*' AS blank FROM l),
        n AS (SELECT doc_id, i, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS p FROM f WHERE NOT blank),
        w AS (SELECT a.doc_id, a.p, md5(a.line) || md5(b.line) || md5(c.line) AS h FROM n a
              JOIN n b ON a.doc_id = b.doc_id AND b.p = a.p + 1 JOIN n c ON a.doc_id = c.doc_id AND c.p = a.p + 2),
        r AS (SELECT doc_id, p FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id, p) AS k FROM w) WHERE k > 1),
        g AS (SELECT DISTINCT n.doc_id, n.i FROM n JOIN r ON n.doc_id = r.doc_id AND n.p BETWEEN r.p AND r.p + 2),
        k AS (SELECT f.doc_id, string_agg(f.line, chr(10) ORDER BY f.i) FILTER (g.i IS NULL) AS text,
                     count(*) FILTER (NOT blank) AS n_lines, count(g.i) AS n_removed_lines
              FROM f LEFT JOIN g ON f.doc_id = g.doc_id AND f.i = g.i GROUP BY f.doc_id)
        SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
               coalesce(k.n_lines, 0)::BIGINT AS n_lines, coalesce(k.n_removed_lines, 0)::BIGINT AS n_removed_lines
        FROM documents d LEFT JOIN k ON d.doc_id = k.doc_id""",
    "op7_mixing": r"""
        WITH d AS (SELECT doc_id, source, md5(coalesce(text, '')) AS digest, row_number() OVER (PARTITION BY doc_id, source, text) AS place, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
        w AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
                     (2 * source_size)::DOUBLE AS cap, 1.5::DOUBLE * (SELECT sum(size) FROM d)::DOUBLE AS everything FROM s),
        -- a source stops below a level l when cap < l * weight; the level is the root of sum(min(cap, l * weight)) = everything
        stops AS (SELECT a.source,
                     (a.everything - coalesce(sum(b.cap) FILTER (b.cap / b.weight < a.cap / a.weight), 0))
                       / (sum(b.weight) FILTER (b.cap / b.weight >= a.cap / a.weight))::DOUBLE AS level,
                     a.cap / a.weight AS stop
                  FROM w a, w b GROUP BY a.source, a.everything, a.cap, a.weight),
        l AS (SELECT max(level) FILTER (level <= stop) AS level FROM stops),
        t AS (SELECT source, source_size, least(cap, coalesce(level * weight, cap)) AS target FROM w, l),
        r AS (SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
                     ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || digest || ':' || place), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE AS draw
              FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
        c AS (SELECT *, (floor(rate) + (draw < rate - floor(rate))::INT)::BIGINT AS copies FROM r)
        SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM c""",
}
