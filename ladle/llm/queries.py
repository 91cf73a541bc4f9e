"""The registered queries of the training-data operators, with production parameters, and their check statements."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.llm import (
    bpe, conversations, decontamination, jaccard, language, privacy, quality, sharding, substrings, token_counts, tries, urls, vectors)
from ladle.llm.common import crc, read


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = F.coalesce(crc("doc_id") % 4 == 2, F.lit(False))
    model = language.fit(docs.filter(F.col("doc_id").isNotNull() & ~held_out).select("doc_id", "text", "lang"))
    return language.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vectors.integer_vectors(read(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return vectors.top_k(rows, rows.filter("vec_id % 20 = 0"), k=20)


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = privacy.find_personal_data(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"),
                        privacy.all_spans("base", "terms").alias("spans"))


def op4_similar_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_classes(read(spark, sf_dir, "documents"), k=4, percent=85)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 4096)


def op6_benchmark_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.overlaps(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "score")


def op7_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.remove_repeats(read(spark, sf_dir, "documents"), window=20)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(crc("doc_id") % 5 == 0, F.lit(False))
    model = quality.fit(docs, read(spark, sf_dir, "labels").filter(~held_out))
    return quality.score_documents(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), decode=True)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_contiguous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read(spark, sf_dir, "documents"), shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damaged(read(spark, sf_dir, "conversations")))


#: Rules of the URL query: (verdict, host, path).
URL_RULES = [
    (urls.ALLOW, "org", "/"), (urls.BLOCK, "example.org", "/es/"), (urls.BLOCK, "example.org", "/en/1"),
    (urls.ALLOW, "com", "/fr/"), (urls.BLOCK, "com", "/de/"),
]


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(read(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tries.prefix_trie(tries.with_shared_heads(tries.sequences(read(spark, sf_dir, "conversations"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_language, op2_exact_top_k, op3_personal_data, op4_similar_classes, op5_token_counts, op6_benchmark_overlap, op7_repeated_spans, op8_quality, op9_byte_bpe, op10_contiguous_shards,
    op11_conversation_repair, op12_url_filter, op13_prefix_trie)
}

SQL: dict[str, str] = {
    "op2_exact_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS vector FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.vector, c.vector)::BIGINT AS score
            FROM v q JOIN v c ON len(q.vector) = len(c.vector) AND q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
        )
        SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
    "op4_similar_classes": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[ \x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS shingle
            FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM w WHERE len(ws) > 0)
        ), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
        ), pairs AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b USING (shingle)
            WHERE a.doc_id <> b.doc_id GROUP BY 1, 2
        ), links AS (
            SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
            WHERE 100 * common >= 85 * (x.n + y.n - common)
        ), reach AS (
            SELECT doc_id AS node, doc_id AS seen FROM documents
            UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.seen
        )
        SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.seen) AS component_id
        FROM documents d JOIN reach r ON r.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
    """,
    "op6_benchmark_overlap": r"""
        WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS ws FROM documents
        ), items AS (
            SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS ws FROM benchmark
        ), b AS (SELECT * FROM items WHERE len(ws) >= 9
        ), short AS (
            SELECT doc_id, item_id, len(i.ws)::BIGINT AS score FROM d JOIN items i ON len(i.ws) BETWEEN 1 AND 8
                AND contains(' ' || array_to_string(d.ws, ' ') || ' ', ' ' || array_to_string(i.ws, ' ') || ' ')
        ), masks AS (SELECT unnest([[0, 1, 3, 4, 6, 8], [0, 2, 4, 5, 7, 8]]) AS m
        ), ds AS (
            SELECT doc_id, i, m, array_to_string(list_transform(m, lambda j: ws[i + j]), ' ') AS seed
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 7)) AS i FROM d WHERE len(ws) >= 9), masks
        ), bs AS (
            SELECT item_id, i, m, array_to_string(list_transform(m, lambda j: ws[i + j]), ' ') AS seed
            FROM (SELECT item_id, ws, unnest(range(1, len(ws) - 7)) AS i FROM b), masks
        ), hits AS (
            SELECT DISTINCT doc_id, item_id, ds.i - bs.i AS diagonal FROM ds JOIN bs ON ds.seed = bs.seed AND ds.m = bs.m
        ), steps AS (
            SELECT doc_id, item_id, diagonal, len(b.ws) AS size, j, CASE WHEN d.ws[j + diagonal] = b.ws[j] THEN 1 ELSE -2 END AS v
            FROM hits JOIN d USING (doc_id) JOIN b USING (item_id), unnest(range(greatest(1, 1 - diagonal), least(len(b.ws), len(d.ws) - diagonal) + 1)) t(j)
        ), sums AS (
            SELECT *, sum(v) OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY j) AS total FROM steps
        ), runs AS (
            SELECT *, total - least(0, coalesce(min(total) OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY j
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS run FROM sums
        ), found AS (
            SELECT doc_id, item_id, max(run)::BIGINT AS score FROM runs GROUP BY doc_id, item_id, diagonal
            HAVING max(run) >= least(13, max(size)) OR 100 * count_if(v = 1) >= 80 * max(size)
            UNION ALL SELECT * FROM short
        )
        SELECT doc_id, item_id, max(score)::BIGINT AS score FROM found GROUP BY doc_id, item_id
    """,
    "op7_repeated_spans": r"""
        WITH w AS (
            SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
        ), windows AS (
            SELECT doc_id, s, md5(array_to_string(ws[s:s + 19], ' ')) AS k
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS s FROM w WHERE len(ws) >= 20)
        ), firsts AS (SELECT k, min({'d': doc_id, 's': s}) AS f FROM windows GROUP BY k
        ), gone AS (
            SELECT DISTINCT doc_id, s + unnest(range(20)) AS i FROM windows JOIN firsts USING (k) WHERE {'d': doc_id, 's': s} <> f
        ), words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w
        ), kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
        )
        SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM w LEFT JOIN kept USING (doc_id)
    """,
}
