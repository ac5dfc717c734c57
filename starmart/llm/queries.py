"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import (
    centroids,
    coder,
    jaccard,
    langid,
    lattice,
    lines,
    mixing,
    packing,
    quality,
    sharding,
    topk,
    variants,
    viterbi,
)
from starmart.sources.scratch import scratch_path


def table(spark: SparkSession, sf_dir: str, table_name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table_name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model, columns=["doc_id"]).select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= quality.THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.jaccard_components(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs)
    return langid.predict_language(docs, model, columns=["doc_id"]).select(
        "doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return viterbi.count_tokens(table(spark, sf_dir, "documents"), columns=["doc_id"])


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = topk.top_k(vectors, F.col("id") % 100 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op4_lattice_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return lattice.near_copy_report(vectors).withColumnRenamed("id", "vec_id")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    shards = sharding.shuffle_to_shards(docs, scratch_path(spark, "shards"), ["doc_id"])
    return shards.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.encode("text", "utf-8")), F.lit(0)).cast("long").alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    coder.write_token_files(table(spark, sf_dir, "documents"), path)
    return coder.read_token_files(spark, path).withColumnRenamed("id", "doc_id")


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix_sources(docs, ["doc_id"])


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.drop_common_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(table(spark, sf_dir, "documents"))


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))
    return found.withColumnRenamed("id", "vec_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_token_counts": op2_token_counts,
    "op3_exact_topk": op3_exact_topk,
    "op4_lattice_near_dups": op4_lattice_near_dups,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op7_language_id": op7_language_id,
    "op8_shards": op8_shards,
    "op9_token_files": op9_token_files,
    "op10_mix_sources": op10_mix_sources,
    "op11_line_dedup": op11_line_dedup,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_centroid_clusters": op13_centroid_clusters,
}


def _clusters_sql(count: int = centroids.CENTROIDS, rounds: int = centroids.ROUNDS) -> str:
    """The rounds one after the other; all numbers are whole and small enough to be exact doubles."""
    steps = [
        """kept AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        )""",
        f"""c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), vec_id) - 1 AS k, v
            FROM kept QUALIFY k < {count}
        )""",
    ]
    for n in range(rounds + 1):
        steps.append(f"""a{n} AS MATERIALIZED (
            SELECT r, min(struct_pack(d := d, k := k)) AS best FROM (
                SELECT r, k, list_inner_product(x.v, x.v) - 2 * list_inner_product(x.v, c.v)
                    + list_inner_product(c.v, c.v) AS d
                FROM kept x, c{n} c
            ) GROUP BY r
        )""")
        if n < rounds:
            steps.append(f"""c{n + 1} AS MATERIALIZED (
            SELECT k, coalesce(m.v, c.v) AS v FROM c{n} c LEFT JOIN (
                SELECT k, list(mean ORDER BY j) AS v FROM (
                    SELECT k, j, floor(sum(x) / count(*)) AS mean FROM (
                        SELECT best.k AS k, unnest(range(64)) AS j, unnest(v) AS x FROM kept JOIN a{n} USING (r)
                    ) GROUP BY k, j
                ) GROUP BY k
            ) m USING (k)
        )""")
    return f"""
        WITH {", ".join(steps)}
        SELECT vec_id, CAST(best.k AS INTEGER) AS cluster, CAST(best.d AS BIGINT) AS distance,
               CAST(sum(best.d) OVER (PARTITION BY best.k) AS BIGINT) AS cluster_inertia,
               CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(list_transform(c.v, lambda x: CAST(x AS BIGINT)), ',')) AS centroid_sha256
        FROM kept JOIN a{rounds} USING (r) JOIN c{rounds} c ON c.k = best.k
    """



#: SQL of the queries that SQL can express.
ORACLES: dict[str, str] = {
    "op3_exact_topk": """
        WITH sound AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), pairs AS (
            SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.v, d.v)::BIGINT AS score
            FROM sound q JOIN sound d ON len(q.v) = len(d.v) AND q.vec_id <> d.vec_id
            WHERE q.vec_id % 100 = 0
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n
            FROM pairs
        )
        SELECT query_id, n::INTEGER AS rank, vec_id, score FROM ranked WHERE n <= 10
    """,
    "op11_line_dedup": """
        WITH docs AS (
            SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
        ), lines AS (
            SELECT r, unnest(range(len(lines))) AS pos, unnest(lines) AS line FROM docs
        ), keyed AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM lines
        ), frequent AS (
            SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10
        ), kept AS (
            SELECT r, string_agg(line, chr(10) ORDER BY pos) AS text, count(*) AS n
            FROM keyed WHERE key NOT IN (SELECT key FROM frequent) GROUP BY r
        )
        SELECT doc_id, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - coalesce(n, 0) AS BIGINT) AS n_dropped,
               sha256(coalesce(text, '')) AS kept_sha256
        FROM docs LEFT JOIN kept USING (r)
    """,
    "op13_centroid_clusters": _clusters_sql(),
}
