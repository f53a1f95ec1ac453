"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from marquee.llm.alignment import alignment_digest
from marquee.llm.cover_tree import near_duplicates
from marquee.llm.decontamination import leaked_passages
from marquee.llm.exact_dedup import mark_exact_copies
from marquee.llm.jaccard_join import jaccard_components
from marquee.llm.personal_data import personal_data
from marquee.llm.pieces import encode_texts
from marquee.llm.quality import fit_quality, score_quality
from marquee.llm.sharding import assign_shards
from marquee.llm.token_counts import count_tokens
from marquee.llm.toxicity import fit_toxicity, score_toxicity
from marquee.llm.url_filter import judge_urls
from marquee.llm.vector_codes import compress_vectors

PIECE_MODEL, BYTE_LEVEL = "piece_bpe_32k.model", "byte_bpe_50k.json"


# Fixed rules of the URL query: verdict, then host and path.
URL_RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def piece_model() -> bytes:
    with open(public_tokenizers.path(PIECE_MODEL), "rb") as file:
        return file.read()


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaked_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), words=4, threshold=85)


def personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


def pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(table(spark, sf_dir, "documents"), piece_model())


def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents"))


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), piece_model())


def vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress_vectors(table(spark, sf_dir, "embeddings"))


def alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path(BYTE_LEVEL), encoding="utf-8") as file:
        return alignment_digest(table(spark, sf_dir, "documents"), file.read(), piece_model())


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_exact_copies(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_decontamination": decontamination,
    "op2_embedding_duplicates": embedding_duplicates,
    "op3_jaccard_join": jaccard_join,
    "op4_personal_data": personal,
    "op5_url_filter": url_filter,
    "op6_toxicity": toxicity,
    "op7_quality": quality,
    "op8_pieces": pieces,
    "op9_sharding": sharding,
    "op10_token_counts": token_counts,
    "op11_vector_codes": vector_codes,
    "op12_alignment": alignment,
    "op13_exact_dedup": exact_dedup,
    "pipeline": corpus_pipeline.run,
}

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _round_sql(k: int) -> str:
    """Assignment ``a<k>`` by codebooks ``c<k>``, and the codebooks after it."""
    return f"""a{k} AS (
            SELECT r, p, min(struct_pack(d, e)) AS best
            FROM (SELECT r, x.p, e, CAST(sum((x.v - c.v) * (x.v - c.v)) AS BIGINT) AS d
                  FROM cells x JOIN c{k} c ON x.p = c.p AND x.j = c.j GROUP BY r, x.p, e)
            GROUP BY r, p
        ), c{k + 1} AS (
            SELECT c.p, c.e, c.j, coalesce(u.v, c.v) AS v
            FROM c{k} c LEFT JOIN (
                SELECT x.p, a.best.e AS e, x.j, CAST((sum(x.v) - ((sum(x.v) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS v
                FROM cells x JOIN a{k} a ON x.r = a.r AND x.p = a.p GROUP BY x.p, a.best.e, x.j
            ) u ON c.p = u.p AND c.e = u.e AND c.j = u.j
        )"""


SQL = {
    "op2_embedding_duplicates": """
        WITH RECURSIVE vectors AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
        ), usable AS (
            SELECT vec_id, v FROM vectors
            WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(v, lambda x: x <> 0)) > 0
        ), links AS (
            SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y ON x.vec_id <> y.vec_id
            WHERE len(x.v) = len(y.v) AND list_cosine_similarity(x.v, y.v) >= 0.95
        ), reached AS (
            SELECT vec_id AS a, vec_id AS b FROM vectors
            UNION
            SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
        ), smallest AS (
            SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a
        )
        SELECT vec_id, (SELECT count(*) FROM links l WHERE l.a = s.vec_id) AS n_links, component_id,
               component_id = vec_id AS kept
        FROM smallest s""",
    "op3_jaccard_join": rf"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), shingles AS (
            SELECT doc_id, list_distinct(CASE
                WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))
                WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
            FROM words
        ), tokens AS (
            SELECT doc_id, len(s) AS n, unnest(s) AS token FROM shingles
        ), links AS (
            SELECT x.doc_id AS a, y.doc_id AS b
            FROM tokens x JOIN tokens y ON x.token = y.token AND x.doc_id <> y.doc_id
            GROUP BY x.doc_id, y.doc_id, x.n, y.n
            HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
        ), reached AS (
            SELECT doc_id AS a, doc_id AS b FROM documents
            UNION
            SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
        ), smallest AS (
            SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a
        )
        SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id FROM shingles JOIN smallest USING (doc_id)""",
    "op11_vector_codes": f"""
        WITH given AS (
            SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
        ), kept AS (
            SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
                   list_transform(v, lambda x: CAST(floor(256 * x) AS BIGINT)) AS v
            FROM given WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), cells AS (
            SELECT r, (i * 16) // len(v) AS p, i % (len(v) // 16) AS j, v[i + 1] AS v
            FROM kept, LATERAL (SELECT unnest(range(len(v))) AS i)
        ), c0 AS (
            SELECT p, r - 1 AS e, j, v FROM cells WHERE r <= 64
        ), {_round_sql(0)}, {_round_sql(1)}, {_round_sql(2)}, coded AS (
            SELECT vec_id, label, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
            FROM a2 JOIN kept USING (r) GROUP BY r, vec_id, label
        )
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY p, e, j)) FROM c2) AS codebooks_sha256
        FROM coded""",
    "op13_exact_dedup": r"""
        WITH plain AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
        )
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept, sha256(t) AS text_sha256
        FROM plain WINDOW same AS (PARTITION BY t)""",
}
