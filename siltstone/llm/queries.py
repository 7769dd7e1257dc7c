"""Registered queries of the package, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.byte_contexts import predict_languages
from siltstone.llm.centroids import centroid_clusters
from siltstone.llm.fingerprints import fingerprints
from siltstone.llm.html_text import extract_text
from siltstone.llm.license_scan import license_scan
from siltstone.llm.mixing import mix_sources
from siltstone.llm.quality import quality_scores
from siltstone.llm.secret_scan import secret_scan
from siltstone.llm.sentencepiece_codec import encode
from siltstone.llm.set_join import jaccard_components
from siltstone.llm.sharding import shards
from siltstone.llm.vector_codes import vector_codes
from siltstone.llm.vector_dedup import near_vectors

#: The vocabulary of public BPE pieces; read on the driver only.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = encode(docs, MODEL, decoded="decoded")
    return both.select(
        "doc_id", F.coalesce(F.size("pieces"), F.lit(0)).cast("bigint").alias("n_pieces"), "pieces",
        F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("key")


def op8_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).drop("key")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    learned = docs.where((remainder != 2) & F.col("lang").isNotNull())
    return predict_languages(docs.select("doc_id", "text"), learned.select("text", "lang"), "doc_id").select(
        "doc_id", F.coalesce(remainder == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {fn.__name__: fn for fn in (
    op1_sentencepiece, op2_license_scan, op3_fingerprints, op4_html_text, op5_shards, op6_secret_scan, op7_quality,
    op8_near_vectors, op9_mix_sources, op10_jaccard_join, op11_language_id, op12_vector_codes, op13_centroids)}

#: Floored mean of integers in DuckDB, whose // rounds toward zero.
_FLOOR = "list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY pos)"
#: Squared distance of two lists of integers, exact in doubles.
_FAR = "CAST(list_inner_product(a.x, a.x) - 2 * list_inner_product(a.x, b.x) + list_inner_product(b.x, b.x) AS BIGINT)"


def _integers(scale: int, where: str = "") -> str:
    return f"""
SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS x FROM embeddings
WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 {where}"""


def _codes_sql(rounds: int = 4) -> str:
    steps = []
    for at in range(rounds + 1):
        steps.append(f"""near{at} AS MATERIALIZED (
    SELECT a.vec_id, a.p, min({_FAR} * 256 + b.e) AS k FROM parts a JOIN book{at} b ON a.p = b.p GROUP BY a.vec_id, a.p)""")
        if at < rounds:
            steps.append(f"""mean{at} AS (
    SELECT p, e, {_FLOOR} AS x FROM (
        SELECT p, e, pos, sum(CAST(v AS BIGINT)) AS s, count(*) AS n FROM (
            SELECT parts.p, k % 256 AS e, generate_subscripts(x, 1) AS pos, unnest(x) AS v
            FROM parts JOIN near{at} ON parts.vec_id = near{at}.vec_id AND parts.p = near{at}.p) GROUP BY p, e, pos)
    GROUP BY p, e),
book{at + 1} AS MATERIALIZED (
    SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM book{at} b LEFT JOIN mean{at} m ON b.p = m.p AND b.e = m.e)""")
    return f"""WITH good AS ({_integers(1024)}),
parts AS MATERIALIZED (
    SELECT vec_id, label, p, x[p * (len(x) // 4) + 1 : (p + 1) * (len(x) // 4)] AS x FROM good, range(4) AS t(p)),
book0 AS MATERIALIZED (
    SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x FROM parts
    WHERE vec_id IN (SELECT vec_id FROM good ORDER BY vec_id LIMIT 256)),
{"," .join(steps)},
coded AS (
    SELECT vec_id, string_agg(lpad(lower(to_hex(k % 256)), 2, '0'), '' ORDER BY p) AS code, CAST(sum(k // 256) AS BIGINT) AS error
    FROM near{rounds} GROUP BY vec_id),
books AS (
    SELECT sha256(string_agg(array_to_string(list_transform(x, lambda v: CAST(CAST(v AS BIGINT) AS VARCHAR)), ','), ','
        ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds})
SELECT good.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM good JOIN coded ON good.vec_id = coded.vec_id, books"""


def _centroids_sql(rounds: int = 3) -> str:
    steps = []
    for at in range(rounds + 1):
        steps.append(f"""near{at} AS MATERIALIZED (
    SELECT a.vec_id, min({_FAR} * 16 + b.e) AS k FROM good a, book{at} b GROUP BY a.vec_id)""")
        if at < rounds:
            steps.append(f"""mean{at} AS (
    SELECT e, {_FLOOR} AS x FROM (
        SELECT e, pos, sum(CAST(v AS BIGINT)) AS s, count(*) AS n FROM (
            SELECT k % 16 AS e, generate_subscripts(x, 1) AS pos, unnest(x) AS v FROM good JOIN near{at} USING (vec_id))
        GROUP BY e, pos) GROUP BY e),
book{at + 1} AS MATERIALIZED (SELECT b.e, coalesce(m.x, b.x) AS x FROM book{at} b LEFT JOIN mean{at} m ON b.e = m.e)""")
    return f"""WITH good AS MATERIALIZED ({_integers(64, "AND len(embedding) = 64")}),
book0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS e, x FROM good
    QUALIFY row_number() OVER (ORDER BY sha256('1:' || vec_id)) <= 16),
{",".join(steps)},
found AS (SELECT vec_id, k % 16 AS e, k // 16 AS distance FROM near{rounds})
SELECT vec_id, CAST(f.e AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
    CAST(sum(distance) OVER (PARTITION BY f.e) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
    sha256(array_to_string(list_transform(b.x, lambda v: CAST(CAST(v AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256
FROM found f JOIN book{rounds} b ON f.e = b.e"""


ORACLES: dict[str, str] = {
    "op12_vector_codes": _codes_sql(),
    "op13_centroids": _centroids_sql(),
    "op10_jaccard_join": r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END AS s FROM texts),
features AS (SELECT doc_id, len(s) AS n, unnest(s) AS f FROM sets),
links AS (
    SELECT x.doc_id AS a, y.doc_id AS b FROM features x JOIN features y ON x.f = y.f AND x.doc_id <> y.doc_id
    GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
reach AS (
    SELECT doc_id AS a, doc_id AS b FROM sets
    UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT doc_id, len(s) AS n_shingles, (SELECT min(b) FROM reach WHERE a = doc_id) AS component_id FROM sets
""",
    "op8_near_vectors": """
WITH RECURSIVE good AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y
    ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v) AND list_cosine_similarity(x.v, y.v) >= 0.9),
reach AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
found AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = found.vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM found
""",
}
