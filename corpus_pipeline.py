"""Documents for training: five stages, each over all rows that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import join_known, kept
from siltstone.llm.mixing import mix_copies
from siltstone.llm.quality import keep_good
from siltstone.llm.queries import MODEL, table
from siltstone.llm.secret_scan import redact
from siltstone.llm.sentencepiece_codec import encode
from siltstone.llm.set_join import jaccard_rows
from siltstone.session import materialise, scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects, with their site's record, go."""
    return keep_good(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id, nulls last, then text hash.

    Rows are known by id and text, so rows that share an id, or have none, are told apart. Of equal rows outside any
    group (texts without words) one stays.
    """
    rows = materialise(jaccard_rows(docs).select("doc_id", "text_hash", "component"), "rows")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    stays, n_stays = kept(rows.where("component is not null").groupBy(F.col("component").alias("of")).agg(
        F.min(order).alias("stays")), "stays")
    others = join_known(rows.where("component is not null"), stays, n_stays, F.col("component") == F.col("of"))
    gone, n_gone = kept(others.where(
        "not (doc_id <=> stays.doc_id and text_hash = stays.text_hash)").select(
        F.col("doc_id").alias("gone"), F.col("text_hash").alias("gone_hash")).distinct(), "gone")
    twice, n_twice = kept(rows.groupBy("doc_id", "text_hash").agg(F.count("*").alias("rows")).where("rows > 1").select(
        F.col("doc_id").alias("twice"), F.col("text_hash").alias("twice_hash")), "twice")
    docs = docs.select(*COLUMNS)
    text_hash = F.xxhash64(docs["text"])
    stay = join_known(
        docs, gone, n_gone, docs["doc_id"].eqNullSafe(F.col("gone")) & (text_hash == F.col("gone_hash")), "left_anti")
    again = F.col("doc_id").eqNullSafe(F.col("twice")) & (F.xxhash64("text") == F.col("twice_hash"))
    once = join_known(stay, twice, n_twice, again, "left_anti")
    repeated = join_known(stay, twice, n_twice, again, "left_semi").dropDuplicates(["doc_id", "text"])
    return once.unionByName(repeated)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; every document stays."""
    clean = redact(docs.select(*COLUMNS))
    return clean.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text")).cast("bigint"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them."""
    return mix_copies(docs.select(*COLUMNS))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts as SentencePiece ids, beside the columns of documents."""
    return encode(docs.select(*COLUMNS), MODEL)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scans", secrets),
    ("mixing sources to target weights", mixing),
    ("SentencePiece encoding and decoding", pieces),
]

#: Models and near-duplicate groups are not expressible in SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage-{at}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
