"""A training-corpus pipeline: quality, near copies, decontamination, personal data, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; its result is written as Parquet
and read again. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.llm import bpe, decontamination, jaccard, privacy, quality
from ladle.llm.common import crc, read, shared_folder


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose neighbours' votes reach 0.3; the labels of every fifth id are left out, as in its query."""
    taught = read(spark, sf_dir, "labels").filter(F.coalesce(crc("doc_id") % 5 != 0, F.lit(False)))
    model = quality.fit(docs, taught)
    kept = [c for c in docs.columns if c != "score"]
    return quality.score_documents(docs.select(*kept), model).filter("score >= 0.3").select(*docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of texts that share four fifths of their five-word shingles."""
    return jaccard.one_of_each(docs, k=5, percent=80)


def drop_benchmark_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    return decontamination.clean_documents(docs, read(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal values and the terms that give them away masked."""
    return privacy.sanitise(docs)


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as token ids; text is what the ids decode to."""
    coded = bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), decode=True)
    same = [F.col("decoded").alias("text") if c == "text" else F.col(c) for c in docs.columns if c not in {"ids", "n_tokens"}]
    return coded.select(*same, F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", one_of_near_copies),
    ("benchmark decontamination", drop_benchmark_texts),
    ("personal data", mask_personal_data),
    ("BPE encoding and decoding", encode_and_decode),
]

#: Classifier votes, PII rules and BPE merges have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = shared_folder(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = {"pipeline": run}
