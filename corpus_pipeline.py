"""A corpus pipeline: language, repeated lines, near duplicates, benchmark leaks, token ids.

Each stage works on what its predecessor kept. ``run`` writes every stage's result as Parquet in
the shared folder and reads it again as the next one's documents, so a lost executor repeats part
of one stage only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import bpe
from eventlake.llm.decontaminate import drop_contaminated
from eventlake.llm.jaccard_join import jaccard_links
from eventlake.llm.language_id import identify, train_text_model
from eventlake.llm.line_dedup import dedup_lines
from eventlake.llm.queries import table, vocabulary_path
from eventlake.llm.shared import prepare, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is accepted, labelled with it.

    The lang column is the declared language, the source stands for the address.
    """
    model = train_text_model(docs)
    found = identify(docs, model, "text", F.col("lang"), F.col("source"))
    kept = found.where("accepted").withColumn("lang", F.col("language"))
    return kept.select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the lines that many others have too."""
    cleaned = dedup_lines(docs)
    size = F.when(F.col("n_dropped") > 0, F.char_length("kept_text")).otherwise(F.col("n_chars"))
    return cleaned.withColumns({"text": F.col("kept_text"), "n_chars": size.cast("long")}).select(
        *docs.columns
    )


def keep_one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the least id.

    Rows that share that id all stay, and so do classes without any id: ids name documents.
    """
    links = jaccard_links(docs)
    gone = links.where("class_id IS NOT NULL").where(
        F.col("doc_id").isNull() | (F.col("doc_id") != F.col("class_id"))
    )
    return docs.join(
        gone.select(F.col("doc_id").alias("gone_id")).distinct(),
        F.col("doc_id").eqNullSafe(F.col("gone_id")),
        "left_anti",
    )


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have no passage of a benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens, digest of the ids, and digest of the text decoded from them."""
    return bpe.encode_digests(docs, vocabulary_path()).select(
        "doc_id", "lang", "source", "n_chars", "n_tokens", "ids_sha256", "decoded_sha256"
    )


STAGES: list[tuple[str, Stage]] = [
    ("language_id", keep_known_languages),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard", keep_one_of_each_class),
    ("decontamination", drop_benchmark_leaks),
    ("bpe", token_ids),
]

# Trained tables, hashing and a tokenizer decide what stays; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select(*DOCUMENT)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
