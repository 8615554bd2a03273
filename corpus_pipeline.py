"""The corpus pipeline: its stages in order, each over all that the one before kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstack.llm import sentencepiece_unigram as spu
from fieldstack.llm.common import stash
from fieldstack.llm.language_mixture import language_mixture, learn_profiles
from fieldstack.llm.line_dedup import line_dedup
from fieldstack.llm.minhash_dedup import near_duplicates
from fieldstack.llm.mixing import temperature_mix
from fieldstack.session import checkpoint_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
MIN_SHARE = 0.5         # of a document's words in its main language
MAX_REPETITION = 2.0    # showings of the least frequent source


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7. Documents without a letter, and those that no language has half of, go. A missing lang is filled in."""
    profiles = learn_profiles(docs.select("text", "lang"))
    found = language_mixture(docs.select(*COLUMNS), profiles)
    return found.where(f"li_lang <> 'und' and li_score >= {MIN_SHARE}").withColumn(
        "lang", F.coalesce("lang", "li_lang")).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10. A text that loses lines keeps the rest; n_chars follows the new text."""
    return line_dedup(docs.select(*COLUMNS)).withColumn(
        "n_chars", F.expr("if(ld_dropped > 0, cast(length(text) as bigint), n_chars)")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4. The document with the least doc_id of each group of near copies stays. Where ids are missing or repeated, a
    document is an id with a text, in this order and null last; rows that repeat both are one document."""
    docs = docs.select(*COLUMNS)
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("n"))
    if ids.where("doc_id is null or n > 1").isEmpty():
        gone = near_duplicates(docs.select("doc_id", "text"), shingle=5, percent=80).where("not kept").select("doc_id")
        return docs.join(gone, "doc_id", "left_anti")
    by = [F.col("doc_id").asc_nulls_last(), "text_hash"]
    names = docs.select("doc_id", F.xxhash64("text").alias("text_hash")).distinct().repartitionByRange(*by).sortWithinPartitions(*by)
    names = stash(names.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), F.monotonically_increasing_id().alias("row")), "names")
    keyed = docs.join(names, F.col("doc_id").eqNullSafe(F.col("id")) & (F.xxhash64("text") == F.col("hash"))).dropDuplicates(["row"])
    keyed = stash(keyed.select(*COLUMNS, "row"), "keyed")
    gone = near_duplicates(keyed.select(F.col("row").alias("doc_id"), "text"), shingle=5, percent=80).where("not kept").selectExpr("doc_id as row")
    return keyed.join(gone, "row", "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8. Small sources are repeated, the smallest twice; every document is shown at least once. The table's files and
    their rows are in training order: one epoch after the other, blocks as permuted."""
    order = ["mx_epoch", "mx_order", "doc_id"]
    return (temperature_mix(docs.select(*COLUMNS), repetition=MAX_REPETITION)
            .repartitionByRange(*order).sortWithinPartitions(*order).select(*COLUMNS))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2. Token ids, and whether they decode to the very text."""
    vocab = spu.load_vocabulary(spu.VOCABULARY)
    return spu.encode(docs.select(*COLUMNS), vocab, check="exact").selectExpr(
        "doc_id", "lang", "source", "n_chars", "cast(coalesce(array_size(token_ids), 0) as bigint) as n_tokens",
        "token_ids", "coalesce(exact, true) as exact")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("mix", mix_sources),
    ("tokenize", tokenize),
]

ORACLE_SQL = None   # mixtures, block permutations and Viterbi paths are no SQL: see tests/llm/test_pipeline.py


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a Parquet table in the shared folder, which the next one reads."""
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
