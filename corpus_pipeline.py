"""The corpus pipeline: language, quality, near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept; stages but the last return the columns of `documents`. Extra columns are
carried as they are, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gavel.llm import language, neardup, packing, quality, substrings
from gavel.llm.tables import stored, working_tables

LEAST_SCORE = 0.5  # share of a text that its language must have
ORACLE_SQL = None  # mixtures and packing have no SQL: tests/llm compares with brute force


READ = {"doc_id", "text", "lang", "n_chars"}  # columns that stages use


def _aside(docs: DataFrame) -> DataFrame:
    """`docs` with names that no operator adds for all columns that are only carried."""
    return docs.withColumnsRenamed({c: f"__own_{c}" for c in docs.columns if c not in READ})


def _back(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of `docs` under their names again."""
    return found.select(*[F.col(c if c in READ else f"__own_{c}").alias(c) for c in docs.columns])


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with one language that is most of their text; texts without a letter go."""
    model = language.learn(docs.select("text", "lang"))
    found = language.identified(_aside(docs), model)
    return _back(found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)), docs)


def repetition(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that neither are too short nor repeat themselves too much."""
    return _back(quality.repetition(_aside(docs)).where("kept"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group (shingles of five words, similarity 0.8).

    It is the row with the smallest doc_id; a row without id stays only if its
    whole group has none, and of rows with one id the least digest of the text
    decides. Groups are of rows, numbered in a stored table, so ids may repeat
    or lack. Rows without words are no group and all stay.
    """
    keep: list[DataFrame] = []
    with working_tables(keep):
        rows = stored(_aside(docs).withColumn("__row", F.monotonically_increasing_id()), "numbered")
        found = neardup.near_duplicates(rows.select(F.col("__row").alias("doc_id"), "text"), neardup.NearParams(words=5))
        found = stored(found.select(F.col("doc_id").alias("__row"), "component_id"), "groups")
        # The digest is taken where the text is, so that no text is shuffled for it.
        keys = rows.select("__row", "doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"))
        order = F.struct(F.col("doc_id").isNull(), "doc_id", "digest", "__row")
        first = keys.join(found, "__row").groupBy("component_id").agg(F.min(order).alias("first")).select("first.__row")
        gone = stored(found.select("__row").join(first, "__row", "left_anti"), "dropped")
        keep += [rows, gone]
    return _back(rows.join(gone, "__row", "left_anti"), docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes passages that an earlier document has, too; n_chars follows the text."""
    kept = substrings.without_repeats(_aside(docs), text_out=True)
    size = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return _back(kept.withColumn("n_chars", size.cast(docs.schema["n_chars"].dataType)), docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens, as pieces of documents."""
    params = packing.PackParams(public_tokenizers.path("word_bpe_49k.json"))
    return packing.packed(docs, params).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("language", languages), ("quality", repetition), ("near-duplicates", near_duplicates), ("passages", passages), ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        kept: list[DataFrame] = []
        with working_tables(kept):
            docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
            kept.append(docs)
    return STAGES[-1][1](spark, docs, sf_dir)
