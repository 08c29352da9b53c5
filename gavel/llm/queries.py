"""The thin queries over the test tables, one per operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gavel.llm import (
    bpe, language, neardup, neighbours, ngrams, packing, phrases, prefixtrie, quality, simhash, substrings, tokenfile, urls,
)
from gavel.session import work_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str, parts: int) -> F.Column:
    """crc32 of the id as text, modulo `parts`."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts


def op1_ngram_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all texts by a model of the texts outside fold 1 of 5."""
    found = ngrams.scored(table(spark, sf_dir, "documents"), fold("doc_id", 5) != 1)
    return found.select(
        "doc_id", (fold("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), neardup.NearParams())


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = packing.PackParams(public_tokenizers.path("word_bpe_49k.json"))
    return packing.packed(table(spark, sf_dir, "documents"), params).withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    file = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encoded(table(spark, sf_dir, "documents"), file, public_tokenizers.PATTERN, digests=True)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all texts, learned from the labelled rows outside fold 1 of 3."""
    docs = table(spark, sf_dir, "documents")
    model = language.learn(docs.where(fold("doc_id", 3) != 1).select("text", "lang"))
    found = language.identified(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "n_languages")


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark, "tokens")
    files = tokenfile.write_tokens(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"))
    return tokenfile.read_tokens(spark, files)


def op8_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.repetition(table(spark, sf_dir, "documents"), keep=["doc_id"])


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judged(pages, urls.rules_frame(spark)).select("page_id", "host", "path", "rule", "verdict")


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_scores": op1_ngram_scores,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_packing": op3_packing,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_language": op5_language,
    "op6_substrings": op6_substrings,
    "op7_token_files": op7_token_files,
    "op8_repetition": op8_repetition,
    "op9_urls": op9_urls,
    "op10_neighbours": op10_neighbours,
    "op11_collocations": op11_collocations,
    "op12_simhash": op12_simhash,
    "op13_prefix_trie": op13_prefix_trie,
}
