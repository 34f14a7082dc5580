"""The operators as queries over a directory of tables, with production parameters.

Each query takes the session and the directory, applies its operator to the whole table and derives its
result columns from what the operator returns.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import (
    byte_bpe, decontaminate, jaccard_join, language_id, lexical_search, quality_classifier, simhash, spelling,
    suffix_dedup, token_counts, token_files)
from tallyhouse.llm.line_rules import clean_lines
from tallyhouse.llm.text import read, text_crc
from tallyhouse.llm.url_rules import judge_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_multi_50k.tiktoken"
URL_RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block"))


def query(run):
    QUERIES[run.__name__] = run
    return run


@query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the labelled rows that are not held out."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    held_out = text_crc("doc_id") % 5 == 0
    model = quality_classifier.fit(docs, labels, ~held_out)
    return quality_classifier.score(docs, model).withColumn("held_out", held_out).select(
        "doc_id", "held_out", "score", "predicted")


@query
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and checksum, from the files that were written."""
    manifest = token_files.write_shards(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return token_files.read_documents(manifest)


@query
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and checksum of every document's ids, and the checksum of what they decode to."""
    return byte_bpe.encode_documents(read(spark, sf_dir, "documents"), public_tokenizers.path(RANKS),
                                     outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every occurrence of a benchmark item in a document; clean documents have no row."""
    return decontaminate.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every document's shingle set and the component of its near duplicates."""
    return jaccard_join.jaccard_components(read(spark, sf_dir, "documents"))


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The histogram of encoded lengths with its suffix sums, each length taken as a context limit."""
    lengths = token_counts.encoded_lengths(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return token_counts.length_histogram(lengths)


@query
def op7_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    found = clean_lines(read(spark, sf_dir, "documents"), with_text=False)
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        "base_failed", "kept")


@query
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document in strings of 50 bytes that also start in an earlier document."""
    return suffix_dedup.repeat_counts(read(spark, sf_dir, "documents"))


@query
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out."""
    docs = read(spark, sf_dir, "documents")
    model = language_id.fit(docs, text_crc("id") % 4 != 2)
    return language_id.predict(docs, model).select(
        "doc_id", (text_crc("doc_id") % 4 == 2).alias("held_out"), "lang_pred", "score")


@query
def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(read(spark, sf_dir, "pages"), rules)


@query
def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and the component of those that lie close."""
    return simhash.simhash_components(read(spark, sf_dir, "documents"))


@query
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word, the common word it is a variant of, and how many words lie one edit away."""
    return spelling.variants(read(spark, sf_dir, "documents"), typo=spelling.TYPO)


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best documents of every benchmark item."""
    return lexical_search.rank_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
