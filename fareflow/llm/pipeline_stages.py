"""The stages of ``corpus_pipeline``: each takes (spark, docs, sf_dir) and returns a DataFrame."""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.llm import decontaminate, language, mixing, simhash, token_files
from fareflow.llm.common import free_name, table
from fareflow.session import work_dir

#: A text goes if its language holds less than this share of its n-grams: no known language at all.
MIN_LANGUAGE_SCORE = 0.2


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter, and those in none of the languages learnt from ``docs``.

    Without a labelled document there is no language to learn, and nothing is dropped.
    """
    model = language.fit(docs.where(~language.held_out()))
    if not model.languages:
        return docs
    (judged,) = free_name(docs, ["judged"])
    good = (F.col(f"{judged}.lang") != language.UNDETERMINED) & (F.col(f"{judged}.score") >= MIN_LANGUAGE_SCORE)
    return language.with_language(docs, model, out=judged).where(good).drop(judged)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near-duplicates."""
    return simhash.one_per_group(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the benchmark's passages contaminate."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order in which the sources are mixed to their target weights."""
    return mixing.in_mixed_order(docs, mixing.TARGETS, rest_weight=mixing.REST_TARGET)


def token_files_in_order(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the token files in the order the mixing stage wrote the rows; what the files hold per document.

    Rows that come from no file are taken by doc_id.
    """
    try:
        part, file, row = free_name(docs, ["_part", "_file", "_row"])
        # By the file's number: names are not in its order once numbers have more digits.
        name = F.col("_metadata.file_name")
        number = F.regexp_extract(name, r"part-(\d+)", 1).try_cast("long")
        docs = docs.select("*", number.alias(part), name.alias(file), F.col("_metadata.row_index").alias(row))
        order = [part, file, row]
    except AnalysisException:
        order = ["doc_id"]
    folder, vocabulary = work_dir(spark, "corpus-tokens"), public_tokenizers.path("byte_bpe_50k.json")
    files = token_files.write_token_files(docs, folder, vocabulary, end_id=2, order=order)
    return token_files.read_digests(spark, files)
