"""A training corpus from raw documents, in stages over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fareflow.llm import pipeline_stages as stages
from fareflow.llm.common import table, written

#: (name, function); a function takes (spark, docs, sf_dir), and its result is written and read again.
STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", stages.known_language),
    ("near duplicates", stages.one_of_each_group),
    ("decontamination", stages.uncontaminated),
    ("mixing", stages.mixed),
    ("token files", stages.token_files_in_order),
]

#: Fingerprints, learnt filters and tokenizers are beyond SQL; tests hold run() against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
