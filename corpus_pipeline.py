"""The corpus pipeline: five stages over ``documents``, each written and read again.

Every stage takes rows with nulls in any column, empty and very long texts,
equal ids and repeated rows, an empty table and columns of any name besides
``doc_id``, ``text`` and ``source``; those columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from creditlens.llm import decontaminate, mixing, quality, simhash, token_files
from creditlens.llm.common import store
from creditlens.sources.tables import Tables


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base or the learned decision list rejects go.  Null,
    empty and wordless texts are rejected by the base; repeated rows are judged alike."""
    return quality.keep_good(docs, Tables(spark, sf_dir).labels)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the one with the smallest id
    (null ids last, then by hash of the text).  Repeated rows are one; texts
    without a word share the fingerprint zero, so one of them stays."""
    return simhash.keep_one(docs, shingle=4, max_bits=4)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an occurring benchmark window go; null and wordless texts
    have none and stay, repeated rows go or stay together."""
    return decontaminate.keep_clean(docs, Tables(spark, sf_dir).benchmark, window=10)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per use that the mix makes of a document, none for those it leaves
    out.  A null source is one of its own; texts without words add nothing to
    a target; equal rows are taken together."""
    return mixing.repeat_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files; returns what they hold per row: ``doc_id, start, n_tokens,
    ids_crc32``.  Null and empty texts hold the end id alone; null ids come first."""
    return token_files.write_and_read(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("token_output", token_output),
]

#: The learned rules and the tokenizer have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = Tables(spark, sf_dir).documents
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
