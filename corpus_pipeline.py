"""A training corpus from ``documents``: quality rules, near-duplicates,
benchmark contamination, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again as the ``docs`` of the next. All but the last return
the columns that they were given. ``run`` does this in the shared scratch
folder, so a lost executor costs at most one stage.

Every stage handles null ids and texts (a null text is empty), repeated rows,
empty tables and further columns, which it carries along."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeshelf.llm import decontaminate, packing, pii, quality_rules, simhash
from lakeshelf.session import materialize, read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor the learned list rejects."""
    return quality_rules.filter_documents(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the smallest id."""
    return simhash.one_per_group(docs, shingle=3, radius=2)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item's window."""
    return decontaminate.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 token ids with their sequence and place."""
    return packing.pack_documents(docs)


STAGES = [("quality_rules", quality), ("simhash_dedup", near_duplicates), ("decontaminate", decontaminated),
          ("pii", redacted), ("packing", packed)]

#: No SQL: stages learn models, hash with XXH64 and tokenize; tests compare
#: the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
