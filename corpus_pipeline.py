"""A training corpus from raw documents: every stage's result is written as Parquet and is the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from codeloom.llm import decontaminate, exact, minhash, packing, toxicity
from codeloom.llm.tables import Store, read_table

STAGES = [
    ("toxicity", toxicity.stage),
    ("exact_dedup", exact.stage),
    ("near_dedup", minhash.stage),
    ("decontamination", decontaminate.stage),
    ("packing", packing.stage),
]

# Trained scores and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the table ``documents``."""
    store = Store(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = store.keep(stage(spark, docs, sf_dir))
    return docs
