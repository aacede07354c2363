"""The corpus pipeline: documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir), is written as Parquet to the shared folder, and is reread
as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexspark.llm import stages
from lexspark.llm.common import Scratch, table

STAGES = [
    ("quality rules", stages.quality_rules),
    ("line dedup", stages.line_dedup),
    ("MinHash near-dedup", stages.minhash_near_dedup),
    ("mixing", stages.mixing),
    ("best-fit packing", stages.best_fit_packing),
]

#: Near-duplicate confirmation and seeded mixing are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole of documents."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.store(stage(spark, docs, sf_dir), f"stage-{k}")
    return docs
