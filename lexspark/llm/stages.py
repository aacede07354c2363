"""The pipeline's stages: each applies one operator to the whole of what the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.llm.common import WORD_CHAR, Scratch, checked_broadcast
from lexspark.llm.line_dedup import remove_repeated_lines
from lexspark.llm.minhash import find_near_duplicates
from lexspark.llm.mixing import mix
from lexspark.llm.packing import op10_best_fit_packing
from lexspark.llm.quality_rules import apply_quality_rules

#: Percent of shingles that documents share to be near duplicates in the pipeline.
NEAR = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule rejects go."""
    return apply_quality_rules(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go, and documents of which no word is left."""
    row = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    out = remove_repeated_lines(row).filter(F.col("_ld_removed").isNull() | F.col("text").rlike(WORD_CHAR))
    return out.select(*[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, of NEAR percent, stays: the one with the smallest doc_id.

    Rows that share a doc_id are one document; of such rows the least text stays, and of rows with
    that text the one whose other columns come first as JSON. Only rows of repeated ids are grouped.
    """
    scratch = Scratch(spark, "near-dedup-stage")
    gone = scratch.store(find_near_duplicates(docs, NEAR).filter(~F.col("kept")).select("doc_id").distinct(), "gone")
    again = scratch.store(docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated-ids")
    gone, again = checked_broadcast(gone, 16), checked_broadcast(again, 16)
    left = docs.join(gone, "doc_id", "left_anti")
    every, rest = [F.col(f"`{c}`") for c in docs.columns], [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    others = F.to_json(F.struct(*rest)) if rest else F.lit("")
    one = left.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(F.struct(*every), F.struct("text", others)).alias("row"))
    return left.join(again, "doc_id", "left_anti").select(*every).union(one.select("row.*"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them, each shard shuffled."""
    return mix(docs).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in their sequences; a document taken twice is packed twice."""
    return op10_best_fit_packing(docs)
