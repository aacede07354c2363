"""Reviewed patches laid over records, with checks for drift; review splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def apply_patches(records: DataFrame, patches: DataFrame, key: str = "concept_id", value: str = "target") -> DataFrame:
    """records with the value of the latest patch set, and its state: UNPATCHED, READY, ALREADY_APPLIED or DRIFT.

    patches: key, old, new, patch_set (the highest number takes precedence). DRIFT leaves the value.
    """
    p = patches.groupBy(key).agg(F.max_by(F.struct("old", "new"), "patch_set").alias("p"))
    d = records.join(p, key, "left")
    state = F.when(F.col("p").isNull(), "UNPATCHED").when(F.col(value).eqNullSafe(F.col("p.new")), "ALREADY_APPLIED").when(F.col(value).eqNullSafe(F.col("p.old")), "READY").otherwise("DRIFT")
    d = d.withColumn("patch_state", state)
    return d.withColumn(value, F.when(F.col("patch_state") == "READY", F.col("p.new")).otherwise(F.col(value))).drop("p")


def validate_patches(records: DataFrame, patches: DataFrame, key: str = "concept_id", value: str = "target") -> DataFrame:
    """finding(code, entity_id, patch_set): unknown id, duplicate in a set, blank or unchanged value, drift."""
    n = patches.groupBy("patch_set", key).agg(F.count("*").alias("n"), F.first("old").alias("old"), F.first("new").alias("new"))
    d = n.join(records.select(key, F.col(value).alias("_now"), F.lit(True).alias("_known")), key, "left")
    codes = F.array_compact(F.array(
        F.when(F.col("_known").isNull(), "unknown-id"), F.when(F.col("n") > 1, "duplicate-id"), F.when(F.coalesce(F.trim("new") == "", F.lit(True)), "blank-value"),
        F.when(F.col("new").eqNullSafe(F.col("old")), "unchanged-value"), F.when(F.col("_known") & ~F.col("_now").eqNullSafe(F.col("old")) & ~F.col("_now").eqNullSafe(F.col("new")), "drift")))
    return d.select(F.col(key).alias("entity_id"), "patch_set", F.explode(codes).alias("code"))


def review_split(all_ids: DataFrame, reviewed: DataFrame, key: str = "concept_id") -> DataFrame:
    """Each id of either side as REVIEWED, REMAINING or UNKNOWN (reviewed but not in the set)."""
    a = all_ids.select(key).distinct().withColumn("_a", F.lit(True))
    b = reviewed.select(key).distinct().withColumn("_b", F.lit(True))
    part = F.when(F.col("_a") & F.col("_b"), "REVIEWED").when(F.col("_a"), "REMAINING").otherwise("UNKNOWN")
    return a.join(b, key, "full").select(key, part.alias("part"))


def joined_sets(patches: DataFrame, expected: DataFrame, key: str = "concept_id") -> DataFrame:
    """Per id of the union of patch sets: sets, and state SINGLE, EXPECTED_OVERLAP, UNEXPECTED_OVERLAP or MISSING_OVERLAP.

    expected: the ids that several sets are known to share. The sets fit together if no id is in one
    of the last two states; an expected id that no set has is missing.
    """
    n = patches.groupBy(key).agg(F.count_distinct("patch_set").alias("sets"))
    d = n.join(expected.select(key).distinct().withColumn("_e", F.lit(True)), key, "full")
    many, known = F.coalesce("sets", F.lit(0)) > 1, F.col("_e").isNotNull()
    state = F.when(many & known, "EXPECTED_OVERLAP").when(many, "UNEXPECTED_OVERLAP").when(known, "MISSING_OVERLAP").otherwise("SINGLE")
    return d.select(key, F.coalesce("sets", F.lit(0)).alias("sets"), state.alias("state"))


def set_difference(a: DataFrame, b: DataFrame, key: str = "concept_id") -> DataFrame:
    """(id, side) of ids that one side alone has, LEFT or RIGHT; no row if the sets are equal."""
    left, right = a.select(key).distinct().withColumn("_a", F.lit(True)), b.select(key).distinct().withColumn("_b", F.lit(True))
    d = left.join(right, key, "full").filter("_a is null or _b is null")
    return d.select(key, F.when(F.col("_a"), "LEFT").otherwise("RIGHT").alias("side"))
