"""Differences between snapshots, and where rows came from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def diff(old: DataFrame, new: DataFrame, key: str, renamed: str | None = None, mapped: str | None = None) -> DataFrame:
    """(key, state): ADDED, REMOVED, RENAMED, REMAPPED, CHANGED or UNCHANGED, by a hash of the other columns."""
    rest = [c for c in old.columns if c != key]
    h = F.xxhash64(*rest)
    cols = [c for c in (renamed, mapped) if c]
    a = old.select(key, h.alias("_h1"), F.lit(True).alias("_in1"), *[F.col(c).alias(f"_1{c}") for c in cols])
    b = new.select(key, h.alias("_h2"), F.lit(True).alias("_in2"), *[F.col(c).alias(f"_2{c}") for c in cols])
    state = F.when(F.col("_in1").isNull(), "ADDED").when(F.col("_in2").isNull(), "REMOVED").when(F.col("_h1") == F.col("_h2"), "UNCHANGED")
    for c, name in ((renamed, "RENAMED"), (mapped, "REMAPPED")):
        if c:
            state = state.when(~F.col(f"_1{c}").eqNullSafe(F.col(f"_2{c}")), name)
    return a.join(b, key, "full").select(key, state.otherwise("CHANGED").alias("state"))


def delta(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """Old and new value, difference, and difference in per cent of the old."""
    d = old.select(key, F.col(value).alias("old")).join(new.select(key, F.col(value).alias("new")), key, "full")
    change = F.coalesce("new", F.lit(0)) - F.coalesce("old", F.lit(0))
    return d.select(key, "old", "new", change.alias("delta"), F.round(100 * change / F.nullif("old", F.lit(0)), 2).alias("delta_pct"))


def set_equal(a: DataFrame, b: DataFrame) -> bool:
    return a.exceptAll(b).limit(1).count() == 0 and b.exceptAll(a).limit(1).count() == 0


def first_wins(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def provenance_lookup(rows: DataFrame, uses: DataFrame, on: Sequence[str] = ("source_id", "entry_id", "term")) -> DataFrame:
    """rows with the concepts that used them, a row a concept, null if none did; keys are compared null-safely."""
    u = uses.select(*[F.col(c).alias(f"_{c}") for c in on], "concept_id").distinct()
    cond = F.lit(True)
    for c in on:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return rows.join(u, cond, "left").drop(*[f"_{c}" for c in on])


def provenance_union(df: DataFrame, key: str, column: str) -> DataFrame:
    """Per key the distinct elements of an array column."""
    return df.select(key, F.explode(column).alias("p")).distinct().groupBy(key).agg(F.array_sort(F.collect_list("p")).alias(column))
