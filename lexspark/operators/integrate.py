"""One set of reviewed patches laid over several tables, all of them or none.

Each table has concept_id, a pivot name that identifies its rows, and a value. Which of the checks
hold for a table is told by its Rules. Findings come first; a patch set with any finding changes
nothing. The tables are then staged, compared with what they were, and committed as one version.

Patches and tables are as long as each other, so they meet by a shuffle of both (hint "merge"): a table
of few bytes on disk can have rows enough to fill a driver that broadcasts it.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.functions.text import is_blank
from lexspark.sources.versions import TableSet


@dataclass(frozen=True)
class Rules:
    """Of one table: whether its value must be a patch's old or new one, and what must hold of a patched row, in SQL."""

    drift: bool = True
    evidence: str | None = None


@dataclass(frozen=True)
class Integration:
    """tables: rules by name. key, pivot, value: columns of all tables. downstream: later patches, whose new value is left alone."""

    tables: Mapping[str, Rules]
    key: str = "concept_id"
    pivot: str = "pivot"
    value: str = "target"


class PatchRefused(RuntimeError):
    """A patch set with findings, or one whose result is not what it should be; nothing was changed."""


def _joined(table: DataFrame, patches: DataFrame, downstream: DataFrame | None, how: Integration) -> DataFrame:
    p = patches.select(F.col(how.key), F.struct(how.pivot, "old", "new").alias("_p")).dropDuplicates([how.key])
    return _with_later(table.join(p.hint("merge"), how.key, "left"), downstream, how)


def _with_later(d: DataFrame, downstream: DataFrame | None, how: Integration) -> DataFrame:
    """Adds _later, the new value of a later patch of the key."""
    if downstream is None:
        return d.withColumn("_later", F.lit(None).cast("string"))
    later = downstream.groupBy(how.key).agg(F.max("new").alias("_later"))
    return d.join(later.hint("merge"), how.key, "left")


def _settled(how: Integration) -> Column:
    """Whether a row has the new value already, or a later one."""
    return F.col(how.value).eqNullSafe(F.col("_p.new")) | F.coalesce(F.col(how.value) == F.col("_later"), F.lit(False))


def patch_findings(tables: Mapping[str, DataFrame], patches: DataFrame, how: Integration, downstream: DataFrame | None = None) -> DataFrame:
    """finding(code, entity_id, table) of patches (key, pivot, old, new) against all tables.

    duplicate-id, blank-value, unchanged-value; and by table missing-record, identity-mismatch,
    drift, evidence-mismatch. A repeated id is told once, and checked by one of its patches. The patches
    are grouped once, and meet all tables in one join.
    """
    c = F.col
    own = F.array_compact(F.array(F.when(F.count("*") > 1, "duplicate-id"), F.when(F.bool_or(is_blank("new")), "blank-value"), F.when(F.bool_or(c("new").eqNullSafe(c("old"))), "unchanged-value")))
    one = patches.groupBy(how.key).agg(F.min(F.struct(how.pivot, "old", "new")).alias("_p"), own.alias("_own"))
    # A row for each table that a patch is checked against, and one without a table for what is wrong with the patch itself.
    names = [F.lit(name) for name in how.tables]
    one = _with_later(one, downstream, how).withColumn("_table", F.explode(F.when(F.size("_own") > 0, F.array(F.lit(""), *names)).otherwise(F.array(*names))))
    rows = []
    for name, rules in how.tables.items():
        fits = F.lit(True) if rules.evidence is None else F.coalesce(F.expr(rules.evidence), F.lit(False))
        rows.append(tables[name].select(how.key, how.pivot, how.value, fits.alias("_fits"), F.lit(True).alias("_known"), F.lit(name).alias("_table")))
    d = one.join(reduce(DataFrame.union, rows).hint("merge"), [how.key, "_table"], "left")
    known, drifts = c("_known").isNotNull(), c("_table").isin([name for name, rules in how.tables.items() if rules.drift])
    hits = [
        F.when(~known, "missing-record"), F.when(known & ~c(how.pivot).eqNullSafe(c(f"_p.{how.pivot}")), "identity-mismatch"),
        F.when(known & drifts & ~c(how.value).eqNullSafe(c("_p.old")) & ~_settled(how), "drift"), F.when(known & ~c("_fits"), "evidence-mismatch"),
    ]
    codes = F.when(c("_table") == "", c("_own")).otherwise(F.array_compact(F.array(*hits)))
    return d.select(F.explode(codes).alias("code"), c(how.key).cast("string").alias("entity_id"), c("_table").alias("table"))


def patched(tables: Mapping[str, DataFrame], patches: DataFrame, how: Integration, downstream: DataFrame | None = None) -> dict[str, DataFrame]:
    """All tables with the new values; their other columns and rows as they are."""
    out = {}
    for name in how.tables:
        d = _joined(tables[name], patches, downstream, how)
        new = F.when(F.col("_p").isNull() | _settled(how), F.col(how.value)).otherwise(F.col("_p.new"))
        out[name] = d.select(*[new.alias(c) if c == how.value else F.col(f"`{c}`") for c in tables[name].columns])
    return out


def unrelated_changes(before: Mapping[str, DataFrame], after: Mapping[str, DataFrame], patches: DataFrame, how: Integration, downstream: DataFrame | None = None) -> DataFrame:
    """finding(code, entity_id, table) of what should not differ: rows lost or added, preserved columns, values without a patch, and patches that did not arrive.

    Rows are compared as multisets of hashes, one shuffle a table.
    """
    p = patches.select(F.col(how.key), F.lit(True).alias("_patched"), F.col("new").alias("_new")).dropDuplicates([how.key]).hint("merge")
    out = None
    for name in how.tables:
        columns = [c for c in before[name].columns if c != how.value]
        seen = lambda d, side: d.select(how.key, how.value, F.xxhash64(*[F.col(f"`{c}`") for c in columns]).alias("rest"), F.lit(side).alias("side"))  # noqa: B023, E731
        both = seen(before[name], 1).union(seen(after[name], -1)).join(p, how.key, "left")
        value = F.when(F.col("_patched"), F.lit(None).cast("string")).otherwise(F.col(how.value))
        changed = both.groupBy(how.key, "rest", value.alias("v")).agg(F.sum("side").alias("n")).filter("n <> 0").select(how.key).distinct()
        later = downstream.groupBy(how.key).agg(F.max("new").alias("_later")) if downstream is not None else None
        arrived = after[name].join(p, how.key)
        arrived = arrived.join(later.hint("merge"), how.key, "left") if later is not None else arrived.withColumn("_later", F.lit(None).cast("string"))
        lost = arrived.filter(~F.col(how.value).eqNullSafe(F.col("_new")) & ~F.coalesce(F.col(how.value) == F.col("_later"), F.lit(False)))
        entity = F.col(how.key).cast("string").alias("entity_id")
        now = changed.select(F.lit("unrelated-change").alias("code"), entity, F.lit(name).alias("table")).union(lost.select(F.lit("patch-not-applied").alias("code"), entity, F.lit(name).alias("table")))
        out = now if out is None else out.union(now)
    return out


def _refuse_any(findings: DataFrame, what: str) -> None:
    first = findings.limit(1).collect()
    if first:
        code, entity, table = first[0]
        raise PatchRefused(f"{what}: {code} {entity} {table}".rstrip())


def integrate(store: TableSet, patches: DataFrame, how: Integration, downstream: DataFrame | None = None) -> int:
    """Lays patches over the store's tables and gives the new version; raises, and changes nothing, on any finding.

    The tables stay at the version they had if a job fails at any point, and another writer's
    version, if one came meanwhile, is not overwritten. The patches are made once.
    """
    base = store.version()
    before = store.tables(base)
    # Written once: findings, tables and the comparison must see the same patches, whatever made them.
    patches = store.spark.read.parquet(store.stage({"patches": patches})["patches"])
    _refuse_any(patch_findings(before, patches, how, downstream), "patches refused")
    staged = store.stage(patched(before, patches, how, downstream))
    after = {name: store.spark.read.parquet(at) for name, at in staged.items()}
    _refuse_any(unrelated_changes(before, after, patches, how, downstream), "result refused")
    return store.commit(staged, base)


def changes(before: Mapping[str, DataFrame], after: Mapping[str, DataFrame], how: Integration) -> DataFrame:
    """(table, rows, changed): rows of each table, and ids whose value differs between two versions."""
    out = None
    for name in how.tables:
        values = lambda d, c: d.groupBy(how.key).agg(F.max(how.value).alias(c), F.count("*").alias(f"{c}_n"))
        d = values(before[name], "a").join(values(after[name], "b"), how.key, "full")
        now = d.agg(F.coalesce(F.sum("b_n"), F.lit(0)).alias("rows"), F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("changed")).select(F.lit(name).alias("table"), "rows", "changed")
        out = now if out is None else out.union(now)
    return out
