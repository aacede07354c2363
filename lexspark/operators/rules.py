"""Decision tables as data: nested conditions compiled to Columns, first match wins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compile_condition(c: dict) -> Column:
    """{"all"|"any": [...]}, {"not": ...}, {"always": true} or {"field", "eq"|"neq"|"in"|"gt"|"lt"|"is_null"|"matches"|"has_tag": value}.

    matches: a pattern somewhere in a text. has_tag: one of an array's tags, or any of a list of them.
    Null is unknown and holds for nothing.
    """
    if "all" in c:
        return reduce(lambda a, b: a & b, map(compile_condition, c["all"]), F.lit(True))
    if "any" in c:
        return reduce(lambda a, b: a | b, map(compile_condition, c["any"]), F.lit(False))
    if "not" in c:
        return ~compile_condition(c["not"])
    if c.get("always"):
        return F.lit(True)
    x = F.col(c["field"])
    tests = {"eq": lambda v: x == v, "neq": lambda v: x != v, "in": lambda v: x.isin(v), "gt": lambda v: x > v, "lt": lambda v: x < v, "is_null": lambda v: x.isNull() if v else x.isNotNull(), "matches": lambda v: x.rlike(v)}
    tests["has_tag"] = lambda v: F.arrays_overlap(x, F.array(*[F.lit(t) for t in ([v] if isinstance(v, str) else v)]))
    found = [tests[k](c[k]) for k in tests if k in c]
    if len(found) != 1:
        raise ValueError(f"a condition on a field has one test: {c}")
    return F.coalesce(found[0], F.lit(False))


def compile_table(rules: list[dict]) -> Column:
    """struct(rule, disposition) of the first rule that holds. Fails without a last rule that always does."""
    if not rules or not rules[-1]["when"].get("always"):
        raise ValueError("a decision table ends with a rule that always holds")
    out = None
    for r in rules:
        value = F.struct(F.lit(r["id"]).alias("rule"), F.lit(r["disposition"]).alias("disposition"))
        out = F.when(compile_condition(r["when"]), value) if out is None else out.when(compile_condition(r["when"]), value)
    return out


def first_rule_of(rules: list[dict], default: str) -> Column:
    """The name of the first rule ({"name", "when"}) that holds, which may mix tags and texts; else the default."""
    return compile_table([{"id": r["name"], "disposition": r["name"], "when": r["when"]} for r in rules] + [{"id": default, "disposition": default, "when": {"always": True}}])["rule"]


def decide(facts: DataFrame, rules: list[dict]) -> DataFrame:
    return facts.withColumn("_d", compile_table(rules)).select(*facts.columns, "_d.rule", "_d.disposition")


def reduce_candidates(pairs: DataFrame) -> DataFrame:
    """Per row_id of pairs (target_id, eligible, credible, exact): what to do, the selected target, all candidates.

    One eligible target and no other credible one is selected; several go to identity review; only
    inexact ones corroborate; nothing asks for a bridge. Every candidate is kept.
    """
    p = pairs.groupBy("row_id", "target_id").agg(*[F.bool_or(c).alias(c) for c in ("eligible", "credible", "exact")])
    g = p.groupBy("row_id").agg(
        F.count_if("eligible").alias("n"), F.count_if(F.col("credible") & ~F.col("eligible")).alias("rivals"), F.count_if(~F.col("exact")).alias("inexact"),
        F.min(F.when(F.col("eligible"), F.col("target_id"))).alias("only"), F.array_sort(F.collect_list("target_id")).alias("candidates"))
    sel = (F.col("n") == 1) & (F.col("rivals") == 0)
    out = F.when(sel, "SELECTED").when((F.col("n") > 0) | (F.col("rivals") > 0), "IDENTITY_REVIEW").when(F.col("inexact") > 0, "CORROBORATIVE").otherwise("BRIDGE_REQUIRED")
    return g.select("row_id", out.alias("disposition"), F.when(sel, F.col("only")).alias("selected"), "candidates")


def adapt_rows(rows: DataFrame, checks: dict[str, Column], source: str, assertion: str, licence: str, scopes: Sequence[str] = ()) -> DataFrame:
    """Fail-closed rows: failed checks as sorted blockers, a rule trace, an evidence reference with its hash, and scope checks that start UNKNOWN."""
    failed = F.array_sort(F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in checks.items()])))
    trace = F.array(*[F.struct(F.lit(n).alias("check"), F.when(c, "PASS").when(~c, "FAIL").otherwise("UNKNOWN").alias("state")) for n, c in checks.items()])
    ref = F.struct(F.lit(source).alias("artifact"), F.col("row_id").alias("locator"), F.lit(assertion).alias("assertion"), F.lit(licence).alias("licence"), F.sha2(F.concat_ws(":", F.lit(source), "row_id", F.lit(assertion)), 256).alias("hash"))
    unknown = F.array(*[F.struct(F.lit(s).alias("scope"), F.lit("UNKNOWN").alias("state")) for s in scopes]).cast("array<struct<scope:string,state:string>>")
    out = rows.withColumns({"blockers": failed, "rule_trace": trace, "evidence_ref": ref, "scope_checks": unknown})
    return out.withColumn("disposition", F.when(F.size("blockers") > 0, "BLOCKED").otherwise("IDENTITY_REVIEW"))


def endpoint_facts(rows: DataFrame) -> DataFrame:
    """Two endpoint facts (pivot, target) for each row with a selected pair."""
    ends = F.array(*[F.struct(F.lit(k).alias("endpoint"), F.col(k).alias("value")) for k in ("pivot", "target")])
    return rows.select("row_id", F.explode(ends).alias("e")).select("row_id", "e.endpoint", "e.value", F.sha2(F.concat_ws(":", "row_id", "e.endpoint", "e.value"), 256).alias("fact_id"))


def discovery_candidates(rows: DataFrame) -> DataFrame:
    """One candidate for each row with a selected pair: its id by content, never more than a lead to follow."""
    return rows.select("row_id", "pivot", "target", F.sha2(F.concat_ws(":", "row_id", "pivot", "target"), 256).alias("candidate_id"), F.lit("DISCOVERY_ONLY").alias("state"))


def join_by_row_id(first: DataFrame, *rest: DataFrame) -> DataFrame:
    """Parallel lists aligned by row_id, never by position."""
    return reduce(lambda a, b: a.join(b, "row_id", "left"), rest, first)
