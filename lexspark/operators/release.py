"""Revisions as a hash tree, and release manifests against them.

A leaf is a key with its revision. Leaves meet by the first hex digits of their key's hash, and
sixteen nodes meet in the one above, so a group is small however large the table, one changed leaf
changes the nodes on its way to the root and no others, and two trees are compared node by node.
Leaves that are equal are counted first, so a repeated key is no hot group.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.functions.canonical import hash_of
from lexspark.functions.text import is_blank

#: Leaves that one node of the lowest level has on average, at most.
LEAVES = 256
STATUSES = ("UNRELEASED", "RELEASED")


def depth_for(leaves: int) -> int:
    return max(0, math.ceil(math.log(max(1, leaves / LEAVES), 16)))


def revision_tree(leaves: DataFrame, key: str = "key", revision: str = "revision", by: Sequence[str] = (), depth: int | None = None) -> DataFrame:
    """(*by, level, node, digest, leaves): level 0 is the root, whose node is ''. by: columns of which each has its own tree.

    depth: levels below the root; what LEAVES asks for unless given, which takes a count. A null
    key or revision counts as an empty one.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    if depth is None:
        depth = depth_for(leaves.count())
    counted = leaves.groupBy(*by, text(key).alias("_key"), text(revision).alias("_revision")).agg(F.count("*").alias("leaves"))
    node = F.substring(F.sha2("_key", 256), 1, depth) if depth else F.lit("")
    item = F.concat_ws(":", F.sha2("_key", 256), "_revision", F.col("leaves").cast("string"))
    level = counted.groupBy(*by, node.alias("node")).agg(_digest(item), F.sum("leaves").alias("leaves"))
    out = level.withColumn("level", F.lit(depth))
    for k in range(depth - 1, -1, -1):
        item = F.concat_ws(":", "node", "digest")
        level = level.groupBy(*by, F.substring("node", 1, k).alias("node")).agg(_digest(item), F.sum("leaves").alias("leaves"))
        out = out.union(level.withColumn("level", F.lit(k)))
    return out.select(*by, "level", "node", "digest", "leaves")


def _digest(item: Column) -> Column:
    return F.sha2(F.array_join(F.array_sort(F.collect_list(item)), ","), 256).alias("digest")


def leaf_item(key: Column, revision: Column, leaves: Column | int = 1) -> Column:
    """The text of a leaf that its node's digest is made of; null counts as empty."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return F.concat_ws(":", F.sha2(text(key), 256), text(revision), leaves.cast("string") if isinstance(leaves, Column) else F.lit(str(leaves)))


def root_of(items: Column, depth: int) -> Column:
    """The root's digest of a small tree from an array of its leaf_items, each distinct; null for none. As revision_tree has it, in one row."""
    level = F.array_sort(items)
    for k in range(depth, 0, -1):
        # Bound by a lambda, so that a level is made once and not for each of its nodes.
        nodes = lambda level: F.transform(F.array_distinct(F.transform(level, lambda x: F.substring(x, 1, k))), lambda n: F.concat_ws(":", n, F.sha2(F.array_join(F.filter(level, lambda x: F.startswith(x, n)), ","), 256)))  # noqa: B023, E731
        level = F.get(F.transform(F.array(level), nodes), F.lit(0))
    return F.when(F.size(items) > 0, F.sha2(F.array_join(level, ","), 256))


def root(tree: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return tree.filter("level = 0").select(*by, "digest")


def changed_nodes(before: DataFrame, after: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(*by, level, node, state): nodes of two trees of one depth that are not the same: CHANGED, ADDED or REMOVED."""
    a, b = before.select(*by, "level", "node", F.col("digest").alias("_a")), after.select(*by, "level", "node", F.col("digest").alias("_b"))
    d = a.join(b, [*by, "level", "node"], "full").filter(~F.col("_a").eqNullSafe(F.col("_b")))
    return d.select(*by, "level", "node", F.when(F.col("_a").isNull(), "ADDED").when(F.col("_b").isNull(), "REMOVED").otherwise("CHANGED").alias("state"))


#: The revisions that a manifest binds, and the codes of those that differ.
BOUND = {"membership_revision": "release-membership-revision-mismatch", "registry_revision": "release-registry-revision-mismatch", "source_revision": "release-source-revision-mismatch", "reviewer_revision": "release-reviewer-revision-mismatch"}
IDENTITY = ("version", *BOUND, "policy_version")


def current_state(tables: Mapping[str, DataFrame], versions: DataFrame, by: str = "release_id", depth: int | None = None) -> DataFrame:
    """(by, version, a revision a table) of each release: tables' leaves (by, key, revision) by the name of their revision."""
    out = versions.select(by, "version")
    for name in BOUND:
        tree = root(revision_tree(tables[name], by=[by], depth=depth), [by]).withColumnRenamed("digest", name)
        out = out.join(tree, by, "left")
    return out


def states(roots: DataFrame, by: str = "release_id") -> DataFrame:
    """(by, version, a revision a table) of several versions at once: roots (by, version, table, digest) of their tables' trees."""
    return roots.groupBy(by, "version").agg(*[F.max(F.when(F.col("table") == name, F.col("digest"))).alias(name) for name in BOUND])


def bound_entries(entries: DataFrame, by: str = "release_id", depth: int | None = None) -> DataFrame:
    """(by, entry_revisions): one digest of a manifest's entries (by, concept_id, revision)."""
    return root(revision_tree(entries, "concept_id", by=[by], depth=depth), [by]).withColumnRenamed("digest", "entry_revisions")


def validate_release(manifests: DataFrame, bound: DataFrame, current: DataFrame, entries: DataFrame, released: DataFrame, by: str = "release_id", schema_version: int = 1, depth: int | None = None, digest: DataFrame | None = None) -> DataFrame:
    """finding(code, severity, entity_id, path) of release manifests.

    manifests: by, schema_version, release_status, version, the revisions of BOUND, policy_version,
    content_hash. bound: the revisions that manifests give their entries (by, concept_id, revision);
    none for a manifest means that it has no such part. current: current_state now. entries:
    revisions now (by, concept_id, revision). released: (by, concept_id) that are released now. digest:
    bound_entries of bound, if that is there already.
    """
    c = F.col
    digest = bound_entries(bound, by, depth) if digest is None else digest
    now = current.select(by, *[c(k).alias(f"_{k}") for k in ("version", *BOUND)])
    d = manifests.join(now, by, "left").join(digest, by, "left")
    sound = F.coalesce(c("schema_version") == schema_version, F.lit(False))
    out = F.coalesce(c("release_status") == "RELEASED", F.lit(False))
    # The hash binds all revisions, the policy and the entries' revisions.
    want = hash_of({**{k: c(f"_{k}") for k in BOUND}, "policy_version": c("policy_version"), "entry_revisions": c("entry_revisions")})
    hit = lambda p, code, path: F.when(p, F.struct(F.lit(code).alias("code"), F.lit(path).alias("path")))
    differs = lambda k, code: hit(out & ~c(k).eqNullSafe(c(f"_{k}")), code, f"release.{k}")
    rules = [hit(~c("release_status").isin(*STATUSES) | c("release_status").isNull(), "invalid-release-status", "release.release_status"), *[hit(is_blank(k), "invalid-release-identity", f"release.{k}") for k in IDENTITY]]
    rules += [hit(out & is_blank("content_hash"), "released-missing-content-hash", "release.content_hash"), hit(out & c("entry_revisions").isNull(), "released-missing-entry-revisions", "release.entry_revisions")]
    rules += [differs("version", "release-version-mismatch"), *[differs(k, code) for k, code in BOUND.items()], hit(out & ~c("content_hash").eqNullSafe(want), "release-content-hash-mismatch", "release.content_hash")]
    none = F.array().cast("array<struct<code: string, path: string>>")
    found = F.when(sound, F.array_compact(F.array(*rules))).otherwise(F.array(F.struct(F.lit("invalid-release-manifest").alias("code"), F.lit("release").alias("path"))))
    whole = d.select(c(by).cast("string").alias("entity_id"), F.explode(F.coalesce(found, none)).alias("f")).select("f.code", "entity_id", "f.path")
    # Entries that are released now must be bound with their present revision, in manifests that bind entries at all.
    binds = d.filter(sound & out & c("entry_revisions").isNotNull()).select(by)
    e = released.select(by, "concept_id").distinct().join(entries.select(by, "concept_id", c("revision").alias("_now")), [by, "concept_id"]).join(binds, by, "left_semi")
    e = e.join(bound.select(by, "concept_id", "revision"), [by, "concept_id"], "left").filter(~c("revision").eqNullSafe(c("_now")))
    single = e.select(F.lit("release-entry-revision-mismatch").alias("code"), c(by).cast("string").alias("entity_id"), F.concat(F.lit("release.entry_revisions."), c("concept_id").cast("string")).alias("path"))
    return whole.union(single).select("code", F.lit("error").alias("severity"), "entity_id", "path")
