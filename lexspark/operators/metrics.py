"""Counts, coverage, contributions, queues and packets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexspark.sources.io import shared_checkpoints


def zero_filled(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """(column, count) for every value of a fixed enumeration."""
    spark = df.sparkSession
    enum = spark.createDataFrame([(v,) for v in values], f"`{column}` string")
    return enum.join(df.groupBy(column).count(), column, "left").select(column, F.coalesce("count", F.lit(0)).alias("count"))


def source_contribution(pairs: DataFrame) -> DataFrame:
    """Per source of (source_id, concept_id): rows, concepts, those it alone has, those others have too."""
    per = pairs.groupBy("source_id", "concept_id").agg(F.count("*").alias("rows"))
    per = per.withColumn("sources", F.count("*").over(Window.partitionBy("concept_id")))
    return per.groupBy("source_id").agg(F.sum("rows").alias("rows"), F.count("*").alias("concepts"), F.count_if(F.col("sources") == 1).alias("unique_concepts"), F.count_if(F.col("sources") > 1).alias("overlap_concepts"))


def source_summary(pairs: DataFrame, registry: DataFrame, quarantined: Column | None = None) -> DataFrame:
    """source_contribution for every registered source, with whether it is absent."""
    p = pairs if quarantined is None else pairs.filter(~quarantined)
    out = registry.select("source_id").distinct().join(source_contribution(p), "source_id", "left")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("rows", "concepts", "unique_concepts", "overlap_concepts")}
    return out.withColumn("absent", F.col("rows").isNull()).withColumns(zero)


def institutions(evidence: DataFrame) -> DataFrame:
    """Distinct institutions per concept; a source without one stands for itself."""
    return evidence.groupBy("concept_id").agg(F.count_distinct(F.coalesce("institution", "source_id")).alias("institutions"))


def global_metrics(evidence: DataFrame) -> DataFrame:
    """One row: concepts with evidence, with one source, with one term and two institutions at least."""
    who = F.coalesce("institution", "source_id")
    per = evidence.groupBy("concept_id").agg(F.count_distinct("key").alias("terms"), F.count_distinct("source_id").alias("sources"), F.count_distinct(who).alias("who"))
    return per.agg(F.count("*").alias("concepts"), F.count_if(F.col("sources") == 1).alias("single_source"), F.count_if((F.col("terms") == 1) & (F.col("who") > 1)).alias("agreement"), F.count_if(F.col("terms") > 1).alias("conflicts"))


def coverage(df: DataFrame, counters: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """total, and for each counter its count and share in per cent of one denominator, two places."""
    aggs = [F.count("*").alias("total")]
    for name, p in counters.items():
        aggs += [F.count_if(p).alias(name), F.round(100 * F.count_if(p) / F.nullif(F.count("*"), F.lit(0)), 2).alias(f"{name}_pct")]
    return df.groupBy(*by).agg(*aggs)


def release_safety(entries: DataFrame, counters: dict[str, Column], findings: DataFrame, protected: DataFrame) -> DataFrame:
    """One row: coverage of the registry's entries, errors found in it, protected files not as planned, and `safe`.

    findings: severity; protected: state, as compare_manifest gives it. Any error, any file that is
    changed, missing or new, and a state or severity that is unknown make it unsafe.
    """
    errors = findings.agg(F.count_if(~F.col("severity").eqNullSafe("warning")).alias("errors"))
    moved = protected.agg(F.count_if(~F.col("state").eqNullSafe("MATCH")).alias("changed_files"))
    one = coverage(entries, counters).crossJoin(errors).crossJoin(moved)  # one row each
    return one.withColumn("safe", (F.col("errors") == 0) & (F.col("changed_files") == 0))


def evidence_counts(decisions: DataFrame, matches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per value of the columns of decisions: concepts, concepts with evidence, pieces of evidence."""
    m = matches.groupBy("concept_id").agg(F.count_distinct("evidence_id").alias("_n"))
    d = decisions.join(m, "concept_id", "left")
    return d.groupBy(*by).agg(F.count_distinct("concept_id").alias("concepts"), F.count_distinct(F.when(F.col("_n") > 0, F.col("concept_id"))).alias("with_evidence"), F.coalesce(F.sum("_n"), F.lit(0)).alias("evidence"))


def histogram(df: DataFrame, value: Column | str, array: bool = False) -> DataFrame:
    value = F.col(value) if isinstance(value, str) else value
    return df.select((F.explode(value) if array else value).alias("value")).groupBy("value").count()


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """(key, holders, surplus) of keys held more than once."""
    return df.groupBy(key).agg(F.count("*").alias("holders")).filter("holders > 1").withColumn("surplus", F.col("holders") - 1)


def demote_duplicates(df: DataFrame, key: str, status: str = "status", to: str = "DUPLICATE_ID") -> DataFrame:
    d = duplicates(df.filter(F.col(key).isNotNull()), key).select(key, "holders")
    return df.join(d, key, "left").withColumn(status, F.when(F.col("holders").isNotNull(), to).otherwise(F.col(status))).drop("holders")


def quota_check(df: DataFrame, category: str, quotas: DataFrame) -> DataFrame:
    """(category, quota, actual, state) against an exact quota of each category; categories without one are UNEXPECTED."""
    c = df.groupBy(category).agg(F.count("*").alias("actual"))
    d = quotas.join(c, category, "full")
    state = F.when(F.col("quota").isNull(), "UNEXPECTED").when(F.coalesce("actual", F.lit(0)) == F.col("quota"), "MET").when(F.coalesce("actual", F.lit(0)) < F.col("quota"), "SHORT").otherwise("OVER")
    return d.select(category, "quota", F.coalesce("actual", F.lit(0)).alias("actual"), state.alias("state"))


def accounting(expected: DataFrame, actual: DataFrame, key: str = "concept_id") -> DataFrame:
    """One row: expected, actual, distinct, duplicated, missing and unexpected ids."""
    e = expected.groupBy(key).agg(F.lit(1).alias("e"))
    a = actual.groupBy(key).agg(F.count("*").alias("n"))
    d = e.join(a, key, "full")
    return d.agg(F.count("e").alias("expected"), F.coalesce(F.sum("n"), F.lit(0)).alias("actual"), F.count("n").alias("distinct_ids"), F.count_if(F.col("n") > 1).alias("duplicated"), F.count_if(F.col("n").isNull()).alias("missing"), F.count_if(F.col("e").isNull()).alias("unexpected"))


def exclusive_categories(df: DataFrame, categories: dict[str, Column]) -> DataFrame:
    """(category, rows): rows that are in one category alone, by category, zero-filled, and those in NONE or SEVERAL.

    The counts add up to the rows of df; the ledger is sound if NONE and SEVERAL are 0.
    """
    held = F.array_compact(F.array(*[F.when(p, n) for n, p in categories.items()]))
    one = df.select(held.alias("h")).select(F.when(F.size("h") == 1, F.get("h", F.lit(0))).when(F.size("h") == 0, "NONE").otherwise("SEVERAL").alias("category"))
    return zero_filled(one, "category", [*categories, "NONE", "SEVERAL"]).withColumnRenamed("count", "rows")


def sealed_ledger(df: DataFrame, categories: dict[str, Column]) -> DataFrame:
    """(category, rows, digest) of exclusive_categories, the digest over all counts.

    The sums are asserted in the plan: a row that is in no category or in several fails the job.
    """
    ledger = exclusive_categories(df, categories)
    text = F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "category", F.col("rows").cast("string")))), ",")
    off = F.sum(F.when(F.col("category").isin("NONE", "SEVERAL"), F.col("rows")).otherwise(0))
    seal = ledger.agg(F.sha2(text, 256).alias("digest"), off.alias("_off"))
    told = F.when(F.col("_off") == 0, F.col("rows")).otherwise(F.raise_error(F.concat(F.col("_off").cast("string"), F.lit(" rows are in no category or in several"))).cast("long"))
    return ledger.filter(~F.col("category").isin("NONE", "SEVERAL")).crossJoin(F.broadcast(seal)).select("category", told.alias("rows"), "digest")  # seal is one row


def ledger_assertions(df: DataFrame, key: str, rows: int | None, every: dict[str, Column]) -> DataFrame:
    """(assertion, ok): row count, unique ids, and predicates that hold for all rows."""
    checks = {"unique-ids": F.count(key) == F.count_distinct(key)} | {n: F.coalesce(F.bool_and(p), F.lit(True)) for n, p in every.items()}
    if rows is not None:
        checks["row-count"] = F.count("*") == rows
    one = df.agg(*[c.alias(n) for n, c in checks.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("assertion"), F.col(f"`{n}`").alias("ok")) for n in checks])).alias("x")).select("x.*")


def queues(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(queue, value, members) for each of the keys by itself, in one pass by grouping sets."""
    cols = [F.col(k).cast("string").alias(k) for k in keys]
    g = df.select(*cols).groupingSets([[F.col(k)] for k in keys], *[F.col(k) for k in keys]).agg(F.grouping_id().alias("g"), F.count("*").alias("members"))
    n = len(keys)
    which, value = None, None
    for i, k in enumerate(keys):
        mask = (2**n - 1) ^ (1 << (n - 1 - i))
        which = F.when(F.col("g") == mask, k) if which is None else which.when(F.col("g") == mask, k)
        value = F.when(F.col("g") == mask, F.col(k)) if value is None else value.when(F.col("g") == mask, F.col(k))
    return g.select(which.alias("queue"), value.alias("value"), "members")


def packets(df: DataFrame, keys: Sequence[str], member: str) -> DataFrame:
    """Packets of rows with equal keys, a row a member: id from the keys' hash, the keys, distinct members and their number."""
    m = df.select(*keys, member).distinct()
    size = m.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.count(member).alias("size"))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    packet = F.sha2(F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]), 256)
    return m.join(size, on).select(packet.alias("packet_id"), *keys, "size", member)


def batch_stats(df: DataFrame, family: str, size: str, covered: Column, bands: Sequence[tuple[int, str]] = ((10, "SMALL"), (100, "MEDIUM")), largest: str = "LARGE") -> DataFrame:
    """Per family: rows, size band, coverage in per cent, sum, least, greatest and median of a size, and its rank by rows."""
    g = df.groupBy(family).agg(F.count("*").alias("rows"), F.count_if(covered).alias("covered"), *[f(size).alias(n) for n, f in (("total", F.sum), ("least", F.min), ("greatest", F.max), ("median", F.median))])
    band = None
    for most, name in bands:
        band = F.when(F.col("rows") <= most, name) if band is None else band.when(F.col("rows") <= most, name)
    g = g.withColumns({"band": band.otherwise(largest), "covered_pct": F.round(100 * F.col("covered") / F.col("rows"), 2)})
    return rank_batches(g, "rows", family)


def rank_batches(df: DataFrame, count: str, name: str) -> DataFrame:
    """Numbers a table of families, largest first. One row a family, so one task suffices."""
    return df.withColumn("batch", F.row_number().over(Window.orderBy(F.desc(count), name)))


def family_counts(df: DataFrame, family: str, status: str, values: Sequence[str]) -> DataFrame:
    return df.groupBy(family).agg(F.count("*").alias("total"), *[F.count_if(F.col(status) == v).alias(v.lower()) for v in values])


def ordered_position(df: DataFrame, *order: str, name: str = "pos") -> DataFrame:
    """df with a row's place (from 0) in a total order, without one task that sees all rows.

    Rows are range-sorted; each partition's size, one number a partition, gives the others' offsets.
    """
    spark = df.sparkSession
    shared_checkpoints(spark)
    d = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("_id", 33)
    sizes = d.groupBy(part.alias("_part")).count().orderBy("_part").collect()
    offsets, total = [], 0
    for r in sizes:
        offsets.append((r["_part"], total))
        total += r["count"]
    table = F.broadcast(spark.createDataFrame(offsets, "_part long, _offset long"))  # one row a partition
    d = d.withColumn("_part", part).join(table, "_part", "left")
    return d.withColumn(name, F.coalesce("_offset", F.lit(0)) + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))).drop("_id", "_part", "_offset")


def chunk_ids(df: DataFrame, size: int, *order: str) -> DataFrame:
    return ordered_position(df, *order).withColumn("chunk_id", F.floor(F.col("pos") / size)).drop("pos")


def chunk_manifest(chunked: DataFrame, key: str, payload: str) -> DataFrame:
    """Per chunk: rows, first and last id, digest of its rows in order."""
    g = chunked.groupBy("chunk_id").agg(F.count("*").alias("rows"), F.min(key).alias("first_id"), F.max(key).alias("last_id"), F.array_sort(F.collect_list(F.struct(key, payload))).alias("v"))
    return g.select("chunk_id", "rows", "first_id", "last_id", F.sha2(F.array_join(F.transform("v", lambda x: x[payload].cast("string")), "\n"), 256).alias("sha256"))


def tier_coverage(decisions: DataFrame, tiers: Sequence[str], baseline: DataFrame) -> DataFrame:
    """Per tier, zero-filled: rows, targets, targets that the baseline has, and gained ones."""
    base = baseline.select("target_id").distinct().withColumn("_b", F.lit(True))
    t = decisions.select("tier", "row_id", "target_id").join(base, "target_id", "left")
    g = t.groupBy("tier").agg(F.count("*").alias("rows"), F.count_distinct("target_id").alias("targets"), F.count_distinct(F.when(F.col("_b"), F.col("target_id"))).alias("overlap"))
    enum = decisions.sparkSession.createDataFrame([(x,) for x in tiers], "tier string")
    z = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return enum.join(g, "tier", "left").select("tier", z("rows"), z("targets"), z("overlap")).withColumn("gain", F.col("targets") - F.col("overlap"))


def annotation_counts(bindings: DataFrame, matrix: DataFrame, records: DataFrame) -> DataFrame:
    """(name, key, n): what a research annotation carries: bindings and the concepts they bind, concepts of the matrix and their
    dispositions, records and their sources.

    bindings: concept_id. matrix: concept_id, disposition. records: source_id. A blank id or disposition is counted under no key.
    """
    named = lambda c: F.when(~F.coalesce(F.trim(F.col(c).cast("string")) == "", F.lit(True)), F.col(c))
    one = lambda d, name, n: d.agg(n.alias("n")).select(F.lit(name).alias("name"), F.lit(None).cast("string").alias("key"), "n")
    per = lambda d, name, c: d.groupBy(named(c).cast("string").alias("key")).agg(F.count("*").alias("n")).filter("key is not null").select(F.lit(name).alias("name"), "key", "n")
    out = one(bindings, "bindings", F.count("*")).union(one(bindings, "bound_concepts", F.count_distinct(named("concept_id"))))
    out = out.union(one(matrix, "concepts", F.count("*"))).union(per(matrix, "dispositions", "disposition"))
    return out.union(one(records, "records", F.count("*"))).union(per(records, "sources", "source_id"))
