"""Operator 2: deletes later copies of repeated line runs, by a suffix array over line-ID sequences.

Each document is a sequence of its lines that hold a word. Prefix doubling ranks the suffixes of
all sequences together: round 0 ranks them by their first line, round k by their first 2^k lines,
from the pair of ranks of the two halves. The distinct pairs are range-sorted across the cluster
and numbered in order, so ranks order the suffixes as a suffix array does, and the suffixes that
share a rank are one of its intervals with a longest common prefix of at least 2^k lines.
Intervals of one suffix leave the computation at once; what stays shrinks round by round.

A run of lines counts if it has at least `min_words` words. Any such repeated run is the union of
minimal ones: from each line the shortest run onwards, and the shortest run backwards, that has
enough words. Such a run of m lines, 2^k <= m < 2^(k+1), lies in the interval of common prefix m
that the ranks of its first and last 2^k lines name. So ranks are needed up to 2^k <= min_words
only, however long the copies, and the union over all intervals of the occurrences that are not
the first yields every line of every maximal repeated run but its first copy. An occurrence that
overlaps the first one in its own document deletes only the lines behind that first copy, which
so stays whole.

Defined results: null and blank texts have no lines and stay as they are; blank lines are not part
of runs and stay; rows with equal doc_id and text are one document and get the same result; the
first copy is the one with the smallest (doc_id, then text hash, then line), null doc_ids last; an
empty table gives an empty table; other columns pass through untouched.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexspark.llm.common import Scratch, checked_broadcast, slices

MIN_WORDS = 50
DOC = ["_ld_doc", "_ld_hash"]


def _minimal_runs(counts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """For each line the lengths in lines of the shortest runs from it and up to it with enough words; 0: none."""
    total = np.concatenate([[0], np.cumsum(counts)])
    n = len(counts)
    end = np.searchsorted(total, total[:-1] + least, side="left")
    onwards = np.where(end <= n, end - np.arange(n), 0)
    start = np.searchsorted(total, total[1:] - least, side="right") - 1
    back = np.where(total[1:] >= least, np.arange(1, n + 1) - start, 0)
    return onwards, back


def _lines(least: int):
    """(doc, hash, text) to a row for each line with a word: its place among these, two hashes, its minimal runs."""

    def run(batches):
        import pyarrow as pa
        import xxhash

        for batch in slices(batches):
            cols: list[list] = [[] for _ in range(8)]
            for doc, h, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                places, lines, counts = [], [], []
                for k, line in enumerate((text or "").encode().split(b"\n")):
                    if n := len(line.split()):
                        places.append(k)
                        lines.append(line)
                        counts.append(n)
                if not lines:
                    continue
                onwards, back = _minimal_runs(np.array(counts), least)
                digests = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, lines)), "<i8").reshape(-1, 2)
                for c, v in zip(cols, ([doc] * len(lines), [h] * len(lines), range(len(lines)), places, digests[:, 0].tolist(), digests[:, 1].tolist(), onwards.tolist(), back.tolist()), strict=True):
                    c.extend(v)
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[*DOC, "i", "place", "h1", "h2", "onwards", "back"])

    return run


def _ranked(rows: DataFrame, keys: list[str], scratch: Scratch) -> DataFrame:
    """keys that at least two rows share, with rank: increasing in the order of keys over the whole cluster."""
    shared = rows.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1").select(*keys)
    ordered = shared.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return scratch.store(ordered.withColumn("rank", F.monotonically_increasing_id()), "ranks")


def repeated_lines(docs: DataFrame, min_words: int, scratch: Scratch) -> DataFrame:
    """(_ld_doc, _ld_hash, _ld_removed): for documents with lines to delete, their places in the text."""
    source = docs.select(F.col("doc_id").cast("long").alias(DOC[0]), F.xxhash64("text").alias(DOC[1]), F.col("text"))
    schema = f"{DOC[0]} long, {DOC[1]} long, i int, place int, h1 long, h2 long, onwards int, back int"
    lines = scratch.store(source.mapInArrow(_lines(min_words), schema), "lines")
    shared = lines.join(checked_broadcast(_ranked(lines, ["h1", "h2"], scratch), 40), ["h1", "h2"])
    # Lines of equal rows are one document's.
    levels = [scratch.store(shared.select(*DOC, "i", "place", "onwards", "back", "rank").dropDuplicates([*DOC, "i"]), "suffixes")]
    longest = levels[0].agg(F.greatest(F.max("onwards"), F.max("back"))).first()[0] or 0
    while 2 ** len(levels) <= longest:
        half = 2 ** (len(levels) - 1)
        ahead = Window.partitionBy(*DOC).orderBy("i").rangeBetween(half, half)
        halves = levels[-1].select(*DOC, "i", F.col("rank").alias("r1"), F.max("rank").over(ahead).alias("r2")).filter("r2 is not null")
        halves = scratch.store(halves, "halves")
        levels.append(scratch.store(halves.join(_ranked(halves, ["r1", "r2"], scratch), ["r1", "r2"]).select(*DOC, "i", "rank"), "suffixes"))
    base = levels[0]
    onwards = base.select(*DOC, F.col("i").alias("start"), F.col("onwards").alias("m"))
    back = base.select(*DOC, (F.col("i") - F.col("back") + 1).alias("start"), F.col("back").alias("m"))
    runs = onwards.union(back).filter("m > 0").distinct()
    runs = scratch.store(runs, "runs") if len(levels) > 1 else runs
    found = None
    for k, level in enumerate(levels):
        these = runs.filter(f"m >= {2**k} and m < {2 ** (k + 1)}").alias("a")
        for name, shift in (("first", F.lit(0)), ("last", F.col("m") - 2**k)):
            ranks = level.select(*[F.col(c).alias(f"_{c}") for c in DOC], F.col("i").alias("_i"), F.col("rank").alias(name))
            on = F.col(DOC[0]).eqNullSafe(F.col(f"_{DOC[0]}")) & (F.col(DOC[1]) == F.col(f"_{DOC[1]}")) & (F.col("start") + shift == F.col("_i"))
            these = these.join(ranks, on).drop(*[f"_{c}" for c in (*DOC, "i")])
        found = these if found is None else found.union(these)
    found = scratch.store(found.withColumn("here", F.struct(F.col(DOC[0]).isNull().alias("no_id"), *DOC, "start")), "intervals")
    key = ["m", "first", "last"]
    firsts = scratch.store(found.groupBy(*key).agg(F.count("*").alias("_n"), F.min("here").alias("earliest")).filter("_n > 1").select(*key, "earliest"), "firsts")
    later = found.join(checked_broadcast(firsts, 80), key).filter(~F.col("here").eqNullSafe(F.col("earliest")))
    e = F.col("earliest")
    same = e[DOC[0]].eqNullSafe(F.col(DOC[0])) & (e[DOC[1]] == F.col(DOC[1]))
    begins = F.when(same, F.greatest("start", e["start"] + F.col("m"))).otherwise(F.col("start"))
    gone = later.select(*DOC, F.explode(F.sequence(begins, F.col("start") + F.col("m") - 1)).alias("i")).distinct()
    places = base.select(*[F.col(c).alias(f"_{c}") for c in DOC], F.col("i").alias("_i"), "place")
    on = F.col(DOC[0]).eqNullSafe(F.col(f"_{DOC[0]}")) & (F.col(DOC[1]) == F.col(f"_{DOC[1]}")) & (F.col("i") == F.col("_i"))
    gone = gone.join(places, on).groupBy(*DOC).agg(F.array_sort(F.collect_set("place")).alias("_ld_removed"))
    return scratch.store(gone, "removed")


def remove_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """docs with the text less the deleted lines, and `_ld_removed`: the array of their places, null if none.

    A column of that name in docs gives way to it.
    """
    scratch = Scratch(docs.sparkSession, "line-dedup")
    gone = checked_broadcast(repeated_lines(docs, min_words, scratch), 64)
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_ld_row"), F.col("doc_id").cast("long").alias("_ld_id"), F.col("text"))
    keyed = row.withColumn("_ld_text", F.xxhash64("text"))
    joined = keyed.join(gone, F.col("_ld_id").eqNullSafe(F.col(DOC[0])) & (F.col("_ld_text") == F.col(DOC[1])), "left")
    lines = F.split("text", "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_ld_removed"))
    text = F.when(F.col("_ld_removed").isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda k: F.get(F.col("_ld_lines"), k)), "\n"))
    joined = joined.withColumn("_ld_lines", F.when(F.col("_ld_removed").isNotNull(), lines)).withColumn("_ld_new", text)
    others = [F.col("_ld_new").alias("text") if c == "text" else F.col("_ld_row").getField(c).alias(c) for c in docs.columns if c != "_ld_removed"]
    return joined.select(*others, F.col("_ld_removed"))


def op2_line_dedup(docs: DataFrame) -> DataFrame:
    """Per document: the text that is left, the lines removed, their number."""
    out = remove_repeated_lines(docs.select("doc_id", "text"))
    return out.select("doc_id", "text", F.coalesce(F.size("_ld_removed"), F.lit(0)).cast("long").alias("lines_removed"), F.coalesce("_ld_removed", F.array().cast("array<int>")).alias("removed"))
