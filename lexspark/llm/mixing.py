"""Operator 9: mixes sources to target weights by a multivariate-hypergeometric splitting tree.

Each source's documents are hashed into blocks, at most BLOCKS a source, whose number is the
permuted order of the draw. A target of q + f times the source's size takes every block q times
and, of the rest, the first blocks in that order as long as they fit in f times the size; the one
block that does not fit is cut into blocks in the same way; and the one of these that does not fit
is drawn from document by document, in hashed order, each taken if it still fits, and at last one
that overshoots if that comes nearer. Output shards come from a binary
tree: a node splits the block quotas that it has of each pass over a source, the blocks that the
pass takes whole, between its halves by a multivariate-hypergeometric draw, so leaves hold exact and
disjoint quotas. Which of the blocks a shard gets comes from an order of each pass alone. Trees of
their own deal the blocks inside the edge blocks and the documents of the last ones. A shard orders
its rows by a seeded hash.

Only the table of sources (name, documents, words, edges) reaches the driver, one row for each
component of the mixture. Groups that one task sees are a source's block totals (at most BLOCKS
rows), the blocks of one pass over it, and some dozens of its documents (those of one block in
BLOCKS squared, BLOCK_DOCS at the least). The shards' number sets how rows are laid out, never
which are taken.

Rows equal in doc_id and text have hashes of their own, made with their number among their equals;
which of them has which number is of no account, as they are equal. The numbers come from counts of
CHUNK rows at a time and running sums of these, so no task holds all equals of a row.

Defined results: a null text has size 0; null sources are one source, last in order; a document
of size 0 is never taken; repeated rows are drawn row by row; equal runs give equal rows, but for
columns other than doc_id, text and source of rows that are equal in these three; an empty table
gives an empty table; other columns, whatever their names, pass through `mix` untouched.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexspark.llm.common import Scratch, checked_broadcast, sized_broadcast, words_of

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2.0
BLOCKS, BLOCK_DOCS = 4096, 64
CHUNK = 1 << 12
SEED = 11


def targets(sizes: dict, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> dict:
    """Words to take of each source: share of all by weight, at most `most` times its size, the excess reshared."""
    names = sorted((k for k in sizes if k is not None)) + ([None] if None in sizes else [])
    weight = {k: weights[i % len(weights)] for i, k in enumerate(names)}
    left, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        total = sum(weight[k] for k in names if k in free)
        over = [k for k in names if k in free and left * weight[k] / total > most * sizes[k]]
        if not over:
            return out | {k: left * weight[k] / total for k in names if k in free}
        for k in over:
            out[k] = most * sizes[k]
        left -= sum(out[k] for k in over)
        free -= set(over)
    return out


def splitting_tree(quotas: np.ndarray, shards: int, seed: int = SEED) -> np.ndarray:
    """shards x sources: how many of each source's blocks each shard holds; columns sum to quotas."""

    def split(q: np.ndarray, lo: int, hi: int) -> None:
        if hi - lo == 1:
            out[lo] = q
            return
        mid = (lo + hi) // 2
        take = round(int(q.sum()) * (mid - lo) / (hi - lo))
        rng = np.random.default_rng([seed, lo, hi])
        # A source at a time: the marginals of a multivariate-hypergeometric draw, which hold any totals.
        left, rest, need = np.zeros_like(q), int(q.sum()), take
        for s, n in enumerate(q):
            rest -= int(n)
            got = _hypergeometric(rng, int(n), rest, need)
            left[s] = got
            need -= got
        split(left, lo, mid)
        split(q - left, mid, hi)

    out = np.zeros((shards, len(quotas)), np.int64)
    split(np.asarray(quotas, np.int64), 0, shards)
    return out


def _hypergeometric(rng, good: int, bad: int, draws: int) -> int:
    if not good or not draws:
        return 0
    return int(rng.hypergeometric(good, bad, draws)) if bad else min(good, draws)


def word_count(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def _fit(block):
    """Takes documents in hashed order as long as they still fit in what the source has left to take."""
    d = block.groupby("_mx_hash", as_index=False).agg({"size": "sum", "left": "first"}).sort_values("_mx_hash")
    left, taken = float(d["left"].iloc[0]), []
    for size in d["size"]:
        fits = 0 < size <= left
        taken.append(fits)
        left -= size if fits else 0
    rest = [k for k, t in enumerate(taken) if not t and d["size"].iloc[k] > 0]
    if rest and d["size"].iloc[best := min(rest, key=lambda k: (d["size"].iloc[k], k))] < 2 * left:
        taken[best] = True  # above the target, but nearer to it
    k = int(block["_mx_k"].iloc[0])
    out = d.assign(_px_k=k, _px_hash=d["_mx_hash"])[taken][["_px_k", "_px_hash"]]
    return out.assign(_px_rank=np.random.default_rng([SEED, k]).permutation(len(out)).astype(np.int32))


def _keyed(docs: DataFrame) -> DataFrame:
    """The whole row apart from what is made of it, so that no column can clash."""
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.col("row.text")
    return d.select("row", F.col("row.doc_id").alias("doc_id"), F.col("row.source").alias("source"), F.xxhash64("row.doc_id", text, F.lit(SEED)).alias("_mx_hash"), word_count(text).alias("_mx_size"))


def _numbers(rows: DataFrame) -> DataFrame:
    """(_mx_uid, _mx_hash) of stored rows (_mx_uid, _mx_hash): hashes made distinct by each row's number among its equals."""
    chunk = F.shiftright("_mx_uid", CHUNK.bit_length() - 1).alias("chunk")
    at = rows.select("_mx_uid", "_mx_hash", chunk)
    before = Window.partitionBy("_mx_hash").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    start = at.groupBy("_mx_hash", "chunk").count().select("_mx_hash", "chunk", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("_mx_hash", "chunk").orderBy("_mx_uid")) - 1
    numbered = at.withColumn("n", within).join(start, ["_mx_hash", "chunk"]).withColumn("n", F.col("n") + F.col("start"))
    return numbered.select("_mx_uid", F.when(F.col("n") == 0, F.col("_mx_hash")).otherwise(F.xxhash64("_mx_hash", "n", F.lit(SEED + 7))).alias("_mx_hash"))


def _distinct(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """_keyed rows whose hashes are distinct. Only rows that have equals are stored and numbered."""
    keyed = _keyed(docs)
    repeated = scratch.store(keyed.groupBy("_mx_hash").count().filter("count > 1").select("_mx_hash"), "repeated")
    n = repeated.count()
    if not n:
        return keyed
    repeated = sized_broadcast(repeated, n, 16)
    several = scratch.store(keyed.join(repeated, "_mx_hash", "left_semi").withColumn("_mx_uid", F.monotonically_increasing_id()), "repeated-rows")
    numbers = scratch.store(_numbers(several), "numbers")
    several = several.drop("_mx_hash").join(numbers, "_mx_uid").select(*keyed.columns)
    return keyed.join(repeated, "_mx_hash", "left_anti").select(*keyed.columns).union(several)


def _plan(sizes: DataFrame) -> list[tuple]:
    """A row for each source: name, number, words, target, whole passes, words of the last pass, blocks."""
    per = {r["source"]: r for r in sizes.groupBy("source").agg(F.sum("_mx_size").alias("size"), F.count("*").alias("n")).collect()}
    goal, rows = targets({k: int(r["size"]) for k, r in per.items()}), []
    for k, name in enumerate(sorted(per, key=lambda x: (x is None, x or ""))):
        size, target = int(per[name]["size"]), float(goal[name])
        full = min(int(target // size), int(MOST)) if size else 0
        rows.append((name, k, size, target, full, target - full * size, max(1, min(BLOCKS, per[name]["n"] // BLOCK_DOCS))))
    return rows


def _edge(docs: DataFrame, block: str, left: str) -> DataFrame:
    """(_mx_k, edge, left, docs): of each source the first block that does not fit whole, and what is left when its turn comes."""
    upto = Window.partitionBy("_mx_k").orderBy(block).rowsBetween(Window.unboundedPreceding, 0)
    totals = docs.groupBy("_mx_k", left, block).agg(F.sum("_mx_size").alias("words"), F.count("*").alias("docs")).withColumn("upto", F.sum("words").over(upto))
    over = totals.filter(F.col("upto") > F.col(left)).select("_mx_k", F.struct(F.col(block).alias("edge"), (F.col(left) - F.col("upto") + F.col("words")).alias("left"), "docs").alias("e"))
    return over.groupBy("_mx_k").agg(F.min_by("e", "e.edge").alias("e")).select("_mx_k", "e.*")


def _cuts(spark, quotas: dict, shards: int, seed: int) -> DataFrame:
    """(_cut_k, _cut_pass, quota, ends): the last ranks, exclusive, of each shard in a quota's permuted order."""
    ends = np.cumsum(splitting_tree(np.array(list(quotas.values()), np.int64), shards, seed), axis=0)
    rows = [(*key, n, [int(x) for x in ends[:, j]]) for j, (key, n) in enumerate(quotas.items())]
    return spark.createDataFrame(rows, "_cut_k int, _cut_pass int, quota long, ends array<int>")


def _shard_of(rank: str) -> Column:
    return F.size(F.filter("ends", lambda e: e <= F.col(rank))).cast("int")


def _draw(spark, quotas: dict, shards: int, seed: int) -> DataFrame:
    """(_dr_k, _dr_block, _dr_shards): the shard of each taken block in each pass, for quotas by (source, pass)."""
    quotas = {key: n for key, n in quotas.items() if n}
    cuts = sized_broadcast(_cuts(spark, quotas, shards, seed), len(quotas), 64 + 4 * shards)
    taken = spark.createDataFrame([(*key, n) for key, n in quotas.items()], "k int, pass int, n long").select("k", "pass", F.explode(F.sequence(F.lit(0), F.col("n").cast("int") - 1)).alias("_dr_block"))
    # Ordered anew in each pass, so that a block's shard does not follow from whether it is taken.
    anew = Window.partitionBy("k", "pass").orderBy(F.xxhash64("k", "pass", "_dr_block", F.lit(seed + 2)), "_dr_block")
    taken = taken.withColumn("rank", F.row_number().over(anew) - 1).join(cuts, (F.col("k") == F.col("_cut_k")) & (F.col("pass") == F.col("_cut_pass")))
    taken = taken.select("k", "_dr_block", "pass", _shard_of("rank").alias("shard"))
    return taken.groupBy(F.col("k").alias("_dr_k"), "_dr_block").agg(F.sort_array(F.collect_list(F.struct("pass", "shard")))["shard"].alias("_dr_shards"))


def mixture(docs: DataFrame, shards: int) -> tuple[DataFrame, DataFrame]:
    """docs as `row` with _mx_size, _mx_k, _mx_hash and _mx_shards, the shard of each copy; and all of them without texts but with the plan."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    keyed = _distinct(docs, scratch)
    sizes = scratch.store(keyed.select("doc_id", "source", "_mx_hash", "_mx_size"), "sizes")
    rows = _plan(sizes)
    plan = spark.createDataFrame(rows, "_mx_source string, _mx_k int, _mx_source_size long, _mx_target double, _mx_full int, _mx_rest double, _mx_blocks int")
    plan = sized_broadcast(plan, len(rows), 100 + max((len((r[0] or "").encode()) for r in rows), default=0))
    of_source = F.col("source").eqNullSafe(F.col("_mx_source"))
    block = F.pmod("_mx_hash", "_mx_blocks").cast("int")
    d = sizes.join(plan, of_source).withColumn("_mx_block", block)
    edge = scratch.store(_edge(d, "_mx_block", "_mx_rest"), "edges")
    # The edge block is cut into blocks of its own, so that only some dozens of documents are left to draw one by one.
    inner = F.greatest(F.lit(1), F.least(F.lit(BLOCKS), F.floor(F.col("docs") / BLOCK_DOCS))).cast("int")
    edges = edge.select(F.col("_mx_k").alias("_ed_k"), F.col("edge").alias("_ed_block"), F.col("left").alias("_ed_left"), inner.alias("_ed_blocks"))
    edges = sized_broadcast(edges, len(rows), 40)
    inside = F.pmod(F.xxhash64("_mx_hash", F.lit(SEED + 5)), F.col("_ed_blocks")).cast("int")
    at_edge = (F.col("_mx_k") == F.col("_ed_k")) & (F.col("_mx_block") == F.col("_ed_block"))
    within = d.join(edges, at_edge).withColumn("_ed_inside", inside).select("_mx_k", "_mx_hash", "_mx_size", "_ed_left", "_ed_inside")
    within = scratch.store(within, "edge-blocks")
    last = scratch.store(_edge(within, "_ed_inside", "_ed_left"), "inner-edges")
    lasts = sized_broadcast(last.select(F.col("_mx_k").alias("_la_k"), F.col("edge").alias("_la_block"), "left"), len(rows), 40)
    few = within.join(lasts, (F.col("_mx_k") == F.col("_la_k")) & (F.col("_ed_inside") == F.col("_la_block"))).select("_mx_k", "_mx_hash", F.col("_mx_size").alias("size"), "left")
    picked = scratch.store(few.groupBy("_mx_k").applyInPandas(_fit, "_px_k int, _px_hash long, _px_rank int"), "edge-documents")
    # Each pass over a source has a quota of its own: the blocks that it takes whole. Those inside edge blocks
    # and the documents of the last blocks are dealt by trees of their own.
    outer = {r["_mx_k"]: r["edge"] for r in edge.collect()}
    quotas = {}
    for _, k, _, _, full, rest, n in rows:
        quotas |= {(k, p): n for p in range(full)} | {(k, full): outer.get(k, n if rest > 0 else 0)}
    drawn = scratch.store(_draw(spark, quotas, shards, SEED), "drawn-blocks")
    drawn_inside = scratch.store(_draw(spark, {(r["_mx_k"], 0): r["edge"] for r in last.collect()}, shards, SEED + 6), "drawn-inner-blocks")
    counts = {(r["_px_k"], 0): r["count"] for r in picked.groupBy("_px_k").count().orderBy("_px_k").collect()}
    cuts = sized_broadcast(_cuts(spark, counts, shards, SEED + 3), len(counts), 64 + 4 * shards)
    picked = scratch.store(picked.join(cuts, F.col("_px_k") == F.col("_cut_k")).select("_px_k", "_px_hash", _shard_of("_px_rank").alias("_px_shard")), "edge-shards")
    # At most BLOCKS rows of each source and some dozens of its last block, counted before a broadcast.
    out = keyed.join(plan, of_source).withColumn("_mx_block", block).join(edges, at_edge, "left").withColumn("_ed_inside", inside)
    drawn_inside = drawn_inside.select(F.col("_dr_k").alias("_di_k"), F.col("_dr_block").alias("_di_block"), F.col("_dr_shards").alias("_di_shards"))
    out = out.join(checked_broadcast(drawn, 40), (F.col("_mx_k") == F.col("_dr_k")) & (F.col("_mx_block") == F.col("_dr_block")), "left")
    out = out.join(checked_broadcast(drawn_inside, 40), (F.col("_ed_k") == F.col("_di_k")) & (F.col("_ed_inside") == F.col("_di_block")), "left")
    out = out.join(checked_broadcast(picked, 20), (F.col("_ed_k") == F.col("_px_k")) & (F.col("_mx_hash") == F.col("_px_hash")), "left")
    none = F.array().cast("array<int>")
    copies = F.concat(F.coalesce("_dr_shards", none), F.coalesce("_di_shards", none), F.when(F.col("_px_shard").isNotNull(), F.array("_px_shard")).otherwise(none))
    return out.withColumn("_mx_shards", F.when(F.col("_mx_size") > 0, copies).otherwise(none)), d


def _even_keys(spark, shards: int) -> list[int]:
    """For each shard a number that Spark's hash partitioning deals to a partition of its own."""
    found: dict[int, int] = {}
    upto = 16 * shards
    while len(found) < shards:
        part = F.pmod(F.hash(F.col("id").cast("int")), F.lit(shards)).alias("part")
        found = {r["part"]: r["key"] for r in spark.range(upto).groupBy(part).agg(F.min(F.col("id").cast("int")).alias("key")).collect()}
        upto *= 2
    return [found[k] for k in range(shards)]


def _mixed(m: DataFrame, shards: int) -> DataFrame:
    """The mixture's rows with all columns of m, dealt to shards, a partition each, and shuffled in them."""
    keys = F.array(*[F.lit(k) for k in _even_keys(m.sparkSession, shards)])
    m = m.withColumn("_mx_shard", F.explode("_mx_shards")).withColumn("_mx_to", F.get(keys, F.col("_mx_shard")))
    return m.repartition(shards, "_mx_to").sortWithinPartitions("_mx_shard", F.xxhash64("_mx_hash", F.lit(SEED + 1)))


def _shards(docs: DataFrame) -> int:
    return int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def mix(docs: DataFrame, shards: int | None = None) -> DataFrame:
    """The mixture's rows: each document as often as it is taken, with its shard, shuffled inside its shard.

    The shard's column is `_mx_shard`, with a `_` more for as long as docs has one of that name.
    shards: as many as there are shuffle partitions unless given.
    """
    shards = shards or _shards(docs)
    name = "_mx_shard"
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    columns = [F.col("row").getField(c).alias(c) for c in docs.columns]
    return _mixed(mixture(docs, shards)[0], shards).select(*columns, F.col("_mx_shard").alias(name))


def op9_mixing(docs: DataFrame) -> DataFrame:
    """Per document: its size, its source's size and target, the words the mix takes of it.

    The mix is made with its texts, and the words of its rows are counted and summed back.
    """
    docs = docs.select("doc_id", "text", "source")
    shards = _shards(docs)
    m, sizes = mixture(docs, shards)
    mixed = _mixed(m, shards).select("_mx_k", "_mx_hash", word_count(F.col("row.text")).alias("words"))
    # Rows of one hash, if any, are taken equally often.
    count = sizes.select("_mx_k", "_mx_hash", F.lit(1).alias("n"), F.lit(0).cast("long").alias("words"))
    count = count.union(mixed.select("_mx_k", "_mx_hash", F.lit(0), "words")).groupBy("_mx_k", "_mx_hash").agg((F.sum("words") / F.sum("n")).cast("long").alias("taken"))
    out = sizes.join(count, ["_mx_k", "_mx_hash"])
    return out.select("doc_id", F.col("_mx_size").alias("size"), F.col("_mx_source_size").alias("source_size"), F.col("_mx_target").alias("target"), "taken")
