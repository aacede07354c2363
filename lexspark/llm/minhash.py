"""Operator 8: near-duplicate documents by b-bit MinHash.

One pass over the texts makes, for every document, its shingle set's size and a 128-bit
fingerprint of the set, up to 128 minima banded into keys (by 85 percent 21 of 6, by 80 percent 25 of
5), and the low two bits of 128 minima packed into 32 bytes. Documents with equal sets form a class at once; only one of each class goes on.
Inside a bucket of equal band keys the packed signatures are compared by counting bits; the share
of equal lanes, corrected for chance collisions, estimates the similarity. Pairs whose estimate is
within five standard errors of the threshold are confirmed on the full sets, made anew from the
whole texts of the documents that share a bucket.

A bucket never becomes all its pairs. First each member proposes its two most similar partners,
and confirmed links are contracted to components; a bucket larger than a block is cut into blocks,
each compared with itself and with the first one alone. Then the buckets that still hold documents of
different components with further partners are settled where they are: their tasks have the texts,
confirm every remaining pair that no earlier band brings together, joining components as they go,
and return the links that joined any, fewer than they have members. There, members of a bucket's
largest component meet the others only, so a large group of copies costs as many comparisons as it
has members times the members that did not join it. So every link between different components is
tried.

Defined results: null or blank texts have no shingles and link with nothing; fewer than five words
are one shingle; rows that share a doc_id are one document whose links are those of all its rows
(each row has the set size of its own text and the component of them all);
a row with a null doc_id links with nothing and is kept; an empty table gives an empty table; only
doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.llm.common import Scratch, checked_broadcast, slices
from lexspark.llm.graph import connected_components
from lexspark.llm.shingles import mix, shingle_set, word_hashes

LANES, BITS = 128, 2
#: Chance that no band brings a pair at the threshold together, at most.
MISS = 5e-5
LOW_BITS = np.uint64(0x5555555555555555)
#: Linked if 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Members of a bucket that one task compares with each other, or with as many others.
BLOCK = 2048
#: Bytes of texts that a block of a bucket holds, where texts are compared.
BLOCK_BYTES = 16 << 20
_RNG = np.random.default_rng(20240229)
_MULTIPLY = _RNG.integers(0, 2**63, LANES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 2**63, LANES, dtype=np.uint64)
SIGNATURE = "doc_id long, text_hash long, n_shingles long, fp1 long, fp2 long, packed binary, bands array<long>"


def banding(percent: int) -> tuple[int, int]:
    """(bands, rows): the longest bands that miss a pair at the threshold with a chance of at most MISS."""
    j = percent / 100
    rows = max((r for r in range(1, LANES + 1) if (1 - j**r) ** (LANES // r) <= MISS), default=1)
    return LANES // rows, rows


def signature(shingles: np.ndarray, percent: int = PERCENT) -> tuple[bytes, np.ndarray]:
    """Packed low bits of the minima, and the keys of the bands."""
    n_bands, n_rows = banding(percent)
    least = np.full(LANES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 1024):
        part = shingles[None, at : at + 1024] * _MULTIPLY[:, None] + _ADD[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    least = mix(least)
    lanes = (least & np.uint64(2**BITS - 1)).reshape(-1, 32)
    packed = np.bitwise_or.reduce(lanes << (np.arange(32, dtype=np.uint64) * np.uint64(BITS)), axis=1)
    rows = least[: n_bands * n_rows].reshape(n_bands, n_rows)
    key = np.arange(1, n_bands + 1, dtype=np.uint64)
    for r in range(n_rows):
        key = mix(key ^ rows[:, r]) + np.uint64(r)
    return packed.astype("<u8").tobytes(), key


def estimated_similarity(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of packed signatures (…, 4 words), corrected for the lanes that agree by chance."""
    chance = 1 / 2**BITS
    return ((1 - _apart(a, b) / LANES) - chance) / (1 - chance)


def estimate_floor(percent: int) -> float:
    """Five standard errors of the estimate below the threshold."""
    j, chance = percent / 100, 1 / 2**BITS
    agree = j + (1 - j) * chance
    return j - 5 * (agree * (1 - agree) / LANES) ** 0.5 / (1 - chance)


def _signatures(percent: int):
    def run(batches):
        import pyarrow as pa

        for batch in slices(batches):
            texts = batch.column(2).to_pylist()
            n, fp1, fp2, packed, bands = [], [], [], [], []
            for words in word_hashes(texts):
                s = shingle_set(words)
                n.append(len(s))
                if len(s):
                    p, keys = signature(s, percent)
                    fp1.append(int(mix(s ^ np.uint64(0xA5A5A5A5)).sum().view(np.int64)))
                    fp2.append(int(mix(s + np.uint64(0x5DEECE66D)).sum().view(np.int64)))
                    packed.append(p)
                    bands.append(keys.view(np.int64))
                else:
                    fp1.append(0), fp2.append(0), packed.append(None), bands.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(fp1, pa.int64()), pa.array(fp2, pa.int64()), pa.array(packed, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "text_hash", "n_shingles", "fp1", "fp2", "packed", "bands"],
            )

    return run


def _most_apart(percent: int) -> float:
    """Lanes that may differ: as many as leave the estimate at its floor."""
    return LANES * (1 - estimate_floor(percent)) * (1 - 1 / 2**BITS)


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a ^ b
    return np.bitwise_count((x | (x >> np.uint64(1))) & LOW_BITS).sum(axis=-1, dtype=np.int64)


def _unpack(packed) -> np.ndarray:
    return np.frombuffer(b"".join(packed.to_pylist()), "<u8").reshape(-1, LANES * BITS // 64)


def group_bounds(*keys: np.ndarray):
    """(lo, hi) of the runs of equal keys that have at least two rows."""
    cut = np.flatnonzero(np.logical_or.reduce([np.diff(k) != 0 for k in keys])) + 1
    for lo, hi in zip(np.concatenate([[0], cut]).tolist(), np.concatenate([cut, [len(keys[0])]]).tolist(), strict=True):
        if hi - lo > 1:
            yield lo, hi


def _proposals(percent: int, most: int = 2):
    """Groups (key, block_a, block_b | block, id, packed), sorted by the first three, to (a, b, key).

    Each member proposes its `most` most similar partners with smaller ids. A row with a key alone
    tells that a member there has more partners that may be similar enough.
    """
    allowed = _most_apart(percent)
    far = np.int64(1) << 40

    def pairs_of(block, ids, sig, one, other):
        # members of the later block against those of the earlier one, or a block against itself
        rows, cols = np.flatnonzero(block == other), np.flatnonzero(block == one)
        more = False
        for at in range(0, len(rows), 256):
            r = rows[at : at + 256]
            rank = (_apart(sig[r][:, None, :], sig[cols][None, :, :]) << 20) + np.arange(len(cols))
            skip = ids[cols][None, :] >= ids[r][:, None] if one == other else ids[cols][None, :] == ids[r][:, None]
            rank[skip | ((rank >> 20) > allowed)] = far
            more = more or bool(((rank < far).sum(axis=1) > most).any())
            if most < len(cols):
                rank = np.partition(rank, most - 1, axis=1)[:, :most]
            i, k = np.nonzero(rank < far)
            yield ids[cols[rank[i, k] & 0xFFFFF]], ids[r[i]], more

    def run(batches):
        import pyarrow as pa

        def emit(t):
            key, x, y, block, ids = (t.column(c).to_numpy() for c in range(5))
            sig = _unpack(t.column(5))
            a, b, again = [], [], []
            for lo, hi in group_bounds(key, x, y):
                s, more = slice(lo, hi), False
                for p, q, more in pairs_of(block[s], ids[s], sig[s], x[lo], y[lo]):
                    a.append(np.minimum(p, q))
                    b.append(np.maximum(p, q))
                if more:
                    again.append(key[lo])
            a, b = (np.concatenate(v) if v else np.empty(0, np.int64) for v in (a, b))
            none = pa.nulls(len(again), pa.int64())
            cols = [pa.concat_arrays([pa.array(v, pa.int64()), none]) for v in (a, b)]
            keys = pa.concat_arrays([pa.nulls(len(a), pa.int64()), pa.array(again, pa.int64())])
            return pa.RecordBatch.from_arrays([*cols, keys], names=["a", "b", "key"])

        yield from by_groups(batches, 3, emit)

    return run


def _settle(percent: int):
    """Groups (key, block_a, block_b | block, id, component, packed, bands, text) to links (u, v) that join components."""
    allowed = _most_apart(percent)

    def run(batches):
        import pyarrow as pa

        def emit(t):
            key, x, y, block, ids, comp = (t.column(c).to_numpy() for c in range(6))
            sig = _unpack(t.column(6))
            bands = np.array(t.column(7).to_pylist(), np.int64)
            u, v = [], []
            for lo, hi in group_bounds(key, x, y):
                s = slice(lo, hi)
                sets = [shingle_set(w) for w in word_hashes(t.column(8).slice(lo, hi - lo).to_pylist())]
                for i, j in _join(ids[s], comp[s], sig[s], bands[s], sets, key[lo], np.flatnonzero(block[s] == y[lo]), np.flatnonzero(block[s] == x[lo])):
                    u.append(int(ids[lo + i]))
                    v.append(int(ids[lo + j]))
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

        yield from by_groups(batches, 3, emit)

    def _join(ids, comp, sig, bands, sets, key, rows, cols):
        comp = comp.copy()
        size = np.array([len(z) for z in sets])
        names, flat = np.unique(np.concatenate(sets), return_inverse=True)
        ends = np.cumsum(size)
        marked = np.zeros(len(names), bool)
        for i in rows.tolist():
            js = cols[(comp[cols] != comp[i]) & (ids[cols] != ids[i])]
            js = js[_apart(sig[i], sig[js]) <= allowed]
            # the first band that brings the pair together is this one
            js = js[bands[i][(bands[js] == bands[i]).argmax(axis=1)] == key]
            if not len(js):
                continue
            mine = flat[ends[i] - size[i] : ends[i]]
            marked[mine] = True
            for at in range(0, len(js), 512):
                part = js[at : at + 512]
                n = size[part]
                first = np.cumsum(n) - n
                all_ = flat[np.arange(int(n.sum())) + np.repeat(ends[part] - n - first, n)]
                both = np.add.reduceat(marked[all_].astype(np.int64), first)
                for j in part[100 * both >= percent * (size[i] + n - both)].tolist():
                    if comp[j] != comp[i]:
                        comp[comp == comp[j]] = comp[i]
                        yield i, j
            marked[mine] = False

    return run


def by_groups(batches, n_keys: int, emit):
    """Calls emit on tables that hold whole groups of rows with equal first n_keys columns; rows come sorted by them."""
    import pyarrow as pa

    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        changed = np.zeros(batch.num_rows, bool)
        for c in range(n_keys):
            v = batch.column(c).to_numpy()
            changed[1:] |= v[1:] != v[:-1]
            changed[0] |= bool(held) and held[-1].column(c)[-1].as_py() != v[0]
        starts = np.flatnonzero(changed)
        if len(starts):
            if starts[-1]:
                held.append(batch.slice(0, starts[-1]))
            if held:
                yield emit(pa.Table.from_batches(held).combine_chunks())
            held = [batch.slice(starts[-1])]
        else:
            held.append(batch)
    if held:
        yield emit(pa.Table.from_batches(held).combine_chunks())


def _confirm(percent: int):
    def run(batches):
        import pyarrow as pa

        for batch in slices(batches):
            a, b = (batch.column(k).to_pylist() for k in (0, 1))
            texts = dict(zip(a, batch.column(2).to_pylist(), strict=True)) | dict(zip(b, batch.column(3).to_pylist(), strict=True))
            ids = list(texts)
            sets = {i: shingle_set(w) for i, w in zip(ids, word_hashes([texts[i] for i in ids]), strict=True)}
            keep = []
            for i, j in zip(a, b, strict=True):
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                keep.append(100 * both >= percent * (len(sets[i]) + len(sets[j]) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_())).rename_columns(["u", "v"])

    return run


def blocks(rows: DataFrame, key: str, block: int, needs: str | None = None, star: bool = False) -> DataFrame:
    """rows of a key with at least two members, dealt out to (key, block_a, block_b).

    Keys with more than `block` rows are cut into blocks by the id's hash, and each pair of blocks
    becomes a group of its own, so that no group exceeds twice a block's expected size. needs: a
    boolean column that must be true for a row of the key at least. star: only pairs of a block with
    itself and with the first one.
    """
    sizes = rows.groupBy(key).agg(F.count("*").alias("_n"), (F.bool_or(needs) if needs else F.lit(True)).alias("_has")).filter("_n > 1 and _has").drop("_has")
    n = F.ceil(F.col("_n") / block).cast("int")
    rows = rows.join(sizes, key).withColumn("_blocks", n).withColumn("block", F.pmod(F.xxhash64("id"), F.col("_blocks")).cast("int"))
    others = F.sequence(F.lit(0), F.col("_blocks") - 1)
    if star:
        others = F.when(F.col("block") == 0, others).otherwise(F.array(F.lit(0), F.col("block")))
    rows = rows.withColumn("_other", F.explode(others))
    return rows.withColumns({"block_a": F.least("block", "_other").cast("int"), "block_b": F.greatest("block", "_other").cast("int")}).drop("_n", "_blocks", "_other")


def _deal_unsettled(rows: DataFrame, block: int) -> DataFrame:
    """rows (key, id, component, bytes) of keys with several components, dealt out to (key, block_a, block_b).

    Members of a key's largest component are in blocks behind those of the others, and meet these only.
    Blocks are bounded by rows and by bytes of text.
    """
    per = rows.groupBy("key", "component").agg(F.count("*").alias("count"), F.sum("bytes").alias("bytes"))
    top = F.max_by(F.struct("component", "count", "bytes"), F.struct("count", "component"))
    most = per.groupBy("key").agg(top.alias("_top"), F.sum("count").alias("_n"), F.sum("bytes").alias("_b"))
    rows = rows.join(most.filter("_n > _top.count"), "key")
    cut = lambda n, size: F.greatest(F.ceil(n / block), F.ceil(size / BLOCK_BYTES)).cast("int")
    top = F.col("_top")
    rows = rows.withColumns({"_minor": F.col("component") != top["component"], "_minors": cut(F.col("_n") - top["count"], F.col("_b") - top["bytes"]), "_majors": cut(top["count"], top["bytes"])})
    h = F.xxhash64("id")
    rows = rows.withColumn("block", F.when(F.col("_minor"), F.pmod(h, "_minors")).otherwise(F.col("_minors") + F.pmod(h, "_majors")).cast("int"))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.when(F.col("_minor"), F.col("_minors") + F.col("_majors")).otherwise(F.col("_minors")) - 1)))
    return rows.withColumns({"block_a": F.least("block", "_other").cast("int"), "block_b": F.greatest("block", "_other").cast("int")})


def find_near_duplicates(docs: DataFrame, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept.

    What is compared are classes of equal sets, under numbers of their own; a doc_id that several
    classes share links them.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "minhash")
    source = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    sigs = scratch.store(source.mapInArrow(_signatures(percent), SIGNATURE), "signatures")
    full = sigs.filter("n_shingles > 0 and doc_id is not null")
    fp = ["fp1", "fp2", "n_shingles"]
    first = F.min(F.struct("doc_id", "text_hash")).alias("first")
    classes = full.groupBy(*fp).agg(first).select(*fp, F.col("first.doc_id").alias("doc_id"), F.col("first.text_hash").alias("text_hash"), F.monotonically_increasing_id().alias("id"))
    classes = scratch.store(classes, "classes")
    reps = full.join(classes, [*fp, "doc_id", "text_hash"]).select("id", "doc_id", "text_hash", "packed", "bands").dropDuplicates(["id"])
    reps = scratch.store(reps, "representatives")
    keys = reps.select("id", F.explode("bands").alias("key"))
    multi = keys.groupBy("key").agg(F.count("*").alias("_n")).filter("_n > 1").select("key")
    keys = scratch.store(keys.join(multi, "key"), "bucket-keys")
    shared = scratch.store(keys.select("id").distinct(), "in-buckets")
    # Texts of the classes that share a bucket; equal rows of a document may bring one twice.
    wanted = scratch.store(reps.join(shared, "id").select("doc_id", "text_hash", "id"), "wanted")
    texts = source.join(checked_broadcast(wanted, 32), ["doc_id", "text_hash"]).select("id", "text")
    texts = scratch.store(texts.dropDuplicates(["id"]), "texts")
    groups = ["key", "block_a", "block_b"]
    dealt = blocks(keys, "key", block, star=True).join(reps.select("id", "packed"), "id").select(*groups, "block", "id", "packed")
    dealt = dealt.repartition(*groups).sortWithinPartitions(*groups)
    proposed = scratch.store(dealt.mapInArrow(_proposals(percent), "a long, b long, key long").distinct(), "proposed")
    pairs = proposed.filter("key is null").join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    pairs = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    links = pairs.select("a", "b", "text_a", "text_b").mapInArrow(_confirm(percent), "u long, v long")
    member = scratch.store(full.select("doc_id", *fp).join(classes.select(*fp, "id"), fp).select("doc_id", "id").distinct(), "members")
    several = member.groupBy("doc_id").agg(F.min("id").alias("u"), F.max("id").alias("v")).filter("u < v").select("doc_id", "u")
    one_document = member.join(several, "doc_id").filter("id > u").select("u", F.col("id").alias("v"))
    links = scratch.store(links.union(one_document), "links")
    labels = scratch.store(connected_components(links, scratch), "components")
    large = keys.groupBy("key").count().filter(F.col("count") > block)
    open_keys = proposed.filter("key is not null").select("key").union(large.select("key")).distinct()
    rows = keys.join(open_keys, "key").join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    rows = rows.join(texts.select("id", F.octet_length("text").alias("bytes")), "id")
    rows = scratch.store(_deal_unsettled(rows, max(1, block // 2)), "unsettled")
    dealt = rows.join(reps.select("id", "packed", "bands"), "id").join(texts, "id")
    dealt = dealt.select(*groups, "block", "id", "component", "packed", "bands", "text").repartition(*groups).sortWithinPartitions(*groups)
    more = scratch.store(dealt.mapInArrow(_settle(percent), "u long, v long"), "more-links")
    if more.limit(1).count():  # else the components stand
        labels = scratch.store(connected_components(links.union(more), scratch), "components")
    at = classes.join(labels, "id", "left").select("id", *fp, F.coalesce("component", "id").alias("component"), F.col("doc_id").alias("least"))
    least = at.groupBy("component").agg(F.min("least").alias("component_id"))
    at = scratch.store(at.join(least, "component").select("id", *fp, "component_id"), "labelled")
    out = sigs.filter("n_shingles > 0").join(at.drop("id"), fp, "left").select("doc_id", "n_shingles", "component_id")
    # A row without words belongs to its document's other rows, if it has any.
    blank = sigs.filter("n_shingles = 0").select("doc_id", "n_shingles")
    others = member.join(blank.select("doc_id").distinct(), "doc_id").join(at.select("id", "component_id"), "id").groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    out = out.union(blank.join(others, "doc_id", "left").select("doc_id", "n_shingles", "component_id"))
    component = F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
