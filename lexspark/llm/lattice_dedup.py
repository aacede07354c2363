"""Operator 5: near-duplicate embeddings by lattice hashing.

In each of TABLES tables a vector of unit length is projected at random to 16 dimensions, scaled,
and decoded to the nearest point of two E8 lattices; the pair of points is its cell. It is a member
of its own cell and visits the PROBES neighbouring cells that lie nearest to it. Members and
visitors of a cell are compared in double precision by matrix products; cells with many rows are
dealt out as pairs of blocks. A pair that meets in several cells is counted in the first alone,
which both sides can tell from their vectors, so tasks emit sums of links and the edges of a
spanning forest, never all pairs. Equal vectors form a class and are compared once.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components link
with nothing, are their own component and are kept; vectors of different dimension never link;
rows with equal vec_id and equal vector are one vector and get equal results; rows with one vec_id
and different vectors are vectors of their own, each with its own n_links (which counts other pairs
of vec_id and vector), in one component; a null vec_id links
with nothing, has a null component and is kept; an empty table gives an empty table; only vec_id
and embedding are read.
"""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from lexspark.llm.common import Scratch, slices
from lexspark.llm.graph import connected_components
from lexspark.llm.minhash import blocks, by_groups, group_bounds
from lexspark.llm.shingles import mix

LEAST = 0.9
TABLES, PROBES, SCALE, LATTICES = 8, 12, 4.0, 2
BLOCK = 2048


def _minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8: two coordinates of +-1, or eight of +-1/2 with evenly many minus signs."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for s, t in itertools.product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = s, t
            out.append(v)
    return np.array(out + [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0])


_NEIGHBOURS = _minimal_vectors()
_COORDINATE = mix(np.arange(1, 8 * LATTICES + 1, dtype=np.uint64)) | np.uint64(1)


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum: round, and if odd re-round the coordinate that is furthest off."""
    r = np.rint(x)
    odd = np.flatnonzero(r.sum(-1).astype(np.int64) & 1)
    off = x[odd] - r[odd]
    k = np.abs(off).argmax(-1)
    r[odd, k] += np.where(off[np.arange(len(odd)), k] >= 0, 1.0, -1.0)
    return r


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest points of E8, which is D8 and D8 shifted by one half."""
    a, b = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(-1) <= ((x - b) ** 2).sum(-1))[:, None], a, b)


def _projections(dim: int) -> np.ndarray:
    rng = np.random.default_rng([5, dim])
    wide = rng.standard_normal((TABLES, max(dim, 8 * LATTICES), 8 * LATTICES))
    return np.stack([np.linalg.qr(w)[0][:dim] * SCALE for w in wide])


def cells(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the own cells (n, TABLES) and of the visited ones (n, TABLES, PROBES) of vectors."""
    n, dim = x.shape
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    own, visited = np.empty((n, TABLES), np.uint64), np.empty((n, TABLES, PROBES), np.uint64)
    row = np.arange(n)
    for t, projection in enumerate(_projections(dim)):
        y = (unit @ projection).reshape(n * LATTICES, 8)
        c = nearest_e8(y)
        gain = ((y - c) @ _NEIGHBOURS.T).reshape(n, -1)
        c = c.reshape(n, LATTICES, 8)
        tag = mix(np.uint64(t * 1_000_003 + dim) + np.zeros(1, np.uint64))

        def key(at, tag=tag):
            return mix((np.rint(2 * at).astype(np.int64).view(np.uint64).reshape(n, -1) * _COORDINATE).sum(1, dtype=np.uint64) ^ tag)

        own[:, t] = key(c)
        best = np.argsort(-gain, axis=1, kind="stable")[:, :PROBES]
        for p in range(PROBES):
            moved = c.copy()
            moved[row, best[:, p] // len(_NEIGHBOURS)] += _NEIGHBOURS[best[:, p] % len(_NEIGHBOURS)]
            visited[:, t, p] = key(moved)
    return own.view(np.int64), visited.view(np.int64)


def _hashed(kind: str):
    """(id, n, vector) with own and visited cells, the vector as bytes of its own width; vectors of each dimension together."""

    def run(batches):
        import pyarrow as pa

        for batch in slices(batches):
            vectors = [np.asarray(v, kind) for v in batch.column(1).to_pylist()]
            own: list = [None] * len(vectors)
            visited: list = [None] * len(vectors)
            for dim in {len(v) for v in vectors}:
                at = [k for k, v in enumerate(vectors) if len(v) == dim]
                o, p = cells(np.stack([vectors[k] for k in at]).astype(np.float64))
                for k, a, b in zip(at, o, p.reshape(len(at), -1), strict=True):
                    own[k], visited[k] = a, b
            keys = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([v.tobytes() for v in vectors], pa.binary()), batch.column(2), pa.array(own, keys), pa.array(visited, keys)], names=["id", "vector", "copies", "own", "visited"])

    return run


def _first_meeting(key: int, a: tuple, b: tuple) -> np.ndarray:
    """Whether `key` is the first cell in which vectors meet; a, b: own and visited cells of each pair's sides."""
    (own_a, visits_a), (own_b, visits_b) = a, b
    none = np.iinfo(np.int64).max
    at_a = np.where((own_a == own_b) | (visits_b == own_a[..., None]).any(-1), own_a, none)
    at_b = np.where((visits_a == own_b[..., None]).any(-1), own_b, none)
    where = np.minimum(at_a, at_b)
    table = (where != none).argmax(1)
    return where[np.arange(len(where)), table] == key


def _compare(least: float, kind: str):
    """Groups of (key, block_a, block_b, block, member, id, copies, vector) to (id, links, other): link counts and forest edges."""

    def group(key, block, member, ids, copies, vectors, one, other):
        lens = np.array([len(v) for v in vectors])
        for size in np.unique(lens):
            some = np.flatnonzero(lens == size)
            x = np.frombuffer(b"".join(vectors[k] for k in some), kind).reshape(len(some), -1).astype(np.float64)
            norm = np.linalg.norm(x, axis=1)
            rows, cols = np.flatnonzero(block[some] == other), np.flatnonzero(block[some] == one)
            for at in range(0, len(rows), 512):
                r = rows[at : at + 512]
                close = (x[r] @ x[cols].T) / (norm[r][:, None] * norm[cols][None, :]) >= least
                close &= member[some][r][:, None] | member[some][cols][None, :]
                close &= (ids[some][cols][None, :] < ids[some][r][:, None]) if one == other else (ids[some][cols][None, :] != ids[some][r][:, None])
                i, j = np.nonzero(close)
                if not len(i):
                    continue
                i, j = r[i], cols[j]
                used, back = np.unique(np.concatenate([i, j]), return_inverse=True)
                own, visits = cells(x[used])
                for lo in range(0, len(i), 20_000):
                    bi, bj = back[: len(i)][lo : lo + 20_000], back[len(i) :][lo : lo + 20_000]
                    first = _first_meeting(key, (own[bi], visits[bi]), (own[bj], visits[bj]))
                    yield some[i[lo : lo + 20_000][first]], some[j[lo : lo + 20_000][first]]

    def run(batches):
        import pyarrow as pa

        def emit(t):
            key, x, y, block = (t.column(c).to_numpy() for c in range(4))
            member = t.column(4).to_numpy(zero_copy_only=False).astype(bool)
            ids, copies = t.column(5).to_numpy(), t.column(6).to_numpy()
            vectors = t.column(7).to_pylist()
            links = np.zeros(len(key), np.int64)
            parent = np.arange(len(key))

            def root(k):
                while parent[k] != k:
                    parent[k] = parent[parent[k]]
                    k = parent[k]
                return k

            edges: list[tuple[int, int]] = []
            for lo, hi in group_bounds(key, x, y):
                s = slice(lo, hi)
                for i, j in group(key[lo], block[s], member[s], ids[s], copies[s], vectors[lo:hi], x[lo], y[lo]):
                    np.add.at(links, i + lo, copies[j + lo])
                    np.add.at(links, j + lo, copies[i + lo])
                    for a, b in zip((i + lo).tolist(), (j + lo).tolist(), strict=True):
                        ra, rb = root(a), root(b)
                        if ra != rb:
                            parent[ra] = rb
                            edges.append((a, b))
            some = np.flatnonzero(links)
            out_id = np.concatenate([ids[some], ids[[e[0] for e in edges]] if edges else np.empty(0, np.int64)])
            out_links = np.concatenate([links[some], np.zeros(len(edges), np.int64)])
            out_other = [None] * len(some) + [int(ids[e[1]]) for e in edges]
            return pa.RecordBatch.from_arrays([pa.array(out_id, pa.int64()), pa.array(out_links, pa.int64()), pa.array(out_other, pa.int64())], names=["id", "links", "other"])

        yield from by_groups(batches, 3, emit)

    return run


def link_embeddings(vectors: DataFrame, least: float = LEAST, block: int = BLOCK) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept. least: cosine from which vectors link."""
    scratch = Scratch(vectors.sparkSession, "lattice")
    single = isinstance(getattr(vectors.schema["embedding"].dataType, "elementType", None), FloatType)
    kind, width = ("<f4", "float") if single else ("<f8", "double")
    v = vectors.select("vec_id", F.col("embedding").cast(f"array<{width}>").alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    v = scratch.store(v.withColumn("ok", F.coalesce(sound & F.col("vec_id").isNotNull(), F.lit(False))), "vectors")
    # Classes of equal vectors, under numbers of their own.
    classes = v.filter("ok").groupBy("v").agg(F.min("vec_id").alias("least"), F.count_distinct("vec_id").alias("copies"))
    classes = scratch.store(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    own = scratch.store(v.filter("ok").join(classes.select("v", "id"), "v").select("vec_id", "id"), "members")
    hashed = classes.select("id", "v", "copies").mapInArrow(_hashed(kind), "id long, vector binary, copies long, own array<long>, visited array<long>")
    hashed = scratch.store(hashed, "cells")
    rows = hashed.select("id", F.explode("own").alias("key"), F.lit(True).alias("member")).union(hashed.select("id", F.explode("visited"), F.lit(False)))
    dealt = blocks(rows, "key", block, "member").join(hashed.select("id", "copies", "vector"), "id")
    keys = ["key", "block_a", "block_b"]
    dealt = dealt.select(*keys, "block", "member", "id", "copies", "vector").repartition(*keys).sortWithinPartitions(*keys)
    found = scratch.store(dealt.mapInArrow(_compare(least, kind), "id long, links long, other long"), "links")
    several = own.groupBy("vec_id").agg(F.min("id").alias("u"), F.max("id").alias("v")).filter("u < v").select("vec_id", "u")
    one_id = own.distinct().join(several, "vec_id").filter("id > u").select("u", F.col("id").alias("v"))
    edges = found.filter("other is not null").select(F.col("id").alias("u"), F.col("other").alias("v"))
    labels = connected_components(edges.union(one_id), scratch)
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    at = classes.select("id", "least", "copies").join(links, "id", "left").join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    at = scratch.store(at, "labelled")
    named = at.groupBy("component").agg(F.min("least").alias("component_id"))
    at = at.join(named, "component").select("id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    rest = v.filter("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    # A vec_id with an unsound vector is in the component of its sound ones.
    sound_ones = own.join(rest.select("vec_id").distinct(), "vec_id").join(at, "id").groupBy("vec_id").agg(F.min("component_id").alias("_of"))
    rest = rest.join(sound_ones, "vec_id", "left").select("vec_id", "n_links", F.coalesce("_of", "component_id").alias("component_id"))
    out = own.join(at, "id").select("vec_id", "n_links", "component_id").union(rest)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
