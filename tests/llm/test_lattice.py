import numpy as np

from lexspark.llm.lattice_dedup import link_embeddings, nearest_e8

SCHEMA = "vec_id long, embedding array<float>, label int, links int"


def brute(rows, least=0.9):
    ids = [r[0] for r in rows]
    ok = [r[1] is not None and None not in r[1] and np.isfinite(r[1]).all() and np.any(r[1]) for r in rows]
    comp, links = dict(zip(ids, ids, strict=True)), dict.fromkeys(ids, 0)
    for i, a in enumerate(rows):
        for j in range(i):
            b = rows[j]
            if ok[i] and ok[j] and len(a[1]) == len(b[1]):
                x, y = (np.array(np.array(v[1], np.float32), float) for v in (a, b))
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= least:
                    links[a[0]] += 1
                    links[b[0]] += 1
                    lo, hi = sorted((comp[a[0]], comp[b[0]]))
                    comp = {k: lo if c == hi else c for k, c in comp.items()}
    return {k: (links[k], comp[k]) for k in ids}


def test_recall_and_precision(spark):
    rng = np.random.default_rng(3)
    rows = []
    for g in range(40):
        base = rng.standard_normal(64)
        rows += [(g * 10 + k, [float(v) for v in base + rng.standard_normal(64) * rng.choice([0, 0.1, 0.2])], 0, 1) for k in range(6)]
    rows += [(900, None, 0, 1), (901, [0.0] * 64, 0, 1), (902, [float("nan")] * 64, 0, 1), (903, [None, 1.0], 0, 1), (904, [], 0, 1), (905, [2.0], 0, 1), (906, [5.0], 0, 1)]
    want = brute(rows)
    for block in (2048, 8):
        got = {r.vec_id: (r.n_links, r.component_id) for r in link_embeddings(spark.createDataFrame(rows, SCHEMA), block=block).collect()}
        assert sum(n for n, _ in got.values()) >= 0.97 * sum(n for n, _ in want.values())
        assert all(got[k][0] <= want[k][0] for k in want) and sum(got[k] == want[k] for k in want) > 0.9 * len(want)


def test_edges(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(3, v, 0, 1), (3, v, 0, 1), (5, v, 0, 1), (None, v, 0, 1), (7, [-x for x in v], 0, 1)]
    got = link_embeddings(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.vec_id or -1, r.n_links, r.component_id or -1, r.kept) for r in got) == [(-1, 0, -1, True), (3, 1, 3, True), (3, 1, 3, True), (5, 1, 3, False), (7, 0, 7, True)]
    assert link_embeddings(spark.createDataFrame([], SCHEMA)).collect() == []


def test_one_id_with_several_vectors(spark):
    def near(v, k):
        return [x + (0.01 if i == k else 0.0) for i, x in enumerate(v)]

    rng = np.random.default_rng(8)
    a, b, c = (rng.standard_normal(32).tolist() for _ in range(3))
    rows = [(1, near(a, 0)), (2, a), (2, b), (2, b), (4, near(b, 1)), (6, near(b, 2)), (9, c), (2, None), (None, b)]
    vectors = sorted({(i, tuple(v)) for i, v in rows if i is not None and v is not None})
    links = {x: 0 for x in vectors}
    component = {i: i for i, _ in vectors}
    for x in vectors:
        for y in vectors:
            p, q = np.array(x[1], np.float32).astype(float), np.array(y[1], np.float32).astype(float)
            if x != y and p @ q / (np.linalg.norm(p) * np.linalg.norm(q)) >= 0.9:
                links[x] += 1
                lo, hi = sorted((component[x[0]], component[y[0]]))
                component = {k: lo if m == hi else m for k, m in component.items()}
    want = sorted((i or -1, 0 if v is None or i is None else links[i, tuple(v)], component.get(i, -1)) for i, v in rows)
    for kind in ("float", "double"):
        d = spark.createDataFrame([(i, v, 0, 1) for i, v in rows], SCHEMA.replace("float", kind))
        got = link_embeddings(d).collect()
        assert sorted((r.vec_id or -1, r.n_links, r.component_id or -1) for r in got) == want


def test_decoded_points_are_nearest():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((300, 8)) * 2
    p = nearest_e8(x)
    twice = np.rint(2 * p).astype(int)
    assert ((twice % 2 == twice[:, :1] % 2).all(axis=1)).all() and (p.sum(1) % 2 == 0).all()
    from lexspark.llm.lattice_dedup import _NEIGHBOURS

    other = ((x[:, None] - p[:, None] - _NEIGHBOURS[None]) ** 2).sum(-1).min(1)
    assert (((x - p) ** 2).sum(-1) <= other + 1e-9).all()
