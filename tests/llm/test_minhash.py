import random
import re

import numpy as np
import pytest

from lexspark.llm import minhash
from lexspark.llm.common import Scratch
from lexspark.llm.graph import connected_components
from lexspark.llm.shingles import CHUNK, shingle_set, word_hashes


def sets_of(text):
    w = [x for x in re.split(r"[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows, percent=85):
    s = {d: sets_of(t) for d, t in rows}
    comp = {d: d for d in s}
    for _ in s:
        for a in s:
            for b in s:
                if a < b and s[a] and s[b] and comp[a] != comp[b] and 100 * len(s[a] & s[b]) >= percent * len(s[a] | s[b]):
                    lo, hi = sorted((comp[a], comp[b]))
                    comp = {d: lo if c == hi else c for d, c in comp.items()}
    return {d: (len(s[d]), comp[d]) for d in s}


def near(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return " ".join(out)


@pytest.mark.parametrize("block", [2048, 8])
def test_matches_brute_force(documents, block):
    rng = random.Random(7)
    rows = []
    for g in range(6):
        words = [f"g{g}w{i}" for i in range(rng.choice([40, 150, 400]))]
        rows += [(100 * g + k, near(rng, words, rng.choice([0, 1, 1, 2, 4]))) for k in range(12)]
    rows += [(900, None), (901, ""), (902, "a b c"), (903, "A b C"), (904, "a b c d"), (905, " \n\t")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.find_near_duplicates(documents(rows), block=block).collect()}
    assert got == brute(rows)


def test_hot_group_of_copies(documents):
    text = " ".join(f"w{i}" for i in range(100))
    rows = [(i, text if i % 3 else text + f" tail{i}") for i in range(600)]
    got = minhash.find_near_duplicates(documents(rows), block=64).collect()
    assert {r.component_id for r in got} == {0} and sum(r.kept for r in got) == 1


def test_edges(documents):
    text = " ".join(f"w{i}" for i in range(50))
    got = minhash.find_near_duplicates(documents([(None, text), (4, text), (4, text), (3, text), (8, text + " " + " ".join(f"ä{i}" for i in range(20_000))), (9, None)])).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in got) == [(-1, -1, True), (3, 3, True), (4, 3, False), (4, 3, False), (8, 8, True), (9, 9, True)]
    assert minhash.find_near_duplicates(documents([])).collect() == []


def brute_by_document(rows, percent=85):
    """Component of each doc_id, if rows that share one are one document with the links of all its rows."""
    sets = [(d, sets_of(t)) for d, t in rows if d is not None]
    comp = {d: d for d, _ in sets}
    for _ in sets:
        for a, x in sets:
            for b, y in sets:
                if x and y and comp[a] != comp[b] and 100 * len(x & y) >= percent * len(x | y):
                    lo, hi = sorted((comp[a], comp[b]))
                    comp = {d: lo if c == hi else c for d, c in comp.items()}
    return comp


def test_documents_with_several_texts(documents):
    rng = random.Random(5)
    texts = {k: [f"{k}{i}" for i in range(60)] for k in "ABCDE"}
    whole = {k: " ".join(v) for k, v in texts.items()}
    rows = [(3, whole["A"]), (7, whole["A"]), (7, whole["B"]), (9, near(rng, texts["B"], 1)), (7, None), (2, whole["C"]), (2, whole["D"]), (2, whole["D"]), (4, near(rng, texts["D"], 1)), (11, whole["C"]), (12, whole["E"]), (13, None), (None, whole["A"])]
    for block in (2048, 2):
        got = minhash.find_near_duplicates(documents(rows), block=block).collect()
        assert len(got) == len(rows)
        assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == brute_by_document(rows)
        assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)


def test_estimate_is_corrected_for_chance():
    rng = np.random.default_rng(1)
    errors = []
    for j in (0.2, 0.5, 0.85):
        for _ in range(30):
            both = rng.integers(0, 2**63, int(1000 * j), dtype=np.uint64)
            rest = [rng.integers(0, 2**63, (1000 - len(both)) // 2, dtype=np.uint64) for _ in range(2)]
            packed = [np.frombuffer(minhash.signature(np.unique(np.concatenate([both, r])))[0], "<u8") for r in rest]
            errors.append(float(minhash.estimated_similarity(*packed)) - len(both) / (len(both) + sum(map(len, rest))))
    assert abs(np.mean(errors)) < 0.02


def test_long_texts_hash_like_short_ones():
    words = [f"w{i}" for i in range(CHUNK // 4)]
    long, short = list(word_hashes([" ".join(words), " ".join(words[:9])]))
    assert len(long) == len(words) and (long[:9] == short).all() and len(shingle_set(short)) == 5


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(200, i) for i in range(201, 260)] + [(rng.randrange(300, 330), rng.randrange(300, 330)) for _ in range(25)] + [(5, 5), (None, 3)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            ra, rb = sorted((root(a), root(b)))
            parent[rb] = ra
    df = spark.createDataFrame(edges, "u long, v long").repartition(7)
    got = connected_components(df, Scratch(spark, "test")).collect()
    assert {r.id: r.component for r in got} == {x: root(x) for x in parent if x in {e for p in edges for e in p if p[0] != p[1]}}
    assert len(got) == len({r.id for r in got})


def test_bands_follow_the_threshold():
    assert minhash.banding(85) == (21, 6) and minhash.banding(80) == (25, 5)
    for percent in (50, 70, 80, 85, 90, 100):
        bands, rows = minhash.banding(percent)
        assert bands * rows <= minhash.LANES and (1 - (percent / 100) ** rows) ** bands <= 5e-5


def test_matches_brute_force_at_80(documents):
    rng = random.Random(8)
    rows = [(100 * g + k, near(rng, [f"g{g}w{i}" for i in range(120)], rng.choice([0, 1, 2, 2]))) for g in range(8) for k in range(6)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.find_near_duplicates(documents(rows), 80).collect()}
    assert got == brute(rows, 80) != brute(rows)
