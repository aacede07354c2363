"""The pipeline against a brute-force version of its stages."""

import random
import zlib
from collections import Counter

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from lexspark.llm import packing
from lexspark.llm.mixing import targets

from .test_line_dedup import brute as repeated_lines
from .test_minhash import brute as near
from .test_quality_rules import brute as counts


def corpus():
    rng = random.Random(11)
    vocab = [f"{a}{b}{c}" for a in "bdgklm" for b in "aeiou" for c in ("n", "r", "st", "la")]
    line = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    text = lambda: "\n".join(line(rng.randint(8, 30)) for _ in range(rng.randint(2, 9)))
    rows = [(i, text()) for i in range(160)]
    passage = line(60)
    rows += [(200 + i, text() + "\n" + passage + "\n" + text()) for i in range(6)]
    rows += [(300 + i, rows[3][1]) for i in range(3)]
    for i in range(10):
        words = rows[20 + i][1].replace("\n", " ").split()
        words[len(words) // 2] = "other"
        rows.append((400 + i, " ".join(words)))
    rows += [(500, "### $$$ " * 40), (501, line(5)), (502, None), (503, (line(9) + "\n") * 30), (504, "LOUD!! " * 50)]
    return [(i, t, ["a", "b", None][i % 3]) for i, t in rows]


def test_same_as_brute_force(spark, documents):
    rows = corpus()
    docs, seen = documents(rows), []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "").cache()
        seen.append(docs.collect())
    quality, lines, dedup, mixed, packed = seen
    good = {i for i, t, _ in rows for n, _, s, _, r in [counts(t)] if n >= 20 and 100 * r <= 30 * n and s * 10 <= n and i != 504}
    assert {r.doc_id for r in quality} == good
    texts = {r.doc_id: r.text for r in quality}
    gone = repeated_lines(list(texts.items()), 50)
    left = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]) for i, t in texts.items()}
    left = {i: t for i, t in left.items() if t.split()}
    assert {r.doc_id: r.text for r in lines} == left
    assert {r.doc_id for r in dedup} == {i for i, (_, c) in near(list(left.items()), 80).items() if i == c}
    times, size, source = Counter(r.doc_id for r in mixed), {r.doc_id: len(r.text.split()) for r in dedup}, {r.doc_id: r.source for r in dedup}
    total = Counter()
    for i, n in size.items():
        total[source[i]] += n
    for s, want in targets(total).items():
        assert abs(sum(times[i] * n for i, n in size.items() if source[i] == s) - want) <= 40
    assert max(times.values()) <= 2
    t = Tokenizer.from_file(packing.default_tokenizer()[0])
    want = Counter()
    for r in mixed:
        ids = np.array(t.encode(r.text, add_special_tokens=False).ids + [packing.END], "<u4")
        for k, (start, n) in enumerate(packing.cut(ids)):
            want[r.doc_id, k, start, n, zlib.crc32(ids[start : start + n].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == want
    assert set(quality[0].asDict()) == set(documents([]).columns)


def test_rows_of_one_document_become_one(spark, documents):
    text = " ".join(f"w{i}" for i in range(40))
    d = documents([(1, text), (1, text), (2, text + " end"), (None, "x"), (None, "x"), (7, "b"), (7, "a")])
    out = dict(corpus_pipeline.STAGES)["MinHash near-dedup"](spark, d, "")
    assert out.columns == d.columns and sorted((r.doc_id or 0, r.text) for r in out.collect()) == [(0, "x"), (0, "x"), (1, text), (7, "a")]


def test_stage_takes_columns_of_any_kind(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, {"a": 1}), (1, text, {"a": 1}), (2, "x", None), (None, None, {"b": 2})]
    d = spark.createDataFrame(rows, "doc_id long, text string, facts map<string,int>")
    out = dict(corpus_pipeline.STAGES)["MinHash near-dedup"](spark, d, "").collect()
    assert sorted((r.doc_id or 0, r.facts or {}) for r in out) == [(0, {"b": 2}), (1, {"a": 1}), (2, {})]


def test_empty_and_rerun(spark, documents, tmp_path):
    docs = documents([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.collect() == []
    documents(corpus()[:60]).write.parquet(str(tmp_path / "documents.parquet"))
    a, b = (sorted((r.doc_id, r.piece, r.ids_crc32) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) for _ in range(2))
    assert a == b and a
