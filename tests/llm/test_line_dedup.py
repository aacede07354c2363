import random

from lexspark.llm.line_dedup import op2_line_dedup, remove_repeated_lines


def brute(rows, least):
    """Every occurrence but the first of every run of lines with enough words, less the lines of that first one."""
    docs = sorted((d, [(k, x, len(x.encode().split())) for k, x in enumerate((t or "").split("\n")) if x.encode().split()]) for d, t in rows)
    seen, gone = {}, {d: set() for d, _ in docs}
    for d, lines in docs:
        for a in range(len(lines)):
            n = 0
            for b in range(a, len(lines)):
                n += lines[b][2]
                key = tuple(x for _, x, _ in lines[a : b + 1])
                if n >= least:
                    if key in seen:
                        first, at = seen[key]
                        gone[d].update(k for j, (k, _, _) in enumerate(lines[a : b + 1], a) if first != d or j >= at + len(key))
                    seen.setdefault(key, (d, a))
    return gone


def test_matches_brute_force(documents):
    rng = random.Random(4)
    lines = [" ".join(f"w{k}_{i}" for i in range(rng.randint(1, 6))) for k in range(6)] + ["", " "]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 14)))) for i in range(40)]
    got = {r.doc_id: set(r._ld_removed or []) for r in remove_repeated_lines(documents(rows), 8).select("doc_id", "_ld_removed").collect()}
    assert got == brute(rows, 8)


def test_passage_goes_and_text_around_it_stays(documents):
    passage = "\n".join(" ".join(f"p{k}_{i}" for i in range(30)) for k in range(3))
    rows = [(1, "first\n" + passage + "\nend"), (2, "other\n" + passage + "\n\nlast"), (3, "alone")]
    out = {r.doc_id: r for r in op2_line_dedup(documents(rows)).collect()}
    assert out[1].text == rows[0][1] and out[2].text == "other\n\nlast" and out[3].lines_removed == 0 and out[2].removed == [1, 2, 3]


def test_first_of_overlapping_copies_stays_whole(documents):
    line = " ".join(f"x{i}" for i in range(30))
    out = remove_repeated_lines(documents([(1, "\n".join([line] * 5)), (2, line)])).collect()
    assert sorted((r.doc_id, r.text) for r in out) == [(1, f"{line}\n{line}"), (2, line)]


def test_clashing_columns(spark):
    long = " ".join(f"x{i}" for i in range(60))
    d = spark.createDataFrame([(1, long, "a", 5, {"k": 1}), (2, long, "b", 6, None)], "doc_id long, text string, _ld_removed string, _ld_id int, _ld_row map<string,int>")
    out = remove_repeated_lines(d)
    assert out.columns == ["doc_id", "text", "_ld_id", "_ld_row", "_ld_removed"]
    assert sorted((r.doc_id, r.text, r._ld_id, r._ld_row) for r in out.collect()) == [(1, long, 5, {"k": 1}), (2, "", 6, None)]


def test_edges(documents):
    long = " ".join(f"x{i}" for i in range(60))
    d = documents([(None, long), (5, long), (5, long), (6, None), (7, ""), (8, "\n \n"), (9, "w " * 50_000)])
    out = remove_repeated_lines(d)
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert out.columns == [*d.columns, "_ld_removed"] and len(got) == 7
    assert got.count((5, long)) == 2 and (None, "") in got and (6, None) in got and (7, "") in got
    assert remove_repeated_lines(documents([])).collect() == []
