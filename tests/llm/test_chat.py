import itertools
import random

import pytest

from lexspark.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, action string, part int"
COST = {"keep": 0, "merge": chat.MERGE, "merge relabelled": chat.MERGE + chat.RELABEL, "relabel": chat.RELABEL, "insert": chat.INSERT}


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def legal(roles):
    body = roles[1:] if roles[:1] == ["system"] else roles
    return body == ["user", "assistant"] * (len(body) // 2) and bool(body)


def fewest_inserted(roles):
    """Turns to insert until the roles are legal, by trying every sequence of at most five more."""
    for more in range(6):
        n = len(roles) + more
        for at in itertools.combinations(range(n), more):
            free = iter(roles)
            shape = [None if k in at else next(free) for k in range(n)]
            for first in ("system", "user"):
                body = ["user", "assistant"] * n
                want = [first, *body][:n] if first == "system" else body[:n]
                if legal(want) and all(a in (None, b) for a, b in zip(shape, want, strict=True)):
                    return more
    return None


def least_cost(roles):
    """Cheapest repair by trying, for each turn, to merge it or to give it each of the roles."""
    said = [(r or "").strip().lower() for r in roles]
    best = None
    for labels in itertools.product(["merge", "system", "user", "assistant"], repeat=len(said)):
        cost, out = 0, []
        for label, own in zip(labels, said, strict=True):
            if label == "merge":
                cost += chat.MERGE + (chat.RELABEL if not out or own != out[-1] else 0)
            else:
                cost += chat.RELABEL if label != own else 0
                out.append(label)
        if labels[0] == "merge" or (best is not None and cost >= best):
            continue
        more = fewest_inserted(out)
        if more is not None and (best is None or cost + more * chat.INSERT < best):
            best = cost + more * chat.INSERT
    return best


def cost_of(out):
    return sum(COST[r.action] for r in out)


def check(rows, out):
    for conv in {r[0] for r in rows}:
        mine = [r for r in out if r.conv_id == conv]
        roles = [r.role for r in mine if not r.action.startswith("merge")]
        assert legal(roles), roles
        turns = sorted((x for x in rows if x[0] == conv), key=lambda x: (x[1] is None, x[1] or 0))
        if len(turns) <= 5:
            assert cost_of(mine) == least_cost([r[2] for r in turns]), [r[2] for r in turns]
        assert [r.text for r in mine if r.action != "insert"] == [x[3] or "" for x in sorted((x for x in rows if x[0] == conv), key=lambda x: (x[1] is None, x[1] or 0))]


@pytest.mark.parametrize("partitions", ["1", "6"])
def test_every_short_conversation(spark, partitions):
    kinds = ["system", "user", "assistant", "tool"]
    rows, conv = [], 0
    for n in (1, 2, 3):
        for roles in itertools.product(kinds, repeat=n):
            rows += [(conv, t, r, f"{conv}-{t}") for t, r in enumerate(roles)]
            conv += 1
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        check(rows, chat.format_chats(table(spark, rows)).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_long_conversation_spans_tasks(spark):
    rng = random.Random(1)
    rows = [(1, t, rng.choice(["user", "assistant", "system", None]), f"t{t}") for t in range(3000)] + [(2, 0, "user", "q")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = chat.format_chats(table(spark, rows)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    check(rows, out)
    whole = chat.format_chats(table(spark, rows).coalesce(1)).collect()
    assert cost_of(out) == cost_of(whole) == sum(cost_of(chat.format_chats(table(spark, rows), piece=n).collect()) for n in (7,))


def test_pieces_of_any_size_cost_the_same(spark):
    rng = random.Random(3)
    kinds = ["system", "user", "assistant", "tool"]
    rows = [(c, t, rng.choice(kinds), f"{c}-{t}") for c in range(40) for t in range(rng.randint(1, 5))]
    for piece in (1, 2, 3, 1000):
        check(rows, chat.format_chats(table(spark, rows), piece=piece).collect())
    for size in (1, 7, 30):
        check(rows, chat.format_chats(table(spark, rows), piece_bytes=size).collect())


def test_long_turns_are_cut_by_their_bytes(spark):
    rows = [(1, t, "user" if t % 2 else "assistant", "w" * 50_000) for t in range(300)]
    texts = []
    real = chat._runs

    def watched(batches, keys):
        for run in real(batches, keys):
            texts.append(sum(len(t) for t in run[5]) if len(run) > 5 else 0)
            yield run

    import pyarrow as pa

    given = [pa.RecordBatch.from_arrays([pa.array([1] * 300), pa.array(range(300)), pa.array([r[2] for r in rows]), pa.array([r[3] for r in rows])], names=["conv_id", "turn", "role", "text"])]

    class Here:
        @staticmethod
        def get():
            return type("T", (), {"partitionId": staticmethod(lambda: 0)})

    import pyspark

    before, pyspark.TaskContext = pyspark.TaskContext, Here
    try:
        cut = list(chat._dealt(1 << 16, 1 << 20)(given))
    finally:
        pyspark.TaskContext = before
    list(watched(cut, 3))
    assert len(texts) >= 14 and max(texts) <= (1 << 20) + 50_000
    check(rows, chat.format_chats(table(spark, rows), piece_bytes=1 << 20).collect())


def test_edges(spark):
    assert chat.format_chats(table(spark, [])).collect() == []
    rows = [(None, 0, " User ", None), (None, None, "ASSISTANT", "a"), (7, 0, "user", "x"), (7, 0, "user", "x")]
    out = chat.format_chats(table(spark, rows)).collect()
    assert [r.role for r in out if r.conv_id is None] == ["user", "assistant"]
    assert [r.action for r in out if r.conv_id == 7] == ["keep", "merge", "insert"]
    assert "".join(r.rendered for r in out if r.conv_id == 7) == "<|user|>\nx\nx\n<|assistant|>\n\n"
