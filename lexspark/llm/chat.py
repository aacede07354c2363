"""Operator 7: chat formatting with minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant turns in turn, ending with
an assistant's. Four states automate it: start, after system, after user, after assistant. Each
turn is kept, merged into the one before it, relabelled, or preceded by an empty turn of the missing
role; each choice has a cost, and dynamic programming finds the cheapest way through.

A conversation may be of any length: rows are range-sorted by conversation and turn over the whole
cluster, so a long one spans tasks, and each task's rows are cut by their number and by the bytes
of their texts, so that no piece holds more than PIECE rows or, but for its last, PIECE_BYTES. Each
piece of a conversation is summed up as a matrix of least costs from state to state; the
conversations in several pieces are chained by these matrices, a row a piece; the states that the
chain gives are joined to the pieces' rows; then each task repairs its pieces between their states.
A conversation of one piece, as nearly all are, is repaired where it is.

Defined results: turns are ordered by turn, nulls last, then role and a hash of the text, and repeated
turns are repeated; a null conv_id is one conversation; a null text is an empty one; roles are compared
trimmed and in lower case, and a role that is null or unknown fits none and must be relabelled;
a conversation that ends with a user's turn gets an empty assistant's turn; an empty table gives an
empty table; only conv_id, turn, role and text are read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.llm.common import Scratch, checked_broadcast, shared_folder, slices

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
MERGE, RELABEL, INSERT = 10, 60, 40
FAR = 1 << 40
#: Rows, and bytes of texts, of a task after which a conversation is cut into another piece.
PIECE, PIECE_BYTES = 1 << 16, 16 << 20
#: What follows what: in each state, the roles that may come next.
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
OUT = "conv_id long, turn long, role string, action string, text string, rendered string"


def choices(role: str | None) -> list[tuple[int, int, int, str]]:
    """(from, to, cost, action) of a turn with this role."""
    said = ROLES.index(role) + 1 if role in ROLES else 0
    out = []
    for state in range(4):
        if state != START and state == said:
            out.append((state, said, MERGE, "merge"))
        elif state != START and state != said:
            out.append((state, state, MERGE + RELABEL, "merge relabelled"))
        for to in NEXT[state]:
            out.append((state, to, 0 if to == said else RELABEL, "keep" if to == said else "relabel"))
            for then in NEXT[to]:
                if then == said:
                    out.append((state, then, INSERT, f"insert {ROLES[to - 1]}"))
    return out


_CHOICES = {r: choices(r) for r in (*ROLES, None)}


def transfer(roles: list) -> np.ndarray:
    """Least costs from each state before these turns to each after them."""
    m = np.where(np.eye(4, dtype=bool), 0, FAR)
    for role in roles:
        new = np.full((4, 4), FAR, np.int64)
        for a, b, cost, _ in _CHOICES[role]:
            new[:, b] = np.minimum(new[:, b], m[:, a] + cost)
        m = new
    return m


def repair(roles: list, start: int, end: int) -> list[tuple[int, str]]:
    """(state, action) of each turn on the cheapest way from start to end; the first choice of equals."""
    cost = np.full(4, FAR, np.int64)
    cost[start] = 0
    back = []
    for role in roles:
        new, how = np.full(4, FAR, np.int64), [None] * 4
        for a, b, c, action in _CHOICES[role]:
            if cost[a] + c < new[b]:
                new[b], how[b] = cost[a] + c, (a, action)
        back.append(how)
        cost = new
    out, state = [], end
    for how in reversed(back):
        before, action = how[state]
        out.append((state, action))
        state = before
    return out[::-1]


def _role(x):
    x = (x or "").strip().lower()
    return x if x in ROLES else None


def _runs(batches, keys: int):
    """Yields (first row, columns) of each run of rows with equal first `keys` columns, whatever batches it spans."""
    held = None
    for batch in slices(batches):
        cols = [c.to_pylist() for c in batch.columns]
        key, lo = list(zip(*cols[:keys], strict=True)), 0
        for hi in range(1, len(key) + 1):
            if hi < len(key) and key[hi] == key[lo]:
                continue
            if held is not None and held[0] == key[lo]:
                for a, c in zip(held[1], cols, strict=True):
                    a.extend(c[lo:hi])
            else:
                if held is not None:
                    yield held[1]
                held = (key[lo], [c[lo:hi] for c in cols])
            lo = hi
    if held is not None:
        yield held[1]


def _dealt(piece: int, piece_bytes: int):
    """(conv_id, turn, role, text) in order, with the task's number and a chunk that grows with the rows and bytes before."""

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        part, rows, size = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            n = batch.num_rows
            length = pc.fill_null(pc.binary_length(batch.column(3)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            before = size + np.cumsum(length) - length
            chunk = ((rows + np.arange(n)) * piece_bytes + before * piece) // (piece * piece_bytes)
            rows, size = rows + n, size + int(length.sum())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, part, np.int32)), pa.array(chunk, pa.int64()), *batch.columns], names=["part", "chunk", "conv_id", "turn", "role", "text"])

    return run


def _pieces(batches):
    """(part, chunk, conv_id, role) to a row a piece: its place, its conversation, its transfer matrix."""
    import pyarrow as pa

    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
    out: list[list] = [[] for _ in kinds]

    def flush():
        done = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=["part", "chunk", "conv_id", "m"])
        for c in out:
            c.clear()
        return done

    for part, chunk, conv, roles in _runs(batches, 3):
        for c, v in zip(out, (part[0], chunk[0], conv[0], transfer([_role(r) for r in roles]).ravel().tolist()), strict=True):
            c.append(v)
        if len(out[0]) >= 4096:
            yield flush()
    yield flush()


#: What a conversation that stops in a state costs: the empty turns it lacks.
_ENDS = np.array([2 * INSERT, 2 * INSERT, INSERT, 0])
_MISSING = {START: ("user", "assistant"), SYSTEM: ("user", "assistant"), USER: ("assistant",), ASSISTANT: ()}


def _chain(pdf):
    """The states before and after each piece of a conversation, and which is the last."""
    pdf = pdf.sort_values(["part", "chunk"])
    cost, back = np.where(np.arange(4) == START, 0, FAR), []
    for m in pdf["m"]:
        through = cost[:, None] + np.array(m, np.int64).reshape(4, 4)
        back.append(through.argmin(0))
        cost = through.min(0)
    final = cost + _ENDS
    state, states = int(final.argmin()), []
    for b in reversed(back):
        states.append((int(b[state]), state))
        state = int(b[state])
    states = states[::-1]
    return pdf.assign(before=[a for a, _ in states], after=[b for _, b in states], last=[k == len(states) - 1 for k in range(len(states))])[["part", "chunk", "conv_id", "before", "after", "last"]]


def render(role: str, text: str) -> str:
    return f"<|{role}|>\n{text}\n"


def _repaired(batches):
    """Rows of pieces in their order to OUT; pieces of split conversations come with the states of their ends."""
    import pyarrow as pa

    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 4]
    out: list[list] = [[] for _ in kinds]
    size = 0

    def flush():
        done = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=["conv_id", "turn", "role", "action", "text", "rendered"])
        for c in out:
            c.clear()
        return done

    for _, _, conv, turns, roles, texts, befores, afters, lasts in _runs(batches, 3):
        names = [_role(r) for r in roles]
        if befores[0] is None:
            before, after, last = START, int((transfer(names)[START] + _ENDS).argmin()), True
        else:
            before, after, last = befores[0], afters[0], lasts[0]
        rows = []
        for turn, text, (state, action) in zip(turns, texts, repair(names, before, after), strict=True):
            role, text = ROLES[state - 1], text or ""
            if action.startswith("insert"):
                rows.append((turn, action[7:], "insert", "", render(action[7:], "")))
                action = "keep"
            rows.append((turn, role, action, text, f"{text}\n" if action.startswith("merge") else render(role, text)))
        if last:
            rows += [(turns[-1], role, "insert", "", render(role, "")) for role in _MISSING[after]]
        for row in rows:
            for c, v in zip(out, (conv[0], *row), strict=True):
                c.append(v)
            size += len(row[3])
            if len(out[0]) >= 4096 or size > 4 << 20:
                yield flush()
                size = 0
    yield flush()


def format_chats(conversations: DataFrame, piece: int = PIECE, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Per turn of the repaired conversations: conv_id, turn, role, action, text, rendered.

    A conversation's rendering is that of its rows in their order, which is kept inside and across
    partitions; a merged turn's is its text alone, behind the turn it continues. (Only if pieces of
    split conversations are more than a broadcast holds, some hundred thousand, are partitions
    formed anew, in the order of conversation and turn again.)
    """
    spark = conversations.sparkSession
    shared_folder(spark)
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_last("turn"), F.asc_nulls_first("role"), F.xxhash64("text").asc()]
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.mapInArrow(_dealt(piece, piece_bytes), "part int, chunk long, conv_id long, turn long, role string, text string")
    rows = rows.checkpoint()  # the same rows in the same tasks for both passes
    scratch = Scratch(spark, "chat")
    pieces = scratch.store(rows.select("part", "chunk", "conv_id", "role").mapInArrow(_pieces, "part int, chunk long, conv_id long, m array<long>"), "pieces")
    split = pieces.groupBy("conv_id").count().filter("count > 1").select(F.col("conv_id").alias("_split"))
    split = pieces.join(split, F.col("conv_id").eqNullSafe(F.col("_split"))).drop("_split")
    chained = scratch.store(split.groupBy("conv_id").applyInPandas(_chain, "part int, chunk long, conv_id long, before int, after int, last boolean"), "states")
    states = chained.select(F.col("part").alias("_part"), F.col("chunk").alias("_chunk"), F.col("conv_id").alias("_conv"), "before", "after", "last")
    small = checked_broadcast(states, 40)  # two pieces a task and one for each PIECE rows of a long conversation
    on = (F.col("part") == F.col("_part")) & (F.col("chunk") == F.col("_chunk")) & F.col("conv_id").eqNullSafe(F.col("_conv"))
    joined = rows.join(small, on, "left")
    if small is states:
        again = ["part", "chunk", *order]
        joined = joined.repartitionByRange("part", "chunk", F.asc_nulls_first("conv_id")).sortWithinPartitions(*again)
    return joined.select("part", "chunk", "conv_id", "turn", "role", "text", "before", "after", "last").mapInArrow(_repaired, OUT)


def op7_chat_format(conversations: DataFrame) -> DataFrame:
    return format_chats(conversations)
