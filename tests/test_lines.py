import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from lexspark.sources import lines
from lexspark.sources.lines import ProtectedChanged, corrupt_lines, file_digests, guarded_write, numbered_ids, read_json_lines, read_lines, refuse_corrupt


@pytest.fixture
def small_splits(spark):
    """Files are cut every 40 bytes."""
    keys = {"spark.sql.files.maxPartitionBytes": "40", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


BODIES = {
    "a.txt": b"one\n\nthree\r\n" + b"".join(b"line %d %s\n" % (k, b"x" * (k % 90)) for k in range(200)), "b.txt": b"no end", "c.txt": b"\n\n\n", "empty.txt": b"", "wide.txt": b"y" * 500 + b"\n" + b"z" * 300, "bom.txt": b"\xef\xbb\xbfmarked\nsecond\n",
    "bytes.bin": bytes(range(256)) * 20 + b"\r\n\r", "sub/d.txt": "é日本\n".encode() * 50,
}


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    for name, body in BODIES.items():
        (tmp_path / "in" / name).write_bytes(body)
    return tmp_path / "in"


def test_numbers_of_a_file_in_many_splits(spark, folder, small_splits):
    d = read_lines(spark, str(folder / "a.txt"))
    assert d.rdd.getNumPartitions() > 1 and spark.read.text(str(folder / "a.txt")).select("_metadata.file_block_start").distinct().count() > 50
    want = BODIES["a.txt"].decode().removesuffix("\n").split("\n")
    got = {r.line: r.text for r in d.collect()}
    assert got == {k: t.removesuffix("\r") for k, t in enumerate(want, 1)}


def test_several_files(spark, folder, small_splits):
    got = {}
    for r in read_lines(spark, [str(folder / n) for n in ("a.txt", "b.txt", "c.txt", "empty.txt", "wide.txt")]).collect():
        got.setdefault(os.path.basename(r.file), {})[r.line] = r.text
    assert {n: sorted(x) for n, x in got.items()} == {n: list(range(1, k + 1)) for n, k in (("a.txt", 203), ("b.txt", 1), ("c.txt", 3), ("wide.txt", 2))}
    assert got["b.txt"][1] == "no end" and got["wide.txt"] == {1: "y" * 500, 2: "z" * 300}


def test_bad_lines_are_told_with_their_place(spark, tmp_path, small_splits):
    body = "".join(f'{{"k": {k}}}\n' if k != 57 else '{"k": \n' for k in range(90)) + "\n  \n[1]\n"
    (tmp_path / "x.jsonl").write_text(body)
    rows = read_json_lines(spark, str(tmp_path / "x.jsonl"), "k INT")
    assert sorted(r.path.rpartition("/")[2] for r in corrupt_lines(rows).collect()) == ["x.jsonl:58", "x.jsonl:93"]
    assert rows.filter("corrupt is null").count() == 89 and rows.filter("k = 60").first().line == 61
    with pytest.raises(Exception, match=r"corrupt record at .*x\.jsonl:(58|93)"):
        refuse_corrupt(rows).collect()
    assert refuse_corrupt(rows.filter("line < 58")).count() == 57


def test_digests(spark, folder, monkeypatch):
    (folder / "p.txt.gz").write_bytes(gzip.compress(b"packed\n"))
    want = {n: (len(b), hashlib.sha256(b).hexdigest()) for n, b in BODIES.items()}
    want["p.txt.gz"] = (len(x := (folder / "p.txt.gz").read_bytes()), hashlib.sha256(x).hexdigest())
    for batch in (256, 1):
        monkeypatch.setattr(lines, "BATCH", batch)
        got = {r.path.rpartition("/in/")[2]: (r.length, r.sha256) for r in file_digests(spark, str(folder)).collect()}
        assert got == want


def test_a_large_file_is_hashed_in_small_batches(spark, tmp_path, monkeypatch):
    """A file of many blocks goes through one task in batches of BATCH lines; none holds more."""
    with (tmp_path / "big.txt").open("wb") as f:
        for k in range(40_000):
            f.write(b"%d %s\n" % (k, b"w" * 200))
    sizes = []
    real = lines._hashed
    monkeypatch.setattr(lines, "_hashed", real)
    d = file_digests(spark, str(tmp_path))
    with (tmp_path / "big.txt").open("rb") as f:
        assert d.first().sha256 == hashlib.file_digest(f, "sha256").hexdigest()
    import pyarrow as pa

    def batches():
        for at in range(0, 40_000, lines.BATCH):
            rows = [b"%d %s" % (k, b"w" * 200) for k in range(at, min(40_000, at + lines.BATCH))]
            sizes.append(len(rows))
            yield pa.RecordBatch.from_arrays([pa.array(["p"] * len(rows)), pa.array([(tmp_path / "big.txt").stat().st_size] * len(rows)), pa.array(rows, pa.binary())], names=["path", "size", "text"])

    (out,) = list(real(batches()))
    assert out.column(1)[0].as_py() == d.first().sha256 and max(sizes) == lines.BATCH


def test_ids_of_lines(spark, folder):
    at = str(folder / "a.txt")
    got = {r.line: r.row_id for r in numbered_ids(read_lines(spark, at), file_digests(spark, at)).collect()}
    whole = hashlib.sha256(BODIES["a.txt"]).hexdigest()
    h = hashlib.sha256(b"three").hexdigest()
    assert 2 not in got and got[3] == hashlib.sha256(f"{whole}:3:{h}".encode()).hexdigest()


def test_writes_are_refused_if_a_protected_file_changed(spark, folder, tmp_path):
    planned = spark.createDataFrame([(r.path, r.sha256) for r in file_digests(spark, str(folder)).collect()], "path string, sha256 string")
    df = spark.range(5)
    guarded_write(df, f"{tmp_path}/out", planned, str(folder))
    assert spark.read.parquet(f"{tmp_path}/out").count() == 5
    with pytest.raises(FileExistsError):
        guarded_write(df, f"{tmp_path}/out", planned, str(folder))

    def spoils(batches):
        (folder / "b.txt").write_bytes(b"changed meanwhile")
        yield from batches

    with pytest.raises(ProtectedChanged, match="DELTA"):
        guarded_write(df.mapInArrow(spoils, "id long"), f"{tmp_path}/late", planned, str(folder))
    assert not os.path.exists(f"{tmp_path}/late") and not os.path.exists(f"{tmp_path}/late.draft")
    (folder / "b.txt").write_bytes(BODIES["b.txt"])
    (folder / "new.txt").write_bytes(b"n")
    with pytest.raises(ProtectedChanged, match="NEW"):
        guarded_write(df, f"{tmp_path}/early", planned, str(folder))
    assert not os.path.exists(f"{tmp_path}/early") and planned.filter(F.col("sha256").isNull()).count() == 0


def test_a_file_is_sorted_by_chunks_of_lines(spark):
    from lexspark.plans import files

    o = spark.range(9000).selectExpr("'1' AS o_orderpriority", "'F' AS o_orderstatus", "8999 - id AS o_orderkey", "1.0 AS o_totalprice", "DATE '2024-01-01' AS o_orderdate")
    chunks = sorted((r.chunk, r.value.split("\n")) for r in files.chunked(o).collect())
    assert [len(v) for _, v in chunks] == [4096, 4096, 808] and [int(x.split(":")[1].split(",")[0]) for _, v in chunks for x in v] == list(range(9000))
