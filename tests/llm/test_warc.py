import base64
import fnmatch
import glob
import gzip
import hashlib
import io
import random
import shutil

import pytest

from lexspark.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, first long"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


ROWS = [(3, "http://a/ä b\r\nX: y", "<p>é</p>"), (1, None, "<p>é</p>"), (2, "u", None), (9, "u", ""), (None, "u", "<p>é</p>"), (4, "v", "big " * 50_000), (4, "v", "big " * 50_000), (5, "w", "WARC/1.1\r\n\x1f\x8b\x08 inside")]


def test_round_trip(spark):
    got = warc.op6_warc(pages(spark, ROWS)).collect()
    firsts = {}
    for p, _, h in ROWS:
        if p is not None:
            firsts[h or ""] = min(p, firsts.get(h or "", p))
    want = []
    for p, _, h in ROWS:
        b = (h or "").encode()
        first = firsts[h or ""]
        want.append((p, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if p == first else "revisit", None if p == first else first))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_leftovers_of_a_lost_attempt_are_not_read(spark, monkeypatch):
    write = warc.write_warc

    def interrupted(df, folder, *a):
        log = write(df, folder, *a)
        for name in [r.path.removeprefix("file:") for r in log.collect()]:
            shutil.copy(name, f"{name}.7.tmp")
        return log

    want = sorted(map(str, warc.op6_warc(pages(spark, ROWS)).collect()))
    monkeypatch.setattr(warc, "write_warc", interrupted)
    assert sorted(map(str, warc.op6_warc(pages(spark, ROWS)).collect())) == want
    assert not fnmatch.fnmatch(warc._temporary("/x", 1, 2, 3).rpartition("/")[2], "*.warc*")


def test_small_payloads_stay_responses(spark, tmp_path):
    warc.write_warc(pages(spark, ROWS), f"file://{tmp_path}/w", min_bytes=9, roll=200).collect()
    rows = warc.read_warc(spark, f"file://{tmp_path}/w").collect()
    assert len(glob.glob(f"{tmp_path}/w/*.warc.gz")) > 1 and not glob.glob(f"{tmp_path}/w/*.tmp")
    assert [r.record_type for r in rows if r.payload_bytes < 9] == ["response"] * 2 and sum(r.record_type == "revisit" for r in rows) == 2


def test_empty_table(spark):
    assert warc.op6_warc(pages(spark, [])).collect() == []


@pytest.mark.parametrize("compressed", [True, False])
@pytest.mark.parametrize("damage", ["flip", "cut", "junk", "none"])
def test_salvage(compressed, damage):
    rng = random.Random(5)
    records = [warc.record_bytes(i, f"http://x/{i}", rng.randbytes(3000).hex().encode(), None, False) for i in range(12)]
    parts = [gzip.compress(r) if compressed else r for r in records]
    data, lost = bytearray(b"".join(parts)), set()
    start, end = sum(map(len, parts[:4])), sum(map(len, parts[:5]))
    if damage == "flip":
        data[(start + end) // 2] ^= 0x20
        lost = {4}
    elif damage == "cut":
        del data[start + 700 : end - 300]
        lost = {4}
    elif damage == "junk":
        data[start:start] = b"WARC/1.0 not a record" + rng.randbytes(5000) + warc.MAGIC
    found = list(warc.salvage(_File(bytes(data))))
    good = [f["x-page-id"] for _, _, problem, f, _ in found if problem is None]
    gaps = [(a, b) for a, b, problem, _, _ in found if problem]
    assert set(range(12)) - set(map(int, good)) == lost and len(good) == len(set(good))
    assert len(gaps) == (damage != "none") and sum(b - a for a, b, *_ in found) == len(data)


def test_records_of_any_length_and_head():
    big = b"x" * (5 << 20)
    records = [warc.record_bytes(1, "http://x/" + "u" * 200_000, big, None, False), warc.record_bytes(2, "http://x", b"", None, False)]
    for compressed in (True, False):
        data = b"".join(gzip.compress(r) if compressed else r for r in records)
        for keep in (True, False):
            found = list(warc.salvage(_File(data), keep))
            assert [(p, f["x-page-id"], x.size, x.digest) for _, _, p, f, x in found] == [(None, "1", len(big), warc.digest_of(big)), (None, "2", 0, warc.digest_of(b""))]
            assert [x.content for *_, x in found] == ([big, b""] if keep else [None, None])


class _File(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def test_a_long_head_in_pieces():
    from lexspark.llm.warc import parse_record

    def record(block):
        return b"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"

    for block, payload in ((b"x" * 90_000, b""), (b"h" * 50_001 + b"\r\n\r\n" + b"p" * 40_000, b"p" * 40_000), (b"h\r\n\r\n", b""), (b"\r\n\r\nall", b"all"), (b"a\r\n\r", b"")):
        for step in (1, 7, 1000, 1 << 20):
            whole = record(block)
            if step == 1 and len(whole) > 1000:
                continue
            fields, got = parse_record(whole[k : k + step] for k in range(0, len(whole), step))
            assert got.content == payload and got.size == len(payload) and fields["content-length"] == str(len(block))
