"""Registered queries over files that Spark writes from the tables: numbered lines, bad records, digests."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexspark.plans.queries import query, read
from lexspark.sources import lines
from lexspark.sources.io import shared_path

#: A line an order; the text of a free one is cut in the middle, so that it is no JSON.
LINE = """concat('{"order":', o_orderkey, CASE WHEN o_totalprice > 450000 THEN ',"stat' ELSE concat(',"status":"', o_orderstatus, '","day":"', CAST(CAST(o_orderdate AS DATE) AS STRING), '"}') END)"""
WRITTEN = f"(SELECT o_orderpriority, o_orderstatus, o_orderkey, o_totalprice, {LINE} AS line_text, row_number() OVER (PARTITION BY o_orderpriority, o_orderstatus ORDER BY o_orderkey) AS line FROM orders)"


#: Keys of a chunk of lines, and tasks that make the chunks and the files.
CHUNK, CHUNK_TASKS, FILE_TASKS = 4096, 128, 64
GROUP = ["o_orderpriority", "o_orderstatus"]


def chunked(orders):
    """(*GROUP, chunk, value): the lines of neighbouring keys as one text, so that the one task that sorts a file's lines has few rows to hold."""
    o = orders.select(*GROUP, "o_orderkey", F.expr(f"o_orderkey div {CHUNK}").alias("chunk"), F.expr(f"coalesce({LINE}, '')").alias("value")).repartition(CHUNK_TASKS, *GROUP, "chunk")
    lines_of = F.array_sort(F.collect_list(F.struct("o_orderkey", "value")))["value"]
    return o.groupBy(*GROUP, "chunk").agg(F.array_join(lines_of, "\n").alias("value"))


def written(spark, sf_dir) -> str:
    """A folder of text files, one for each priority and status, whose lines are in the order of their keys."""
    at = shared_path(spark, "lines")
    o = chunked(read(spark, sf_dir, "orders"))
    o.repartition(FILE_TASKS, *GROUP).sortWithinPartitions(*GROUP, "chunk").drop("chunk").write.partitionBy(*GROUP).option("lineSep", "\n").text(at)
    return at


def group_of(file: str) -> list:
    """The folder names that writers give a file's priority and status."""
    part = lambda c: F.url_decode(F.regexp_extract(file, rf"{c}=([^/]*)/", 1))
    return [part(c).alias(c) for c in ("o_orderpriority", "o_orderstatus")]


@query(f"SELECT o_orderpriority, o_orderstatus, line, CASE WHEN o_totalprice <= 450000 THEN o_orderkey END AS order_key, o_totalprice > 450000 AS corrupt FROM {WRITTEN}")
def json_lines(spark, sf_dir):
    """A1: JSON lines of files that may be cut into splits, each with its number in its file; lines that are no JSON are told."""
    d = lines.read_json_lines(spark, written(spark, sf_dir), "`order` LONG, status STRING, day STRING")
    corrupt = F.col("corrupt").isNotNull()
    return d.select(*group_of("file"), "line", F.when(~corrupt, F.col("order")).alias("order_key"), corrupt.alias("corrupt"))


WHOLE = f"(SELECT o_orderpriority, o_orderstatus, string_agg(line_text, chr(10) ORDER BY line) || chr(10) AS body FROM {WRITTEN} GROUP BY 1, 2)"


@query(f"SELECT o_orderpriority, o_orderstatus, octet_length(encode(body))::BIGINT AS length, sha256(body) AS sha256 FROM {WHOLE}")
def file_digests(spark, sf_dir):
    """Length and SHA-256 of files of any size, streamed through a task each."""
    d = lines.file_digests(spark, written(spark, sf_dir)).filter(F.col("path").rlike(r"/part-[^/]*$"))
    return d.select(*group_of("path"), "length", "sha256")


@query(f"""SELECT w.o_orderpriority, w.o_orderstatus, line, sha256(sha256(body) || ':' || line || ':' || sha256(line_text)) AS row_id FROM {WRITTEN} w JOIN {WHOLE} b ON b.o_orderpriority = w.o_orderpriority AND b.o_orderstatus = w.o_orderstatus""")
def line_ids(spark, sf_dir):
    """A2: ids of lines from their file's hash, their number and their own hash, no file read whole by one row."""
    at = written(spark, sf_dir)
    d = lines.numbered_ids(lines.read_lines(spark, at), lines.file_digests(spark, at))
    return d.select(*group_of("file"), "line", "row_id")
