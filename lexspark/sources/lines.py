"""Lines of files with their numbers, and digests of files, whatever a file's size.

Spark may cut a file into many splits. A line's number is the number of lines in the splits before
its own and its place there: two scans, a count a split between them, and nothing is shuffled but
these counts. A digest is one stream of a file's bytes through one task, which holds a batch of
lines at a time. All bytes come through Spark's own readers, so any store that Spark reads will do.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexspark.sources.io import compare_manifest, shared_path

#: Rows, and about the bytes, of an Arrow batch while files are hashed.
BATCH, BATCH_BYTES = 256, 16 << 20
#: Files that Spark's line reader would unpack; they are hashed whole, each in one row, so each must be below 2 GB.
PACKED = r"(?i)\.(gz|bz2|zst|zstd|lz4|snappy|deflate|xz)$"


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """file, line (from 1), text of every line, empty ones too; a line ends with \\n, and a \\r before it is cut off.

    If the two scans should not see the same splits, as when a file is changed between them, the job
    fails rather than misnumber a line.
    """
    d = spark.read.option("lineSep", "\n").text(paths)
    # In a task the ids of a split's lines follow one another, so a line's place is its id less the least.
    d = d.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("id"), F.col("value").alias("text"))
    splits = d.groupBy("file", "start").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "start", "first", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    place = F.col("id") - F.col("first")
    sure = F.when((place >= 0) & (place < F.col("n")), F.col("before") + place + 1).otherwise(F.raise_error(F.concat(F.lit("splits have changed: "), F.col("file"))).cast("long"))
    return d.join(splits, ["file", "start"], "left").select("file", sure.alias("line"), F.regexp_replace("text", "\r$", "").alias("text"))


def read_json_lines(spark: SparkSession, paths: str | Sequence[str], schema: str) -> DataFrame:
    """The columns of schema, `corrupt` (a line that is no JSON object), `file` and `line`; blank lines are skipped."""
    lines = read_lines(spark, paths).filter(F.trim("text") != "")
    row = F.from_json("text", f"{schema}, corrupt STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt"})
    return lines.select(row.alias("r"), "file", "line").select("r.*", "file", "line")


def corrupt_lines(rows: DataFrame) -> DataFrame:
    """finding(code, severity, path, message); path: file:line."""
    return rows.filter("corrupt is not null").select(F.lit("corrupt-record").alias("code"), F.lit("error").alias("severity"), F.concat_ws(":", "file", F.col("line").cast("string")).alias("path"), F.col("corrupt").alias("message"))


def refuse_corrupt(rows: DataFrame) -> DataFrame:
    """The rows without `corrupt`; the job fails at the first line that has it, with its file and number."""
    where = F.concat(F.lit("corrupt record at "), F.col("file"), F.lit(":"), F.col("line").cast("string"))
    line = F.when(F.col("corrupt").isNull(), F.col("line")).otherwise(F.raise_error(where).cast("long"))
    return rows.withColumn("line", line).drop("corrupt")


def numbered_ids(lines: DataFrame, digests: DataFrame) -> DataFrame:
    """Lines with line_hash and row_id = hash(file hash : line : line hash); empty ones are left out. digests: path, sha256."""
    d = lines.filter("text <> ''").join(digests.select(F.col("path").alias("file"), F.col("sha256").alias("file_hash")), "file")
    d = d.withColumn("line_hash", F.sha2("text", 256))
    return d.withColumn("row_id", F.sha2(F.concat_ws(":", "file_hash", F.col("line").cast("string"), "line_hash"), 256))


def _hashed(batches):
    """(path, size, text) in order to (path, sha256): a file's lines joined again by what parted them."""
    import pyarrow as pa

    path, plain, marked, seen, size = None, None, None, 0, 0

    def done():
        # A last line end, and a byte-order mark, are not among the lines; the file's size tells of them.
        for digest, start in ((plain, 0), (marked, 3)):
            for tail in (b"", b"\n"):
                if start + seen + len(tail) == size:
                    digest.update(tail)
                    return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([digest.hexdigest()])], names=["path", "sha256"])
        raise ValueError(f"{path} has {size} bytes, of which {seen} were read as lines")

    for batch in batches:
        for p, n, text in zip(*(batch.column(k) for k in range(3)), strict=True):
            p, text = p.as_py(), text.as_buffer()
            if p != path:
                if path is not None:
                    yield done()
                path, size, seen, plain, marked = p, n.as_py(), 0, hashlib.sha256(), hashlib.sha256(b"\xef\xbb\xbf")
            else:
                plain.update(b"\n")
                marked.update(b"\n")
                seen += 1
            plain.update(text)
            marked.update(text)
            seen += text.size
    if path is not None:
        yield done()


def file_digests(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """path, length, sha256 of every file below the paths, of any size. Stored, so that it is computed once.

    Empty files, which Spark's readers pass over, come from its list of the files' names.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    listed = files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("length"))
    plain = listed.filter(~F.col("path").rlike(PACKED))
    largest = plain.agg(F.max("length")).first()[0] or 1
    # A session of its own, in which no file is cut and small ones share a task.
    own = spark.newSession()
    for key, value in (("files.maxPartitionBytes", largest), ("files.openCostInBytes", 0), ("files.minPartitionNum", 1), ("execution.arrow.maxRecordsPerBatch", BATCH), ("execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        own.conf.set(f"spark.sql.{key}", str(value))
    lines = own.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(paths)
    lines = lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("text")).filter(~F.col("path").rlike(PACKED))
    at = shared_path(spark, "digests")
    lines.mapInArrow(_hashed, "path string, sha256 string").write.parquet(f"{at}/plain")
    packed = files.filter(F.col("_metadata.file_path").rlike(PACKED)).select(F.col("_metadata.file_path").alias("path"), F.sha2("content", 256).alias("sha256"))
    found = spark.read.schema("path string, sha256 string").parquet(f"{at}/plain").union(packed)
    at_root = lambda c: F.regexp_replace(c, r"^(\w+):/{2,}(?=/)", "$1:")
    names = spark.createDataFrame([(n,) for n in files.inputFiles()], "path string").select(at_root("path").alias("path"))
    known = listed.select(at_root("path").alias("path"), "length").join(found.select(at_root("path").alias("path"), "sha256"), "path")
    empty = names.join(listed.select(at_root("path").alias("path")), "path", "left_anti").select("path", F.lit(0).cast("long"), F.sha2(F.lit(""), 256))
    return known.union(empty)


class ProtectedChanged(RuntimeError):
    """A protected file is not what was planned; nothing was written."""


def guarded_write(df: DataFrame, target: str, planned: DataFrame, protected: str | Sequence[str], fmt: str = "parquet") -> None:
    """Writes df to target, unless a protected file (planned: path, sha256) differs, is missing, or is new; a target that exists is refused.

    Files are compared before the job that makes df and after it, and what it wrote appears at
    target only then.
    """
    spark = df.sparkSession

    def check() -> None:
        off = compare_manifest(planned, file_digests(spark, protected)).filter("state <> 'MATCH'").limit(1).collect()
        if off:
            raise ProtectedChanged(f"{off[0].state}: {off[0].path}")

    check()
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(path(target)):
        raise FileExistsError(target)
    draft = f"{target}.draft"
    df.write.format(fmt).save(draft)
    try:
        check()
    except ProtectedChanged:
        fs.delete(path(draft), True)
        raise
    if not fs.rename(path(draft), path(target)):
        raise OSError(f"{draft} could not be renamed to {target}")
