"""Readers and writers of attestations, registries, line streams and manifests."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TERM_BLOCK = "STRUCT<preferred: STRING, aliases: ARRAY<STRING>>"
ATTESTATION = (
    "source_id STRING, source_revision STRING, source_edition STRING, "
    "locator STRUCT<page: INT, plate: STRING, entry_id: STRING, nomenclature_id: STRING, chapter: STRING, section: STRING, `table`: STRING, url: STRING>, "
    f"source_language STRING, pivot {TERM_BLOCK}, third {TERM_BLOCK}, target {TERM_BLOCK}, source_term_raw STRING, context STRING, category STRING, "
    "laterality STRING, directional_qualifiers ARRAY<STRING>, source_codes ARRAY<STRING>, terminology_ids ARRAY<STRING>, notes STRING"
)


def read_attestations(spark: SparkSession, paths: str | Sequence[str], schema: str = ATTESTATION, envelope: str | None = None) -> DataFrame:
    """Attestations of JSON lines, a JSON array, one object, or an envelope object, with `file` and `corrupt`.

    envelope: the name of the envelope's array; such files and arrays over several lines are read
    whole, one by a task. Blank lines are skipped; a line that does not parse keeps its text in
    `corrupt`.
    """
    reader = spark.read.option("columnNameOfCorruptRecord", "corrupt").option("mode", "PERMISSIVE")
    file = F.col("_metadata.file_path").alias("file")
    if envelope:
        df = reader.option("multiLine", True).schema(f"`{envelope}` ARRAY<STRUCT<{_fields(spark, schema)}>>, corrupt STRING").json(paths)
        return df.select(F.inline_outer(envelope), "corrupt", file)
    df = reader.schema(f"{schema}, corrupt STRING").json(paths)
    return df.select("*", file)


def _fields(spark: SparkSession, schema: str) -> str:
    return spark.createDataFrame([], schema).schema.simpleString()[len("struct<") : -1]


def corrupt_findings(df: DataFrame) -> DataFrame:
    return df.filter("corrupt is not null").select(F.lit("corrupt-record").alias("code"), F.lit("error").alias("severity"), F.col("file").alias("path"), F.col("corrupt").alias("message"))


def read_raw_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """number_lines of files; each is read whole, since its hash goes into its lines' ids."""
    return number_lines(spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value"))


def number_lines(files: DataFrame, file: str = "file", value: str = "value") -> DataFrame:
    """file, file_hash, line (from 1), text, line_hash, row_id = hash(file hash : line : line hash); empty lines are counted, not returned."""
    whole = files.select(file, F.sha2(value, 256).alias("file_hash"), F.split(value, "\r?\n").alias("lines"))
    lines = whole.select(file, "file_hash", F.posexplode("lines").alias("k", "text")).filter("text <> ''")
    lines = lines.select(file, "file_hash", (F.col("k") + 1).alias("line"), "text", F.sha2("text", 256).alias("line_hash"))
    return lines.withColumn("row_id", F.sha2(F.concat_ws(":", "file_hash", F.col("line").cast("string"), "line_hash"), 256))


def split_rendered(text: Column) -> Column:
    """struct(line, text) of `line<TAB>text`; the number is null without a tab."""
    parts = F.split(text, "\t", 2)
    tab = F.size(parts) == 2
    return F.struct(F.when(tab, F.try_to_number(parts[0], F.lit("9999999999")).cast("int")).alias("line"), F.when(tab, F.get(parts, F.lit(1))).otherwise(text).alias("text"))


def page_of_marker(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"^=== PDF_PAGE (\d+) ===$", 1), F.lit("")).cast("int")


def unescape_lines(text: Column) -> Column:
    """Literal \\n made line ends."""
    return F.replace(text, F.lit("\\n"), F.lit("\n"))


def key_mismatches(entries: DataFrame) -> DataFrame:
    """finding(concept_id, code) of entries that stand under another key."""
    return entries.filter(~F.col("key").eqNullSafe(F.col("concept_id"))).select("concept_id", F.lit("entry-key-mismatch").alias("code"))


def explode_registry(entries: DataFrame, released: str = "RELEASED", status: str = "release_status") -> dict[str, DataFrame]:
    """Tables of a nested registry: entries, claims, mappings, conflicts, audits. With a status column, released ones only."""
    e = entries.filter(F.col(status) == released) if status in entries.columns else entries
    part = lambda c: e.select("concept_id", F.inline(c))
    return {"entries": e, "claims": part("claims"), "mappings": e.select("concept_id", F.inline("mapping.mappings")), "conflicts": part("conflicts"), "audits": part("audits")}


def write_by_source(df: DataFrame, path: str, source: str = "source_id", fmt: str = "json") -> None:
    """A folder for each source."""
    df.write.partitionBy(source).format(fmt).save(path)


def read_by_source(spark: SparkSession, path: str, schema: str, fmt: str = "json") -> DataFrame:
    """Rows of all folders that write_by_source made, the source as its column; schema: of all columns."""
    return spark.read.schema(schema).format(fmt).load(path)


def write_chunks(chunked: DataFrame, path: str) -> None:
    chunked.write.partitionBy("chunk_id").json(path)


def manifest(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """path, length, sha256 of every file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))


def compare_manifest(expected: DataFrame, current: DataFrame) -> DataFrame:
    """path, state: MATCH, DELTA, MISSING or NEW."""
    a, b = expected.select("path", F.col("sha256").alias("want")), current.select("path", F.col("sha256").alias("have"))
    state = F.when(F.col("have").isNull(), "MISSING").when(F.col("want").isNull(), "NEW").when(F.col("want") == F.col("have"), "MATCH").otherwise("DELTA")
    return a.join(b, "path", "full").select("path", state.alias("state"), "want", "have")


def shared_checkpoints(spark) -> None:
    """Sees to a checkpoint folder: spark.checkpoint.dir, or in a local session one of its own; a cluster without it is refused."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        given = sc.getConf().get("spark.checkpoint.dir")
        if not given and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(given or tempfile.mkdtemp(prefix="spark-checkpoint-"))


def shared_path(spark, name: str) -> str:
    """A path of its own under the checkpoint folder."""
    shared_checkpoints(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
