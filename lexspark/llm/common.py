"""Helpers shared by the operators of this subpackage: shared scratch tables, size-checked joins."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of characters that are not ASCII white space.
SPACES = r"[\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"

#: A side of a join is broadcast only if its counted rows times its row width stay below this.
BROADCAST_BYTES = 16 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir.

    Where it is unset a local session, whose executor is the driver, gets one; a cluster is refused.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        given = sc.getConf().get("spark.checkpoint.dir")
        if not given and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(given or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return sc.getCheckpointDir()


class Scratch:
    """Tables written to the shared folder, so that a lost executor costs no recomputation of what precedes them."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self.n = 0

    def path(self, name: str) -> str:
        self.n += 1
        return f"{self.root}/{self.n:03d}-{name}"

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """df written as Parquet and reread."""
        at = self.path(name)
        df.write.parquet(at)
        out = self.spark.read.schema(df.schema).parquet(at)
        out._scratch_path = at
        return out

    def drop(self, df: DataFrame) -> None:
        """Deletes a stored table that nothing lazy refers to any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(df._scratch_path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def checked_broadcast(small: DataFrame, row_bytes: int) -> DataFrame:
    """small, a stored table, marked for broadcast if its counted size allows; else as it is, for a shuffled join."""
    return sized_broadcast(small, small.count(), row_bytes)


def sized_broadcast(small: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """As checked_broadcast, for a table whose rows are counted already."""
    return F.broadcast(small) if rows * row_bytes <= BROADCAST_BYTES else small


#: Rows and bytes of Arrow data that a task turns into Python objects at once.
SLICE_ROWS, SLICE_BYTES = 1024, 8 << 20


def slices(batches):
    """The batches in smaller ones, so that a task's Python objects stay few whatever the batch size."""
    for batch in batches:
        step = max(1, min(SLICE_ROWS, int(batch.num_rows * SLICE_BYTES / max(1, batch.nbytes))))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def words_of(text: Column) -> Column:
    """The words of a text as an array; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
