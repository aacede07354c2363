"""The first k rows of each key, whatever the size of a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Parts that the rows of one key are dealt to.
SALTS = 64


def first_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank", salts: int = SALTS) -> DataFrame:
    """The first k rows of each key in an order, with their rank from 1.

    Rows are ranked in salted parts first, of which each keeps k; what is left, at most k rows a
    part, is ranked again. So a key that holds most rows is sorted by many tasks, and equal orders
    are settled by the rows' own hash.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(salts)).cast("int"))
    top = lambda d, by: d.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])))).filter(F.col("_rank") <= k)
    part = top(salted, [*keys, "_salt"]).drop("_rank", "_salt")
    return top(part, list(keys)).withColumnRenamed("_rank", rank)
