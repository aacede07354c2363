"""Tables of mesh vertices and faces."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def transform(vertices: DataFrame, scale: float = 1.0) -> DataFrame:
    """Vertices (part_id, index, x, y, z) with the up axis changed from z to y, and scaled."""
    return vertices.withColumns({"x": F.col("x") * scale, "y": F.col("z") * scale, "z": -F.col("y") * scale})


def bounds(vertices: DataFrame) -> DataFrame:
    return vertices.groupBy("part_id").agg(F.count("*").alias("vertices"), F.array(*[F.array(F.min(c), F.max(c)) for c in "xyz"]).alias("bounds"))


def triangulate(faces: DataFrame) -> DataFrame:
    """Triangles (a, b, c) of polygons (part_id, face, corners): a fan from the first corner."""
    f = faces.filter(F.size("corners") >= 3).withColumn("i", F.explode(F.sequence(F.lit(1), F.size("corners") - 2)))
    return f.select("part_id", "face", F.col("corners")[0].alias("a"), F.get("corners", F.col("i")).alias("b"), F.get("corners", F.col("i") + 1).alias("c"))


def weld(vertices: DataFrame, digits: int = 6) -> DataFrame:
    """Coincident vertices made one: new index per place, normals averaged and of unit length.

    The new index is the least old one at the place, so no global numbering is needed.
    """
    at = {c: F.round(c, digits) for c in "xyz"}
    g = vertices.withColumns(at).groupBy("part_id", "x", "y", "z").agg(F.min("index").alias("index"), F.array_sort(F.collect_list("index")).alias("welded"), *[F.sum(c).alias(c) for c in ("nx", "ny", "nz")])
    n = F.sqrt(F.col("nx") ** 2 + F.col("ny") ** 2 + F.col("nz") ** 2)
    return g.withColumns({c: F.round(F.when(n > 0, F.col(c) / n).otherwise(0.0), digits) for c in ("nx", "ny", "nz")})


def check_buffers(triangles: DataFrame, vertices: DataFrame) -> DataFrame:
    """(part_id, face, corner): triangle corners that no vertex has."""
    c = triangles.select("part_id", "face", F.explode(F.array("a", "b", "c")).alias("index"))
    return c.join(vertices.select("part_id", "index"), ["part_id", "index"], "left_anti").select("part_id", "face", F.col("index").alias("corner"))
