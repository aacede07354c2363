"""Canonical text of nested values, walked by their Spark type; native.

Fields and map keys stand in alphabetical order and null fields are left out, so null and missing
are the same. Scalars are written as Spark's JSON has them. The order of arrays counts, unless
`unordered`: then their elements stand in the order of their own canonical texts, at every depth.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, ByteType, DataType, IntegerType, LongType, MapType, ShortType, StringType, StructType


#: Types whose JSON is their text, and texts that JSON writes as they are.
PLAIN = (BooleanType, ByteType, ShortType, IntegerType, LongType)
UNESCAPED = r"\A[ !#-\[\]-~]*\z"


def _scalar(c: Column, kind: DataType = StringType()) -> Column:
    if isinstance(kind, PLAIN):
        return c.cast("string")
    text = F.to_json(F.array(c), {"ignoreNullFields": "false"})
    written = F.substr(text, F.lit(2), F.length(text) - 2)
    if isinstance(kind, StringType):  # a writer of JSON for each of the few texts that need one
        return F.when(c.rlike(UNESCAPED), F.concat(F.lit('"'), c, F.lit('"'))).otherwise(written)
    return written


def canonical_text(c: Column, kind: DataType, unordered: bool = False) -> Column:
    """The canonical text of a value; null for null."""
    if isinstance(kind, StructType):
        return F.when(c.isNotNull(), object_text({f.name: canonical_text(c.getField(f.name), f.dataType, unordered) for f in kind.fields}))
    if isinstance(kind, MapType):
        pairs = F.transform(F.map_entries(c), lambda e: F.struct(e["key"].cast("string").alias("k"), F.concat(_scalar(e["key"].cast("string")), F.lit(":"), canonical_text(e["value"], kind.valueType, unordered)).alias("t")))
        return F.when(c.isNotNull(), F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(pairs), lambda p: p["t"]), ","), F.lit("}")))
    if isinstance(kind, ArrayType):
        items = F.transform(c, lambda x: F.coalesce(canonical_text(x, kind.elementType, unordered), F.lit("null")))
        return F.when(c.isNotNull(), F.concat(F.lit("["), F.array_join(F.array_sort(items) if unordered else items, ","), F.lit("]")))
    return F.when(c.isNotNull(), _scalar(c, kind))


def object_text(fields: Mapping[str, Column]) -> Column:
    """The canonical text of an object from those of its fields, of which null ones are left out."""
    return F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(_scalar(F.lit(k)), F.lit(":"), t) for k, t in sorted(fields.items())]), F.lit("}"))


def array_text(texts: Column) -> Column:
    """The canonical text of an unordered array from those of its elements, none of which is null."""
    return F.concat(F.lit("["), F.array_join(F.array_sort(texts), ","), F.lit("]"))


def without(kind: StructType, paths: Iterable[str]) -> StructType:
    """A struct type less the fields at dotted paths, which lead through arrays: `conflicts.entry_revision`."""
    heads: dict[str, list[str]] = {}
    for p in paths:
        head, _, rest = p.partition(".")
        heads.setdefault(head, []).append(rest)
    out = StructType()
    for f in kind.fields:
        rest = heads.get(f.name)
        if rest is None:
            out = out.add(f)
        elif all(rest):
            inner = f.dataType.elementType if isinstance(f.dataType, ArrayType) else f.dataType
            less = without(inner, rest)
            out = out.add(f.name, ArrayType(less) if isinstance(f.dataType, ArrayType) else less)
    return out


def revision(df: DataFrame, leave_out: Iterable[str] = (), unordered: bool = False) -> Column:
    """SHA-256 of a row's canonical text, but for the fields at these paths; a Column over df."""
    kind = without(df.schema, leave_out)
    row = F.struct(*[F.col(f"`{f.name}`") for f in kind.fields])
    return F.sha2(canonical_text(row, kind, unordered), 256)


def hash_of(values: Mapping[str, Column]) -> Column:
    """SHA-256 of named texts, in alphabetical order, nulls left out."""
    fields = [F.concat(_scalar(F.lit(k)), F.lit(":"), _scalar(v.cast("string"))) for k, v in sorted(values.items())]
    return F.sha2(F.concat(F.lit("{"), F.concat_ws(",", *[F.when(v.isNotNull(), f) for f, (_, v) in zip(fields, sorted(values.items()), strict=True)]), F.lit("}")), 256)
