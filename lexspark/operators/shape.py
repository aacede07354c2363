"""Shapes of untyped JSON documents, checked natively over VARIANT columns.

A shape is data, a dict that could be read from JSON itself, compiled to one Column of findings, so
that a wrong type is a finding with its path and not a silent null. `type` is one of

- object: `fields` by name; `closed` is the code of a key that is in none of them
- list: `items` is the shape of each element
- text (not blank; `unlike`: a pattern it must not match), texts (an array of them, distinct when folded)
- flag, count (a whole number above 0), date, url, one_of (`values`), is (`value`), any

with `code`, and `severity` (error). A missing value is wrong unless `optional`; null is wrong unless
`nullable`; `if_text` passes all that is not a text with content. Numbers are whole by value: 2.0 is.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, IntegerType, LongType, MapType, StringType, StructType

from lexspark.functions.text import fold_key, is_blank, is_iso_date, is_url

FINDING = "array<struct<code: string, severity: string, path: string>>"
ARRAY, MAP, KEYS = "array<variant>", "map<string,variant>", "map<string,struct<>>"


@dataclass(frozen=True)
class Place:
    """A value inside a VARIANT: its root, its JSON path, and how a finding names it; `held`: the value itself, where a cast of the root has it (see _held)."""

    root: Column
    json: str
    name: Column
    held: Column | None = None

    def field(self, key: str) -> "Place":
        step = f".{key}" if re.fullmatch(r"[A-Za-z_]\w*", key) else f"['{key}']"
        return Place(self.root, self.json + step, F.concat(self.name, F.lit(f".{key}")), None if self.held is None else self.held.getField(key))

    def read(self, kind: str) -> Column:
        return F.try_variant_get(self.root, self.json, kind)

    def missing(self) -> Column:
        return self.read("variant").isNull()

    def kind(self) -> Column:
        """STRING, BOOLEAN, BIGINT, DECIMAL(p,s), DOUBLE, VOID, OBJECT<...>, ARRAY<...>; null for a missing value."""
        return F.schema_of_variant(self.read("variant"))

    def text(self) -> Column:
        return F.when(self.kind() == "STRING", self.read("string"))

    def number(self) -> Column:
        return F.when(self.kind().rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), self.read("double"))


def _none() -> Column:
    return F.array().cast(FINDING)


def _one(code: str, shape: Mapping, name: Column) -> Column:
    return F.array(F.struct(F.lit(code).alias("code"), F.lit(shape.get("severity", "error")).alias("severity"), name.alias("path")))


def _scalar_ok(shape: Mapping, at: Place) -> Column:
    kind, text = shape["type"], at.text()
    if kind == "text":
        ok = ~is_blank(text)
        return ok & ~text.rlike(shape["unlike"]) if "unlike" in shape else ok
    if kind == "flag":
        return at.kind() == "BOOLEAN"
    if kind == "count":
        return (at.number() > 0) & (at.number() == F.floor(at.number()))
    if kind == "date":
        return is_iso_date(text)
    if kind == "url":
        return is_url(text)
    if kind == "one_of":
        return text.isin(list(shape["values"]))
    if kind == "is":
        return text == shape["value"] if isinstance(shape["value"], str) else at.number() == shape["value"]
    raise ValueError(f"no such shape: {kind}")


def _texts(shape: Mapping, at: Place) -> Column:
    items = at.held
    text = lambda x: F.when(F.schema_of_variant(x) == "STRING", F.trim(F.try_variant_get(x, "$", "string")))
    folded = F.transform(items, lambda x: F.nullif(fold_key(text(x)), F.lit("")))
    where = lambda i: F.concat(at.name, F.lit("["), i.cast("string"), F.lit("]"))

    def item(x: Column, i: Column, keys: Column) -> Column:
        key = F.get(keys, i)
        again = F.coalesce(F.array_position(keys, key) <= i, F.lit(False))
        return F.when(is_blank(text(x)), _one("invalid-string-array-item", shape, where(i))).when(again, _one("duplicate-normalized-term", shape, where(i))).otherwise(_none())

    # The keys are bound by a lambda of their own, so that they are made once and not for every item.
    found = F.get(F.transform(F.array(folded), lambda keys: F.flatten(F.transform(items, lambda x, i: item(x, i, keys)))), F.lit(0))
    # Most arrays have two items at most; these are compiled, which lambdas are not.
    first, second = (text(F.get(items, F.lit(k))) for k in (0, 1))
    alone = F.when(is_blank(first), _one("invalid-string-array-item", shape, where(F.lit(0)))).otherwise(_none())
    again = F.nullif(fold_key(first), F.lit("")) == F.nullif(fold_key(second), F.lit(""))
    other = F.when(is_blank(second), _one("invalid-string-array-item", shape, where(F.lit(1)))).when(again, _one("duplicate-normalized-term", shape, where(F.lit(1)))).otherwise(_none())
    size = F.size(items)
    return F.when(items.isNull(), _one("invalid-string-array", shape, at.name)).when(size == 0, _none()).when(size == 1, alone).when(size == 2, F.concat(alone, other)).otherwise(found)


def _held(shape: Mapping) -> str:
    """The type that a value is cast to once, so that its fields are not sought one by one: null where an object or an array is none."""
    if shape["type"] == "object":
        return "struct<" + ", ".join(f"`{k}`: {_held(s)}" for k, s in shape.get("fields", {}).items()) + ">"
    return ARRAY if shape["type"] in ("list", "texts") else "variant"


def findings(shape: Mapping, at: Place) -> Column:
    """An array of findings (code, severity, path) of a value, which is held, and all below it but the items of lists, which are rows of their own."""
    kind = shape["type"]
    if kind == "any":
        return _none()
    leaf = Place(at.held, "$", at.name)
    if kind == "object":
        below = [findings(s, at.field(k)) for k, s in shape.get("fields", {}).items()]
        if "closed" in shape:
            odd = F.array_except(F.map_keys(at.read(KEYS)), F.array(*[F.lit(k) for k in shape["fields"]]).cast("array<string>"))
            below.append(F.transform(odd, lambda k: _one(shape["closed"], shape, F.concat(at.name, F.lit("."), k))[0]))
        wrong, out, gone = at.held.isNull(), F.concat(*below) if below else _none(), at.missing()
    elif kind == "list":
        wrong, out, gone = at.held.isNull(), _none(), at.missing()
    elif kind == "texts":
        wrong, out, gone = F.lit(False), _texts(shape, at), at.held.isNull() & at.missing()
    else:
        wrong, out, gone = ~F.coalesce(_scalar_ok(shape, leaf), F.lit(False)), _none(), at.held.isNull()
    if kind in ("object", "list"):
        # Whether it is missing, or null, is asked only of what is no object and no array.
        excused = [f for f in (gone if shape.get("optional") else None, at.kind() == "VOID" if shape.get("nullable") else None, is_blank(at.text()) if shape.get("if_text") else None) if f is not None]
        bad = _one(shape["code"], shape, at.name)
        bad = F.when(reduce(lambda a, b: a | b, [F.coalesce(f, F.lit(False)) for f in excused]), _none()).otherwise(bad) if excused else bad
        return F.when(wrong, bad).otherwise(out)
    result = F.when(wrong, _one(shape.get("code", "invalid-string-array"), shape, at.name)).otherwise(out)
    if shape.get("optional"):
        result = F.when(gone, _none()).otherwise(result)
    if shape.get("nullable"):
        result = F.when((at if kind == "texts" else leaf).kind() == "VOID", _none()).otherwise(result)
    if shape.get("if_text"):
        result = F.when(is_blank((at if kind == "texts" else leaf).text()), _none()).otherwise(result)
    return result


def _lists(shape: Mapping, keys: tuple[str, ...] = ()) -> list[tuple[tuple[str, ...], Mapping]]:
    """(keys that lead there, shape of the items) of the lists in a value whose items have a shape, those in items left out."""
    if shape["type"] == "list":
        return [] if shape["items"]["type"] == "any" else [(keys, shape["items"])]
    return [x for k, s in shape.get("fields", {}).items() for x in _lists(s, (*keys, k))]


def codes(shape: Mapping) -> set[str]:
    """All codes that a shape can give."""
    out = {shape[k] for k in ("code", "closed") if k in shape}
    if shape["type"] == "texts":
        out |= {"invalid-string-array", "invalid-string-array-item", "duplicate-normalized-term"}
    for s in [*shape.get("fields", {}).values(), *([shape["items"]] if "items" in shape else [])]:
        out |= codes(s)
    return out


@dataclass(frozen=True)
class Document:
    """A document of records: what names it, the version it must declare, its array of records and their shape."""

    label: str
    version: int
    records: str
    record: Mapping

    def codes(self) -> set[str]:
        return codes(self.record) | {"unparsable-document", "unsupported-schema-version", "invalid-document-shape"}


def records(documents: DataFrame, document: Document) -> DataFrame:
    """document_id, pos, record (VARIANT) and `found`, the document's own findings, on its first record or alone with a null one."""
    v = F.try_parse_json("body")
    d = documents.select("document_id", v.alias("v"))
    top = Place(F.col("v"), "$", F.lit(document.label))
    version = {"type": "is", "value": document.version, "code": "unsupported-schema-version"}
    body = Place(F.col("v"), f"$.{document.records}", F.lit(document.records))
    found = F.when(F.col("v").isNull(), _one("unparsable-document", {}, F.lit(document.label))).otherwise(
        F.concat(findings(version, Place(top.root, "$", F.lit(f"{document.label}.schemaVersion"), top.field("schemaVersion").read("variant"))), F.when(F.col("records").isNull(), _one("invalid-document-shape", {}, body.name)).otherwise(_none()))
    )
    # The records are a column of their own before it is asked whether they are there, so that they are read once.
    d = d.select("document_id", "v", body.read(ARRAY).alias("records")).select("document_id", found.alias("found"), "records")
    return d.select("document_id", "found", F.posexplode_outer("records").alias("pos", "record")).withColumn("found", F.when(F.coalesce("pos", F.lit(0)) == 0, F.col("found")).otherwise(_none()))


def _checked(d: DataFrame, shapes: Mapping[int, Mapping]) -> DataFrame:
    """d (entity_id, found, level, name, v: a value) with the findings of its values added to found, and h, the values held, by level. shapes: by level."""
    # Shapes that are no object are held as they are.
    d = d.select("*", *[F.when(F.col("level") == n, F.try_variant_get("v", "$", _held(s))).alias(f"h{n}") for n, s in shapes.items()])
    own = F.when(F.col("name").isNull(), _none())
    for n, s in shapes.items():
        own = own.when(F.col("level") == n, findings(s, Place(F.col("v"), "$", F.col("name"), F.col(f"h{n}"))))
    return d.withColumn("found", F.concat("found", own))


def _items(d: DataFrame, lists: list[tuple[int, int, tuple[str, ...]]]) -> DataFrame:
    """A row (level, name, v) for each item of the lists (level, level of its items, keys) that d's values hold; found stays with the first, or alone with nulls.

    The lists of a value stand one behind the other in one array, so an item's place there tells its list and its number.
    """
    none = F.array().cast(ARRAY)
    held = [F.coalesce(reduce(Column.getField, keys, F.col(f"h{n}")), none).alias(f"l{of}") for n, of, keys in lists]
    d = d.select("entity_id", "found", "name", *held)
    ends = [reduce(lambda a, b: a + b, [F.size(f"l{of}") for _, of, _ in lists[: k + 1]]).alias(f"e{of}") for k, (_, of, _) in enumerate(lists)]
    d = d.select("entity_id", "found", "name", *ends, F.concat(*[F.col(f"l{of}") for _, of, _ in lists]).alias("all"))
    d = d.select("*", F.posexplode_outer("all").alias("pos", "v"))
    level, name, start = F.when(F.col("pos").isNull(), None), F.when(F.col("pos").isNull(), None), F.lit(0)
    for _, of, keys in lists:
        here = F.col("pos") < F.col(f"e{of}")
        level = level.when(here, of)
        name = name.when(here, F.concat("name", F.lit("".join(f".{k}" for k in keys) + "["), (F.col("pos") - start).cast("string"), F.lit("]")))
        start = F.col(f"e{of}")
    found = F.when(F.coalesce("pos", F.lit(0)) == 0, F.col("found")).otherwise(_none())
    return d.select("entity_id", found.alias("found"), level.cast("int").alias("level"), name.alias("name"), "v")


def validate_documents(documents: DataFrame, document: Document) -> DataFrame:
    """finding(code, severity, entity_id, path, message) of documents (document_id, body): one pass, records and items of lists apart, no shuffle.

    A value is cast once to the structs of its shape, and findings are a column of their own before
    they become rows, so that they are compiled and not interpreted. The rows come by explode_outer: for
    explode the optimizer would ask for arrays that are not empty, and make them, casts included, once
    more to do so. A list's items come from the struct that its value was cast to.
    """
    name = F.concat(F.lit(f"{document.records}["), F.col("pos").cast("string"), F.lit("]"))
    d = records(documents, document).select(F.col("document_id").cast("string").alias("entity_id"), "found", F.lit(0).alias("level"), name.alias("name"), F.col("record").alias("v"))
    levels, shapes = [document.record], {0: document.record}
    while shapes:
        d, lists = _checked(d, shapes), []
        for n, shape in shapes.items():
            for keys, items in _lists(shape):
                lists.append((n, len(levels), keys))
                levels.append(items)
        shapes = {of: levels[of] for _, of, _ in lists}
        if lists:
            d = _items(d, lists)
    d = d.select("entity_id", F.explode_outer("found").alias("f")).filter("f is not null")
    return d.select("f.code", "f.severity", "entity_id", "f.path", F.concat_ws(" ", "f.path", F.lit("rule"), "f.code").alias("message"))


def json_name(field: str) -> str:
    """camelCase of a column's name."""
    head, *rest = field.split("_")
    return head + "".join(w.capitalize() for w in rest)


def typed(at: Place, kind: DataType, names: Mapping[str, str] | None = None) -> Column:
    """A value of a VARIANT as a Spark type; what has another type there is null, and only that.

    names: JSON's name of a field, where it is not the camelCase of the column's.
    """
    names = names or {}
    if isinstance(kind, StructType):
        fields = [typed(at.field(names.get(f.name, json_name(f.name))), f.dataType, names).alias(f.name) for f in kind.fields]
        return F.when(at.read(MAP).isNotNull(), F.struct(*fields))
    if isinstance(kind, ArrayType):
        return F.transform(at.read(ARRAY), lambda x: typed(Place(x, "$", at.name), kind.elementType, names))
    if isinstance(kind, MapType):
        return F.transform_values(at.read(MAP), lambda _, x: typed(Place(x, "$", at.name), kind.valueType, names))
    if isinstance(kind, StringType):
        return at.text()
    if isinstance(kind, BooleanType):
        return F.when(at.kind() == "BOOLEAN", at.read("boolean"))
    if isinstance(kind, IntegerType | LongType):
        return F.when(at.number() == F.floor(at.number()), at.number().cast(kind))
    return at.number().cast(kind)


def typed_records(documents: DataFrame, document: Document, schema: StructType, names: Mapping[str, str] | None = None) -> DataFrame:
    """document_id, pos and the columns of schema, from the records that are objects."""
    d = records(documents, document)
    row = typed(Place(F.col("record"), "$", F.lit("")), schema, names)
    return d.select("document_id", "pos", row.alias("r")).filter("r is not null").select("document_id", "pos", "r.*")
