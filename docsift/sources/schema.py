"""Document schemas: declaration, typed conformance, coercion, enums,
schemaless paths, merging, name-pattern typing and kind selection.

All checks are Column expressions: a frame is split into valid rows and
rejected rows (with a reason) in one pass -- nothing is collected.
"""

from __future__ import annotations

import fnmatch
import re
from dataclasses import dataclass, field as dc_field
from typing import Any, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = [
    "FieldSpec", "Document", "boolean", "byte", "short", "int_", "long", "float_", "double", "keyword", "text", "date",
    "join", "obj", "nested", "conform", "coerce", "enum_encode", "enum_decode", "dyn_get", "dyn_set",
    "merge_documents", "Template", "apply_templates", "select_kind",
]

# Integral type bounds.
INT_BOUNDS = {"tinyint": (-(1 << 7), (1 << 7) - 1), "smallint": (-(1 << 15), (1 << 15) - 1),
              "int": (-(1 << 31), (1 << 31) - 1), "bigint": (-(1 << 63), (1 << 63) - 1)}


@dataclass(frozen=True)
class FieldSpec:
    """One declared field: type, required, default, list (multi-valued)."""

    type: Any
    required: bool = False
    default: Any = None
    list: bool = False
    fields: "Document | None" = None      # object / nested sub-document
    kind: str = "value"                   # value | object | nested | join

    def spark_type(self) -> T.DataType:
        if self.kind in ("object", "nested"):
            st = self.fields.struct()
            return T.ArrayType(st) if self.kind == "nested" or self.list else st
        if self.kind == "join":
            return T.StructType([T.StructField("name", T.StringType()), T.StructField("parent", T.StringType())])
        t = T._parse_datatype_string(self.type) if isinstance(self.type, str) else self.type
        return T.ArrayType(t) if self.list else t

    def req(self) -> "FieldSpec":
        return FieldSpec(self.type, True, self.default, self.list, self.fields, self.kind)

    def with_default(self, v: Any) -> "FieldSpec":
        return FieldSpec(self.type, self.required, v, self.list, self.fields, self.kind)

    def as_list(self) -> "FieldSpec":
        return FieldSpec(self.type, self.required, self.default, True, self.fields, self.kind)


def boolean():
    return FieldSpec("boolean")


def byte():
    return FieldSpec("tinyint")


def short():
    return FieldSpec("smallint")


def int_():
    return FieldSpec("int")


def long():
    return FieldSpec("bigint")


def float_():
    return FieldSpec("float")


def double():
    return FieldSpec("double")


def keyword():
    return FieldSpec("string")


def text():
    return FieldSpec("string")


def date():
    return FieldSpec("timestamp")


def join():
    return FieldSpec(None, kind="join")


def obj(doc: "Document"):
    return FieldSpec(None, fields=doc, kind="object")


def nested(doc: "Document"):
    return FieldSpec(None, fields=doc, kind="nested")


@dataclass(frozen=True)
class Document:
    """Ordered named fields; ``struct()`` gives the Spark schema."""

    fields: dict = dc_field(default_factory=dict)

    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(n, f.spark_type(), not f.required) for n, f in self.fields.items()])


# --------------------------------------------------------------------------- coercion


def coerce(c: Column, target: str | T.DataType, as_term: bool = False) -> tuple[Column, Column]:
    """(value, error) for one input Column: ``try_cast`` with the checks of the
    declared type -- integral values must be whole and in range, booleans
    accept true/false (and, as a term, any nonzero number)."""
    t = T._parse_datatype_string(target) if isinstance(target, str) else target
    name = t.simpleString()
    s = c.cast("string")
    if name in INT_BOUNDS:
        # the digits themselves say whether a number is whole; with an exponent, the double does
        digits = F.regexp_extract(s, r"^\s*([+-]?\d*)(?:\.0*)?\s*$", 1)
        whole = F.when(s.rlike(r"^\s*[+-]?(\d+\.?0*|\.0+)\s*$"), F.coalesce(digits.try_cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)")))
        double = F.when(s.rlike("[eE]"), s.try_cast("double"))
        whole = F.coalesce(whole, F.when(double == F.floor(double), double.try_cast("decimal(38,0)")))
        val = whole.try_cast(name)  # null beyond the type's bounds
        err = F.when(c.isNotNull() & val.isNull(), F.concat(F.lit(f"not a valid {name}: "), s))
        return val, err
    if name in ("float", "double"):
        val = s.try_cast(name)
        return val, F.when(c.isNotNull() & val.isNull(), F.concat(F.lit(f"not a valid {name}: "), s))
    if name == "boolean":
        low = F.lower(s)
        val = F.when(low == "true", F.lit(True)).when(low == "false", F.lit(False))
        if as_term:
            num = s.try_cast("double")
            val = F.coalesce(val, F.when(num.isNotNull(), num != 0))
        return val, F.when(c.isNotNull() & val.isNull(), F.concat(F.lit("not a valid boolean: "), s))
    if name in ("timestamp", "timestamp_ntz", "date"):
        from docsift.functions.dates import parse_date
        val = parse_date(s).cast(name)
        return val, F.when(c.isNotNull() & val.isNull(), F.concat(F.lit("not a valid date: "), s))
    if name == "string":
        return s, F.lit(None).cast("string")
    val = c.try_cast(name) if hasattr(c, "try_cast") else c.cast(name)
    return val, F.when(c.isNotNull() & val.isNull(), F.lit(f"not a valid {name}"))


def _read_value(c: Column, src: T.DataType, f: FieldSpec, path: str) -> tuple[Column, list[Column]]:
    """(typed value, error Columns) of one declared plain field."""
    base_t = T._parse_datatype_string(f.type) if isinstance(f.type, str) else f.type
    errs = []
    if f.list:
        arr = c if isinstance(src, T.ArrayType) else F.when(c.isNotNull(), F.array(c))
        v = F.transform(arr, lambda x: coerce(x, base_t)[0])
        fails = lambda x: coerce(x, base_t)[0].isNull() & (F.lit(True) if f.required else x.isNotNull())
        errs.append(F.when(F.coalesce(F.exists(arr, fails), F.lit(False)), F.lit(f"{path}: bad list item")))
        if f.default is not None:
            v = F.coalesce(v, F.array(F.lit(f.default).cast(base_t)))
    else:
        if isinstance(src, T.ArrayType):
            errs.append(F.when(F.size(c) > 1, F.lit(f"{path}: list for a single value")))
            c = F.get(c, F.lit(0))
        v, e = coerce(c, base_t)
        errs.append(F.when(e.isNotNull(), F.concat(F.lit(f"{path}: "), e)))
        if f.default is not None:
            v = F.coalesce(v, F.lit(f.default).cast(base_t))
    if f.required:
        errs.append(F.when(c.isNull(), F.lit(f"{path}: required")))
    return v, errs


def _read_object(c: Column, src: T.DataType, doc: Document, path: str) -> tuple[Column, list[Column]]:
    """(struct of the declared sub-fields, error Columns) of one object."""
    have = src.fieldNames() if isinstance(src, T.StructType) else []
    vals, errs = [], []
    if not isinstance(src, (T.StructType, T.NullType)):
        return F.lit(None).cast(doc.struct()), [F.when(c.isNotNull(), F.lit(f"{path}: not an object"))]
    for n, f in doc.fields.items():
        sub = c.getField(n) if n in have else F.lit(None)
        v, e = _read(sub, src[n].dataType if n in have else T.NullType(), f, f"{path}.{n}")
        vals.append(v.cast(f.spark_type()).alias(n))
        errs += [F.when(c.isNotNull(), x) for x in e]
    return F.when(c.isNotNull(), F.struct(*vals)), errs


def _read(c: Column, src: T.DataType, f: FieldSpec, path: str) -> tuple[Column, list[Column]]:
    if f.kind == "value":
        return _read_value(c, src, f, path)
    missing = [F.when(c.isNull(), F.lit(f"{path}: required"))] if f.required else []
    if f.kind == "join":
        return c.cast(f.spark_type()), missing
    if f.kind == "object" and not f.list:
        if isinstance(src, T.ArrayType):
            v, errs = _read_object(F.get(c, F.lit(0)), src.elementType, f.fields, path)
            return v, [*missing, F.when(F.size(c) > 1, F.lit(f"{path}: list for a single value")), *errs]
        v, errs = _read_object(c, src, f.fields, path)
        return v, missing + errs
    # a list of objects; one object becomes a list of one
    item = src.elementType if isinstance(src, T.ArrayType) else src
    arr = c if isinstance(src, T.ArrayType) else F.when(c.isNotNull(), F.array(c))
    if isinstance(src, T.NullType):
        return F.lit(None).cast(f.spark_type()), missing
    reasons = F.transform(arr, lambda x: F.concat_ws("; ", *_read_object(x, item, f.fields, path)[1], F.when(
        x.isNull(), F.lit(f"{path}: bad list item")) if f.required else F.lit(None).cast("string")))
    reason = F.concat_ws("; ", F.filter(reasons, lambda r: r != ""))
    return F.transform(arr, lambda x: _read_object(x, item, f.fields, path)[0]), [*missing, F.when(reason != "", reason)]


def conform(df: DataFrame, doc: Document) -> tuple[DataFrame, DataFrame]:
    """Typed reading: required fields must exist, defaults fill, a scalar
    becomes a one-element list for list fields, unknown fields are ignored;
    objects and lists of objects are read by the same rules at any depth.

    Returns (valid rows in the declared schema, rejected rows as they came, with
    ``_reason``).
    """
    have = set(df.columns)
    vals, errs = [], []
    for n, f in doc.fields.items():
        v, e = _read(F.col(n) if n in have else F.lit(None), df.schema[n].dataType if n in have else T.NullType(), f, n)
        vals.append(v.alias(n))
        errs += e
    reason = F.concat_ws("; ", *errs) if errs else F.lit("")
    ok = df.select(*vals, reason.alias("__reason")).filter(F.col("__reason") == "").drop("__reason")
    bad = df.select("*", reason.alias("_reason")).filter(F.col("_reason") != "")
    return ok, bad


# --------------------------------------------------------------------------- enums


def enum_encode(c: Column, mapping: dict, on_unknown: str = "null") -> Column:
    """Map raw values to enum names (``create_map`` literal lookup).  Unknown
    values: ``null`` or ``error`` (raise)."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    out = m[c]
    if on_unknown == "error":
        return F.when(c.isNull() | out.isNotNull(), out).otherwise(F.raise_error(F.concat(F.lit("unknown enum value: "), c.cast("string"))))
    return out


def enum_decode(c: Column, mapping: dict, on_unknown: str = "null") -> Column:
    return enum_encode(c, {v: k for k, v in mapping.items()}, on_unknown)


# --------------------------------------------------------------------------- schemaless


def dyn_get(c: Column, path: str, type_: str = "string") -> Column:
    """Value at a dotted path of a JSON string / variant column (null when
    missing or not convertible).  A list on the path is an error (null)."""
    v = F.try_parse_json(c)
    jp = "$" + "".join(f"['{p}']" for p in path.split("."))
    return F.try_variant_get(v, jp, type_)


def dyn_set(df: DataFrame, column: str, path: str, value: Column) -> DataFrame:
    """Set a dotted path inside ``column``, creating missing levels: a struct, a
    VARIANT or a JSON string (which stays one).  A list or a plain value on the
    path is an error, of the request for a struct, else of the row."""
    if isinstance(df.schema[column].dataType, (T.VariantType, T.StringType)):
        text = isinstance(df.schema[column].dataType, T.StringType)
        old = F.try_parse_json(F.col(column)) if text else F.col(column)
        kind = df.select(value.alias("v")).schema["v"].dataType
        new = value if isinstance(kind, T.VariantType) else F.to_variant_object(value) if isinstance(kind, (T.StructType, T.MapType, T.ArrayType)) else (
            value.cast("variant"))
        out = _let(old, lambda v: _variant_set(v, path.split("."), 0, new))
        return df.withColumn(column, F.to_json(out) if text else out)
    parts = path.split(".")
    t = df.schema[column].dataType
    c = F.col(column)

    def build(cur: Column, cur_t: T.DataType | None, rest: list[str]) -> Column:
        head = rest[0]
        if len(rest) == 1:
            return cur.withField(head, value) if cur_t is not None else F.struct(value.alias(head))
        sub_t = None
        if isinstance(cur_t, T.StructType) and head in cur_t.fieldNames():
            sub_t = cur_t[head].dataType
            if isinstance(sub_t, T.ArrayType):
                raise ValueError(f"list on the path {path!r} at {head!r}")
        inner = build(cur.getField(head) if sub_t is not None else F.lit(None), sub_t, rest[1:])
        return cur.withField(head, inner) if cur_t is not None else F.struct(inner.alias(head))

    if not isinstance(t, T.StructType):
        raise ValueError(f"{column} is not a struct")
    return df.withColumn(column, build(c, t, parts))


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _variant_set(old: Column, path: list[str], at: int, value: Column) -> Column:
    """The object ``old`` (a name, as it is used several times) rebuilt with a new value at path[at:]."""
    head, here = path[at], ".".join(path[:at]) or "the value"
    kind = F.schema_of_variant(old)  # read on the way to an error only
    error = F.raise_error(F.concat(F.when(kind.startswith("ARRAY"), F.lit("Cannot traverse through a list value: ")).otherwise(
        F.lit("Expected sub document for field: ")), F.lit(here))).cast("map<string,variant>")
    fields = F.when(old.isNull() | F.is_variant_null(old), F.create_map().cast("map<string,variant>")).otherwise(
        F.coalesce(F.try_variant_get(old, "$", "map<string,variant>"), error))

    def rebuilt(fields: Column) -> Column:
        inner = value if at == len(path) - 1 else _let(fields[head], lambda v: _variant_set(v, path, at + 1, value))
        rest = F.map_filter(fields, lambda k, _: k != F.lit(head))
        return F.to_variant_object(F.map_concat(rest, F.create_map(F.lit(head), inner)))

    return _let(fields, rebuilt)


# --------------------------------------------------------------------------- merging and templates


def merge_documents(frames: dict[str, DataFrame], kind_col: str = "_kind") -> DataFrame:
    """Union several document kinds into one collection.  Fields shared by
    name must have identical types (else ValueError); missing fields are null.
    """
    seen: dict[str, T.DataType] = {}
    for name, df in frames.items():
        for f in df.schema.fields:
            if f.name in seen and seen[f.name] != f.dataType:
                raise ValueError(f"field {f.name!r} has types {seen[f.name].simpleString()} and {f.dataType.simpleString()}")
            seen.setdefault(f.name, f.dataType)
    out = None
    for name, df in frames.items():
        d = df.withColumn(kind_col, F.lit(name))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


@dataclass(frozen=True)
class Template:
    """Name-pattern typing rule: ``match`` / ``unmatch`` on the full column
    path (glob, or regex with ``match_pattern='regex'``), optionally only for
    a detected type (``match_mapping_type``: long, double, string, boolean,
    date); matching columns are cast to ``type``."""

    type: str
    match: str | None = None
    unmatch: str | None = None
    match_pattern: str = "simple"
    match_mapping_type: str | None = None
    subfields: tuple = ()   # ((sub name, type), ...): the same value typed again as ``<name>__<sub>``

    def matches(self, path: str, t: T.DataType) -> bool:
        def m(p: str) -> bool:
            return bool(re.fullmatch(p, path)) if self.match_pattern == "regex" else fnmatch.fnmatchcase(path, p)
        if self.match is not None and not m(self.match):
            return False
        if self.unmatch is not None and m(self.unmatch):
            return False
        if self.match_mapping_type not in (None, "*"):
            detected = {"bigint": "long", "int": "long", "smallint": "long", "tinyint": "long", "double": "double",
                        "float": "double", "string": "string", "boolean": "boolean", "timestamp": "date",
                        "timestamp_ntz": "date", "date": "date"}.get(t.simpleString())
            if detected != self.match_mapping_type:
                return False
        return True


def _typed(c: Column, t: T.DataType, path: str, rules: list) -> Column:
    """Cast leaves of ``c`` (at ``path``) by the first matching rule; recurse
    into structs and arrays of structs so rules see full dotted paths."""
    if isinstance(t, T.StructType):
        return F.struct(*[_typed(c.getField(f.name), f.dataType, f"{path}.{f.name}", rules).alias(f.name) for f in t.fields])
    if isinstance(t, T.ArrayType) and isinstance(t.elementType, T.StructType):
        return F.transform(c, lambda x: _typed(x, t.elementType, path, rules))
    rule = next((r for r in rules if r.matches(path, t)), None)
    return c.cast(rule.type) if rule else c


def apply_templates(df: DataFrame, templates: Iterable[Template]) -> DataFrame:
    """Cast every field, at any depth, by the first template matching its full
    dotted path; top-level matches may add typed sub-field columns."""
    tl = list(templates)
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        cols.append(_typed(c, f.dataType, f.name, tl).alias(f.name))
        rule = next((t for t in tl if t.matches(f.name, f.dataType)), None)
        for sub, typ in (rule.subfields if rule else ()):
            cols.append(c.cast(typ).alias(f"{f.name}__{sub}"))
    return df.select(*cols)


def select_kind(df: DataFrame, kinds: dict[str, list[str]], join_field: str = "join") -> dict[str, DataFrame]:
    """Split a parent/child collection by relation name; each kind keeps its columns."""
    return {name: df.filter(F.col(f"{join_field}.name") == F.lit(name)).select(*cols) for name, cols in kinds.items()}
