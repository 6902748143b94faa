"""Sorting: fields, _score, _doc, scripts, array modes, nested sort, missing."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.functions.scripts import as_script
from docsift.operators.query import Ctx, Query


def array_mode(arr: Column, mode: str) -> Column:
    """Reduce an array to one sort value: min, max, sum, avg, median."""
    m = mode.lower()
    if m == "min":
        return F.array_min(arr)
    if m == "max":
        return F.array_max(arr)
    vals = F.filter(arr, lambda x: x.isNotNull())
    n = F.size(vals)
    total = F.aggregate(vals, F.lit(0.0), lambda a, b: a + b.cast("double"))
    if m == "sum":
        return F.when(n > 0, total)
    if m == "avg":
        return F.when(n > 0, total / n)
    if m == "median":
        s = F.array_sort(vals)
        lo = F.element_at(s, ((n + 1) / 2).cast("int"))
        hi = F.element_at(s, (n / 2).cast("int") + 1)
        return F.when(n > 0, (lo.cast("double") + hi.cast("double")) / 2)
    raise ValueError(mode)


@dataclass(frozen=True)
class NestedSort:
    path: str
    filter: Query | None = None
    max_children: int | None = None
    nested: "NestedSort | None" = None


@dataclass(frozen=True)
class Sort:
    """``field`` may be ``_score`` or ``_doc``.  Default order: desc for _score,
    asc otherwise; missing values last; arrays reduce with ``mode`` (default
    min for asc, max for desc)."""

    field: str | None = None
    order: str | None = None
    mode: str | None = None
    missing: Any = None
    nested: NestedSort | None = None
    unmapped_type: str | None = None
    numeric_type: str | None = None
    script: Any = None
    script_type: str = "number"

    def direction(self) -> str:
        if self.order:
            return self.order.lower()
        return "desc" if self.field == "_score" else "asc"

    def value(self, ctx: Ctx) -> Column:
        if self.script is not None:
            c = as_script(self.script).column()
            return c.cast("double" if self.script_type == "number" else "string")
        if self.field == "_score":
            return F.col("_score")
        if self.field == "_doc":
            return F.col(ctx.id_col)
        if self.nested is not None:
            c = self._nested_values(ctx, self.nested, self.field)
            arr = True
        elif not ctx.has(self.field):
            if self.unmapped_type is None:
                raise KeyError(self.field)
            return F.lit(None).cast(self.unmapped_type)
        else:
            c = ctx.col(self.field)
            arr = isinstance(ctx.dtype(self.field), T.ArrayType)
        if arr:
            c = array_mode(c, self.mode or ("max" if self.direction() == "desc" else "min"))
        if self.numeric_type:
            c = c.cast({"long": "bigint", "date": "timestamp", "date_nanos": "timestamp"}.get(self.numeric_type, self.numeric_type))
        return c

    def _nested_values(self, ctx: Ctx, ns: NestedSort, fld: str) -> Column:
        arr = ctx.col(ns.path)
        if ns.filter is not None:
            arr = F.filter(arr, lambda x: ns.filter.predicate(ctx.nested(ns.path, x)))
        if ns.max_children is not None:
            arr = F.slice(arr, 1, int(ns.max_children))
        rest = fld[len(ns.path) + 1:]
        if ns.nested is not None:
            inner = ns.nested
            sub = inner.path[len(ns.path) + 1:]
            def elem(x):
                a = x.getField(sub)
                if inner.filter is not None:
                    inner_ctx = ctx.nested(ns.path, x)
                    a = F.filter(a, lambda y: inner.filter.predicate(inner_ctx.nested(inner.path, y)))
                if inner.max_children is not None:
                    a = F.slice(a, 1, int(inner.max_children))
                return F.transform(a, lambda y: y.getField(fld[len(inner.path) + 1:]))
            return F.flatten(F.transform(arr, elem))
        def get(x):
            c = x
            for p in rest.split("."):
                c = c.getField(p)
            return c
        return F.transform(arr, get)

    def order_columns(self, ctx: Ctx, when: Column | None = None) -> list[Column]:
        """``when``: the rows that this sort orders; the others are all alike to it."""
        v = self.value(ctx) if when is None else F.when(when, self.value(ctx))
        desc = self.direction() == "desc"
        miss = self.missing
        if miss is not None and miss not in ("_last", "_first"):
            v = F.coalesce(v, F.lit(miss))
            miss = None
        first = miss == "_first"
        if desc:
            return [v.desc_nulls_first() if first else v.desc_nulls_last()]
        return [v.asc_nulls_first() if first else v.asc_nulls_last()]


def as_sort(s: Any) -> Sort:
    if isinstance(s, Sort):
        return s
    if isinstance(s, str):
        if s.startswith("-"):
            return Sort(s[1:], "desc")
        return Sort(s)
    if isinstance(s, tuple):
        return Sort(s[0], s[1])
    raise TypeError(s)
