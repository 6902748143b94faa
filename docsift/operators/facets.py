"""Faceted navigation: named filters driven by request parameters.

Parameters are ``{(name, *sub_keys): [values]}`` (string keys are accepted as
one-element tuples).  Values that do not parse for the field type are dropped;
single-valued parameters use the last value.

Rule: hits obey every selection; each facet counts under every *other*
facet's selection (UNION mode) or under all selections including its own
(INTERSECT mode -- always, unlike the reference's quirk).

Plan (one scan for all counting facets): every counting facet contributes
``struct(facet, k1, k2, keep, num, cnt)`` elements to one array per row, the
array is filtered on ``keep`` and exploded, and a single
``groupBy(facet, k1, k2)`` counts with map-side combine -- the shuffle is
(facets x values), not rows.  Range facets and expression facets are
conditional aggregates in one more single-row ``agg``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field as dc_field
from typing import Any

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.operators.aggs import Agg, Bucket, TermsAgg, _Env, run_aggs
from docsift.operators.query import Ctx, Range, Term, Terms
from docsift.operators.sort import as_sort

__all__ = [
    "QueryFilters", "SimpleFilter", "FacetFilter", "FacetRangeFilter", "SimpleExpressionsFilter",
    "FacetExpressionsFilter", "SortFilter", "PageFilter", "AttrSimpleFilter", "AttrFacetFilter",
    "AttrRangeSimpleFilter", "AttrRangeFacetFilter", "AttrBoolSimpleFilter", "AttrBoolFacetFilter",
    "normalize_params", "decode_values",
]

UNION, INTERSECT = "union", "intersect"


# --------------------------------------------------------------------------- parameters


def normalize_params(params: dict) -> dict[tuple, list[str]]:
    out: dict[tuple, list[str]] = {}
    for k, v in (params or {}).items():
        key = (k,) if isinstance(k, str) else tuple(str(x) for x in k)
        vals = [v] if isinstance(v, (str, int, float, bool)) else list(v)
        out[key] = [str(x) for x in vals]
    return out


def _decode(v: str, t: T.DataType) -> Any:
    """Parse one parameter for a field type; None when it does not parse."""
    try:
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            f = float(v)
            if not f.is_integer():
                return None
            i = int(f)
            bits = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}[type(t)]
            return i if -(1 << (bits - 1)) <= i < (1 << (bits - 1)) else None
        if isinstance(t, (T.FloatType, T.DoubleType)):
            return float(v)
        if isinstance(t, T.BooleanType):
            s = v.lower()
            if s in ("true", "false"):
                return s == "true"
            return float(s) != 0.0
        if isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            from docsift.functions.dates import parse_date_literal
            parse_date_literal(v)
            return v
        return v
    except (ValueError, TypeError):
        return None


def decode_values(params: dict, key: tuple, t: T.DataType) -> list[Any]:
    return [d for d in (_decode(v, t) for v in params.get(key, [])) if d is not None]


def decode_last(params: dict, key: tuple, t: T.DataType) -> Any:
    vals = decode_values(params, key, t)
    return vals[-1] if vals else None


def _and(cols: list[Column]) -> Column:
    e = F.lit(True)
    for c in cols:
        e = e & c
    return e


def _base_type(t: T.DataType) -> T.DataType:
    return t.elementType if isinstance(t, T.ArrayType) else t


# --------------------------------------------------------------------------- filters


class BaseFilter:
    name: str
    param: str | None

    @property
    def key(self) -> str:
        return self.param or self.name

    def prepare(self, params: dict, ctx: Ctx) -> "Prepared":
        raise NotImplementedError


@dataclass
class Prepared:
    flt: Any
    predicate: Column | None = None          # selection; None when nothing is selected
    own_counts: bool = False                 # INTERSECT: count under own selection too
    selected: Any = None                     # decoded selection (for flags / zero rows)
    state: dict = dc_field(default_factory=dict)
    sub_predicates: dict = dc_field(default_factory=dict)  # attr id -> (predicate, own_counts)


@dataclass
class SimpleFilter(BaseFilter):
    """Field filter without counts: UNION = any of the values, INTERSECT = all."""

    name: str
    field: str
    mode: str = UNION
    param: str | None = None

    def prepare(self, params, ctx):
        vals = decode_values(params, (self.key,), _base_type(ctx.dtype(self.field)))
        if not vals:
            return Prepared(self)
        if self.mode == INTERSECT:
            p = _and([Term(self.field, v).cond(ctx) for v in vals])
        else:
            p = Terms(self.field, vals).cond(ctx)
        return Prepared(self, p, selected=vals)


@dataclass
class FacetFilter(SimpleFilter):
    """Field facet: value counts, selected flags, selected values with zero
    count appended.  ``size`` limits values (count desc, value asc); selected
    values are reported with their count whatever the limit.

    ``terms``: a terms aggregation of one's own in place of size and
    min_doc_count (order, include/exclude, missing, sub-aggregations); its
    result, with the selected flag, is the facet, and its children's results
    are ``<name>><child>``."""

    size: int | None = None
    min_doc_count: int = 1
    terms: TermsAgg | None = None

    def prepare(self, params, ctx):
        p = SimpleFilter.prepare(self, params, ctx)
        p.own_counts = self.mode == INTERSECT
        p.selected = p.selected or []
        return p

    def elements(self, ctx: Ctx, keep: Column) -> Column:
        c = ctx.col(self.field)
        arr = F.array_distinct(c) if isinstance(ctx.dtype(self.field), T.ArrayType) else F.array(c)
        return F.transform(F.filter(arr, lambda x: x.isNotNull()), lambda x: _elem(self.name, x.cast("string"), F.lit(None), keep))


@dataclass
class FacetRangeFilter(BaseFilter):
    """gte/lte selection; reports the value count (and extra metric aggs)
    under the other facets' selections."""

    name: str
    field: str
    aggs: dict = dc_field(default_factory=dict)
    param: str | None = None

    def prepare(self, params, ctx):
        t = _base_type(ctx.dtype(self.field))
        lo = decode_last(params, (self.key, "gte"), t)
        hi = decode_last(params, (self.key, "lte"), t)
        if lo is None and hi is None:
            return Prepared(self, selected=(None, None))
        return Prepared(self, Range(self.field, gte=lo, lte=hi).cond(ctx), selected=(lo, hi))


@dataclass
class SimpleExpressionsFilter(BaseFilter):
    """Named predicates selected by name; UNION = OR, INTERSECT = AND."""

    name: str
    values: dict
    mode: str = UNION
    param: str | None = None

    def prepare(self, params, ctx):
        names = [v for v in params.get((self.key,), []) if v in self.values]
        if not names:
            return Prepared(self, selected=[])
        preds = [self.values[n].predicate(ctx) for n in names]
        if self.mode == INTERSECT:
            p = _and(preds)
        else:
            p = F.lit(False)
            for q in preds:
                p = p | q
        return Prepared(self, p, own_counts=self.mode == INTERSECT, selected=names)


@dataclass
class FacetExpressionsFilter(SimpleExpressionsFilter):
    """Named predicates with a count per name."""


@dataclass
class SortFilter(BaseFilter):
    """Sort choice by name; unknown or absent selects the first."""

    name: str
    values: dict
    param: str | None = None

    def prepare(self, params, ctx):
        chosen = (params.get((self.key,)) or [None])[-1]
        if chosen not in self.values:
            chosen = next(iter(self.values))
        return Prepared(self, selected=chosen, state={"sorts": [as_sort(s) for s in self.values[chosen]]})


@dataclass
class PageFilter(BaseFilter):
    """page / page size (one of ``available_sizes``) with a hit cap."""

    name: str = "page"
    available_sizes: tuple = (10, 25, 50, 100)
    default_size: int = 10
    max_hits: int = 10000
    param: str | None = None

    def prepare(self, params, ctx):
        page = decode_last(params, (self.key,), T.IntegerType())
        page = max(page, 1) if page is not None else 1
        size = decode_last(params, (self.key, "size"), T.IntegerType())
        size = max(size, 1) if size is not None else self.default_size
        per_page = size if size in self.available_sizes else self.default_size
        frm = min((page - 1) * per_page, self.max_hits)
        sz = min(per_page, self.max_hits - frm)
        return Prepared(self, state={"page": page, "per_page": per_page, "from": frm, "size": sz})


# --------------------------------------------------------------------------- attribute filters


def _attr_params(params: dict, key: str) -> dict[int, tuple[str, list[str]]]:
    """("attrs", "<id>", "any"|"all") -> values (the mode is required: bool
    attribute filters may share the parameter name with ("attrs", "<id>"))."""
    out: dict[int, tuple[str, list[str]]] = {}
    for k, vals in params.items():
        if not k or k[0] != key or len(k) != 3 or not vals:
            continue
        try:
            a = int(k[1])
        except ValueError:
            continue
        mode = k[2]
        if mode not in ("any", "all"):
            continue
        out[a] = (UNION if mode == "any" else INTERSECT, vals)
    return out


def _attr_is(a: int, v: Any):
    return lambda x: (x["attr_id"] == F.lit(a)) & (x["value"] == F.lit(v))


@dataclass
class AttrSimpleFilter(BaseFilter):
    """Select attributes ``array<struct<attr_id, value>>``: per attribute any
    ("any") or all ("all") of the values; attributes are ANDed."""

    name: str
    field: str
    param: str | None = None

    def _attr_pred(self, ctx: Ctx, a: int, mode: str, vals: list) -> Column:
        arr = ctx.col(self.field)
        if mode == INTERSECT:
            return _and([F.coalesce(F.exists(arr, _attr_is(a, v)), F.lit(False)) for v in vals])
        return F.coalesce(F.exists(arr, lambda x: (x["attr_id"] == F.lit(a)) & x["value"].isin(vals)), F.lit(False))

    def prepare(self, params, ctx):
        vt = ctx.dtype(self.field).elementType["value"].dataType
        subs = {}
        for a, (mode, raw) in _attr_params(params, self.key).items():
            vals = [d for d in (_decode(v, vt) for v in raw) if d is not None]
            if isinstance(vt, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
                vals = [v for v in vals if v >= 0]  # value ids are non-negative
            if vals:
                subs[a] = (self._attr_pred(ctx, a, mode, vals), mode == INTERSECT, vals)
        if not subs:
            return Prepared(self, sub_predicates={})
        return Prepared(self, _and([s[0] for s in subs.values()]), sub_predicates=subs)


@dataclass
class AttrFacetFilter(AttrSimpleFilter):
    """Counts per (attribute, value).  A union-selected attribute is counted
    without its own selection; an intersect-selected one with it.  Order:
    count desc, value asc; a selected attribute keeps its top ``selected_size``."""

    selected_size: int = 100

    def elements(self, ctx: Ctx, keep_for) -> Column:
        arr = F.array_distinct(ctx.col(self.field))
        return F.transform(F.filter(arr, lambda x: x.isNotNull() & x["attr_id"].isNotNull() & x["value"].isNotNull()),
                           lambda x: _elem(self.name, x["attr_id"].cast("string"), x["value"].cast("string"), keep_for(x["attr_id"])))


@dataclass
class AttrRangeSimpleFilter(BaseFilter):
    """Range attributes ``array<struct<attr_id, value float>>`` with
    (attrs, id, gte|lte) parameters.  NaN never matches; -0.0 equals 0.0.
    Reversed bounds (gte > lte) match only documents with two values, one per
    bound."""

    name: str
    field: str
    param: str | None = None

    def _attr_pred(self, ctx: Ctx, a: int, lo: float | None, hi: float | None) -> Column:
        arr = ctx.col(self.field)

        def ok(x, lo_, hi_):
            v = x["value"].cast("double")
            e = (x["attr_id"] == F.lit(a)) & ~F.isnan(v)
            if lo_ is not None:
                e = e & (v >= F.lit(float(lo_)))
            if hi_ is not None:
                e = e & (v <= F.lit(float(hi_)))
            return e

        if lo is not None and hi is not None and lo > hi:
            return F.coalesce(F.exists(arr, lambda x: ok(x, lo, None)) & F.exists(arr, lambda x: ok(x, None, hi)), F.lit(False))
        return F.coalesce(F.exists(arr, lambda x: ok(x, lo, hi)), F.lit(False))

    def prepare(self, params, ctx):
        sel: dict[int, list] = {}
        for k, vals in params.items():
            if len(k) == 3 and k[0] == self.key and k[2] in ("gte", "lte") and vals:
                try:
                    a = int(k[1])
                    v = float(np.float32(float(vals[-1])))  # parameters are float attributes
                except (ValueError, OverflowError):
                    continue
                if math.isnan(v):
                    continue
                b = sel.setdefault(a, [None, None])
                b[0 if k[2] == "gte" else 1] = v
        subs = {a: (self._attr_pred(ctx, a, lo, hi), False, (lo, hi)) for a, (lo, hi) in sel.items()}
        if not subs:
            return Prepared(self, sub_predicates={})
        return Prepared(self, _and([s[0] for s in subs.values()]), sub_predicates=subs)


@dataclass
class AttrRangeFacetFilter(AttrRangeSimpleFilter):
    """Per attribute: documents, min and max under the other selections (each
    selected attribute without its own bounds); top ``size`` attributes by
    document count, then attribute id."""

    size: int = 100

    def elements(self, ctx: Ctx, keep_for) -> Column:
        arr = ctx.col(self.field)
        ids = F.transform(arr, lambda x: x["attr_id"])
        return F.transform(
            F.filter(F.transform(arr, lambda x, i: F.struct(x.alias("x"), i.alias("i"))),
                     lambda s: s["x"].isNotNull() & s["x"]["attr_id"].isNotNull()),
            lambda s: _elem(self.name, s["x"]["attr_id"].cast("string"), F.lit(None), keep_for(s["x"]["attr_id"]),
                            num=F.when(~F.isnan(s["x"]["value"].cast("double")), s["x"]["value"].cast("double")),
                            cnt=F.array_position(ids, s["x"]["attr_id"]) == s["i"] + 1))


@dataclass
class AttrBoolSimpleFilter(BaseFilter):
    """Bool attributes ``array<struct<attr_id, value boolean>>`` with (attrs, id) parameters."""

    name: str
    field: str
    param: str | None = None

    def prepare(self, params, ctx):
        subs = {}
        for k, vals in params.items():
            if len(k) == 2 and k[0] == self.key:
                try:
                    a = int(k[1])
                except ValueError:
                    continue
                bools = [d for d in (_decode(v, T.BooleanType()) for v in vals) if d is not None]
                if bools:
                    arr = ctx.col(self.field)
                    p = F.coalesce(F.exists(arr, lambda x: (x["attr_id"] == F.lit(a)) & x["value"].isin(bools)), F.lit(False))
                    subs[a] = (p, False, sorted(set(bools)))
        if not subs:
            return Prepared(self, sub_predicates={})
        return Prepared(self, _and([s[0] for s in subs.values()]), sub_predicates=subs)


@dataclass
class AttrBoolFacetFilter(AttrBoolSimpleFilter):
    """Counts of false/true per attribute; a selected value with no documents
    is reported with 0.  Order: count desc, false before true."""

    def elements(self, ctx: Ctx, keep_for) -> Column:
        arr = F.array_distinct(ctx.col(self.field))
        return F.transform(F.filter(arr, lambda x: x.isNotNull() & x["attr_id"].isNotNull() & x["value"].isNotNull()),
                           lambda x: _elem(self.name, x["attr_id"].cast("string"), x["value"].cast("string"), keep_for(x["attr_id"])))


# --------------------------------------------------------------------------- apply


def _elem(facet: str, k1: Column, k2: Column, keep: Column, num: Column | None = None, cnt: Column | None = None) -> Column:
    return F.struct(F.lit(facet).alias("facet"), k1.cast("string").alias("k1"), k2.cast("string").alias("k2"),
                    keep.alias("keep"), (num if num is not None else F.lit(None).cast("double")).alias("num"),
                    (cnt if cnt is not None else F.lit(True)).alias("cnt"))


_COUNTING = (FacetFilter, AttrFacetFilter, AttrRangeFacetFilter, AttrBoolFacetFilter)


@dataclass
class FacetResult:
    hits: DataFrame
    total: DataFrame
    facets: dict
    page: DataFrame | None
    base: DataFrame
    aggregations: dict = dc_field(default_factory=dict)
    cached: list = dc_field(default_factory=list)

    def release(self) -> None:
        """Unpersist the shared facet counts (and the base, if cached)."""
        for d in self.cached:
            d.unpersist()


class QueryFilters:
    """An ordered set of named filters applied to a search."""

    def __init__(self, filters: list[BaseFilter]):
        self.filters = list(filters)

    def apply(self, search, params: dict, cache: bool = False) -> FacetResult:
        """Hits, total, facets and aggregations of ``search`` under the selections.

        The search keeps all it asks for: its sort (unless a sort filter sets
        one), offset and size (unless a page filter sets them), rescores and
        source options.  Its own aggregations see the query and the plain
        filters; facets and their selections, like its post filters, narrow only
        the hits and the total, and post filters do not narrow facet counts.
        """
        params = normalize_params(params)
        matched, ctx, aux, base_df, pred = search._compile()
        base = matched.persist(StorageLevel.MEMORY_AND_DISK) if cache else matched
        bctx = search._ctx(base)
        prepared = [f.prepare(params, bctx) for f in self.filters]
        preds = [p.predicate for p in prepared]

        def others(i: int, own: bool) -> Column:
            m = _and([p for j, p in enumerate(preds) if p is not None and (j != i or own)])
            return m if i < 0 else F.coalesce(m, F.lit(False))

        # ---- hits, sorted, rescored and paged as the search and the filters ask
        hits = search._post(base.filter(others(-1, True)), ctx)
        sorts = next((p.state["sorts"] for p in prepared if isinstance(p.flt, SortFilter)), None)
        page = next((p for p in prepared if isinstance(p.flt, PageFilter)), None)
        s = search
        if sorts:
            s = s._with(sorts=tuple(sorts))
        best = F.max("_score") if (s._sorted_by_score() or s.track_scores_) else F.lit(None).cast("double")
        total = hits.agg(F.count(F.lit(1)).cast("bigint").alias("total"), best.alias("max_score"))
        page_df = None
        if page is not None:
            st = page.state
            s = s._with(size_=st["size"], from__=st["from"])
            mt = (page.flt.max_hits - 1) // st["per_page"] + 1
            tp = F.least(F.expr(f"cast((total - 1) div {st['per_page']} as int) + 1"), F.lit(mt))
            page_df = total.select("total", F.lit(st["page"]).alias("page"), F.lit(st["per_page"]).alias("per_page"),
                                   tp.alias("total_pages"), F.lit(st["from"]).alias("from"), F.lit(st["size"]).alias("size"))
        hits_out = s._hits_from(hits, ctx, aux)

        # ---- the search's own aggregations
        plain = _and([p.predicate for p in prepared if p.predicate is not None and not isinstance(p.flt, _FACETS)])
        env = _Env(base=base_df, ctx_for=search._ctx, match=pred, id_col=search.id_col)
        aggregations = run_aggs(base.filter(F.coalesce(plain, F.lit(False))), search.aggs_, env) if search.aggs_ else {}

        # ---- counting facets: one explode, one groupBy
        parts: list[Column] = []
        for i, (f, p) in enumerate(zip(self.filters, prepared)):
            if isinstance(f, FacetFilter) and f.terms is None:
                parts.append(f.elements(bctx, others(i, p.own_counts)))
            elif isinstance(f, (AttrFacetFilter, AttrRangeFacetFilter, AttrBoolFacetFilter)):
                rest = others(i, False)
                subs = p.sub_predicates

                def keep_for(attr_col, rest=rest, subs=subs):
                    # attribute a: its own selection only in INTERSECT mode
                    if not subs:
                        return rest
                    e = None
                    for a in subs:
                        mask = rest & _and([sp for b, (sp, own, _) in subs.items() if b != a or own])
                        e = (F.when(attr_col == F.lit(a), mask) if e is None else e.when(attr_col == F.lit(a), mask))
                    return e.otherwise(rest & _and([sp for sp, _, _ in subs.values()]))

                parts.append(f.elements(bctx, keep_for))
        facets: dict[str, DataFrame] = {}
        cached: list[DataFrame] = []
        if parts:
            allp = parts[0] if len(parts) == 1 else F.concat(*parts)
            ex = base.select(F.explode(F.filter(allp, lambda e: F.coalesce(e["keep"], F.lit(False)))).alias("e")).select("e.*")
            # (facets x values) rows: small, and shared by every facet's result frame,
            # so it is computed once and kept (spilling to disk if needed)
            counts = ex.groupBy("facet", "k1", "k2").agg(
                F.count_if("cnt").cast("bigint").alias("doc_count"), F.min("num").alias("min"), F.max("num").alias("max"))
            counts = counts.persist(StorageLevel.MEMORY_AND_DISK)
            cached.append(counts)
            for f, p in zip(self.filters, prepared):
                if isinstance(f, _COUNTING) and getattr(f, "terms", None) is None:
                    facets[f.name] = _shape(f, p, counts.filter(F.col("facet") == f.name), bctx)
        for i, (f, p) in enumerate(zip(self.filters, prepared)):
            if isinstance(f, FacetFilter) and f.terms is not None:
                found = run_aggs(base.filter(others(i, p.own_counts)), {f.name: f.terms}, env)
                chosen = F.lit(False)
                for v in p.selected:
                    chosen = chosen | (F.col(f.name) == F.lit(v).cast(_base_type(bctx.dtype(f.field))))
                found[f.name] = found[f.name].withColumn("selected", F.coalesce(chosen, F.lit(False)))
                facets.update(found)

        # ---- range and expression facets: conditional aggregates in one row
        aggs: list[Column] = []
        for i, (f, p) in enumerate(zip(self.filters, prepared)):
            mask = others(i, p.own_counts)
            if isinstance(f, FacetRangeFilter):
                aggs.append(F.count(F.when(mask, bctx.col(f.field))).cast("bigint").alias(f"{f.name}__count"))
                for mname, m in f.aggs.items():
                    if isinstance(m, Bucket) or not _simple(m, bctx):  # e.g. a histogram of the field under the other selections
                        facets.update({f"{f.name}>{k}": v for k, v in run_aggs(base.filter(mask), {mname: m}, env).items()})
                    else:
                        aggs.append(_cond_metric(m, mask, bctx, f"{f.name}__{mname}"))
            elif isinstance(f, FacetExpressionsFilter):
                for vname, q in f.values.items():
                    aggs.append(F.count_if(mask & q.predicate(bctx)).cast("bigint").alias(f"{f.name}__{vname}"))
        if aggs:
            one = base.agg(*aggs)
            for f, p in zip(self.filters, prepared):
                if isinstance(f, FacetRangeFilter):
                    names = ["count"] + [n for n, m in f.aggs.items() if not isinstance(m, Bucket) and _simple(m, bctx)]
                    facets[f.name] = one.select(*[F.col(f"{f.name}__{n}").alias(n) for n in names])
                elif isinstance(f, FacetExpressionsFilter):
                    sel = set(p.selected or [])
                    rows = F.array(*[F.struct(F.lit(v).alias("value"), F.col(f"{f.name}__{v}").alias("doc_count"),
                                              F.lit(v in sel).alias("selected"), F.lit(i).alias("__i"))
                                     for i, v in enumerate(f.values)])
                    facets[f.name] = one.select(F.inline(rows)).orderBy("__i").drop("__i")
        if cache:
            cached.append(base)
        return FacetResult(hits=hits_out, total=total, facets=facets, page=page_df, base=base, aggregations=aggregations, cached=cached)


def _simple(m: Agg, ctx: Ctx) -> bool:
    """A metric that fits the shared conditional aggregate: one of the basic ones over a plain field."""
    from docsift.operators import aggs as A

    return (type(m) in (A.Min, A.Max, A.Avg, A.Sum, A.ValueCount) and m.field is not None
            and m.script is None and m.value_script is None and m.missing is None)


def _cond_metric(m: Agg, mask: Column, ctx: Ctx, alias: str) -> Column:
    from docsift.operators import aggs as A

    arr = isinstance(ctx.dtype(m.field), T.ArrayType)
    v = ctx.col(m.field)
    x = F.when(mask, v if arr else v.cast("double"))
    col = {A.Min: F.min(F.array_min(x) if arr else x).cast("double"), A.Max: F.max(F.array_max(x) if arr else x).cast("double"),
           A.Avg: F.sum(A._arr_sum(x)) / F.sum(A._arr_cnt(x)) if arr else F.avg(x),
           A.Sum: F.coalesce(F.sum(A._arr_sum(x) if arr else x), F.lit(0.0)),
           A.ValueCount: (F.coalesce(F.sum(A._arr_cnt(x)), F.lit(0)) if arr else F.count(x)).cast("bigint")}[type(m)]
    return col.alias(alias)


_FACETS = (*_COUNTING, FacetRangeFilter, FacetExpressionsFilter)


def _with_selection(spark, counts: DataFrame, by: list[str], selected: list[tuple], types: list) -> DataFrame:
    """The counts with a ``selected`` flag, and the selected values without any as zero rows; values are compared typed."""
    c = counts.select(*by, "doc_count", F.lit(False).alias("selected"))
    if selected:  # the selection list is request-sized
        rows = [F.struct(*[F.lit(v).cast(t).alias(b) for b, v, t in zip(by, row, types)]) for row in selected]
        chosen = spark.range(1).select(F.inline(F.array(*rows))).select(*by, F.lit(0).cast("bigint").alias("doc_count"), F.lit(True).alias("selected"))
        c = c.unionByName(chosen).groupBy(*by).agg(F.max("doc_count").alias("doc_count"), F.max("selected").alias("selected"))
    return c.select(*by, F.col("doc_count").cast("bigint").alias("doc_count"), "selected")


def _shape(f: BaseFilter, p: Prepared, counts: DataFrame, ctx: Ctx) -> DataFrame:
    spark = counts.sparkSession
    if isinstance(f, FacetFilter):
        vt = _base_type(ctx.dtype(f.field))
        c = counts.select(F.col("k1").cast(vt).alias("value"), "doc_count")
        c = _with_selection(spark, c, ["value"], [(v,) for v in p.selected or []], [vt])
        top = c.filter(F.col("doc_count") >= f.min_doc_count) if f.min_doc_count > 1 else c.filter("doc_count > 0")
        if f.size is not None:
            top = top.orderBy(F.desc("doc_count"), F.asc("value")).limit(f.size)
        out = top.unionByName(c.filter("selected")).distinct() if p.selected else top
        return out.orderBy(F.desc("doc_count"), F.asc("value"))
    if isinstance(f, AttrBoolFacetFilter):
        c = counts.select(F.col("k1").cast("int").alias("attr_id"), (F.col("k2") == "true").alias("value"), "doc_count")
        sel = [(a, b) for a, (_, _, vals) in p.sub_predicates.items() for b in vals]
        out = _with_selection(spark, c, ["attr_id", "value"], sel, [T.IntegerType(), T.BooleanType()])
        return out.orderBy("attr_id", F.desc("doc_count"), F.asc("value"))
    if isinstance(f, AttrRangeFacetFilter):
        c = counts.select(F.col("k1").cast("int").alias("attr_id"), "doc_count", F.col("min").cast("float").alias("min"),
                          F.col("max").cast("float").alias("max"))
        return c.orderBy(F.desc("doc_count"), F.asc("attr_id")).limit(f.size)
    if isinstance(f, AttrFacetFilter):
        vt = ctx.dtype(f.field).elementType["value"].dataType
        c = counts.select(F.col("k1").cast("int").alias("attr_id"), F.col("k2").cast(vt).alias("value"), "doc_count")
        sel_pairs = [(a, v) for a, (_, _, vals) in p.sub_predicates.items() for v in vals]
        sel_attrs = list(p.sub_predicates)
        out = _with_selection(spark, c, ["attr_id", "value"], sel_pairs, [T.IntegerType(), vt])
        if sel_attrs:  # of the selected attributes: the most frequent values, and the selected ones
            w = Window.partitionBy("attr_id").orderBy(F.desc("doc_count"), F.asc("value"))
            out = out.withColumn("__rn", F.row_number().over(w)).filter(
                ~F.col("attr_id").isin(sel_attrs) | (F.col("__rn") <= f.selected_size) | F.col("selected")).drop("__rn")
        return out.orderBy("attr_id", F.desc("doc_count"), F.asc("value"))
    raise TypeError(f)
