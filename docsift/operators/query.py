"""Query tree: immutable nodes that compile to Spark Columns.

Each node gives two Columns against a compilation context:

* ``predicate(ctx)`` -- a boolean that is never null.  Every leaf is wrapped in
  ``coalesce(.., false)`` before any negation, so a row missing a field matches
  ``must_not`` / ``ne`` (SQL ``<>`` would drop it).
* ``score(ctx)`` -- a double, meaningful where the predicate holds.

Multi-valued fields: any field may hold an array.  A leaf over an array column
means "some element satisfies it", evaluated with the ``exists`` higher-order
function (no explode).

Nodes that need data from other rows (BM25 statistics, parent/child joins)
register scalar subqueries or keyed left joins on the context; the plan layer
applies them before the predicate is evaluated, so Catalyst sees one plan.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass
from typing import Any, Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.functions import text as TX

__all__ = [
    "Ctx", "Query", "MatchAll", "MatchNone", "Term", "Terms", "Ids", "Exists", "Range", "Bool",
    "MinimumShouldMatch", "Match", "MatchPhrase", "MultiMatch", "Nested", "DisMax", "ConstantScore",
    "Field", "field", "Raw",
]

_FLOATS = (T.FloatType, T.DoubleType)


# --------------------------------------------------------------------------- context


class Ctx:
    """Resolves field paths to Columns and collects auxiliary plan pieces."""

    def __init__(self, df: DataFrame, id_col: str | None = None, corpus: DataFrame | None = None,
                 prefetch: dict | None = None, inherit: "Ctx | None" = None, stats_tables: dict | None = None,
                 text_indexes: dict | None = None):
        self.df = df
        # field -> TextIndex: matches come from the postings, by a join on the id
        self.text_indexes = text_indexes or {}
        self._indexed: dict[Any, tuple[str, str]] = {}
        # field -> precomputed collection statistics (functions.text.collection_stats)
        self.stats_tables = stats_tables or {}
        # statistics columns already present in ``df`` (computed by the context it was derived from)
        self._inherited = {} if inherit is None else {
            k: v for k, v in inherit._root._derived_keys.items() if k[0] == "stats" and v in df.columns}
        # field -> all query terms of the search on it: one shared statistics subquery per field
        self.prefetch = prefetch or {}
        self.id_col = id_col
        self.corpus = corpus if corpus is not None else df
        self._schema = df.schema
        self._var: Column | None = None
        self._prefix: str | None = None
        self._elem_type: T.StructType | None = None
        self._root = self
        self._derived: dict[str, Column] = {}
        self._derived_keys: dict[Any, str] = {}
        self._derived_types: dict[str, T.DataType] = {}
        self._joins: list[tuple[DataFrame, str, str]] = []
        self._n = 0

    # -- scopes
    def nested(self, path: str, var: Column) -> "Ctx":
        t = self.dtype(path)
        if not isinstance(t, T.ArrayType) or not isinstance(t.elementType, T.StructType):
            raise ValueError(f"{path} is not an array of structs")
        c = Ctx.__new__(Ctx)
        c.__dict__.update(self.__dict__)
        c._var, c._prefix, c._elem_type = var, path, t.elementType
        return c

    @property
    def in_nested(self) -> bool:
        return self._var is not None

    # -- fields
    def _split(self, name: str):
        if self._prefix and name.startswith(self._prefix + "."):
            return self._var, self._elem_type, name[len(self._prefix) + 1:].split(".")
        return None, self._schema, name.split(".")

    def has(self, name: str) -> bool:
        if name in self._root._derived:
            return True
        try:
            self.dtype(name)
            return True
        except KeyError:
            return False

    def dtype(self, name: str) -> T.DataType:
        if name in self._root._derived:
            return self._root._derived_types[name]
        _, t, parts = self._split(name)
        arr = False
        for p in parts:
            while isinstance(t, T.ArrayType):
                t, arr = t.elementType, True
            if not isinstance(t, T.StructType) or p not in t.fieldNames():
                raise KeyError(name)
            t = t[p].dataType
        return T.ArrayType(t) if arr else t

    def col(self, name: str) -> Column:
        if name in self._root._derived:
            return F.col(name)
        var, _, parts = self._split(name)
        if var is None:
            return F.col(".".join(f"`{p}`" for p in parts))
        c = var
        for p in parts:
            c = c.getField(p)
        return c

    # -- auxiliary columns and joins
    def fresh(self, base: str) -> str:
        self._root._n += 1
        return f"__ds_{base}_{self._root._n}"

    def derive(self, key: Any, build: Callable[[], Column], dtype: T.DataType) -> Column:
        """A column computed once per row (e.g. tokens of a text field)."""
        if self.in_nested:
            return build()
        r = self._root
        if key in r._inherited:
            return F.col(r._inherited[key])
        if key not in r._derived_keys:
            name = self.fresh("d")
            r._derived_keys[key] = name
            r._derived[name] = build()
            r._derived_types[name] = dtype
        return F.col(r._derived_keys[key])

    def derive_name(self, key: Any, build: Callable[[], Column], dtype: T.DataType) -> str:
        """Like ``derive`` but returns the column name (root scope only)."""
        if self.in_nested:
            raise ValueError("named derived columns are not available inside a nested scope")
        self.derive(key, build, dtype)
        return self._root._derived_keys[key]

    def attach(self, keyed: "DataFrame | Callable[[], DataFrame]", left_key: str, right_key: str, nulls: bool = False) -> None:
        """Left-join a frame holding at most one row per key (aggregated side).

        A callable is asked for the frame when the joins are applied, so nodes
        compiled later may still add to it.  ``nulls``: the left key may be null
        for many rows; these are spread instead of meeting in one partition.
        """
        if self.in_nested:
            raise ValueError("joins are not available inside a nested scope")
        self._root._joins.append((keyed, left_key, right_key, nulls))

    def indexed(self, name: str, terms: Sequence[str], slop: int | None = None) -> tuple[Column, Column] | None:
        """(hits, score) of the terms (``slop`` set: of the phrase) from the field's postings, null where nothing matches;
        None without postings of the field."""
        index = self.text_indexes.get(name)
        if index is None or self.in_nested or not self.id_col or not isinstance(self.dtype(name), T.StringType):
            return None
        r, key = self._root, (name, tuple(terms), slop)
        if key not in r._indexed:
            found = index.scores(list(terms)) if slop is None else index.phrase(list(terms), slop)
            hits, score, of = self.fresh("hits"), self.fresh("text"), self.fresh("id")
            self.attach(found.select(F.col("id").alias(of), F.col("hits").alias(hits), F.col("score").alias(score)), self.id_col, of)
            r._indexed[key] = (hits, score)
        return tuple(F.col(c) for c in r._indexed[key])

    def apply(self, df: DataFrame | None = None) -> DataFrame:
        df = self.df if df is None else df
        r = self._root
        for i, (keyed, lk, rk, nulls) in enumerate(r._joins):
            if not isinstance(keyed, DataFrame):
                keyed = keyed()
                r._joins[i] = (keyed, lk, rk, nulls)
            on = F.col(lk) == keyed[rk]
            if nulls and self.id_col:  # a second key: always equal, but for null keys, which match nothing anyway
                salt = f"__salt_{rk}"
                keyed = keyed.withColumn(salt, F.when(F.col(rk).isNull(), F.lit(1)).otherwise(F.lit(0)))
                on = (F.col(lk) == keyed[rk]) & (F.when(F.col(lk).isNull(), F.pmod(F.xxhash64(F.col(self.id_col)), F.lit(1 << 16)).cast("int")).otherwise(F.lit(0)) == keyed[salt])
                df = df.join(keyed, on, "left").drop(keyed[rk], keyed[salt])
            else:
                df = df.join(keyed, on, "left").drop(keyed[rk])
        for name, c in r._derived.items():  # in order: later ones may use earlier ones
            df = df.withColumn(name, c)
        return df

    def aux_columns(self) -> list[str]:
        r = self._root
        names = list(r._derived)
        for keyed, _, rk, _ in r._joins:
            names += [c for c in (keyed if isinstance(keyed, DataFrame) else keyed()).columns if c != rk]
        return names

    # -- text
    def tokens(self, name: str) -> Column:
        t = self.dtype(name)
        src = self.col(name)
        if isinstance(t, T.ArrayType):
            src = F.array_join(src, " ")
        return self.derive(("tok", self._prefix, name), lambda: TX.tokens(src), T.ArrayType(T.StringType()))

    def text_stats(self, name: str, terms: Sequence[str]) -> Column:
        """Scalar subquery over the whole collection: struct(n, avgdl, df0..dfk).

        One aggregate pass, only over the query's own terms; its result is a
        single row, so no token shuffle and no broadcast of growing size.  It
        is bound once as a column, so every reference shares one subquery.
        """
        if self.in_nested:
            return self._stats_subquery(name, terms)
        shared = self.prefetch.get(name)
        if shared and set(terms) <= set(shared):
            full = self.derive(("stats", None, name, tuple(shared)), lambda: self._stats_subquery(name, shared), T.StructType())
            idx = {w: i for i, w in enumerate(shared)}
            parts = [full.getField("n").alias("n"), full.getField("avgdl").alias("avgdl")]
            parts += [full.getField(f"df{idx[w]}").alias(f"df{i}") for i, w in enumerate(terms)]
            return F.struct(*parts)
        key = ("stats", self._prefix, name, tuple(terms))
        return self.derive(key, lambda: self._stats_subquery(name, terms), T.StructType())

    def _stats_subquery(self, name: str, terms: Sequence[str]) -> Column:
        if not self._prefix and hasattr(self.stats_tables.get(name), "stats"):
            return self.stats_tables[name].stats(list(terms))
        if not self._prefix and name in self.stats_tables:
            return TX.stats_from_table(self.stats_tables[name], list(terms))
        src = self.corpus
        if self._prefix:
            src = src.select(F.explode(F.col(self._prefix)).alias("__e"))
            c = F.col("__e")
            for p in name[len(self._prefix) + 1:].split("."):
                c = c.getField(p)
        else:
            c = F.col(".".join(f"`{p}`" for p in name.split(".")))
        t = self.dtype(name)
        if isinstance(t, T.ArrayType):
            c = F.array_join(c, " ")
        # counts by pattern: no token arrays for documents that are only counted
        src = src.select(F.lower(c).alias("text")).filter("text IS NOT NULL")
        length = F.regexp_count("text", F.lit(TX.TOKEN_PATTERN))
        parts = [F.count(F.lit(1)).cast("double").alias("n"), F.avg(length).alias("avgdl")]
        parts += [F.count_if(TX.has_token(F.col("text"), w)).cast("double").alias(f"df{i}") for i, w in enumerate(terms)]
        return src.select(F.struct(*parts).alias("s")).scalar()

    def text(self, name: str) -> Column:
        """Lower-cased text of a field (arrays joined), for token-boundary regex tests."""
        t = self.dtype(name)
        src = self.col(name)
        if isinstance(t, T.ArrayType):
            src = F.array_join(src, " ")
        return F.lower(src)


def _lit(v: Any, t: T.DataType) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(t, T.BooleanType):
        if isinstance(v, str):
            return F.lit(v.lower() == "true")
        return F.lit(bool(v))
    if isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType)) and isinstance(v, (str, int)):
        from docsift.functions.dates import parse_date_literal

        return parse_date_literal(v).cast(t)
    if isinstance(t, T.StringType):
        return F.lit(v if isinstance(v, str) or v is None else str(v))
    return F.lit(v).cast(t)


def leaf(ctx: Ctx, name: str, test: Callable[[Column, T.DataType], Column], raw: bool = False) -> Column:
    """Leaf test: scalar field -> test(c); array field -> exists(c, test).

    Null-safe (never null) unless ``raw``: the raw form may be null for a
    missing value, which a filter treats as no match -- and plain comparisons
    are what the Parquet reader can push down."""
    if not ctx.has(name):
        return F.lit(False)  # unmapped field matches nothing
    t = ctx.dtype(name)
    c = ctx.col(name)
    if isinstance(t, T.ArrayType):
        et = t.elementType
        e = F.exists(c, lambda x: F.coalesce(test(x, et), F.lit(False)))
    else:
        e = test(c, t)
    return e if raw else F.coalesce(e, F.lit(False))


def _not_nan(x: Column, t: T.DataType) -> Column:
    return ~F.isnan(x) if isinstance(t, _FLOATS) else F.lit(True)


# --------------------------------------------------------------------------- nodes


class Query:
    boost: float | None = None

    def predicate(self, ctx: Ctx) -> Column:
        """Boolean that is never null (safe to negate or to use as a value)."""
        raise NotImplementedError

    def cond(self, ctx: Ctx) -> Column:
        """Filter form: may be null where the predicate is false.  Leaves keep
        plain comparisons here so Catalyst can push them into the scan."""
        return self.predicate(ctx)

    def score(self, ctx: Ctx) -> Column:
        return F.lit(1.0 if self.boost is None else float(self.boost))

    def _b(self) -> float:
        return 1.0 if self.boost is None else float(self.boost)

    # combinators
    def __and__(self, other: "Query") -> "Bool":
        return Bool(filter=[self, other])

    def __or__(self, other: "Query") -> "Bool":
        return Bool(should=[self, other])

    def __invert__(self) -> "Bool":
        return Bool(must_not=[self])


@dataclass(frozen=True)
class Raw(Query):
    """A predicate given directly as a Column or SQL string (scored constant)."""

    expr: Any
    boost: float | None = None

    def predicate(self, ctx):
        c = F.expr(self.expr) if isinstance(self.expr, str) else self.expr
        return F.coalesce(c, F.lit(False))


@dataclass(frozen=True)
class MatchAll(Query):
    boost: float | None = None

    def predicate(self, ctx):
        return F.lit(True)


@dataclass(frozen=True)
class MatchNone(Query):
    def predicate(self, ctx):
        return F.lit(False)

    def score(self, ctx):
        return F.lit(0.0)


@dataclass(frozen=True)
class Term(Query):
    """Exact value; on a multi-valued field, "contains".  ``value=None`` is "missing"."""

    field: str
    value: Any
    boost: float | None = None

    def cond(self, ctx):
        if self.value is None:
            return ~Exists(self.field).predicate(ctx)
        return leaf(ctx, self.field, lambda x, t: x == _lit(self.value, t), raw=True)

    def predicate(self, ctx):
        return F.coalesce(self.cond(ctx), F.lit(False))


@dataclass(frozen=True)
class Terms(Query):
    field: str
    values: tuple
    boost: float | None = None

    def __init__(self, field: str, values: Iterable[Any], boost: float | None = None):
        object.__setattr__(self, "field", field)
        object.__setattr__(self, "values", tuple(values))
        object.__setattr__(self, "boost", boost)

    def cond(self, ctx):
        vals = [v for v in self.values if v is not None]
        if not vals:
            return F.lit(False)
        return leaf(ctx, self.field, lambda x, t: x.isin([_lit(v, t) for v in vals]), raw=True)

    def predicate(self, ctx):
        return F.coalesce(self.cond(ctx), F.lit(False))


@dataclass(frozen=True)
class Ids(Query):
    """Documents with the given ids.  Very long lists: pass a DataFrame of ids."""

    values: Any
    boost: float | None = None

    def predicate(self, ctx):
        if ctx.id_col is None:
            raise ValueError("Ids needs the id column of the collection")
        if isinstance(self.values, DataFrame):
            keyed = self.values.select(F.col(self.values.columns[0]).alias("__ids_k")).distinct()
            name = ctx.fresh("ids")
            keyed = keyed.withColumn(name, F.lit(True))
            ctx.attach(keyed, ctx.id_col, "__ids_k")
            return F.coalesce(F.col(name), F.lit(False))
        return Terms(ctx.id_col, list(self.values)).predicate(ctx)


@dataclass(frozen=True)
class Exists(Query):
    field: str
    boost: float | None = None

    def predicate(self, ctx):
        if not ctx.has(self.field):
            return F.lit(False)
        t = ctx.dtype(self.field)
        c = ctx.col(self.field)
        if isinstance(t, T.ArrayType):
            return F.coalesce(F.exists(c, lambda x: x.isNotNull()), F.lit(False))
        return c.isNotNull()


@dataclass(frozen=True)
class Range(Query):
    """gt / gte / lt / lte.  Float fields never match NaN; -0.0 equals 0.0.

    On a range-typed field (struct with gte/lte, null = unbounded) ``relation``
    is ``intersects`` (default), ``contains`` or ``within``.
    """

    field: str
    gt: Any = None
    gte: Any = None
    lt: Any = None
    lte: Any = None
    relation: str | None = None
    boost: float | None = None

    def _scalar(self, x: Column, t: T.DataType) -> Column:
        e = _not_nan(x, t)
        if self.gt is not None:
            e = e & (x > _lit(self.gt, t))
        if self.gte is not None:
            e = e & (x >= _lit(self.gte, t))
        if self.lt is not None:
            e = e & (x < _lit(self.lt, t))
        if self.lte is not None:
            e = e & (x <= _lit(self.lte, t))
        return e

    def cond(self, ctx):
        if not ctx.has(self.field):
            return F.lit(False)
        t = ctx.dtype(self.field)
        base_t = t.elementType if isinstance(t, T.ArrayType) else t
        if isinstance(base_t, T.StructType):
            return leaf(ctx, self.field, lambda x, st: self._relation(x, st), raw=True)
        return leaf(ctx, self.field, self._scalar, raw=True)

    def predicate(self, ctx):
        return F.coalesce(self.cond(ctx), F.lit(False))

    def _relation(self, x: Column, st: T.StructType) -> Column:
        names = st.fieldNames()
        bt = st[names[0]].dataType
        none = F.lit(None).cast(bt)

        def stored(closed: str, opened: str, tighter) -> tuple[Column, Column]:
            """The stored bound (null: unbounded) and whether it is exclusive."""
            c = x.getField(closed) if closed in names else none
            o = x.getField(opened) if opened in names else none
            is_open = F.coalesce(o.isNotNull() & (c.isNull() | tighter(o, c)), F.lit(False))
            return F.when(is_open, o).otherwise(c), is_open

        flo, lo_open = stored("gte", "gt", lambda o, c: o >= c)
        fhi, hi_open = stored("lte", "lt", lambda o, c: o <= c)
        qlo, lo_inc = (self.gte, True) if self.gte is not None else (self.gt, False)
        qhi, hi_inc = (self.lte, True) if self.lte is not None else (self.lt, False)
        ql, qh = _lit(qlo, bt), _lit(qhi, bt)
        rel = (self.relation or "intersects").lower()
        T_ = F.lit(True)
        if rel == "intersects":
            a = T_ if qhi is None else flo.isNull() | (flo < qh) | ((flo == qh) & ~lo_open & F.lit(hi_inc))
            b = T_ if qlo is None else fhi.isNull() | (fhi > ql) | ((fhi == ql) & ~hi_open & F.lit(lo_inc))
            return a & b
        if rel == "within":
            a = T_ if qlo is None else flo.isNotNull() & ((flo > ql) | ((flo == ql) & (F.lit(lo_inc) | lo_open)))
            b = T_ if qhi is None else fhi.isNotNull() & ((fhi < qh) | ((fhi == qh) & (F.lit(hi_inc) | hi_open)))
            return a & b
        if rel == "contains":
            a = flo.isNull() if qlo is None else flo.isNull() | (flo < ql) | ((flo == ql) & (~lo_open | ~F.lit(lo_inc)))
            b = fhi.isNull() if qhi is None else fhi.isNull() | (fhi > qh) | ((fhi == qh) & (~hi_open | ~F.lit(hi_inc)))
            return a & b
        raise ValueError(f"unknown relation {self.relation}")


# --------------------------------------------------------------------------- bool


@dataclass(frozen=True)
class MinimumShouldMatch:
    """``count`` (negative = optional clauses), ``percent`` (negative allowed), or
    ``combinations``: [(n, MinimumShouldMatch)] -- applies when clauses > n."""

    count: int | None = None
    percent: int | None = None
    combinations: tuple = ()

    def resolve(self, total: int) -> int:
        if self.combinations:
            combos = sorted(self.combinations, key=lambda p: p[0])
            if total <= combos[0][0]:
                return total
            spec = [s for n, s in combos if total > n][-1]
            return spec.resolve(total)
        if self.count is not None:
            r = self.count if self.count >= 0 else total + self.count
        elif self.percent is not None:
            part = math.floor(total * abs(self.percent) / 100.0)
            r = part if self.percent >= 0 else total - part
        else:
            r = 1
        return max(0, min(total, r))

    @staticmethod
    def of(v: Any) -> "MinimumShouldMatch | None":
        if v is None or isinstance(v, MinimumShouldMatch):
            return v
        if isinstance(v, int):
            return MinimumShouldMatch(count=v)
        s = str(v).strip()
        if "<" in s:
            combos = []
            for part in s.split():
                n, spec = part.split("<")
                combos.append((int(n), MinimumShouldMatch.of(spec)))
            return MinimumShouldMatch(combinations=tuple(combos))
        if s.endswith("%"):
            return MinimumShouldMatch(percent=int(s[:-1]))
        return MinimumShouldMatch(count=int(s))


def _count_true(cols: list[Column]) -> Column:
    return sum((F.when(c, 1).otherwise(0) for c in cols), F.lit(0))


@dataclass(frozen=True)
class Bool(Query):
    """must (scored, required), filter (required, unscored), should (scored;
    required only when there is no must/filter, or with minimum_should_match),
    must_not (excluded).  The boost multiplies the score."""

    must: tuple = ()
    filter: tuple = ()
    should: tuple = ()
    must_not: tuple = ()
    minimum_should_match: Any = None
    boost: float | None = None

    def __init__(self, must=(), filter=(), should=(), must_not=(), minimum_should_match=None, boost=None):
        object.__setattr__(self, "must", tuple(must))
        object.__setattr__(self, "filter", tuple(filter))
        object.__setattr__(self, "should", tuple(should))
        object.__setattr__(self, "must_not", tuple(must_not))
        object.__setattr__(self, "minimum_should_match", MinimumShouldMatch.of(minimum_should_match))
        object.__setattr__(self, "boost", boost)

    def _required_should(self) -> int:
        n = len(self.should)
        if self.minimum_should_match is not None:
            return self.minimum_should_match.resolve(n)
        return 1 if n and not self.must and not self.filter else 0

    def cond(self, ctx):
        parts = [q.cond(ctx) for q in self.must + self.filter]
        parts += [~q.predicate(ctx) for q in self.must_not]
        need = self._required_should()
        if need == 1:
            any_ = None
            for q in self.should:
                c = q.cond(ctx)
                any_ = c if any_ is None else any_ | c
            parts.append(any_)
        elif need > 1:
            parts.append(_count_true([q.cond(ctx) for q in self.should]) >= F.lit(need))
        if not parts:
            return F.lit(True)
        e = parts[0]
        for p in parts[1:]:
            e = e & p
        return e

    def predicate(self, ctx):
        return F.coalesce(self.cond(ctx), F.lit(False))

    def score(self, ctx):
        s = F.lit(0.0)
        for q in self.must:
            s = s + q.score(ctx)
        for q in self.should:
            s = s + F.when(q.predicate(ctx), q.score(ctx)).otherwise(F.lit(0.0))
        return s * F.lit(self._b())


@dataclass(frozen=True)
class ConstantScore(Query):
    filter: Query
    boost: float | None = None

    def predicate(self, ctx):
        return self.filter.predicate(ctx)

    def cond(self, ctx):
        return self.filter.cond(ctx)


@dataclass(frozen=True)
class DisMax(Query):
    """Any sub-query matches; score = best + tie_breaker * (sum of the others)."""

    queries: tuple
    tie_breaker: float = 0.0
    boost: float | None = None

    def __init__(self, queries, tie_breaker: float = 0.0, boost: float | None = None):
        object.__setattr__(self, "queries", tuple(queries))
        object.__setattr__(self, "tie_breaker", tie_breaker)
        object.__setattr__(self, "boost", boost)

    def predicate(self, ctx):
        e = F.lit(False)
        for q in self.queries:
            e = e | q.predicate(ctx)
        return e

    def score(self, ctx):
        parts = [F.when(q.predicate(ctx), q.score(ctx)).otherwise(F.lit(0.0)) for q in self.queries]
        best = parts[0] if len(parts) == 1 else F.greatest(*parts)
        total = sum(parts[1:], parts[0])
        return (best + F.lit(float(self.tie_breaker)) * (total - best)) * F.lit(self._b())


# --------------------------------------------------------------------------- text


def _text_score(ctx: Ctx, fld: str, terms: list[str], toks: Column) -> Column:
    """BM25 over the distinct query terms present in the document."""
    if not terms:
        return F.lit(0.0)
    stats = ctx.text_stats(fld, terms)
    dl = F.size(toks)
    s = F.lit(0.0)
    for i, w in enumerate(terms):
        tf = TX.term_freq(toks, w)
        idf = TX.bm25_idf(stats.getField("n"), stats.getField(f"df{i}"))
        s = s + F.when(tf > 0, idf * TX.bm25_tf(tf, dl, stats.getField("avgdl"))).otherwise(F.lit(0.0))
    return s


def _uniq(ts: list[str]) -> list[str]:
    seen, out = set(), []
    for t in ts:
        if t not in seen:
            seen.add(t)
            out.append(t)
    return out


@dataclass(frozen=True)
class Match(Query):
    """Analyzed full-text match: any term (``operator='or'``), all terms
    (``'and'``) or ``minimum_should_match`` of the distinct query terms.  Scored
    with BM25 (k1=1.2, b=0.75) over collection statistics."""

    field: str
    query: str
    operator: str = "or"
    minimum_should_match: Any = None
    boost: float | None = None
    analyzer: str | None = None  # of the query string

    def _terms(self) -> list[str]:
        return _uniq(TX.analyze(self.query, self.analyzer))

    def predicate(self, ctx):
        terms = self._terms()
        if not terms or not ctx.has(self.field):
            return F.lit(False)
        need = self.need(terms)
        found = ctx.indexed(self.field, terms)
        if found:
            return F.coalesce(found[0] >= need, F.lit(False))
        txt = ctx.text(self.field)
        if need == 1:
            some = [TX.has_token(txt, w) for w in terms]
            return F.coalesce(functools.reduce(lambda a, b: a | b, some), F.lit(False))
        return F.coalesce(_count_true([TX.has_token(txt, w) for w in terms]) >= F.lit(need), F.lit(False))

    def need(self, terms: list[str]) -> int:
        """How many of the distinct terms a document must have."""
        msm = MinimumShouldMatch.of(self.minimum_should_match)
        return max(1, len(terms) if self.operator.lower() == "and" else (msm.resolve(len(terms)) if msm else 1))

    def score(self, ctx):
        terms = self._terms()
        if not terms or not ctx.has(self.field):
            return F.lit(0.0)
        found = ctx.indexed(self.field, terms)
        if found:
            return F.coalesce(found[1], F.lit(0.0)) * F.lit(self._b())
        return _text_score(ctx, self.field, terms, ctx.tokens(self.field)) * F.lit(self._b())


@dataclass(frozen=True)
class MatchPhrase(Query):
    field: str
    query: str
    slop: int = 0
    prefix: bool = False
    boost: float | None = None
    analyzer: str | None = None  # of the query string

    def _terms(self):
        return TX.analyze(self.query, self.analyzer)

    def predicate(self, ctx):
        terms = self._terms()
        if not terms or not ctx.has(self.field) or not all(map(TX.is_token, terms)):
            return F.lit(False)
        found = None if self.prefix else ctx.indexed(self.field, terms, self.slop)
        if found:
            return found[0].isNotNull()
        many = isinstance(ctx.dtype(self.field), T.ArrayType)
        src = ctx.col(self.field)

        def somewhere(test: Callable[[Column], Column]) -> Column:  # in one element: a phrase does not cross elements
            return F.exists(src, lambda x: test(F.lower(x))) if many else test(F.lower(src))

        whole = _uniq(terms[:-1] if self.prefix else terms)
        if self.slop == 0:  # adjacent tokens = separated by non-token characters only; cheap containment tests first
            here = lambda x: functools.reduce(lambda a, b: a & b, [x.contains(w) for w in terms]) & x.rlike(TX.phrase_regex(terms, self.prefix))
            return F.coalesce(somewhere(here), F.lit(False))
        pre = F.lit(True)
        for w in whole:
            pre = pre & F.coalesce(somewhere(functools.partial(TX.has_token, term=w)), F.lit(False))
        texts = F.transform(src, F.lower) if many else F.array(F.lower(src))
        return pre & TX.sloppy_phrase(F.when(pre, texts), terms, self.slop, self.prefix)

    def score(self, ctx):
        terms = _uniq(self._terms()[:-1] if self.prefix else self._terms())
        if not terms or not ctx.has(self.field):
            return F.lit(0.0) if not self.prefix else F.lit(self._b())
        found = None if self.prefix else ctx.indexed(self.field, self._terms(), self.slop)
        if found:
            return F.coalesce(found[1], F.lit(0.0)) * F.lit(self._b())
        return _text_score(ctx, self.field, terms, ctx.tokens(self.field)) * F.lit(self._b())


def _field_boost(spec: str) -> tuple[str, float]:
    if "^" in spec:
        f, b = spec.rsplit("^", 1)
        return f, float(b)
    return spec, 1.0


@dataclass(frozen=True)
class MultiMatch(Query):
    """``type``: best_fields (max + tie_breaker x rest), most_fields (sum),
    cross_fields (fields analyzed as one), phrase, phrase_prefix.  Field boosts
    use ``name^boost``."""

    query: str
    fields: tuple
    type: str = "best_fields"
    tie_breaker: float = 0.0
    operator: str = "or"
    minimum_should_match: Any = None
    boost: float | None = None
    analyzer: str | None = None

    def __init__(self, query, fields, type="best_fields", tie_breaker=0.0, operator="or", minimum_should_match=None, boost=None, analyzer=None):
        for k, v in dict(query=query, fields=tuple(fields), type=type, tie_breaker=tie_breaker, operator=operator,
                         minimum_should_match=minimum_should_match, boost=boost, analyzer=analyzer).items():
            object.__setattr__(self, k, v)

    def _subs(self) -> list[tuple[Query, float]]:
        out = []
        for spec in self.fields:
            f, b = _field_boost(spec)
            if self.type in ("phrase", "phrase_prefix"):
                q: Query = MatchPhrase(f, self.query, prefix=self.type == "phrase_prefix", analyzer=self.analyzer)
            else:
                q = Match(f, self.query, self.operator, self.minimum_should_match, analyzer=self.analyzer)
            out.append((q, b))
        return out

    def _cross_tokens(self, ctx: Ctx) -> Column:
        cols = [ctx.tokens(_field_boost(s)[0]) for s in self.fields if ctx.has(_field_boost(s)[0])]
        return ctx.derive(("xtok", self.fields), lambda: F.flatten(F.array(*[F.coalesce(c, F.array().cast("array<string>")) for c in cols])),
                          T.ArrayType(T.StringType()))

    def predicate(self, ctx):
        if self.type == "cross_fields":
            terms = _uniq(TX.analyze(self.query, self.analyzer))
            if not terms:
                return F.lit(False)
            toks = self._cross_tokens(ctx)
            need = len(terms) if self.operator.lower() == "and" else 1
            msm = MinimumShouldMatch.of(self.minimum_should_match)
            if msm:
                need = max(1, msm.resolve(len(terms)))
            return F.coalesce(_count_true([F.array_contains(toks, F.lit(w)) for w in terms]) >= F.lit(need), F.lit(False))
        e = F.lit(False)
        for q, _ in self._subs():
            e = e | q.predicate(ctx)
        return e

    def score(self, ctx):
        if self.type == "cross_fields":
            # blended: each term scored per field, best field per term, summed
            terms = _uniq(TX.analyze(self.query, self.analyzer))
            total = F.lit(0.0)
            for w in terms:
                per = []
                for spec in self.fields:
                    f, b = _field_boost(spec)
                    if ctx.has(f):
                        per.append(_text_score(ctx, f, [w], ctx.tokens(f)) * F.lit(b))
                if per:
                    total = total + (per[0] if len(per) == 1 else F.greatest(*per))
            return total * F.lit(self._b())
        parts = [F.when(q.predicate(ctx), q.score(ctx) * F.lit(b)).otherwise(F.lit(0.0)) for q, b in self._subs()]
        if self.type == "most_fields":
            s = sum(parts[1:], parts[0])
        else:
            best = parts[0] if len(parts) == 1 else F.greatest(*parts)
            s = best + F.lit(float(self.tie_breaker)) * (sum(parts[1:], parts[0]) - best)
        return s * F.lit(self._b())


# --------------------------------------------------------------------------- nested


@dataclass(frozen=True)
class Nested(Query):
    """Some element of the array-of-structs ``path`` satisfies ``query`` as a
    whole (all conditions on the same element).  score_mode: avg (default),
    max, min, sum, none."""

    path: str
    query: Query
    score_mode: str = "avg"
    ignore_unmapped: bool = False
    boost: float | None = None

    def predicate(self, ctx):
        if not ctx.has(self.path):
            if self.ignore_unmapped:
                return F.lit(False)
            raise KeyError(self.path)
        return F.coalesce(F.exists(ctx.col(self.path), lambda x: self.query.predicate(ctx.nested(self.path, x))), F.lit(False))

    def score(self, ctx):
        if not ctx.has(self.path):
            return F.lit(0.0)
        mode = (self.score_mode or "avg").lower()
        if mode == "none":
            return F.lit(0.0)
        arr = ctx.col(self.path)
        scores = F.transform(
            F.filter(arr, lambda x: self.query.predicate(ctx.nested(self.path, x))),
            lambda x: self.query.score(ctx.nested(self.path, x)).cast("double"),
        )
        total = F.aggregate(scores, F.lit(0.0), lambda a, b: a + b)
        if mode == "sum":
            s = total
        elif mode == "max":
            s = F.array_max(scores)
        elif mode == "min":
            s = F.array_min(scores)
        else:
            s = total / F.greatest(F.size(scores), F.lit(1)).cast("double")
        return F.coalesce(s, F.lit(0.0)) * F.lit(self._b())


# --------------------------------------------------------------------------- field helper


class Field:
    """Fluent helpers mirroring a typed field: eq / ne / one_of / gt / ... / match."""

    def __init__(self, name: str):
        self.name = name

    def eq(self, v):
        return Term(self.name, v)

    def ne(self, v):
        if v is None:
            return Exists(self.name)
        return Bool(must_not=[Term(self.name, v)])

    def one_of(self, vs):
        return Terms(self.name, vs)

    def gt(self, v):
        return Range(self.name, gt=v)

    def gte(self, v):
        return Range(self.name, gte=v)

    def lt(self, v):
        return Range(self.name, lt=v)

    def lte(self, v):
        return Range(self.name, lte=v)

    def range(self, gt=None, gte=None, lt=None, lte=None, relation=None):
        return Range(self.name, gt, gte, lt, lte, relation)

    def exists(self):
        return Exists(self.name)

    def missing(self):
        return Bool(must_not=[Exists(self.name)])

    def match(self, q, **kw):
        return Match(self.name, q, **kw)

    def asc(self, **kw):
        from docsift.operators.sort import Sort
        return Sort(self.name, "asc", **kw)

    def desc(self, **kw):
        from docsift.operators.sort import Sort
        return Sort(self.name, "desc", **kw)


def field(name: str) -> Field:
    return Field(name)


def collect_text_terms(*nodes: Any) -> dict[str, list[str]]:
    """Every analyzed query term per text field in a set of query trees (root
    scope only), in first-seen order."""
    out: dict[str, list[str]] = {}

    def add(fld: str, text_: str, analyzer: str | None) -> None:
        lst = out.setdefault(fld, [])
        for w in TX.analyze(text_, analyzer):
            if w not in lst:
                lst.append(w)

    def walk(x: Any) -> None:
        if isinstance(x, Nested):
            return  # nested scopes use their own element statistics
        if isinstance(x, (Match, MatchPhrase)):
            add(x.field, x.query, x.analyzer)
        elif isinstance(x, MultiMatch):
            for spec in x.fields:
                add(_field_boost(spec)[0], x.query, x.analyzer)
        if isinstance(x, (list, tuple)):
            for y in x:
                walk(y)
        elif hasattr(x, "__dataclass_fields__"):
            for f in x.__dataclass_fields__:
                walk(getattr(x, f))

    for n in nodes:
        walk(n)
    return out
