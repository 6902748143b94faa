"""Search plan: query, filters, post filters, aggregations, sorting and paging
over one DataFrame, compiled into DataFrame plans (nothing is collected).

* ``hits()``        -- matching rows (post filters applied), ``_score``, sorted, paged.
* ``total()``       -- one row: ``total`` (bigint) and ``max_score``.
* ``aggregations()``-- {path: DataFrame}; post filters do *not* narrow them.
* ``count()``       -- one row: ``count`` under query, filters and post filters.

Filters (``filter``) are unscored and become plain predicates that Catalyst
pushes into the Parquet scan.  The query's score is computed after filtering.
"""

from __future__ import annotations

import dataclasses
import fnmatch
from dataclasses import dataclass, field as dc_field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.functions.scripts import as_script
from docsift.operators.aggs import Agg, _Env, run_aggs
from docsift.operators.query import Ctx, Match, MatchAll, Query
from docsift.operators.sort import Sort, as_sort
from docsift.operators.text_index import TextIndex

__all__ = ["Search", "SearchResult", "Rescore", "multi_search", "DEFAULT_SIZE"]

DEFAULT_SIZE = 10


@dataclass(frozen=True)
class Rescore:
    """Re-score the top ``window_size`` hits with a second query.

    score_mode: total (default, q_w * s + r_w * r), multiply, avg, max, min.
    Documents the rescore query does not match keep ``query_weight * s``.
    Rescored documents come first; the rest follow in their original order.
    """

    query: Query
    window_size: int = 10
    query_weight: float = 1.0
    rescore_query_weight: float = 1.0
    score_mode: str = "total"


@dataclass(frozen=True)
class Search:
    df: DataFrame
    id_col: str
    query_: Query | None = None
    filters: tuple = ()
    post_filters: tuple = ()
    aggs_: dict = dc_field(default_factory=dict)
    sorts: tuple = ()
    size_: int | None = DEFAULT_SIZE
    from__: int = 0
    min_score_: float | None = None
    rescores: tuple = ()
    track_scores_: bool = False
    terminate_after_: int | None = None
    source_: Any = None                 # None (all), False (none), or (includes, excludes)
    runtime_fields: tuple = ()          # ((name, script, type), ...)
    script_fields: tuple = ()           # ((name, script), ...)
    fields_: tuple = ()                 # ((name, format or None), ...)
    docvalue_fields_: tuple = ()        # ((name, format or None), ...)
    stored_fields_: Any = None          # None (default), () = none, tuple of names
    knn_: Any = None
    explain_: bool = False
    corpus: DataFrame | None = None
    text_stats: dict = dc_field(default_factory=dict)   # field -> collection_stats table
    text_indexes: dict = dc_field(default_factory=dict)
    whole_indexes: tuple = ()
    vector_indexes: dict = dc_field(default_factory=dict)

    # ------------------------------------------------------------ builder
    def _with(self, **kw) -> "Search":
        return dataclasses.replace(self, **kw)

    def query(self, q: Query | None) -> "Search":
        return self._with(query_=q)

    def filter(self, *qs: Query) -> "Search":
        return self._with(filters=self.filters + tuple(qs))

    def post_filter(self, *qs: Query) -> "Search":
        return self._with(post_filters=self.post_filters + tuple(qs))

    def aggs(self, **aggs: Agg) -> "Search":
        d = dict(self.aggs_)
        d.update(aggs)
        return self._with(aggs_=d)

    def sort(self, *sorts: Any) -> "Search":
        return self._with(sorts=self.sorts + tuple(as_sort(s) for s in sorts))

    def size(self, n: int | None) -> "Search":
        return self._with(size_=n)

    def offset(self, n: int) -> "Search":
        return self._with(from__=n)

    def min_score(self, s: float | None) -> "Search":
        return self._with(min_score_=s)

    def rescore(self, r: Rescore) -> "Search":
        return self._with(rescores=self.rescores + (r,))

    def track_scores(self, on: bool = True) -> "Search":
        return self._with(track_scores_=on)

    def terminate_after(self, n: int | None) -> "Search":
        return self._with(terminate_after_=n)

    def source(self, includes: Any = None, excludes: Any = None, enabled: bool = True) -> "Search":
        if not enabled:
            return self._with(source_=False)
        inc = (includes,) if isinstance(includes, str) else tuple(includes or ())
        exc = (excludes,) if isinstance(excludes, str) else tuple(excludes or ())
        return self._with(source_=(inc, exc))

    def runtime_field(self, name: str, script: Any, type: str | None = None) -> "Search":
        return self._with(runtime_fields=self.runtime_fields + ((name, script, type),))

    def script_field(self, name: str, script: Any) -> "Search":
        return self._with(script_fields=self.script_fields + ((name, script),))

    def fields(self, *specs: Any) -> "Search":
        norm = tuple((s, None) if isinstance(s, str) else (s[0], s[1]) for s in specs)
        return self._with(fields_=self.fields_ + norm)

    def docvalue_fields(self, *specs: Any) -> "Search":
        """Column values of fields, as ``docvalue_<name>``: names or (name, format)."""
        return self._with(docvalue_fields_=self.docvalue_fields_ + tuple((s, None) if isinstance(s, str) else tuple(s) for s in specs))

    def stored_fields(self, *names: str) -> "Search":
        return self._with(stored_fields_=tuple(names))

    def knn(self, k: Any) -> "Search":
        return self._with(knn_=k)

    def explain(self, on: bool = True) -> "Search":
        return self._with(explain_=on)

    def with_text_stats(self, field: str, table: DataFrame) -> "Search":
        """Use a stored ``functions.text.collection_stats`` table for BM25 on ``field``."""
        d = dict(self.text_stats)
        d[field] = table
        return self._with(text_stats=d)

    def with_text_index(self, field: str, index: TextIndex, whole: bool = False) -> "Search":
        """Match ``field`` by its postings.  ``whole``: the search's rows are all documents of the index, so the best hits of a
        plain match may be chosen from the postings alone."""
        return self._with(text_indexes={**self.text_indexes, field: index}, text_stats={**self.text_stats, field: index},
                          whole_indexes=tuple(f for f in self.whole_indexes if f != field) + ((field,) if whole else ()))

    def with_vector_index(self, field: str, index: Any) -> "Search":
        """Answer a ``Knn`` on ``field`` that sets ``num_candidates`` from a ``VectorIndex``."""
        return self._with(vector_indexes={**self.vector_indexes, field: index})

    # ------------------------------------------------------------ compile
    def _base(self) -> DataFrame:
        df = self.df
        for name, script, typ in self.runtime_fields:
            c = as_script(script).column()
            df = df.withColumn(name, c.cast(typ) if typ else c)
        return df

    def _terms(self) -> dict:
        from docsift.operators.query import collect_text_terms
        return collect_text_terms(self.query_, self.filters, self.post_filters, [r.query for r in self.rescores])

    def _ctx(self, df: DataFrame) -> Ctx:
        return Ctx(df, self.id_col, corpus=self.corpus if self.corpus is not None else df, prefetch=self._terms(),
                   stats_tables=self.text_stats, text_indexes=self.text_indexes)

    def _page_of_postings(self) -> DataFrame | None:
        """(id, hits, score) of as many best hits as the page and the rescores need, if postings alone tell them."""
        q = self.query_
        plain = (isinstance(q, Match) and q.field in self.whole_indexes and self.size_ is not None and self.knn_ is None and self.terminate_after_ is None
                 and not (self.filters or self.post_filters or self.sorts or self.explain_ or self.runtime_fields))
        if not plain:
            return None
        terms = q._terms()
        if not terms or q.need(terms) > 1 or q._b() <= 0:
            return None
        return self.text_indexes[q.field].top_k(terms, max([self.from__ + self.size_, *(r.window_size for r in self.rescores)]))

    def _sorted_by_score(self) -> bool:
        return not self.sorts or any(s.field == "_score" for s in self.sorts)

    def _compile(self):
        """(matched: query+filters with _score, ctx, match predicate over base)."""
        base = self._base()
        ctx = self._ctx(base)
        q = self.query_ or MatchAll()
        pred = q.cond(ctx)  # filter forms: plain comparisons reach the Parquet scan
        for f in self.filters:
            pred = pred & f.cond(ctx)
        # filters alone (no query) form an unscored bool: every hit scores 0
        score = F.lit(0.0) if self.query_ is None and self.filters else q.score(ctx).cast("double")
        knn_side = None
        if self.knn_ is not None:
            knn_side = self.knn_.top_k(base, self.id_col, self._ctx, self.vector_indexes.get(self.knn_.field))
            if self.query_ is None:
                pred = F.lit(False)
        df = ctx.apply(base)
        if knn_side is not None:
            df = df.join(knn_side, self.id_col, "left")
            pred = pred | F.col("__knn_score").isNotNull()
            qpart = F.when(q.predicate(ctx), score).otherwise(F.lit(0.0)) if self.query_ is not None else F.lit(0.0)
            score = qpart + F.coalesce(F.col("__knn_score"), F.lit(0.0))
        matched = df.filter(pred).withColumn("_score", score)
        if self.explain_:
            matched = matched.withColumn("_explanation", _explain(q, ctx))
        if self.min_score_ is not None:
            matched = matched.filter(F.col("_score") >= F.lit(float(self.min_score_)))
        if self.terminate_after_ is not None:
            matched = matched.limit(self.terminate_after_)  # whichever rows come first: no scan beyond them
        aux = ctx.aux_columns() + (["__knn_score"] if knn_side is not None else [])
        return matched, ctx, aux, df, pred

    def _post(self, matched: DataFrame, ctx: Ctx) -> DataFrame:
        if not self.post_filters:
            return matched
        # a context of its own: what these filters join is joined to the matched rows, over the whole collection
        own = Ctx(matched, self.id_col, corpus=self.corpus if self.corpus is not None else self._base(), prefetch=self._terms(),
                  stats_tables=self.text_stats, text_indexes=self.text_indexes)
        p = F.lit(True)
        for f in self.post_filters:
            p = p & f.cond(own)
        return own.apply(matched).filter(p).select(*matched.columns)

    def _order(self, ctx: Ctx) -> list[Column]:
        cols: list[Column] = []
        for s in self.sorts or (Sort("_score", "desc"),):
            cols += s.order_columns(ctx)
        cols.append(F.col(self.id_col).asc_nulls_last())
        return cols

    def _project(self, df: DataFrame, aux: list[str], *more: str) -> DataFrame:
        src_cols = [c for c in self.df.columns]
        keep: list[Any] = []
        if self.stored_fields_ is not None and len(self.stored_fields_) == 0:
            keep = []
        elif self.source_ is False:
            keep = [self.id_col]
        elif isinstance(self.source_, tuple):
            inc, exc = self.source_
            keep = _source_filter(df.select(*src_cols).schema, inc, exc)
        else:
            keep = src_cols + [n for n, _, _ in self.runtime_fields if n not in src_cols]
        if self.stored_fields_:
            keep = [self.id_col] + [F.col(n) for n in self.stored_fields_ if n != self.id_col]
        extra = []
        for name, script in self.script_fields:
            extra.append(as_script(script).column().alias(name))
        for name, fmt in self.fields_:
            extra.append(_formatted(df, name, fmt).alias(f"fields_{name}"))
        for name, fmt in self.docvalue_fields_:
            extra.append(_docvalue(df, name, fmt).alias(f"docvalue_{name}"))
        score = [F.col("_score")]
        if self.explain_:
            score.append(F.col("_explanation"))
        return df.select(*keep, *extra, *score, *more)

    # ------------------------------------------------------------ results
    def hits(self) -> DataFrame:
        page = self._page_of_postings()
        if page is not None:  # a few rows: the collection is read for them only
            base = self._base()
            ctx = self._ctx(base)
            best = page.select(F.col("id").alias("__page_id"), (F.col("score") * F.lit(self.query_._b())).alias("_score"))
            matched = base.join(best, F.col(self.id_col) == F.col("__page_id")).drop("__page_id")
            if self.min_score_ is not None:
                matched = matched.filter(F.col("_score") >= F.lit(float(self.min_score_)))
            return self._hits_from(matched, ctx, [])
        matched, ctx, aux, _, _ = self._compile()
        return self._hits_from(self._post(matched, ctx), ctx, aux)

    def _hits_from(self, hits: DataFrame, ctx: Ctx, aux: list[str]) -> DataFrame:
        if not self._sorted_by_score() and not self.track_scores_:
            hits = hits.withColumn("_score", F.lit(None).cast("double"))
        order = self._order(ctx)
        for i, r in enumerate(self.rescores):
            # Rescored rows come first, so when the requested page lies inside
            # the last window the rest of the hits is never needed.
            fast = i == len(self.rescores) - 1 and self.size_ is not None and self.from__ + self.size_ <= r.window_size
            hits = self._rescore(hits, order, r, fast, ctx)
            order = [F.col("__rs_in").desc(), F.col("_score").desc_nulls_last(), F.col("__rs_rank").asc_nulls_last()] + self._order(ctx)
        if self.size_ is None:
            # all hits: sorted only if a sort, a query to rank by or an offset asks for it
            ranked = self.sorts or self.rescores or self.from__ or self.query_ is not None or self.knn_ is not None
            out = hits.orderBy(*order) if ranked else hits
            if self.from__:
                out = out.offset(self.from__)
        else:
            out = hits.orderBy(*order).limit(self.from__ + self.size_)
            if self.from__:
                out = out.offset(self.from__)
        return self._project(out, aux)

    def _rescore(self, hits: DataFrame, order: list[Column], r: Rescore, fast: bool, main: Ctx) -> DataFrame:
        from pyspark.sql import Window

        win = hits.orderBy(*order).limit(r.window_size)
        # rank inside the window: window_size rows at most
        win = win.withColumn("__rs_rank", F.row_number().over(Window.orderBy(*order)))
        rctx = Ctx(win, self.id_col, corpus=self.corpus if self.corpus is not None else self._base(), prefetch=self._terms(),
                   inherit=main, stats_tables=self.text_stats)
        rp, rs = r.query.predicate(rctx), r.query.score(rctx)
        win = rctx.apply(win)
        s = F.col("_score") * F.lit(r.query_weight)
        t = rs * F.lit(r.rescore_query_weight)
        mode = r.score_mode.lower()
        comb = {"total": s + t, "multiply": s * t, "avg": (s + t) / F.lit(2.0), "max": F.greatest(s, t), "min": F.least(s, t)}[mode]
        cols = [c for c in hits.columns if c not in ("_score", "__rs_in", "__rs_rank")]
        win = win.select(*cols, F.when(rp, comb).otherwise(s).alias("_score"), F.lit(True).alias("__rs_in"), "__rs_rank")
        if fast:
            return win
        rest = hits.join(win.select(F.col(self.id_col).alias("__rs_id")), hits[self.id_col] == F.col("__rs_id"), "left_anti")
        rest = rest.select(*cols, "_score", F.lit(False).alias("__rs_in"), F.lit(None).cast("int").alias("__rs_rank"))
        return win.unionByName(rest)

    def total(self) -> DataFrame:
        matched, ctx, _, _, _ = self._compile()
        hits = self._post(matched, ctx)
        ms = F.max("_score") if (self._sorted_by_score() or self.track_scores_) else F.lit(None).cast("double")
        return hits.agg(F.count(F.lit(1)).cast("bigint").alias("total"), ms.alias("max_score"))

    def count(self) -> DataFrame:
        matched, ctx, _, _, _ = self._compile()
        return self._post(matched, ctx).agg(F.count(F.lit(1)).cast("bigint").alias("count"))

    def aggregations(self) -> dict[str, DataFrame]:
        matched, ctx, _, base, pred = self._compile()
        env = _Env(base=base, ctx_for=self._ctx, match=pred, id_col=self.id_col)
        return run_aggs(matched, self.aggs_, env)

    def results(self, with_hits: bool = True) -> "SearchResult":
        """Hits, total and aggregations over one shared filtered base.

        The base (query + filters, scored) is persisted (memory, spilling to
        disk) only when more than one output reads it -- hits plus
        aggregations, or several aggregations; ``release()`` unpersists it.
        A lost executor's cached blocks are recomputed from the lineage.
        """
        from pyspark import StorageLevel

        matched, ctx, aux, base, pred = self._compile()
        shared = (with_hits and bool(self.aggs_)) or len(self.aggs_) > 1
        if shared:
            matched = matched.persist(StorageLevel.MEMORY_AND_DISK)
        env = _Env(base=base, ctx_for=self._ctx, match=pred, id_col=self.id_col)
        aggs = run_aggs(matched, self.aggs_, env)
        hits = total = None
        if with_hits:
            posted = self._post(matched, ctx)
            view = self._with(aggs_={})
            hits = view._hits_from(posted, ctx, aux)
            ms = F.max("_score") if (self._sorted_by_score() or self.track_scores_) else F.lit(None).cast("double")
            total = posted.agg(F.count(F.lit(1)).cast("bigint").alias("total"), ms.alias("max_score"))
        return SearchResult(hits=hits, total=total, aggregations=aggs, cached=[matched] if shared else [])

    def matched(self) -> DataFrame:
        """All rows matching query, filters and post filters, with ``_score`` (unsorted)."""
        matched, ctx, aux, _, _ = self._compile()
        return self._post(matched, ctx).drop(*[c for c in aux if c in matched.columns])


@dataclass
class SearchResult:
    hits: DataFrame | None
    total: DataFrame | None
    aggregations: dict
    cached: list = dc_field(default_factory=list)

    def release(self) -> None:
        for d in self.cached:
            d.unpersist()


def _source_filter(schema: T.StructType, inc: tuple, exc: tuple) -> list[Column]:
    """Columns for includes/excludes with wildcards over dotted paths, at any
    depth of structs and arrays of structs.  A pattern that matches a path covers
    all below it; an object of which nothing is left is dropped."""

    def covered(path: list[str], patterns: tuple) -> bool:
        return any(fnmatch.fnmatchcase(".".join(path[:i]), p) for i in range(1, len(path) + 1) for p in patterns)

    def whole(t: T.DataType, path: list[str]) -> bool:
        """Every leaf of the type stays."""
        if isinstance(t, T.ArrayType):
            return whole(t.elementType, path)
        if isinstance(t, T.StructType):
            return all(whole(f.dataType, [*path, f.name]) for f in t.fields)
        return (not inc or covered(path, inc)) and not covered(path, exc)

    def pick(c: Column, t: T.DataType, path: list[str]) -> Column | None:
        if whole(t, path):
            return c
        if isinstance(t, T.ArrayType):
            if pick(F.lit(None).cast(t.elementType), t.elementType, path) is None:
                return None
            return F.transform(c, lambda x: pick(x, t.elementType, path))
        if not isinstance(t, T.StructType):
            return None
        kept = [(f.name, pick(c.getField(f.name), f.dataType, [*path, f.name])) for f in t.fields]
        kept = [k.alias(n) for n, k in kept if k is not None]
        return F.when(c.isNotNull(), F.struct(*kept)) if kept else None

    cols = [(f.name, pick(F.col(f"`{f.name}`"), f.dataType, [f.name])) for f in schema.fields]
    return [c.alias(n) for n, c in cols if c is not None]


def _docvalue(df: DataFrame, name: str, fmt: str | None) -> Column:
    """Array of a field's column values, as a column store holds them: sorted, strings once each, nulls left out.

    Dates and formatted numbers are strings (dates in milliseconds with
    ``epoch_millis``); other values keep their type."""
    c = F.col(name)
    t = df.select(c).schema[0].dataType
    inner = t.elementType if isinstance(t, T.ArrayType) else t
    if isinstance(inner, (T.StructType, T.MapType)):
        raise ValueError(f"{name} has no column values")
    values = F.array_sort(F.filter(c if isinstance(t, T.ArrayType) else F.array(c), lambda x: x.isNotNull()))
    values = F.coalesce(values, F.array().cast(T.ArrayType(inner)))
    if isinstance(inner, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        if fmt == "epoch_millis":
            return F.transform(values, lambda x: F.unix_millis(x.cast("timestamp")).cast("string"))
        return F.transform(values, lambda x: F.date_format(x, fmt or "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
    if isinstance(inner, T.StringType):
        return F.array_distinct(values)
    if fmt and isinstance(inner, T.NumericType):
        return F.transform(values, lambda x: F.format_number(x.cast("double"), int(fmt)))
    return values


def _formatted(df: DataFrame, name: str, fmt: str | None) -> Column:
    """array<string> of a field (a dotted path reaches into structs and arrays of structs)."""
    c = F.col(name)
    t = df.select(c).schema[0].dataType

    def text(x: Column, kind: T.DataType) -> Column:
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            return F.date_format(x, fmt or "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
        if fmt and isinstance(kind, T.NumericType):
            return F.format_number(x.cast("double"), int(fmt))
        return x.cast("string")

    if isinstance(t, T.ArrayType):
        return F.coalesce(F.transform(c, lambda x: text(x, t.elementType)), F.array().cast("array<string>"))
    return F.when(c.isNull(), F.array().cast("array<string>")).otherwise(F.array(text(c, t)))


def _explain(q: Query, ctx: Ctx) -> Column:
    """array<struct<path, description, value>> of the score of each node."""
    parts: list[Column] = []

    from docsift.functions.text import analyze
    from docsift.operators.query import Match, MatchAll, MatchPhrase, _text_score, _uniq

    def entry(path: str, desc: str, value: Column) -> Column:
        return F.struct(F.lit(path).alias("path"), F.lit(desc).alias("description"), value.cast("double").alias("value"))

    def walk(node: Query, path: str) -> None:
        matched = node.predicate(ctx)
        desc = ("sum of:" if isinstance(node, (Match, MatchPhrase)) or type(node).__name__ == "Bool"
                else "*:*" if isinstance(node, MatchAll) else type(node).__name__)
        parts.append(entry(path, desc, F.when(matched, node.score(ctx)).otherwise(F.lit(0.0))))
        if isinstance(node, (Match, MatchPhrase)) and ctx.has(node.field):
            toks = ctx.tokens(node.field)
            for i, w in enumerate(_uniq(analyze(node.query, node.analyzer))):  # per-term BM25 weights
                parts.append(entry(f"{path}.terms[{i}]", f"weight({node.field}:{w})",
                                   F.when(matched, _text_score(ctx, node.field, [w], toks) * F.lit(node._b())).otherwise(F.lit(0.0))))
        kids: list[tuple[str, Query]] = []
        for attr in ("must", "should", "filter", "must_not", "queries"):
            for i, ch in enumerate(getattr(node, attr, ()) or ()):
                kids.append((f"{path}.{attr}[{i}]", ch))
        inner = getattr(node, "query", None)
        if isinstance(inner, Query):
            kids.append((f"{path}.query", inner))
        for p, ch in kids:
            walk(ch, p)

    walk(q, "query")
    return F.array(*parts)


def _shares_pass(s: Search) -> tuple | None:
    """What searches must have in common to be answered in one pass over the rows; None: this one needs its own."""
    if s.size_ is None or s.rescores or s.knn_ is not None or s.terminate_after_ is not None or s.explain_ or s.whole_indexes:
        return None
    held = lambda d: tuple(sorted((k, id(v)) for k, v in d.items()))
    return (id(s.df), s.id_col, id(s.corpus), s.runtime_fields, repr(s.source_), s.fields_, s.docvalue_fields_, s.script_fields, repr(s.stored_fields_),
            held(s.text_stats), held(s.text_indexes))


def _one_pass(group: list[tuple[int, Search]]) -> DataFrame:
    """Hits of several searches over the same rows: each row is tagged with the searches it matches, and each tag keeps its page.

    One context serves all, so they share joins, analyzed texts and statistics.
    The window's limit keeps a tag's best rows of each partition before the shuffle.
    """
    from pyspark.sql import Window

    first = group[0][1]
    base = first._base()
    terms: dict[str, list[str]] = {}
    for _, s in group:
        for fld, words in s._terms().items():
            terms[fld] = list(dict.fromkeys([*terms.get(fld, []), *words]))
    ctx = Ctx(base, first.id_col, corpus=first.corpus if first.corpus is not None else base, prefetch=terms, stats_tables=first.text_stats,
              text_indexes=first.text_indexes)
    hits, some = [], F.lit(False)
    for i, s in group:
        q = s.query_ or MatchAll()
        cond = q.cond(ctx)
        for f in (*s.filters, *s.post_filters):
            cond = cond & f.cond(ctx)
        score = F.lit(0.0) if s.query_ is None and s.filters else q.score(ctx).cast("double")
        kept = cond if s.min_score_ is None else cond & (score >= F.lit(float(s.min_score_)))
        hits.append(F.when(kept, F.struct(F.lit(i).alias("query_id"), score.alias("_score"))))
        some = some | cond
    tag = F.explode(F.filter(F.array(*hits), lambda h: h.isNotNull())).alias("__hit")
    rows = ctx.apply(base).filter(some)
    rows = rows.select("*", tag).select(*rows.columns, F.col("__hit.query_id").alias("query_id"), F.col("__hit._score").alias("_score"))
    silent = [i for i, s in group if not s._sorted_by_score() and not s.track_scores_]
    rows = rows.withColumn("_score", F.when(~F.col("query_id").isin(silent), F.col("_score")) if silent else F.col("_score"))
    order, cut = [], F.lit(False)
    for i, s in group:
        own = F.col("query_id") == F.lit(i)
        for o in s.sorts or (Sort("_score", "desc"),):
            order += o.order_columns(ctx, own)
        cut = cut | (own & (F.col("__rank") > F.lit(s.from__)) & (F.col("__rank") <= F.lit(s.from__ + s.size_)))
    order.append(F.col(first.id_col).asc_nulls_last())
    rows = rows.withColumn("__rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)))
    rows = rows.where(F.col("__rank") <= max(s.from__ + s.size_ for _, s in group)).where(cut)
    return first._project(rows, ctx.aux_columns(), "query_id", "__rank").orderBy("query_id", "__rank").drop("__rank")


def multi_search(searches: list[Search]) -> DataFrame:
    """Hits of several searches as one frame tagged by ``query_id`` (0-based, in request order).

    Searches over the same DataFrame that return the same columns take one pass
    over it, whatever their queries, sorts and pages; one that rescores, ranks by
    vectors, explains, ends early or wants all its hits takes its own.
    """
    groups: dict = {}
    for i, s in enumerate(searches):
        key = _shares_pass(s)
        groups.setdefault(key if key is not None else ("alone", i), []).append((i, s))
    out = None
    for group in groups.values():
        h = _one_pass(group) if len(group) > 1 else group[0][1].hits().withColumn("query_id", F.lit(group[0][0]))
        out = h if out is None else out.unionByName(h, allowMissingColumns=True)
    return out
