"""Aggregations: metrics and (nested) buckets, compiled to groupBy plans.

A tree of aggregations becomes one DataFrame per bucket path, named
``parent>child``.  Buckets under buckets lengthen the groupBy key; sibling
metrics of a bucket share its single ``agg`` (Catalyst plans partial + final
aggregation, so hot keys are combined map-side before the shuffle).

Output columns: each bucket agg named ``n`` contributes key column ``n``
(ranges and filters use the bucket key string); every bucket row carries
``doc_count``; single-value metrics are columns named after the metric;
multi-value metrics use ``<name>_<stat>``.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass, field as dc_field
from typing import Any, Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.functions.scripts import as_script
from docsift.operators.query import Ctx, Query

__all__ = [
    "Min", "Max", "Avg", "Sum", "ValueCount", "Cardinality", "Stats", "ExtendedStats", "Percentiles",
    "MedianAbsoluteDeviation", "WeightedAvg", "TopHits", "ScriptedMetric",
    "TermsAgg", "SignificantTerms", "Histogram", "DateHistogram", "RangeAgg", "DateRangeAgg",
    "NestedAgg", "FilterAgg", "FiltersAgg", "GlobalAgg", "run_aggs",
]


# --------------------------------------------------------------------------- value sources


class Agg:
    aggs: dict = {}


@dataclass(frozen=True)
class _Src:
    """Value source: field, script (SQL over row), value script over ``_value``, missing."""

    field: str | None = None
    script: Any = None
    value_script: Any = None
    missing: Any = None


def _value(df: DataFrame, ctx: Ctx, src: Any, name: str) -> tuple[DataFrame, str, bool]:
    """Add the value column ``__v_<name>``; returns (df, column, is_array)."""
    col = f"__v_{name}"
    if src.script is not None:
        c = as_script(src.script).column()
        arr = False
    else:
        c = ctx.col(src.field)
        arr = isinstance(ctx.dtype(src.field), T.ArrayType)
    if src.missing is not None:  # missing substitutes the field value, before any value script
        if arr:
            c = F.when(F.size(F.filter(c, lambda x: x.isNotNull())) > 0, c).otherwise(F.array(F.lit(src.missing)))
        else:
            c = F.coalesce(c, F.lit(src.missing))
    if src.value_script is not None:
        if arr:  # element by element: the rows stay as they are for the other metrics
            df = df.withColumn(col + "_raw", c)
            c = as_script(src.value_script).over_elements(col + "_raw")
        else:
            df = df.withColumn(col + "_raw", c)
            c = as_script(src.value_script).column({"_value": col + "_raw"})
    return df.withColumn(col, c), col, arr


class Metric(Agg):
    """Metrics give aggregate Columns; ``own_frame`` metrics compute a frame per key."""

    own_frame = False
    needs_scalar = False  # requires one value per row (explode arrays first)

    def columns(self, name: str, v: str, arr: bool) -> list[Column]:
        raise NotImplementedError


def _arr_sum(c: Column) -> Column:
    return F.aggregate(F.filter(c, lambda x: x.isNotNull()), F.lit(0.0), lambda a, b: a + b.cast("double"))


def _arr_cnt(c: Column) -> Column:
    return F.size(F.filter(c, lambda x: x.isNotNull()))


@dataclass(frozen=True)
class Min(_Src, Metric):
    def columns(self, name, v, arr):
        c = F.col(v)
        return [F.min(F.array_min(c) if arr else c).alias(name)]


@dataclass(frozen=True)
class Max(_Src, Metric):
    def columns(self, name, v, arr):
        c = F.col(v)
        return [F.max(F.array_max(c) if arr else c).alias(name)]


@dataclass(frozen=True)
class Sum(_Src, Metric):
    """0 on an empty bucket (never null)."""

    def columns(self, name, v, arr):
        c = F.col(v)
        return [F.coalesce(F.sum(_arr_sum(c) if arr else c.cast("double")), F.lit(0.0)).alias(name)]


@dataclass(frozen=True)
class Avg(_Src, Metric):
    def columns(self, name, v, arr):
        c = F.col(v)
        if arr:
            return [(F.sum(_arr_sum(c)) / F.sum(_arr_cnt(c))).alias(name)]
        return [F.avg(c.cast("double")).alias(name)]


@dataclass(frozen=True)
class ValueCount(_Src, Metric):
    """Number of values (not rows): arrays count their non-null elements."""

    def columns(self, name, v, arr):
        c = F.col(v)
        return [F.coalesce(F.sum(_arr_cnt(c)) if arr else F.count(c), F.lit(0)).cast("bigint").alias(name)]


@dataclass(frozen=True)
class Cardinality(_Src, Metric):
    """Distinct values: HyperLogLog++ sketch (mergeable, bounded memory) by
    default; ``exact=True`` for an exact two-phase distinct count."""

    precision_threshold: int | None = None
    exact: bool = False
    needs_scalar = True

    def columns(self, name, v, arr):
        c = F.col(v)
        if self.exact:
            return [F.count_distinct(c).cast("bigint").alias(name)]
        rsd = 0.05 if self.precision_threshold is None else max(0.004, min(0.3, 1.04 / math.sqrt(max(self.precision_threshold, 16))))
        return [F.approx_count_distinct(c, rsd).cast("bigint").alias(name)]


@dataclass(frozen=True)
class Stats(_Src, Metric):
    def columns(self, name, v, arr):
        c = F.col(v)
        if arr:
            cnt, s = F.sum(_arr_cnt(c)), F.sum(_arr_sum(c))
            mn, mx = F.min(F.array_min(c)), F.max(F.array_max(c))
        else:
            cnt, s, mn, mx = F.count(c), F.sum(c.cast("double")), F.min(c), F.max(c)
        return [F.coalesce(cnt, F.lit(0)).cast("bigint").alias(f"{name}_count"), mn.cast("double").alias(f"{name}_min"),
                mx.cast("double").alias(f"{name}_max"), (s / cnt).alias(f"{name}_avg"),
                F.coalesce(s, F.lit(0.0)).alias(f"{name}_sum")]


@dataclass(frozen=True)
class ExtendedStats(_Src, Metric):
    """Stats + sum_of_squares, population variance and std deviation, and
    avg +/- sigma * std bounds (sigma 2 by default)."""

    sigma: float = 2.0
    needs_scalar = True

    def columns(self, name, v, arr):
        c = F.col(v).cast("double")
        base = Stats(self.field).columns(name, v, False)
        std = F.stddev_pop(c)
        avg = F.avg(c)
        return base + [
            F.sum(c * c).alias(f"{name}_sum_of_squares"),
            F.var_pop(c).alias(f"{name}_variance"),
            std.alias(f"{name}_std_deviation"),
            (avg + F.lit(self.sigma) * std).alias(f"{name}_std_upper"),
            (avg - F.lit(self.sigma) * std).alias(f"{name}_std_lower"),
        ]


def pct_name(p: float) -> str:
    s = ("%g" % p).replace(".", "_").replace("-", "m")
    return f"p{s}"


# Default percents of a percentiles aggregation.
DEFAULT_PERCENTS = (1.0, 5.0, 25.0, 50.0, 75.0, 95.0, 99.0)


@dataclass(frozen=True)
class Percentiles(_Src, Metric):
    """Percentiles from a mergeable quantile sketch (``percentile_approx``),
    bounded memory per bucket however hot.  ``accuracy`` trades memory for
    exactness (relative rank error 1/accuracy).  Columns ``<name>_p<percent>``."""

    percents: tuple = DEFAULT_PERCENTS
    accuracy: int = 10000
    needs_scalar = True

    def columns(self, name, v, arr):
        ps = [float(p) for p in self.percents]
        q = F.percentile_approx(F.col(v).cast("double"), [p / 100.0 for p in ps], self.accuracy)
        return [q.alias(f"__pq_{name}")]

    def finish(self, name: str) -> list[Column]:
        return [F.element_at(F.col(f"__pq_{name}"), i + 1).alias(f"{name}_{pct_name(float(p))}") for i, p in enumerate(self.percents)]


@dataclass(frozen=True)
class MedianAbsoluteDeviation(_Src, Metric):
    """median(|x - median(x)|): two sketch passes, the per-bucket median joined back."""

    accuracy: int = 10000
    own_frame = True
    needs_scalar = True

    def frame(self, name, df, keys, v):
        med_of = F.percentile_approx(F.col(v).cast("double"), 0.5, self.accuracy)
        if keys:
            med = df.groupBy(*keys).agg(med_of.alias("__med"))
            med = med.select(*[F.col(k).alias(f"__mk{i}") for i, k in enumerate(keys)], "__med")
            j = df.join(med, [df[k].eqNullSafe(med[f"__mk{i}"]) for i, k in enumerate(keys)], "left").select(*keys, v, "__med")
        else:
            j = df.select(v, df.select(med_of).scalar().alias("__med"))
        return j.groupBy(*keys).agg(F.percentile_approx(F.abs(F.col(v) - F.col("__med")), 0.5, self.accuracy).alias(name))


@dataclass(frozen=True)
class WeightedAvg(Metric):
    """sum(value * weight) / sum(weight) over rows where both are present."""

    value: _Src = None
    weight: _Src = None
    own_frame = False

    def prepare(self, df, ctx, name):
        df, vc, _ = _value(df, ctx, self.value, name + "_val")
        df, wc, _ = _value(df, ctx, self.weight, name + "_w")
        return df, vc, wc

    def columns2(self, name, vc, wc):
        v, w = F.col(vc).cast("double"), F.col(wc).cast("double")
        both = v.isNotNull() & w.isNotNull()
        return [(F.sum(F.when(both, v * w)) / F.sum(F.when(both, w))).alias(name)]


@dataclass(frozen=True)
class TopHits(Agg):
    """Top documents per bucket: ``row_number`` over the bucket keys ordered by
    ``sort`` (default _score desc, id asc), rows ``from+1 .. from+size``.
    The window group limit runs partially before the shuffle, so a hot bucket
    only ships its own top rows.

    ``source``: top-level columns, ``source_includes`` / ``source_excludes``: dotted
    paths with wildcards; ``fields`` and ``docvalue_fields``: names or (name, format),
    as in ``Search``; ``max_score`` adds ``_max_score``, the best score of the bucket."""

    size: int = 3
    from_: int = 0
    sort: tuple = ()
    source: tuple | None = None
    source_includes: tuple = ()
    source_excludes: tuple = ()
    fields: tuple = ()
    docvalue_fields: tuple = ()
    max_score: bool = False


@dataclass(frozen=True)
class ScriptedMetric(Agg):
    """init/map/combine/reduce with Python callables.

    ``map(state, pdf) -> state`` folds a pandas batch of one bucket into the
    partition-local state (``init()`` gives a fresh one), ``combine(state)``
    turns it into a small picklable value; ``reduce(values)`` makes the result.

    Rows are sorted by bucket inside their partition (spilling to disk), so a
    task holds one state at a time, however many buckets there are.

    ``merge(values) -> value`` joins values of ``combine`` into one of the same
    kind.  With it, a bucket's values are merged in levels of at most ``fan_in``
    by partition number, and ``reduce`` gets the one or few that are left.
    Without it, ``reduce`` needs all values of a bucket, one per partition, in one
    call, as the script asks for them.
    """

    init: Callable = None
    map: Callable = None
    combine: Callable = None
    reduce: Callable = None
    fields: tuple = ()
    result_type: str = "double"
    merge: Callable = None
    fan_in: int = 64


# --------------------------------------------------------------------------- buckets


class Bucket(Agg):
    def bucketize(self, df: DataFrame, ctx: Ctx, name: str, keys: list[str], env: "_Env") -> tuple[DataFrame, list[str]]:
        raise NotImplementedError

    def finalize(self, res: DataFrame, name: str, keys: list[str], env: "_Env") -> DataFrame:
        """Buckets under their public key names, cut, filled and ordered."""
        return res


def _key_value(ctx: Ctx, fieldname: str | None, script: Any) -> tuple[Column, bool]:
    if script is not None:
        return as_script(script).column(), False
    return ctx.col(fieldname), isinstance(ctx.dtype(fieldname), T.ArrayType)


def _order_cols(order: Any, name: str, default=(("_count", "desc"), ("_key", "asc"))) -> list[Column]:
    items = order or default
    if isinstance(items, tuple) and len(items) == 2 and isinstance(items[0], str):
        items = (items,)
    out = []
    has_key = False
    for k, d in items:
        col = {"_count": "doc_count", "_key": name}.get(k, k)
        has_key |= col == name
        c = F.col(col)
        out.append(c.desc_nulls_last() if d.lower() == "desc" else c.asc_nulls_last())
    if not has_key:
        out.append(F.col(name).asc_nulls_last())
    return out


def _top_k(res: DataFrame, keys: list[str], order: list[Column], size: int | None) -> DataFrame:
    if size is None:
        return res.orderBy(*([F.col(k) for k in keys] + order))
    if not keys:
        return res.orderBy(*order).limit(size)
    w = Window.partitionBy(*keys).orderBy(*order)
    return res.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= size).drop("__rn")


@dataclass(frozen=True)
class TermsAgg(Bucket):
    """Bucket per distinct value (each document once per distinct value of a
    multi-valued field).  size 10 by default, order by count desc then key asc,
    ``min_doc_count`` 1, ``missing`` bucket, include/exclude by values, regex,
    or hash partition ``(i, n)``."""

    field: str | None = None
    script: Any = None
    size: int | None = 10
    min_doc_count: int = 1
    missing: Any = None
    order: Any = None
    include: Any = None
    exclude: Any = None
    show_other: bool = False
    aggs: dict = dc_field(default_factory=dict)

    def _filters(self, k: Column) -> Column:
        e = F.lit(True)
        inc, exc = self.include, self.exclude
        if inc is not None:
            if isinstance(inc, str):
                e = e & k.cast("string").rlike("^(?:" + inc + ")$")
            elif isinstance(inc, dict) and "partition" in inc:
                h = F.conv(F.substring(F.md5(k.cast("string").cast("binary")), 1, 8), 16, 10).cast("long")
                e = e & (h % F.lit(int(inc["num_partitions"])) == F.lit(int(inc["partition"])))
            else:
                e = e & k.isin(list(inc))
        if exc is not None:
            if isinstance(exc, str):
                e = e & ~k.cast("string").rlike("^(?:" + exc + ")$")
            else:
                e = e & ~k.isin(list(exc))
        return e

    def bucketize(self, df, ctx, name, keys, env):
        k, arr = _key_value(ctx, self.field, self.script)
        if arr:
            df = df.withColumn(name, F.explode_outer(F.array_distinct(k)))
        else:
            df = df.withColumn(name, k)
        if self.missing is not None:
            df = df.withColumn(name, F.coalesce(F.col(name), F.lit(self.missing)))
        else:
            df = df.filter(F.col(name).isNotNull())
        if self.include is not None or self.exclude is not None:
            df = df.filter(self._filters(F.col(name)))
        return df, [name]

    def _all_terms(self, name: str, env: "_Env") -> DataFrame:
        """Distinct terms of the whole collection (for min_doc_count = 0)."""
        bctx = env.ctx_for(env.base)
        k, arr = _key_value(bctx, self.field, self.script)
        t = env.base.select((F.explode(F.array_distinct(k)) if arr else k).alias(name))
        if self.missing is not None:
            t = t.select(F.coalesce(F.col(name), F.lit(self.missing)).alias(name))
        t = t.filter(F.col(name).isNotNull())
        if self.include is not None or self.exclude is not None:
            t = t.filter(self._filters(F.col(name)))
        return t.distinct()

    def finalize(self, res, name, keys, env):
        if self.min_doc_count > 1:
            res = res.filter(F.col("doc_count") >= self.min_doc_count)
        elif self.min_doc_count == 0:
            if keys:
                raise ValueError("min_doc_count=0 is supported for top-level terms only")
            metric_cols = [c for c in res.columns if c not in (name, "doc_count")]
            res = self._all_terms(name, env).join(res, name, "left").select(
                name, F.coalesce(F.col("doc_count"), F.lit(0)).cast("bigint").alias("doc_count"), *metric_cols)
        order = _order_cols(self.order, name)
        if self.show_other:  # the total of each parent, before the cut, travels with its buckets
            res = res.withColumn("__tot", F.sum("doc_count").over(Window.partitionBy(*keys))) if keys else \
                res.withColumn("__tot", res.select(F.sum("doc_count")).scalar())
        out = _top_k(res, keys, order, self.size)
        if self.show_other:
            shown = F.sum("doc_count").over(Window.partitionBy(*keys))  # at most ``size`` rows of a parent
            out = out.withColumn("sum_other_doc_count", (F.col("__tot") - shown).cast("bigint")).drop("__tot")
            out = out.orderBy(*([F.col(k) for k in keys] + order))
        return out


@dataclass(frozen=True)
class SignificantTerms(TermsAgg):
    """Terms unusually frequent in the foreground (the query's matches) against
    the background (the whole collection, or ``background_filter``).  Score:
    JLH = (fg% - bg%) * (fg% / bg%), kept when fg% > bg%; ``min_doc_count`` 3;
    ordered by score desc then term unless ``order`` says otherwise.  Value
    source, include/exclude, missing and sub-aggregations are those of terms."""

    min_doc_count: int = 3
    background_filter: Query | None = None

    def finalize(self, res, name, keys, env):
        raise NotImplementedError  # needs the rows: see _significant


MAX_FILL = 1 << 22  # empty buckets that a histogram fills at most


@dataclass(frozen=True)
class Histogram(Bucket):
    """key = floor((x - offset) / interval) * interval + offset.  With
    ``min_doc_count=0`` gaps between the first and last bucket (widened by
    ``extended_bounds``) are filled; ``hard_bounds`` drop keys outside;
    ``max_buckets`` fails a request that would fill more per parent.

    Rows are grouped, joined and filled by the whole-number bucket index; the
    key is computed from it at the end.  Values without one are left out: null,
    NaN, infinite, or so far off that a double cannot count the intervals.  More
    than ``MAX_FILL`` buckets are never filled, they fail the request."""

    field: str | None = None
    interval: float = 1.0
    offset: float = 0.0
    min_doc_count: int = 0
    extended_bounds: tuple | None = None
    hard_bounds: tuple | None = None
    missing: Any = None
    order: Any = None
    script: Any = None
    max_buckets: int | None = None
    aggs: dict = dc_field(default_factory=dict)

    def key_of(self, x: Column) -> Column:
        index = (x.cast("double") - F.lit(float(self.offset))) / F.lit(float(self.interval))
        return F.when(F.abs(index) < F.lit(float(1 << 53)), F.floor(index).cast("long"))

    def key_out(self, index: Column) -> Column:
        return index * F.lit(float(self.interval)) + F.lit(float(self.offset))

    def _index(self, bound: Any, up: bool = False) -> int | None:
        x = None if bound is None else (float(bound) - self.offset) / self.interval
        return None if x is None else (math.ceil(x) if up else math.floor(x))

    def bucketize(self, df, ctx, name, keys, env):
        k, arr = _key_value(ctx, self.field, self.script)
        if self.missing is not None:
            k = F.coalesce(k, F.lit(self.missing)) if not arr else k
        if arr:
            df = df.withColumn(name, F.explode(F.array_distinct(F.transform(k, self.key_of))))
        else:
            df = df.withColumn(name, self.key_of(k))
        df = df.filter(F.col(name).isNotNull())
        if self.hard_bounds is not None:
            lo, hi = self.hard_bounds
            if lo is not None:
                df = df.filter(self.key_out(F.col(name)) >= F.lit(float(lo)))
            if hi is not None:
                df = df.filter(self.key_out(F.col(name)) <= F.lit(float(hi)))
        return df, [name]

    def _fill(self, res: DataFrame, name: str, keys: list[str], step: int, bounds_ext: tuple | None) -> DataFrame:
        """Adds the empty buckets between the first and last whole-number key, ``step`` apart."""
        lo, hi = F.min(name), F.max(name)
        rng = res.groupBy(*keys).agg(lo.alias("__lo"), hi.alias("__hi")) if keys else res.agg(lo.alias("__lo"), hi.alias("__hi"))
        if bounds_ext is not None:
            elo, ehi = bounds_ext
            if elo is not None:
                rng = rng.withColumn("__lo", F.least(F.coalesce("__lo", F.lit(elo)), F.lit(elo)))
            if ehi is not None:
                rng = rng.withColumn("__hi", F.greatest(F.coalesce("__hi", F.lit(ehi)), F.lit(ehi)))
        most = MAX_FILL if self.max_buckets is None else self.max_buckets
        n = F.floor((F.col("__hi") - F.col("__lo")) / F.lit(step)) + 1
        error = F.raise_error(F.lit(f"too many buckets (> {most})")).cast("long")
        rng = rng.withColumn("__hi", F.when(n > most, error).otherwise(F.col("__hi")))
        grid = rng.filter(F.col("__lo").isNotNull()).select(
            *keys, F.explode(F.sequence(F.col("__lo"), F.col("__hi"), F.lit(step).cast("long"))).alias(name))
        metric_cols = [c for c in res.columns if c not in keys and c != name]
        out = grid.join(res, keys + [name], "left")
        return out.select(*keys, name, *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) if c == "doc_count" else F.col(c) for c in metric_cols])

    def finalize(self, res, name, keys, env):
        if self.min_doc_count == 0:
            ext = None
            if self.extended_bounds is not None:
                lo, hi = (self._index(b) for b in self.extended_bounds)
                if self.hard_bounds is not None:  # extended bounds never reach past the hard bounds
                    hard_lo, hard_hi = self._index(self.hard_bounds[0], up=True), self._index(self.hard_bounds[1])
                    lo = max(lo, hard_lo) if None not in (lo, hard_lo) else lo
                    hi = min(hi, hard_hi) if None not in (hi, hard_hi) else hi
                ext = (lo, hi)
            res = self._fill(res, name, keys, 1, ext)
        elif self.min_doc_count > 1:
            res = res.filter(F.col("doc_count") >= self.min_doc_count)
        order = _order_cols(self.order, name, default=(("_key", "asc"),))
        return res.orderBy(*([F.col(k) for k in keys] + order))


# Calendar units and fixed-interval unit lengths in milliseconds.
CALENDAR_UNITS = {"minute": "MINUTE", "1m": "MINUTE", "hour": "HOUR", "1h": "HOUR", "day": "DAY", "1d": "DAY",
                  "week": "WEEK", "1w": "WEEK", "month": "MONTH", "1M": "MONTH", "quarter": "QUARTER", "1q": "QUARTER",
                  "year": "YEAR", "1y": "YEAR"}
FIXED_UNITS_MS = {"ms": 1, "s": 1000, "m": 60_000, "h": 3_600_000, "d": 86_400_000}


def fixed_interval_ms(spec: str) -> int:
    import re

    m = re.fullmatch(r"(\d+)(ms|s|m|h|d)", spec)
    if not m:
        raise ValueError(f"bad fixed interval {spec}")
    return int(m.group(1)) * FIXED_UNITS_MS[m.group(2)]


@dataclass(frozen=True)
class DateHistogram(Bucket):
    """``calendar_interval`` (minute .. year, UTC) or ``fixed_interval`` (e.g.
    ``90m``, ``1d``).  Key column is epoch milliseconds of the bucket start;
    ``<name>_as_string`` the ISO form.  ``min_doc_count=0`` fills gaps."""

    field: str | None = None
    calendar_interval: str | None = None
    fixed_interval: str | None = None
    offset_ms: int = 0
    min_doc_count: int = 1
    extended_bounds: tuple | None = None
    hard_bounds: tuple | None = None
    missing: Any = None
    order: Any = None
    script: Any = None
    max_buckets: int | None = None
    aggs: dict = dc_field(default_factory=dict)

    def key_ms(self, ts: Column) -> Column:
        t = ts.cast("timestamp")
        ms = F.unix_millis(t) - F.lit(self.offset_ms)
        if self.calendar_interval:
            unit = CALENDAR_UNITS[self.calendar_interval]
            return F.unix_millis(F.date_trunc(unit, F.timestamp_millis(ms))) + F.lit(self.offset_ms)
        step = fixed_interval_ms(self.fixed_interval)
        return F.floor(ms / F.lit(step)).cast("long") * F.lit(step) + F.lit(self.offset_ms)

    def bucketize(self, df, ctx, name, keys, env):
        k, arr = _key_value(ctx, self.field, self.script)
        if arr:
            df = df.withColumn(name, F.explode(F.array_distinct(F.transform(F.filter(k, lambda x: x.isNotNull()), self.key_ms))))
        else:
            if self.missing is not None:
                from docsift.functions.dates import parse_date_literal
                k = F.coalesce(k.cast("timestamp"), parse_date_literal(self.missing))
            df = df.filter(k.isNotNull()).withColumn(name, self.key_ms(k))
        if self.hard_bounds is not None:  # buckets starting outside the bounds are dropped
            from docsift.functions.dates import date_literal_ms
            lo, hi = self.hard_bounds
            if lo is not None:
                df = df.filter(F.col(name) >= F.lit(date_literal_ms(lo)))
            if hi is not None:
                df = df.filter(F.col(name) <= F.lit(date_literal_ms(hi)))
        return df, [name]

    def _ext_keys(self) -> tuple:
        """Bucket keys (epoch ms) of the extended bounds, as Columns or None."""
        from docsift.functions.dates import date_literal_ms
        if self.extended_bounds is None:
            return None, None
        return tuple(None if b is None else self.key_ms(F.timestamp_millis(F.lit(date_literal_ms(b)))) for b in self.extended_bounds)

    def finalize(self, res, name, keys, env):
        if self.min_doc_count == 0:
            elo, ehi = self._ext_keys()
            if self.calendar_interval:
                unit = CALENDAR_UNITS[self.calendar_interval]
                step_expr = {"MINUTE": "INTERVAL 1 MINUTE", "HOUR": "INTERVAL 1 HOUR", "DAY": "INTERVAL 1 DAY",
                             "WEEK": "INTERVAL 7 DAY", "MONTH": "INTERVAL 1 MONTH", "QUARTER": "INTERVAL 3 MONTH",
                             "YEAR": "INTERVAL 1 YEAR"}[unit]
                rng = res.groupBy(*keys).agg(F.min(name).alias("__lo"), F.max(name).alias("__hi")) if keys else res.agg(F.min(name).alias("__lo"), F.max(name).alias("__hi"))
                if elo is not None:
                    rng = rng.withColumn("__lo", F.least(F.coalesce("__lo", elo), elo))
                if ehi is not None:
                    rng = rng.withColumn("__hi", F.greatest(F.coalesce("__hi", ehi), ehi))
                if self.hard_bounds is not None:  # extended bounds never reach past the hard bounds
                    from docsift.functions.dates import date_literal_ms
                    hlo, hhi = self.hard_bounds
                    if hlo is not None:
                        rng = rng.withColumn("__lo", F.greatest("__lo", self.key_ms(F.timestamp_millis(F.lit(date_literal_ms(hlo))))))
                        rng = rng.withColumn("__lo", F.when(F.col("__lo") < F.lit(date_literal_ms(hlo)),
                                                            F.unix_millis(F.timestamp_millis("__lo") + F.expr(step_expr))).otherwise(F.col("__lo")))
                    if hhi is not None:
                        rng = rng.withColumn("__hi", F.least("__hi", self.key_ms(F.timestamp_millis(F.lit(date_literal_ms(hhi))))))
                seq = F.sequence(F.timestamp_millis("__lo"), F.timestamp_millis("__hi"), F.expr(step_expr))
                guard = seq if self.max_buckets is None else F.when(F.size(seq) <= self.max_buckets, seq).otherwise(
                    F.raise_error(F.lit(f"too many buckets (> {self.max_buckets})")).cast("array<timestamp>"))
                grid = rng.filter(F.col("__lo").isNotNull()).select(*keys, F.explode(guard).alias("__t")).select(*keys, F.unix_millis("__t").alias(name))
                metric_cols = [c for c in res.columns if c not in keys and c != name]
                res = grid.join(res, keys + [name], "left").select(
                    *keys, name, *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) if c == "doc_count" else F.col(c) for c in metric_cols])
            else:
                from docsift.functions.dates import date_literal_ms
                step = fixed_interval_ms(self.fixed_interval)
                ext = None
                if self.extended_bounds is not None:
                    ext = tuple(None if b is None else (date_literal_ms(b) - self.offset_ms) // step * step + self.offset_ms
                                for b in self.extended_bounds)
                res = Histogram(max_buckets=self.max_buckets)._fill(res, name, keys, step, ext)
        elif self.min_doc_count > 1:
            res = res.filter(F.col("doc_count") >= self.min_doc_count)
        res = res.withColumn(f"{name}_as_string", F.date_format(F.timestamp_millis(F.col(name)), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        order = _order_cols(self.order, name, default=(("_key", "asc"),))
        return res.orderBy(*([F.col(k) for k in keys] + order))


def _fmt_num(v: Any) -> str:
    return "*" if v is None else ("%s" % float(v))


@dataclass(frozen=True)
class RangeAgg(Bucket):
    """Possibly overlapping ranges ``[from, to)``; open ends allowed.  Ranges are
    given as (from, to) or (from, to, key); empty buckets are kept, in the
    given order.  Keys default to ``from-to`` with ``*`` for open ends."""

    field: str | None = None
    ranges: tuple = ()
    script: Any = None
    aggs: dict = dc_field(default_factory=dict)

    def _lit_bound(self, v):
        return F.lit(v)

    def _norm(self):
        out = []
        for i, r in enumerate(self.ranges):
            if isinstance(r, dict):
                fr, to, key = r.get("from"), r.get("to"), r.get("key")
            else:
                fr, to = r[0], r[1]
                key = r[2] if len(r) > 2 else None
            out.append((i, fr, to, key or f"{self._fmt(fr)}-{self._fmt(to)}"))
        return out

    def _fmt(self, v):
        return _fmt_num(v)

    def _cmp_value(self, k: Column) -> Column:
        return k.cast("double")

    def bucketize(self, df, ctx, name, keys, env):
        k, arr = _key_value(ctx, self.field, self.script)
        specs = []
        for i, fr, to, key in self._norm():
            specs.append(F.struct(F.lit(key).alias("k"), F.lit(i).alias("i"),
                                  (F.lit(None) if fr is None else self._lit_bound(fr)).alias("f"),
                                  (F.lit(None) if to is None else self._lit_bound(to)).alias("t")))
        arr_specs = F.array(*specs)

        def inside(x: Column, r: Column) -> Column:
            v = self._cmp_value(x)
            return F.coalesce((r["f"].isNull() | (v >= r["f"])) & (r["t"].isNull() | (v < r["t"])) & v.isNotNull() & ~F.isnan(v), F.lit(False))

        if arr:
            hit = F.filter(arr_specs, lambda r: F.exists(k, lambda x: inside(x, r)))
        else:
            hit = F.filter(arr_specs, lambda r: inside(k, r))
        df = df.withColumn("__r", F.explode(hit)).withColumn(name, F.col("__r.k")).drop("__r")
        return df, [name]

    def finalize(self, res, name, keys, env):
        spark = res.sparkSession
        rows = [(i, key, None if fr is None else float(self._num(fr)), None if to is None else float(self._num(to))) for i, fr, to, key in self._norm()]
        lits = F.array(*[F.struct(F.lit(i).alias("__i"), F.lit(k).alias(name), F.lit(a).cast("double").alias(f"{name}_from"),
                                  F.lit(b).cast("double").alias(f"{name}_to")) for i, k, a, b in rows])
        # the literal range list is fixed by the request: generate it per parent bucket
        parents = res.select(*keys).distinct() if keys else spark.range(1)
        grid = parents.select(*keys, F.inline(lits))
        metric_cols = [c for c in res.columns if c not in keys and c != name]
        out = grid.join(res, keys + [name], "left")
        out = out.select(*keys, name, f"{name}_from", f"{name}_to", "__i",
                         *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) if c == "doc_count" else F.col(c) for c in metric_cols])
        return out.orderBy(*([F.col(k) for k in keys] + [F.col("__i")])).drop("__i")

    def _num(self, v):
        return v


@dataclass(frozen=True)
class DateRangeAgg(RangeAgg):
    """Date ranges; bounds are date strings (flexible format) or epoch ms."""

    def _lit_bound(self, v):
        from docsift.functions.dates import parse_date_literal
        return F.unix_millis(parse_date_literal(v))

    def _cmp_value(self, k):
        return F.unix_millis(k.cast("timestamp")).cast("double")

    def _num(self, v):
        from docsift.functions.dates import date_literal_ms
        return date_literal_ms(v)

    def _fmt(self, v):
        return "*" if v is None else str(v)


@dataclass(frozen=True)
class NestedAgg(Bucket):
    """Aggregate over the elements of an array-of-structs; doc_count counts elements."""

    path: str = None
    aggs: dict = dc_field(default_factory=dict)

    def bucketize(self, df, ctx, name, keys, env):
        return df.withColumn(self.path, F.explode(F.col(self.path))), []


@dataclass(frozen=True)
class FilterAgg(Bucket):
    """One bucket of the rows matching ``filter``."""

    filter: Query = None
    aggs: dict = dc_field(default_factory=dict)

    def bucketize(self, df, ctx, name, keys, env):
        return df.filter(self.filter.predicate(ctx)), []


@dataclass(frozen=True)
class FiltersAgg(Bucket):
    """Named, possibly overlapping filters; ``other_bucket_key`` collects rows
    matching none.  Empty buckets are kept."""

    filters: dict = dc_field(default_factory=dict)
    other_bucket_key: str | None = None
    aggs: dict = dc_field(default_factory=dict)

    def _names(self):
        names = list(self.filters)
        if self.other_bucket_key:
            names.append(self.other_bucket_key)
        return names

    def bucketize(self, df, ctx, name, keys, env):
        preds = [(n, q.predicate(ctx)) for n, q in self.filters.items()]
        if self.other_bucket_key:
            none = F.lit(True)
            for _, p in preds:
                none = none & ~p
            preds.append((self.other_bucket_key, none))
        arr = F.array(*[F.struct(F.lit(n).alias("k"), p.alias("m")) for n, p in preds])
        df = df.withColumn(name, F.explode(F.transform(F.filter(arr, lambda x: x["m"]), lambda x: x["k"])))
        return df, [name]

    def finalize(self, res, name, keys, env):
        spark = res.sparkSession
        lits = F.array(*[F.struct(F.lit(i).alias("__i"), F.lit(n).alias(name)) for i, n in enumerate(self._names())])
        parents = res.select(*keys).distinct() if keys else spark.range(1)
        grid = parents.select(*keys, F.inline(lits))
        metric_cols = [c for c in res.columns if c not in keys and c != name]
        out = grid.join(res, keys + [name], "left").select(
            *keys, name, "__i", *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) if c == "doc_count" else F.col(c) for c in metric_cols])
        return out.orderBy(*([F.col(k) for k in keys] + [F.col("__i")])).drop("__i")


@dataclass(frozen=True)
class GlobalAgg(Bucket):
    """All documents of the collection, ignoring the query and filters."""

    aggs: dict = dc_field(default_factory=dict)

    def bucketize(self, df, ctx, name, keys, env):
        if keys:
            raise ValueError("global must be a top-level aggregation")
        return env.base, []


# --------------------------------------------------------------------------- planner


@dataclass
class _Env:
    base: DataFrame            # unfiltered collection (for global / significance)
    ctx_for: Callable[[DataFrame], Ctx]
    match: Column | None = None  # foreground predicate over ``base``
    id_col: str | None = None


def _metric_columns(df: DataFrame, ctx: Ctx, metrics: dict[str, Agg]) -> tuple[DataFrame, list[Column], list[Callable], list]:
    cols, finishers, own = [], [], []
    for name, m in metrics.items():
        if isinstance(m, WeightedAvg):
            df, vc, wc = m.prepare(df, ctx, name)
            cols += m.columns2(name, vc, wc)
            continue
        if isinstance(m, (TopHits, ScriptedMetric)):
            own.append((name, m, None))
            continue
        df, v, arr = _value(df, ctx, m, name)
        if arr and (m.needs_scalar or m.own_frame):
            own.append((name, m, v))
            continue
        if m.own_frame:
            own.append((name, m, v))
            continue
        cols += m.columns(name, v, arr)
        if isinstance(m, Percentiles):
            finishers.append(lambda d, m=m, name=name: d.select("*", *m.finish(name)).drop(f"__pq_{name}"))
    return df, cols, finishers, own


def _own_frame(name: str, m: Agg, df: DataFrame, keys: list[str], v: str | None, env: _Env, ctx: Ctx) -> DataFrame:
    if isinstance(m, TopHits):
        return None  # handled as a separate result
    if isinstance(m, ScriptedMetric):
        return _scripted(name, m, df, keys)
    # exploded (array) value or own-frame metric
    if isinstance(df.schema[v].dataType, T.ArrayType):
        df = df.withColumn(v, F.explode(F.col(v)))
    if m.own_frame:
        return m.frame(name, df, keys, v)
    cols = m.columns(name, v, False)
    out = df.groupBy(*keys).agg(*cols)
    if isinstance(m, Percentiles):
        out = out.select("*", *m.finish(name)).drop(f"__pq_{name}")
    return out


def _plain(key) -> tuple:
    """A bucket key that equals itself (NaN does not)."""
    import pandas as pd

    return tuple(None if pd.isna(x) else x for x in (key if isinstance(key, tuple) else (key,)))


def _states(m: ScriptedMetric, kdf: DataFrame, kn: list[str], schema: str) -> DataFrame:
    """(keys, __part, __state): the combined state of each bucket in each partition."""
    import pickle

    import pandas as pd

    fields, combine = list(m.fields), m.combine or (lambda s: s)

    def per_partition(it):
        from pyspark import TaskContext

        part, key, state, done = TaskContext.get().partitionId(), None, None, []
        out = lambda: pd.DataFrame(done, columns=[*kn, "__part", "__state"])
        for pdf in it:
            for k, g in pdf.groupby(kn, dropna=False, sort=False) if kn else [((), pdf)]:
                k = _plain(k)
                if k != key:
                    if key is not None:
                        done.append([*key, part, pickle.dumps(combine(state))])
                    key, state = k, m.init() if m.init else {}
                state = m.map(state, g[fields])
            if len(done) >= 1000:
                yield out()
                done = []
        if key is not None:
            done.append([*key, part, pickle.dumps(combine(state))])
        if done:  # an empty partition yields no frame at all
            yield out()

    if kn:
        kdf = kdf.sortWithinPartitions(*kn)
    return kdf.mapInPandas(per_partition, schema)


def _merged(m: ScriptedMetric, states: DataFrame, kn: list[str], schema: str, levels: int = 3) -> DataFrame:
    """``states`` merged in levels: those whose partition numbers differ in the last digit only, base ``fan_in``, then the next one."""
    import pickle

    import pandas as pd

    def join(pdf):
        values = [pickle.loads(b) for b in pdf.sort_values("__part")["__state"]]
        one = values[0] if len(values) == 1 else m.merge(values)
        return pdf.iloc[:1].assign(__state=[pickle.dumps(one)])[[*kn, "__part", "__state"]]

    for _ in range(levels):
        states = states.withColumn("__part", F.floor(F.col("__part") / F.lit(m.fan_in + 0.0)).cast("int")).withColumn("__of", F.col("__part"))
        states = states.groupBy(*kn, "__of").applyInPandas(lambda pdf: join(pdf), schema)
    return states


def _scripted(name: str, m: ScriptedMetric, df: DataFrame, keys: list[str]) -> DataFrame:
    import pickle

    import pandas as pd

    kdf = df.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], *m.fields)
    kn = [f"__k{i}" for i in range(len(keys))]
    kschema = "".join(f"{c} {kdf.schema[c].dataType.simpleString()}, " for c in kn)
    schema = kschema + "__part int, __state binary"
    states = _states(m, kdf, kn, schema)
    if m.merge:
        states = _merged(m, states, kn, schema)

    def reducer(pdf):
        vals = [pickle.loads(b) for b in pdf.sort_values("__part")["__state"]]
        row = {c: pdf[c].iloc[0] for c in kn}
        row[name] = m.reduce(vals) if m.reduce else vals
        return pd.DataFrame([row])

    if not kn:  # what is left: one state for each fan_in ** levels partitions
        red = states.withColumn("__all", F.lit(1)).groupBy("__all").applyInPandas(lambda p: reducer(p), f"{name} {m.result_type}")
    else:
        red = states.groupBy(*kn).applyInPandas(reducer, f"{kschema}{name} {m.result_type}")
    return red.select(*[F.col(f"__k{i}").alias(k) for i, k in enumerate(keys)], name)


def _top_hits(name: str, m: TopHits, df: DataFrame, keys: list[str], ctx: Ctx, id_col: str | None) -> DataFrame:
    from docsift.operators.sort import as_sort

    order = []
    for s in (m.sort or (("-_score",) if "_score" in df.columns else ())):
        order += as_sort(s).order_columns(ctx)
    if id_col:
        order.append(F.col(id_col).asc())
    lo, hi = m.from_ + 1, m.from_ + m.size
    cols: list = list(m.source) if m.source is not None else [c for c in df.columns if not c.startswith("__") and c not in keys]
    added = []
    if m.fields or m.docvalue_fields or m.source_includes or m.source_excludes:
        from docsift.plans.search import _docvalue, _formatted, _source_filter

        spec = lambda x: (x, None) if isinstance(x, str) else x
        added = [_formatted(df, *spec(x)).alias(f"fields_{spec(x)[0]}") for x in m.fields]
        added += [_docvalue(df, *spec(x)).alias(f"docvalue_{spec(x)[0]}") for x in m.docvalue_fields]
        if m.source_includes or m.source_excludes:
            kept = df.select(*[c for c in cols if c != "_score"])
            cols = [*_source_filter(kept.schema, m.source_includes, m.source_excludes), *(["_score"] if "_score" in cols else [])]
    best = []
    if m.max_score:
        score = F.max("_score") if "_score" in df.columns else F.max(F.lit(None).cast("double"))
        tops = df.groupBy(*[F.col(k).alias(f"__of{i}") for i, k in enumerate(keys)]).agg(score.alias("__best"))
        best = [F.col("__best").alias("_max_score")]
    if keys:  # per bucket: the window group limit runs partially before the shuffle
        w = Window.partitionBy(*keys).orderBy(*order)
        out = df.withColumn("_rank", F.row_number().over(w)).filter((F.col("_rank") >= lo) & (F.col("_rank") <= hi))
    else:  # whole result: distributed top-k first, then number only those rows (at most from + size)
        top = df.orderBy(*order).limit(hi)
        out = top.withColumn("_rank", F.row_number().over(Window.orderBy(*order))).filter(F.col("_rank") >= lo)
    if m.max_score:  # a row per bucket, joined to the few rows that are left
        out = out.join(tops, functools.reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"__of{i}")) for i, k in enumerate(keys)])) if keys else (
            out.withColumn("__best", tops.select("__best").scalar()))
    return out.select(*keys, "_rank", *[c for c in cols if not (isinstance(c, str) and c in keys)], *added, *best)


def _significant(res: DataFrame, m: SignificantTerms, name: str, keys: list[str], totals: DataFrame, env: _Env) -> DataFrame:
    """``res``: the terms' buckets in the foreground (the rows narrowed by the
    query and any parent buckets); ``totals``: the foreground's size, per parent.
    The background is one grouped count over the whole collection or
    ``background_filter``."""
    bctx = env.ctx_for(env.base)
    back = env.base.filter(m.background_filter.predicate(bctx)) if m.background_filter is not None else env.base
    back, _ = m.bucketize(back, bctx, "__term", [], env)
    counts = back.groupBy("__term").agg(F.count(F.lit(1)).cast("bigint").alias("bg_count"))
    everything = env.base.filter(m.background_filter.predicate(bctx)) if m.background_filter is not None else env.base
    size = everything.select(F.count(F.lit(1)).cast("double")).scalar()
    g = res.join(counts, res[name] == counts["__term"], "left").drop("__term")
    if keys:
        g = g.join(totals, keys)
        share = F.col("doc_count") / F.col("__fgt")
    else:
        share = F.col("doc_count") / totals.select("__fgt").scalar()
    g = g.withColumn("bg_count", F.coalesce("bg_count", F.lit(0)).cast("bigint"))
    back_share = F.col("bg_count") / size
    g = g.withColumn("score", F.when((F.col("bg_count") > 0) & (share > back_share), (share - back_share) * (share / back_share)).otherwise(F.lit(0.0)))
    others = [c for c in res.columns if c not in (*keys, name, "doc_count")]
    g = g.filter((F.col("doc_count") >= m.min_doc_count) & (F.col("score") > 0)).select(*keys, name, "doc_count", "bg_count", "score", *others)
    return _top_k(g, keys, _order_cols(m.order, name, default=(("score", "desc"), ("_key", "asc"))), m.size)


def _columns_of(df: DataFrame, ctx: Ctx, name: str, m: Agg) -> list[str]:
    """The result columns that metric ``m`` declares."""
    tdf, cols, fins, own = _metric_columns(df, ctx, {name: m})
    if own:
        return [name]
    one = tdf.agg(*cols)
    for f in fins:
        one = f(one)
    return one.columns


def run_aggs(df: DataFrame, aggs: dict[str, Agg], env: _Env, keys: list[str] | None = None,
             path: str = "", public: list[str] | None = None, key_out: dict | None = None) -> dict[str, DataFrame]:
    """Evaluate an aggregation tree; returns {path: DataFrame}.

    Rows carry bucket keys in internal columns (``keys``), so a bucket may have
    the name of a field; results carry them under the buckets' names
    (``public``), converted by ``key_out``.  A bucket that keeps only some of its
    terms is cut first: children and top hits read the rows of the kept ones.
    """
    keys, public, key_out = keys or [], public or [], key_out or {}
    out: dict[str, DataFrame] = {}
    ctx = env.ctx_for(df)
    metrics = {n: a for n, a in aggs.items() if not isinstance(a, Bucket)}
    if metrics and not keys:
        tdf, cols, fins, own = _metric_columns(df, ctx, metrics)
        one = tdf.agg(*cols) if cols else None
        if one is not None:
            for f in fins:
                one = f(one)
        for name, m in metrics.items():
            p = path + name
            if isinstance(m, TopHits):
                out[p] = _top_hits(name, m, df, [], ctx, env.id_col).withColumn("_total", df.select(F.count(F.lit(1))).scalar())
            elif any(o[0] == name for o in own):
                o = [o for o in own if o[0] == name][0]
                out[p] = _own_frame(name, m, tdf, [], o[2], env, ctx)
            else:
                out[p] = one.select(*_columns_of(df, ctx, name, m))
    for name, a in aggs.items():
        if not isinstance(a, Bucket):
            continue
        p = path + name
        kname = f"__k{len(keys)}_{name}"
        kdf, kcols = a.bucketize(df, ctx, kname, keys, env)
        all_keys = keys + kcols
        all_public = public + [name] * len(kcols)
        outs = {**key_out, **({name: a.key_out} if kcols and hasattr(a, "key_out") else {})}
        kctx = env.ctx_for(kdf)
        sub = a.aggs or {}
        sub_metrics = {n: s for n, s in sub.items() if not isinstance(s, Bucket)}
        mdf, cols, fins, own = _metric_columns(kdf, kctx, sub_metrics)
        grouped = mdf.groupBy(*all_keys).agg(F.count(F.lit(1)).cast("bigint").alias("doc_count"), *cols)
        for f in fins:
            grouped = f(grouped)
        for oname, m, v in own:
            if isinstance(m, TopHits):
                continue
            fr = _own_frame(oname, m, mdf, all_keys, v, env, kctx)
            if all_keys:
                grouped = grouped.join(fr, [grouped[k].eqNullSafe(fr[k]) for k in all_keys], "left").select(
                    grouped["*"], *[fr[c] for c in fr.columns if c not in all_keys])
            else:  # both sides are single global-aggregate rows
                grouped = grouped.withColumn("__one", F.lit(1)).join(fr.withColumn("__one", F.lit(1)), "__one").drop("__one")

        def shown(d: DataFrame) -> DataFrame:
            """Internal key columns under the buckets' names."""
            return d.select(*[F.col(k).alias(n) for k, n in zip(all_keys, all_public)], *[c for c in d.columns if c not in all_keys])

        def converted(d: DataFrame) -> DataFrame:
            return d.select(*[outs[c](F.col(c)).alias(c) if c in outs else F.col(f"`{c}`") for c in d.columns])

        res = shown(grouped)
        if isinstance(a, SignificantTerms):
            totals = df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, public)]).agg(F.count(F.lit(1)).cast("double").alias("__fgt"))
            res = _significant(res, a, name, public, totals, env)
        elif kcols:
            res = a.finalize(res, name, public, env)
        out[p] = converted(res)
        rows, rctx = kdf, kctx
        children = {n: s for n, s in sub.items() if isinstance(s, Bucket)}
        tops = [(n, m) for n, m, _ in own if isinstance(m, TopHits)]
        if isinstance(a, TermsAgg) and (children or tops):
            kept = res.select(*[F.col(n).alias(f"__p{i}") for i, n in enumerate(all_public)])
            rows = kdf.join(kept, [kdf[k] == kept[f"__p{i}"] for i, k in enumerate(all_keys)], "left_semi")
            rctx = env.ctx_for(rows)
        for oname, m in tops:
            th = _top_hits(oname, m, rows, all_keys, rctx, env.id_col)
            if all_keys:  # total hits of the bucket: its doc_count (one row per kept bucket)
                th = th.select(*[F.col(k).alias(n) for k, n in zip(all_keys, all_public)],
                               *[F.col(f"`{c}`") for c in th.columns if c not in all_keys and c not in all_public])
                th = converted(th.join(res.select(*all_public, F.col("doc_count").alias("_total")), all_public))
            else:
                th = th.withColumn("_total", kdf.select(F.count(F.lit(1))).scalar())
            out[p + ">" + oname] = th
        if children:
            out.update(run_aggs(rows, children, env, all_keys, p + ">", all_public, outs))
    return out
