"""Function score, score functions and rescoring helpers (all Column expressions)."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.functions.scripts import as_script
from docsift.operators.query import Ctx, MatchAll, Query

__all__ = ["FunctionScore", "Weight", "FieldValueFactor", "ScriptScore", "RandomScore", "modifier"]


def modifier(name: str | None, x: Column) -> Column:
    """Field value modifiers.  Fixed values: none, log (base 10), log1p, log2p,
    ln, ln1p, ln2p, square, sqrt, reciprocal."""
    m = (name or "none").lower()
    if m == "none":
        return x
    if m == "log":
        return F.log10(x)
    if m == "log1p":
        return F.log10(x + F.lit(1.0))
    if m == "log2p":
        return F.log10(x + F.lit(2.0))
    if m == "ln":
        return F.log(x)
    if m == "ln1p":
        return F.log1p(x)
    if m == "ln2p":
        return F.log(x + F.lit(2.0))
    if m == "square":
        return x * x
    if m == "sqrt":
        return F.sqrt(x)
    if m == "reciprocal":
        return F.lit(1.0) / x
    raise ValueError(f"unknown modifier {name}")


class ScoreFunction:
    filter: Query | None = None
    weight: float | None = None

    def value(self, ctx: Ctx, qscore: Column) -> Column:
        raise NotImplementedError

    def applies(self, ctx: Ctx) -> Column:
        return F.lit(True) if self.filter is None else self.filter.predicate(ctx)

    def weighted(self, ctx: Ctx, qscore: Column) -> Column:
        v = self.value(ctx, qscore)
        return v if self.weight is None else v * F.lit(float(self.weight))


@dataclass(frozen=True)
class Weight(ScoreFunction):
    weight: float = 1.0
    filter: Query | None = None

    def value(self, ctx, qscore):
        return F.lit(1.0)


@dataclass(frozen=True)
class FieldValueFactor(ScoreFunction):
    field: str
    factor: float | None = None
    missing: float | None = None
    modifier: str | None = None
    filter: Query | None = None
    weight: float | None = None

    def value(self, ctx, qscore):
        t = ctx.dtype(self.field)
        c = ctx.col(self.field)
        if isinstance(t, T.ArrayType):
            c = F.element_at(c, 1)  # first value of a multi-valued field
        c = c.cast("double")
        if self.missing is not None:
            c = F.coalesce(c, F.lit(float(self.missing)))
        if self.factor is not None:
            c = c * F.lit(float(self.factor))
        return modifier(self.modifier, c)


@dataclass(frozen=True)
class ScriptScore(ScoreFunction):
    script: Any
    filter: Query | None = None
    weight: float | None = None

    def value(self, ctx, qscore):
        s = as_script(self.script)
        if isinstance(s.body(), str) and "_score" in s.body():
            name = ctx.derive_name(("qscore", id(self)), lambda: qscore, T.DoubleType())
            return s.column({"_score": name}).cast("double")
        return s.column().cast("double")


@dataclass(frozen=True)
class RandomScore(ScoreFunction):
    """Seeded, per-document stable score in [0, 1): md5 of seed and field.
    Independent of partitioning (unlike ``rand``)."""

    seed: int = 0
    field: str | None = None
    filter: Query | None = None
    weight: float | None = None

    def value(self, ctx, qscore):
        key = ctx.col(self.field or ctx.id_col)
        h = F.substring(F.md5(F.concat_ws(":", F.lit(str(int(self.seed))), key.cast("string")).cast("binary")), 1, 6)
        return F.conv(h, 16, 10).cast("double") / F.lit(float(1 << 24))


@dataclass(frozen=True)
class FunctionScore(Query):
    """score_mode: multiply (default), sum, avg (weight-weighted), first, max, min;
    boost_mode: multiply (default), replace, sum, avg, max, min.  With no
    function applying to a row the function score is 1.  ``min_score`` drops
    rows whose final score is lower."""

    query: Query | None = None
    functions: tuple = ()
    score_mode: str = "multiply"
    boost_mode: str = "multiply"
    min_score: float | None = None
    max_boost: float | None = None
    boost: float | None = None

    def __init__(self, query=None, functions=(), score_mode="multiply", boost_mode="multiply", min_score=None, max_boost=None, boost=None):
        for k, v in dict(query=query, functions=tuple(functions), score_mode=score_mode, boost_mode=boost_mode,
                         min_score=min_score, max_boost=max_boost, boost=boost).items():
            object.__setattr__(self, k, v)

    def _q(self) -> Query:
        return self.query or MatchAll()

    def _raw_score(self, ctx):
        q = self._q()
        qs = q.score(ctx)
        if not self.functions:
            return qs * F.lit(self._b())
        parts = [(f.applies(ctx), f.weighted(ctx, qs), f) for f in self.functions]
        applied = lambda a, v: F.when(a & v.isNotNull(), v)
        vals = [applied(a, v) for a, v, _ in parts]
        mode = self.score_mode.lower()
        if mode == "multiply":
            fs = F.lit(1.0)
            for v in vals:
                fs = fs * F.coalesce(v, F.lit(1.0))
        elif mode == "sum":
            fs = F.lit(0.0)
            for v in vals:
                fs = fs + F.coalesce(v, F.lit(0.0))
        elif mode == "avg":
            num, den = F.lit(0.0), F.lit(0.0)
            for (a, v, f), av in zip(parts, vals):
                w = F.lit(float(f.weight if f.weight is not None else 1.0))
                num = num + F.coalesce(av, F.lit(0.0))
                den = den + F.when(av.isNotNull(), w).otherwise(F.lit(0.0))
            fs = F.when(den > 0, num / den)
        elif mode == "first":
            fs = F.coalesce(*vals) if len(vals) > 1 else vals[0]
        elif mode == "max":
            fs = F.greatest(*vals) if len(vals) > 1 else vals[0]
        elif mode == "min":
            fs = F.least(*vals) if len(vals) > 1 else vals[0]
        else:
            raise ValueError(self.score_mode)
        any_applied = F.lit(False)
        for v in vals:
            any_applied = any_applied | v.isNotNull()
        fs = F.when(any_applied, fs).otherwise(F.lit(1.0))
        fs = F.coalesce(fs, F.lit(1.0))
        if self.max_boost is not None:
            fs = F.least(fs, F.lit(float(self.max_boost)))
        bm = self.boost_mode.lower()
        combined = {
            "multiply": lambda: qs * fs,
            "replace": lambda: fs,
            "sum": lambda: qs + fs,
            "avg": lambda: (qs + fs) / F.lit(2.0),
            "max": lambda: F.greatest(qs, fs),
            "min": lambda: F.least(qs, fs),
        }[bm]()
        return combined * F.lit(self._b())

    def predicate(self, ctx):
        p = self._q().predicate(ctx)
        if self.min_score is not None:
            p = p & F.coalesce(self._raw_score(ctx) >= F.lit(float(self.min_score)), F.lit(False))
        return p

    def score(self, ctx):
        return self._raw_score(ctx)
