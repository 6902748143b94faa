"""Parent/child relations inside one collection (a ``join`` struct column with
``name`` and ``parent``).

Children are aggregated per parent id first (partial + final aggregation, so a
parent with a huge number of children is combined map-side) and the result --
at most one row per parent -- is left-joined back.  No pairs are emitted.  Only
the score modes that the search asks for are computed.

``store_families`` writes the collection bucketed by family: a child under its
parent's id, a parent under its own.  A search over that table joins on the
family, so relations need no shuffle of either side.  A family has two levels;
where a document is both child and parent, use the plain layout.
"""

from __future__ import annotations

from dataclasses import dataclass

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.operators.query import Ctx, Query
from docsift.session import checkpoint_dir

__all__ = ["HasChild", "HasParent", "ParentId", "family_key", "score_agg", "store_families", "FAMILY"]

FAMILY = "_family"
BUCKET_ROWS = 1 << 19
MAX_BUCKETS = 100_000  # Spark's own limit (spark.sql.sources.bucketing.maxBuckets)


def store_families(df: DataFrame, id_col: str, table: str | None = None, buckets: int = 64, join_field: str = "join", path: str | None = None) -> DataFrame:
    """``df`` with the column ``_family``, written as a table bucketed and sorted by it, one file a bucket.

    ``buckets`` is the least number of buckets: larger collections take more, of
    ``BUCKET_ROWS`` rows on average, so that a bucket is sorted in memory when
    written and when joined.
    """
    spark = df.sparkSession
    buckets = min(max(buckets, -(-df.count() // BUCKET_ROWS)), MAX_BUCKETS)
    table = table or f"families_{uuid.uuid4().hex}"
    path = path or f"{checkpoint_dir(spark).rstrip('/')}/{table}"
    keyed = df.withColumn(FAMILY, F.coalesce(F.col(f"{join_field}.parent"), F.col(id_col)))
    keyed.repartition(buckets, FAMILY).write.mode("overwrite").option("path", path).bucketBy(buckets, FAMILY).sortBy(FAMILY).saveAsTable(table)
    return spark.table(table)


def _by_family(ctx: Ctx) -> bool:
    return FAMILY in ctx.df.columns and FAMILY in ctx.corpus.columns


def score_agg(mode: str, s: Column, child_id: Column) -> Column:
    """Combine child scores per parent: none, sum, avg, max, min, first, multiply."""
    m = (mode or "none").lower()
    if m == "none":
        return F.lit(0.0)
    if m == "sum":
        return F.sum(s)
    if m == "avg":
        return F.avg(s)
    if m == "max":
        return F.max(s)
    if m == "min":
        return F.min(s)
    if m == "first":
        return F.min_by(s, child_id)
    if m == "multiply":
        zero = F.count_if(s == 0) > 0
        neg = F.pmod(F.count_if(s < 0), F.lit(2)) == 1
        mag = F.exp(F.sum(F.log(F.abs(F.when(s != 0, s)))))
        return F.when(zero, F.lit(0.0)).otherwise(F.when(neg, -mag).otherwise(mag))
    raise ValueError(mode)


def _memo(ctx: Ctx, key, build):
    memo = ctx._root.__dict__.setdefault("_memo", {})
    if key not in memo:
        memo[key] = build()
    return memo[key]


@dataclass(frozen=True)
class HasChild(Query):
    """Parents with between ``min_children`` (at least 1) and ``max_children``
    matching children of ``type``.  ``score_mode`` none (score 0), sum, avg,
    max, min, first, multiply."""

    type: str
    query: Query
    min_children: int | None = None
    max_children: int | None = None
    score_mode: str = "none"
    join_field: str = "join"
    boost: float | None = None

    def _cols(self, ctx: Ctx) -> tuple[Column, Column | None]:
        """(count, score) of a row's matching children.  Nodes over the same child
        query share one child aggregate, of the modes that any of them asks for,
        and one join."""
        modes, cn = _memo(ctx, ("hc", self.type, self.join_field, id(self.query)), lambda: self._join(ctx))
        mode = (self.score_mode or "none").lower()
        if mode != "none":
            score_agg(mode, F.lit(0.0), F.lit(0))  # an unknown mode raises here
            modes.add(mode)
        parent = F.col(FAMILY) == F.col(ctx.id_col) if _by_family(ctx) else F.lit(True)  # by family, children meet the counts too
        return F.when(parent, F.col(cn)), F.when(parent, F.col(f"{cn}_{mode}")) if mode != "none" else None

    def _join(self, ctx: Ctx) -> tuple[set, str]:
        modes, cn = set(), ctx.fresh("hc_n")
        key = FAMILY if _by_family(ctx) else f"{self.join_field}.parent"

        def keyed() -> DataFrame:
            corpus = ctx.corpus
            cctx = Ctx(corpus, ctx.id_col)
            pred, score = self.query.predicate(cctx), self.query.score(cctx).cast("double")
            kids = corpus.filter((F.col(f"{self.join_field}.name") == F.lit(self.type)) & F.col(f"{self.join_field}.parent").isNotNull())
            kids = cctx.apply(kids).filter(pred).select(F.col(key).alias(f"__hc_p_{cn}"), score.alias("__s"), F.col(ctx.id_col).alias("__cid"))
            return kids.groupBy(f"__hc_p_{cn}").agg(F.count(F.lit(1)).alias(cn), *[score_agg(m, F.col("__s"), F.col("__cid")).alias(f"{cn}_{m}") for m in sorted(modes)])

        ctx.attach(keyed, FAMILY if _by_family(ctx) else ctx.id_col, f"__hc_p_{cn}")
        return modes, cn

    def predicate(self, ctx):
        cn, _ = self._cols(ctx)
        lo = max(1, self.min_children or 1)
        e = cn >= F.lit(lo)
        if self.max_children is not None:
            e = e & (cn <= F.lit(self.max_children))
        return F.coalesce(e, F.lit(False))

    def score(self, ctx):
        _, sn = self._cols(ctx)
        if sn is None:
            return F.lit(0.0)
        return F.coalesce(sn, F.lit(0.0)) * F.lit(self._b())


@dataclass(frozen=True)
class HasParent(Query):
    """Children whose parent (of ``parent_type``) matches; ``score=True`` takes
    the parent's score, else a constant 1."""

    parent_type: str
    query: Query
    score_: bool = False
    join_field: str = "join"
    boost: float | None = None

    def _cols(self, ctx: Ctx) -> tuple[str, str]:
        def build():
            corpus = ctx.corpus
            pctx = Ctx(corpus, ctx.id_col)
            pred, score = self.query.predicate(pctx), self.query.score(pctx).cast("double")
            par = pctx.apply(corpus.filter(F.col(f"{self.join_field}.name") == F.lit(self.parent_type))).filter(pred)
            mn, sn = ctx.fresh("hp_m"), ctx.fresh("hp_s")
            of = f"__hp_k_{mn}"
            if _by_family(ctx):  # a parent's family is its own id
                keyed = par.where(F.col(FAMILY) == F.col(ctx.id_col)).select(F.col(FAMILY).alias(of), F.lit(True).alias(mn), score.alias(sn))
                ctx.attach(keyed, FAMILY, of)
            else:
                ctx.attach(par.select(F.col(ctx.id_col).alias(of), F.lit(True).alias(mn), score.alias(sn)), f"{self.join_field}.parent", of, nulls=True)
            return mn, sn
        return _memo(ctx, ("hp", id(self)), build)

    def predicate(self, ctx):
        mn, _ = self._cols(ctx)
        return F.coalesce(F.col(mn) & F.col(f"{self.join_field}.parent").isNotNull(), F.lit(False))

    def score(self, ctx):
        _, sn = self._cols(ctx)
        return (F.coalesce(F.col(sn), F.lit(0.0)) if self.score_ else F.lit(1.0)) * F.lit(self._b())


@dataclass(frozen=True)
class ParentId(Query):
    """Children of ``type`` whose parent id is ``id``."""

    type: str
    id: str
    join_field: str = "join"
    boost: float | None = None

    def predicate(self, ctx):
        return F.coalesce((F.col(f"{self.join_field}.name") == F.lit(self.type)) & (F.col(f"{self.join_field}.parent") == F.lit(self.id)), F.lit(False))


def family_key(id_col: str, join_field: str = "join") -> str:
    """SQL expression bucketing a document with its family: a child under its
    parent id, a parent under its own id (so the parent counts itself)."""
    return f"coalesce(`{join_field}`.parent, `{id_col}`)"
