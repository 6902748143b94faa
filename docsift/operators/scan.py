"""Segmented prefix scans that stay bounded per task however hot a key is.

``prefix_max(df, keys, seq, exprs)`` adds, for every row, the maximum of each
expression over the *earlier* rows (smaller ``seq``) with the same key.  Any
"last value before" query is a max over ``struct(seq, value)``.

A plain ``Window.partitionBy(keys).orderBy(seq)`` puts every row of a key into
one task; a key holding a third of the data would be one giant sort.  Here the
order column is cut into chunks of ``chunk`` consecutive values:

1. inside each (key, chunk) a window gives the in-chunk prefix -- at most
   ``chunk`` rows per window partition because ``seq`` is unique;
2. a grouped aggregate gives one summary row per (key, chunk); a window over
   those summaries (one row per chunk, not per row) gives the prefix of all
   earlier chunks;
3. the chunk prefix is joined back on (key, chunk) -- both sides are spread
   over many chunks, so a hot key is not a hot join key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_CHUNK = 1 << 20


def prefix_max(df: DataFrame, keys: list[str], seq: str, exprs: dict[str, Column], chunk: int = DEFAULT_CHUNK) -> DataFrame:
    ck = "__chunk"
    d = df.withColumn(ck, F.floor(F.col(seq) / F.lit(chunk)).cast("long"))
    vals = {f"__v_{n}": e for n, e in exprs.items()}
    d = d.withColumns(vals)
    w_in = Window.partitionBy(*keys, ck).orderBy(seq).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumns({f"__in_{n}": F.max(f"__v_{n}").over(w_in) for n in exprs})
    summ = d.groupBy(*keys, ck).agg(*[F.max(f"__v_{n}").alias(f"__c_{n}") for n in exprs])
    w_ch = Window.partitionBy(*keys).orderBy(ck).rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.select(*keys, ck, *[F.max(f"__c_{n}").over(w_ch).alias(f"__p_{n}") for n in exprs])
    d = d.join(summ, keys + [ck], "left")
    out = d.withColumns({n: _greatest(F.col(f"__in_{n}"), F.col(f"__p_{n}")) for n in exprs})
    drop = [ck] + [f"__v_{n}" for n in exprs] + [f"__in_{n}" for n in exprs] + [f"__p_{n}" for n in exprs]
    return out.drop(*drop)


def _greatest(a: Column, b: Column) -> Column:
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(F.greatest(a, b))
