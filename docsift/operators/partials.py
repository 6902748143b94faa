"""Mergeable partial aggregates of numeric fields, stored per key and period.

``build`` reads the rows once and writes one row per key and period: counts, sums,
extremes, a quantile sketch (KLL) and a distinct-count sketch (HyperLogLog) of each
field.  ``stats``, ``percentiles``, ``deviation`` and ``cardinality`` then merge the
rows of any keys and periods; the collection is not read again.  A period's rows
are bounded by the keys, a sketch's size by its parameter, so a query's cost does
not grow with the documents.

Counts, sums, means and extremes are exact, the variance up to rounding.  A
percentile's rank is off by about ``rank_error`` of the values at most, whatever
is merged.

Nulls and NaN are not counted; a key with no values has count 0 and null results.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.operators.aggs import DEFAULT_PERCENTS, pct_name
from docsift.session import checkpoint_dir

__all__ = ["Partials", "rank_error"]

SIZE = 1000  # of a quantile sketch
LG_CELLS = 12  # of a distinct-count sketch
_GRID = 1000  # quantiles that stand for the values in ``deviation``


def rank_error(size: int = SIZE) -> float:
    """Share of the values by which a percentile's rank may be off (the published error of KLL sketches, 99 % confidence)."""
    return 2.446 / size ** 0.9433


@dataclass(frozen=True)
class Partials:
    table: DataFrame  # keys, period, and per field the struct (n, sum, squares, spread, low, high, quantiles, distinct)
    keys: tuple
    path: str | None = None

    @staticmethod
    def build(df: DataFrame, keys: list[str], time: str, fields: list[str], unit: str = "day", path: str | None = None, size: int = SIZE) -> "Partials":
        """Write the partials of ``fields`` per ``keys`` and ``unit`` of the column ``time``."""
        path = path or f"{checkpoint_dir(df.sparkSession).rstrip('/')}/partials-{uuid.uuid4().hex}"
        _grouped(df, keys, time, fields, unit, size).write.mode("overwrite").parquet(path)
        return Partials.read(df.sparkSession, path, keys)

    @staticmethod
    def read(spark: SparkSession, path: str, keys: list[str]) -> "Partials":
        return Partials(spark.read.parquet(path), tuple(keys), path)

    def append(self, df: DataFrame, time: str, unit: str = "day", size: int = SIZE) -> "Partials":
        """Add rows that are not in the partials yet; a period may have several rows per key."""
        fields = [c for c in self.table.columns if c not in (*self.keys, "period")]
        _grouped(df, list(self.keys), time, fields, unit, size).write.mode("append").parquet(self.path)
        return Partials.read(df.sparkSession, self.path, list(self.keys))

    # ------------------------------------------------------------ queries
    def _rows(self, where: Column | None) -> DataFrame:
        return self.table if where is None else self.table.where(where)

    def stats(self, by: list[str], field: str, name: str | None = None, where: Column | None = None, sigma: float = 2.0) -> DataFrame:
        """The columns of ``Stats`` and ``ExtendedStats``, per ``by`` (keys or ``period``)."""
        name, p = name or field, lambda c: F.col(f"{field}.{c}")
        sums = self._rows(where).groupBy(*by).agg(
            F.sum(p("n")).alias("__n"), F.sum(p("sum")).alias("__s"), F.sum(p("squares")).alias("__q"), F.min(p("low")).alias("__lo"), F.max(p("high")).alias("__hi"),
            F.collect_list(F.struct(p("n").alias("n"), p("sum").alias("sum"), p("spread").alias("spread"))).alias("__parts"))
        # spreads about their own means, moved to the common one: no difference of large sums
        mean = F.col("__s") / F.col("__n")
        spread = F.aggregate("__parts", F.lit(0.0), lambda a, x: a + F.when(x["n"] > 0, x["spread"] + x["n"] * (x["sum"] / x["n"] - F.col("__mean")) * (
            x["sum"] / x["n"] - F.col("__mean"))).otherwise(F.lit(0.0)))
        out = sums.withColumn("__mean", F.when(F.col("__n") > 0, mean)).withColumn("__var", F.when(F.col("__n") > 0, spread / F.col("__n")))
        std = F.sqrt("__var")
        return out.select(*by, F.col("__n").alias(f"{name}_count"), F.col("__lo").alias(f"{name}_min"), F.col("__hi").alias(f"{name}_max"), F.col("__mean").alias(f"{name}_avg"),
                          F.col("__s").alias(f"{name}_sum"), F.when(F.col("__n") > 0, F.col("__q")).alias(f"{name}_sum_of_squares"), F.col("__var").alias(f"{name}_variance"),
                          std.alias(f"{name}_std_deviation"), (F.col("__mean") + F.lit(sigma) * std).alias(f"{name}_std_upper"),
                          (F.col("__mean") - F.lit(sigma) * std).alias(f"{name}_std_lower"))

    def _quantiles(self, by: list[str], field: str, ranks: list[float], where: Column | None) -> DataFrame:
        """(by, __q): the merged sketch's quantiles, null without values."""
        merged = self._rows(where).groupBy(*by).agg(F.kll_merge_agg_double(f"{field}.quantiles").alias("__k"), F.sum(f"{field}.n").alias("__n"))
        values = F.kll_sketch_get_quantile_double("__k", F.array(*[F.lit(float(r)) for r in ranks]))
        return merged.select(*by, F.when(F.col("__n") > 0, values).alias("__q"))

    def percentiles(self, by: list[str], field: str, percents: tuple = DEFAULT_PERCENTS, name: str | None = None, where: Column | None = None) -> DataFrame:
        name, found = name or field, self._quantiles(by, field, [p / 100 for p in percents], where)
        return found.select(*by, *[F.col("__q")[i].alias(f"{name}_{pct_name(float(p))}") for i, p in enumerate(percents)])

    def deviation(self, by: list[str], field: str, name: str | None = None, where: Column | None = None) -> DataFrame:
        """The median absolute deviation, of the values that evenly spaced quantiles stand for."""
        found = self._quantiles(by, field, [(i + 0.5) / _GRID for i in range(_GRID)], where)
        away = F.array_sort(F.transform("__q", lambda x: F.abs(x - F.col("__q")[_GRID // 2])))
        return found.select(*by, away[_GRID // 2].alias(name or field))

    def cardinality(self, by: list[str], field: str, name: str | None = None, where: Column | None = None) -> DataFrame:
        found = self._rows(where).groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg(f"{field}.distinct")).alias(name or field))
        return found.select(*by, F.coalesce(name or field, F.lit(0)).alias(name or field))


def _grouped(df: DataFrame, keys: list[str], time: str, fields: list[str], unit: str, size: int) -> DataFrame:
    rows = df.select(*keys, F.date_trunc(unit, F.col(time)).alias("period"), *[F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")).alias(f) for f in fields])

    def of(f: str) -> Column:
        x = F.col(f)
        n = F.count(x)
        return F.struct(n.alias("n"), F.coalesce(F.sum(x), F.lit(0.0)).alias("sum"), F.coalesce(F.sum(x * x), F.lit(0.0)).alias("squares"),
                        F.coalesce(F.var_pop(x) * n, F.lit(0.0)).alias("spread"), F.min(x).alias("low"), F.max(x).alias("high"),
                        F.kll_sketch_agg_double(f, F.lit(size)).alias("quantiles"), F.hll_sketch_agg(x.cast("string"), F.lit(LG_CELLS)).alias("distinct")).alias(f)

    # partial aggregation combines a hot key before the shuffle
    return rows.groupBy(*keys, "period").agg(*[of(f) for f in fields])
