"""Running sums over a whole table, without putting all rows of a key in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .state import keep

BUCKETS = 64


def with_bucket(df: DataFrame, by: list[str], value: str, source: DataFrame | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Adds _bucket: the number of quantile bounds of ``value`` (within ``by``, in ``source`` or else ``df``) below the row's value.

    ``by`` must name few combinations (features, scales): their bounds are broadcast, ``buckets`` numbers for each.
    """
    cuts = [i / buckets for i in range(1, buckets)]
    bounds = (df if source is None else source).groupBy(*by).agg(F.percentile_approx(value, cuts, 1000).alias("_bounds"))
    placed = df.join(F.broadcast(bounds), by, "left")
    return placed.withColumn("_bucket", F.coalesce(F.size(F.filter("_bounds", lambda b: b < F.col(value))), F.lit(0))).drop("_bounds")


def running_sum(df: DataFrame, by: list[str], value: str, amount: str, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``amount`` over rows of the same ``by`` with a smaller ``value``. Values are distinct within ``by``."""
    placed = keep(with_bucket(keep(df), by, value))
    totals = placed.groupBy(*by, "_bucket").agg(F.sum(amount).alias("_total"))
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("_offset", F.sum("_total").over(before)).drop("_total")
    within = Window.partitionBy(*by, "_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    kind = df.schema[amount].dataType
    zero = F.lit(0).cast(kind)
    inner = F.coalesce(F.sum(amount).over(within), zero)
    summed = placed.withColumn("_inner", inner).join(F.broadcast(offsets), [*by, "_bucket"])
    return summed.withColumn(name, (F.col("_inner") + F.coalesce("_offset", zero)).cast(kind)).drop("_inner", "_offset", "_bucket")


def ranked(df: DataFrame, number: str, order: list[str], name: str = "rank", kind: str = "int") -> DataFrame:
    """Adds ``name``: the place of a row, from 1, in the order of ``order``, whose rows must be distinct. ``number`` rises with that order."""
    placed = keep(with_bucket(df.withColumn("_all", F.lit(0)), ["_all"], number))
    before = Window.partitionBy("_all").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_all", "_bucket").agg(F.count("*").alias("_n")).withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n", "_all")
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order))
    return placed.join(F.broadcast(offsets), "_bucket").withColumn(name, (F.col("_offset") + within).cast(kind)).drop("_bucket", "_offset", "_all")
