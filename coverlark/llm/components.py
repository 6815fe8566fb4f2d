"""Connected components of an edge table by alternating large and small stars; each round is one written table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import materialize


def _print(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``edges`` has bigint columns u and v. Returns (node, component) for every node with an edge; component is the least node reachable.

    Loops are ignored. Only joins and minima are used, so a hub is never gathered into one task's memory.
    """
    e = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    before = _print(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*")
        e = materialize(small.where("u <> v").distinct(), "edges")
        now = _print(e)
        if now == before:
            break
        before = now
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
