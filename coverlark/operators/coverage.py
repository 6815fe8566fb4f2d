"""How well a panel covers a universe."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..functions.prefix import running_sum
from ..functions.state import keep
from ..functions.vectors import distances, exact_means
from .balance import WEIGHT, half_weights

PANEL_ITEMS = 20_000


def nearest_panel_distance(items: DataFrame, ladder: DataFrame, item: str, sizes: list[int], coords: str = "coords", same_universe: bool = True, panel_coords: DataFrame | None = None) -> DataFrame:
    """(item, n, distance) for every item and panel size: the Euclidean distance to the nearest of the first n of the ladder.

    Panel members are at 0 when ``same_universe``. ``panel_coords`` has the panel's coordinates if it is from another
    universe. The panel is brought to the driver and sent with the tasks: at most max(sizes) items, which must be within
    PANEL_ITEMS. An item is compared with each member once, for all sizes. Items without coordinates are infinitely far, as
    are all from an empty panel. Coordinates must be of one length.
    """
    if max(sizes) > PANEL_ITEMS:
        raise ValueError(f"a panel of over {PANEL_ITEMS} items is not sent to all tasks")
    source = (items if panel_coords is None else panel_coords).select(item, F.col(coords).cast("array<double>").alias("_c"))
    panel = ladder.where(F.col("rank") <= max(sizes)).select("rank", item).join(source, item).orderBy("rank", item).limit(PANEL_ITEMS + 1).collect()
    if len(panel) > PANEL_ITEMS:
        raise ValueError(f"a panel of over {PANEL_ITEMS} items is not sent to all tasks")
    ranks = np.array([r["rank"] for r in panel], np.int64)
    points = [np.array(r["_c"], float) for r in panel if r["_c"] is not None]
    at_point = [r["rank"] for r in panel if r["_c"] is not None]
    ids = [r[item] for r in panel]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            known = np.array(batch.column(1).is_valid())
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(int(known.sum()), -1)
            low, k, out = np.full(len(x), np.inf), 0, []
            place = pc.index_in(batch.column(0), value_set=pa.array(ids, batch.schema.types[0])).fill_null(len(ids)).to_numpy(zero_copy_only=False)
            own = np.append(ranks, np.iinfo(np.int64).max)[place]
            for n in sorted(set(sizes)):
                while k < len(points) and at_point[k] <= n:
                    low = np.fmin(low, distances(x, points[k]))
                    k += 1
                found = np.full(batch.num_rows, np.inf)
                found[known] = np.sqrt(low)
                if same_universe:
                    found[own <= n] = 0.0
                out.append(pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.full(batch.num_rows, n, np.int32)), pa.array(found)], names=[item, "n", "distance"]))
            yield from out

    rows = items.select(item, F.col(coords).cast("array<double>").alias("_x"))
    return rows.mapInArrow(run, T.StructType([items.schema[item], T.StructField("n", T.IntegerType()), T.StructField("distance", T.DoubleType())]))


def exact_mean(df: DataFrame, by: list[str], value: str, name: str) -> DataFrame:
    """The mean of doubles, rounded once from their exact sum, whatever their order."""
    found = exact_means(df.withColumn("_values", F.array(F.col(value).cast("double"))), by, "_values", "_means")
    return found.select(*by, F.col("_means")[0].alias(name))


def group_statistics(distances: DataFrame, group: str) -> DataFrame:
    """(n, group, mean_distance, max_distance, group_size)."""
    return distances.groupBy("n", group).agg(F.avg("distance").alias("mean_distance"), F.max("distance").alias("max_distance"), F.count("*").alias("group_size"))


def balanced_mean(statistics: DataFrame) -> DataFrame:
    """(n, balanced_mean): the mean of the groups' means."""
    return statistics.groupBy("n").agg(F.avg("mean_distance").alias("balanced_mean"))


def quantiles(df: DataFrame, by: list[str], value: str, at: dict[str, float], buckets: int = 64) -> DataFrame:
    """(by, one column for each of ``at``): inverse-ECDF quantiles, the least value with at least the share at or below it.

    Values of a key are counted, and the counts are added up by buckets of about as many different values each. Only the
    bucket in which a rank lies is looked at again and sorted, so that no task holds the values of a key. Shares are compared
    as whole numbers. Null values don't count; a key that has none but null gives null.
    """
    key = F.struct(F.lit(0).alias("_"), *by).alias("_key")  # a struct, so that null keys are equal
    counted = keep(df.select(key, F.col(value).alias("_v")).groupBy("_key", "_v").agg(F.count("*").alias("_n")))
    values = counted.where(F.col("_v").isNotNull())
    bounds = values.groupBy("_key").agg(F.percentile_approx("_v", [k / buckets for k in range(1, buckets)], 1000).alias("_bounds"))
    placed = keep(values.join(bounds, "_key").select("_key", "_v", "_n", F.size(F.filter("_bounds", lambda b: b < F.col("_v"))).alias("_bucket")))
    in_order = Window.partitionBy("_key").orderBy("_bucket")  # at most ``buckets`` rows a key
    sums = placed.groupBy("_key", "_bucket").agg(F.sum("_n").alias("_sum"))
    sums = sums.select("_key", "_bucket", F.sum("_sum").over(in_order).alias("_to"), "_sum", F.sum("_sum").over(Window.partitionBy("_key")).alias("_all"))
    shares = {name: Fraction(str(q)) for name, q in at.items()}
    rank = lambda q: F.greatest(F.expr(f"(_all * {q.numerator} + {q.denominator - 1}) div {q.denominator}"), F.lit(1))
    ranks = F.array(*[F.struct(F.lit(name).alias("_name"), rank(q).alias("_rank")) for name, q in shares.items()])
    wanted = sums.select("_key", "_bucket", (F.col("_to") - F.col("_sum")).alias("_below"), "_to", F.explode(ranks).alias("_w")).where((F.col("_below") < F.col("_w._rank")) & (F.col("_w._rank") <= F.col("_to")))
    summed = placed.join(wanted, ["_key", "_bucket"]).withColumn("_upto", F.col("_below") + F.sum("_n").over(Window.partitionBy("_key", "_w._name").orderBy("_v")))
    found = summed.where(F.col("_upto") >= F.col("_w._rank")).groupBy("_key").agg(*[F.min(F.when(F.col("_w._name") == name, F.col("_v"))).alias(name) for name in at])
    keys = counted.select("_key").distinct()
    return keys.join(found, "_key", "left").select(*[F.col("_key")[c].alias(c) for c in by], *at)


def balanced_quantile(df: DataFrame, group: str, by: str, value: str, q: float, name: str) -> DataFrame:
    """(by, name): the least value at which the balanced weight of values up to it reaches ``q``. Weights sum to 1 in each ``by``.

    Weights have 36 places; a cumulative weight within 1e-28 of ``q`` counts as reaching it.
    """
    one = df.groupBy(by).agg(F.count("*")).select(F.min(by).alias("_one"))  # items and groups are the same in each
    weights = half_weights(df.join(F.broadcast(one), F.col(by) == F.col("_one")).select(group), group)
    distinct = df.join(weights, group).groupBy(by, value).agg(F.sum("half_weight").cast(WEIGHT).alias("_w"))
    summed = running_sum(distinct, [by], value, "_w", "_below")
    reached = F.col("_below") + F.col("_w") + F.lit("0.0000000000000000000000000001").cast("decimal(38,36)") >= F.lit(str(q / 2)).cast("decimal(38,36)")
    return summed.where(reached).groupBy(by).agg(F.min(value).alias(name))


def coverage_summary(distances: DataFrame, group: str) -> DataFrame:
    """Ten numbers for each panel size, from rows (n, group, distance) that hold every item once for each n."""
    distances = keep(distances)
    statistics = keep(group_statistics(distances, group))
    by_group = statistics.groupBy("n").agg(F.avg("mean_distance").alias("weighted_mean"), F.max("max_distance").alias("unweighted_max"), F.max("mean_distance").alias("max_group_mean"), F.max("max_distance").alias("max_group_max"))
    long = statistics.unpivot(["n"], ["mean_distance", "max_distance"], "of", "value")
    found = quantiles(long, ["n", "of"], "value", {"median": 0.5, "p95": 0.95})
    one = lambda q, of, name: F.min(F.when(F.col("of") == of, F.col(q))).alias(name)
    by_group = by_group.join(found.groupBy("n").agg(*[one(q, f"{kind}_distance", f"{q}_group_{kind}") for q in ("median", "p95") for kind in ("mean", "max")]), "n")
    return by_group.join(balanced_quantile(distances, group, "n", "distance", 0.5, "weighted_median"), "n").join(balanced_quantile(distances, group, "n", "distance", 0.95, "weighted_p95"), "n")
