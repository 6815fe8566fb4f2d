"""How selections and coverage change with features, scales, chance and the universe."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions.keys import draw_key
from ..functions.prefix import running_sum
from ..functions.state import keep
from ..operators import balance, compare, coverage, selection


def without(features: list[str], drop: list[str]) -> list[str]:
    """The features that are left, at least one."""
    if missing := set(drop) - set(features):
        raise ValueError(f"unknown features {sorted(missing)}")
    if not (left := [f for f in features if f not in drop]):
        raise ValueError("no feature is left")
    return left


def reduced(df: DataFrame, features: list[str], drop: list[str]) -> DataFrame:
    """Coordinates without some features."""
    return df.withColumn("coords", F.array(*without(features, drop)))


def ablation(df: DataFrame, item: str, group: str, features: list[str], drops: dict[str, list[str]], size: int, sizes: list[int]) -> DataFrame:
    """(dropped, n, shared, fraction, weighted_mean): ladders chosen without some features, judged in the full space.

    ``df`` has a percentile column for each feature and coords of all. ``drops`` names sets of features: single ones for
    leave-one-out, groups for a grouped ablation.
    """
    df = keep(df)
    full = selection.group_ladder(df, item, group, size=size)
    parts = []
    for name, drop in drops.items():
        ladder = selection.group_ladder(reduced(df, features, drop), item, group, size=size)
        distances = coverage.nearest_panel_distance(df, ladder, item, sizes).join(df.select(item, group), item)
        mean = coverage.balanced_mean(coverage.group_statistics(distances, group)).withColumnRenamed("balanced_mean", "weighted_mean")
        parts.append(compare.overlap(full, ladder, item, sizes).join(mean, "n").select(F.lit(name).alias("dropped"), "n", "shared", "fraction", "weighted_mean"))
    return reduce(DataFrame.unionByName, parts)


#: Bytes of random panels' points that are broadcast at a time; more panels are sent in slices of replicates.
POINTS = 1 << 29
BLOCK = 1024


def _panels(df: DataFrame, item: str, ladders: DataFrame, size: int, coords: str) -> Iterator[dict[int, np.ndarray]]:
    """The points of every random ladder by replicate, as many replicates at a time as ``POINTS`` holds."""
    points = keep(ladders.where(F.col("rank") <= size).join(df.select(item, coords), item).select("replicate", "rank", coords))
    shape = points.groupBy("replicate").agg(F.count("*").alias("n"), F.max(F.size(coords)).alias("d")).agg(F.max(F.col("n") * F.col("d") * 8).alias("bytes"), F.min("replicate").alias("low"), F.max("replicate").alias("high")).first()
    if shape["bytes"] is None:
        return
    if shape["bytes"] > POINTS:
        raise ValueError(f"one random panel of {shape['bytes']} bytes is not broadcast")
    step = max(1, POINTS // max(shape["bytes"], 1))
    for low in range(shape["low"], shape["high"] + 1, step):
        got = points.where(F.col("replicate").between(low, low + step - 1)).toPandas().sort_values(["replicate", "rank"])
        if len(got):
            yield {int(r): np.array(own[coords].tolist()) for r, own in got.groupby("replicate")}


def _distances(x: np.ndarray, panels: dict[int, np.ndarray], sizes: list[int]) -> Iterator[tuple[int, int, np.ndarray]]:
    """Replicate, panel size and each item's distance to the panel. The least distance is carried from one size to the next."""
    for replicate, y in panels.items():
        low, done = np.full(len(x), np.inf), 0
        for n in sorted(sizes):
            for k in range(done, min(n, len(y)), 64):
                d2 = np.zeros((len(x), len(y[k : min(k + 64, n)])))
                for j in range(x.shape[1]):
                    d2 += (x[:, j, None] - y[None, k : min(k + 64, n), j]) ** 2
                low = np.minimum(low, d2.min(axis=1))
            done = n
            yield replicate, n, np.sqrt(low)


def random_coverage(df: DataFrame, item: str, group: str, ladders: DataFrame, sizes: list[int], coords: str = "coords") -> DataFrame:
    """(replicate, n, group, mean_distance, max_distance, group_size) for every random ladder and panel size.

    The ladders' points are broadcast, a checked number at a time. Tasks work in blocks of items of one range of groups and
    sum by group before anything is sent: a row for each group of a block, replicate and size, not for each item.
    """
    kind = df.schema[group].dataType.simpleString()
    dealt = df.select(item, group, coords).repartitionByRange(group, item).sortWithinPartitions(group).select(group, coords)

    def sums_of(panels: dict[int, np.ndarray]) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(panels)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for at in range(0, len(pdf), BLOCK):
                    part = pdf.iloc[at : at + BLOCK]
                    names, start = np.unique(part[group].to_numpy(), return_index=True)
                    count = np.diff(start, append=len(part))
                    found = [(replicate, n, np.add.reduceat(distance, start), np.maximum.reduceat(distance, start)) for replicate, n, distance in _distances(np.array(part[coords].tolist()), shared.value, sizes)]
                    replicate, n, total, most = zip(*found, strict=True)
                    each = {"replicate": np.repeat(replicate, len(names)), "n": np.repeat(n, len(names)), "total": np.concatenate(total), "most": np.concatenate(most)}
                    yield pd.DataFrame({**each, group: np.tile(names, len(found)), "count": np.tile(count, len(found))})

        return dealt.mapInPandas(run, f"replicate int, n int, {group} {kind}, total double, most double, count long")

    none = df.sparkSession.createDataFrame([], f"replicate int, n int, {group} {kind}, total double, most double, count long")
    sums = reduce(DataFrame.unionByName, map(sums_of, _panels(df, item, ladders, max(sizes), coords)), none)
    found = sums.groupBy("replicate", "n", group).agg(F.sum("total").alias("_t"), F.max("most").alias("max_distance"), F.sum("count").alias("group_size"))
    return found.select("replicate", "n", group, (F.col("_t") / F.col("group_size")).alias("mean_distance"), "max_distance", "group_size")


#: The bits of a distance, from the left, that are known after each pass of a weighted selection.
PASSES = (17, 29, 64)
#: Weights are whole multiples of 2 ** -PLACES, rounded down.
PLACES = 120
QUANTILES = {"weighted_median": Fraction(1, 2), "weighted_p95": Fraction(19, 20)}


def random_quantiles(df: DataFrame, item: str, group: str, ladders: DataFrame, sizes: list[int], at: dict[str, Fraction] = QUANTILES, coords: str = "coords") -> DataFrame:
    """(replicate, n, names of ``at``): balanced weighted quantiles of the distances to every random panel, without interpolation.

    A weighted selection by bits: a pass counts items by the leading bits of their distance and by the size of their group,
    only within the bracket that the passes before left to a quantile, and the bracket narrows to those bits in which the
    cumulative weight reaches it. The third pass leaves one distance. Tasks count before they send: no row stands for an
    item, replicate and size. An item weighs 1 / its group's size; rounding takes less than 2 ** -``PLACES`` for
    each item from a cumulative weight, and one that is within 2 ** -60 of a quantile reaches it. The driver holds a bracket for each replicate, size and name.
    """
    spark, names = df.sparkSession, [*at]
    counted = df.groupBy(group).agg(F.count("*").alias("_size"))
    groups = counted.count()
    weighted = keep(df.join(counted, group).select(coords, "_size").repartitionByRange("_size", coords).sortWithinPartitions("_size"))
    rows: list[tuple] = []
    for panels in _panels(df, item, ladders, max(sizes), coords):
        brackets: dict[tuple[int, int, int], tuple[int, int]] = {}
        for known, bits in zip((0, *PASSES), PASSES, strict=False):
            brackets = _narrowed(weighted, panels, sizes, coords, brackets, known, bits, groups, [at[name] for name in names])
        for replicate in panels:
            for n in sorted(set(sizes)):
                if all((replicate, n, q) in brackets for q in range(len(names))):
                    rows.append((replicate, n, *(float(np.int64(brackets[replicate, n, q][0]).view(np.float64)) for q in range(len(names)))))
    return spark.createDataFrame(rows, "replicate int, n int, " + ", ".join(f"{name} double" for name in names))


def _narrowed(weighted: DataFrame, panels: dict[int, np.ndarray], sizes: list[int], coords: str, brackets: dict, known: int, bits: int, groups: int, at: list[Fraction]) -> dict:
    """(replicate, n, number of the quantile) -> (its leading ``bits`` bits, weight below them), from those with ``known`` bits."""
    shared = weighted.sparkSession.sparkContext.broadcast((panels, brackets))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        panels, brackets = shared.value
        for pdf in batches:
            for start in range(0, len(pdf), BLOCK):
                part = pdf.iloc[start : start + BLOCK]
                group_sizes, size = np.unique(part["_size"].to_numpy(), return_inverse=True)
                out = []
                for replicate, n, distance in _distances(np.array(part[coords].tolist()), panels, sizes):
                    key = distance.view(np.int64)
                    for q in range(len(at)) if known else (-1,):
                        inside = np.arange(len(key)) if q < 0 else np.flatnonzero(key >> (64 - known) == brackets[replicate, n, q][0])
                        prefix, where = np.unique(key[inside] >> (64 - bits), return_inverse=True)
                        count = np.bincount(where * len(group_sizes) + size[inside], minlength=len(prefix) * len(group_sizes))
                        filled = np.flatnonzero(count)
                        out.append((replicate, n, q, len(filled), prefix[filled // len(group_sizes)], group_sizes[filled % len(group_sizes)], count[filled]))
                replicate, n, q, rows, prefix, own, count = zip(*out, strict=True)
                yield pd.DataFrame({**{c: np.repeat(v, rows) for c, v in (("replicate", replicate), ("n", n), ("q", q))}, "prefix": np.concatenate(prefix), "size": np.concatenate(own), "count": np.concatenate(count)})

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        """Of one replicate the first prefix of each size and quantile whose cumulative weight reaches the quantile."""
        brackets, replicate, out = shared.value[1], int(pdf["replicate"].iloc[0]), []
        unit = {int(s): (1 << PLACES) // int(s) for s in pdf["size"].unique()}
        rows = pdf.sort_values(["n", "q", "prefix"], ignore_index=True)
        n, q, prefix, size, count = (rows[c].tolist() for c in ("n", "q", "prefix", "size", "count"))
        starts = [k for k in range(len(n)) if not k or (n[k], q[k]) != (n[k - 1], q[k - 1])]
        for start, end in zip(starts, [*starts[1:], len(n)], strict=True):
            for number in range(len(at)) if q[start] < 0 else (q[start],):
                below = total = brackets[replicate, n[start], number][1] if q[start] >= 0 else 0
                for k in range(start, end):
                    if k > start and prefix[k] != prefix[k - 1]:
                        below = total
                    total += count[k] * unit[size[k]]
                    if (k + 1 == end or prefix[k + 1] != prefix[k]) and (total + (1 << 60)) * at[number].denominator >= at[number].numerator * (groups << PLACES):
                        out.append((replicate, n[start], number, prefix[k], str(below)))
                        break
        return pd.DataFrame(out, columns=["replicate", "n", "q", "prefix", "below"])

    counts = weighted.mapInPandas(run, "replicate int, n int, q int, prefix long, size long, count long")
    counts = counts.groupBy("replicate", "n", "q", "prefix", "size").agg(F.sum("count").alias("count"))
    chosen = counts.groupBy("replicate").applyInPandas(choose, "replicate int, n int, q int, prefix long, below string")
    return {(r["replicate"], r["n"], r["q"]): (r["prefix"], int(r["below"])) for r in chosen.collect()}


def random_metrics(statistics: DataFrame, quantiles: DataFrame) -> DataFrame:
    """(replicate, n) and the ten numbers of each random panel, as in ``coverage_summary``, from ``random_coverage`` and ``random_quantiles``."""
    disc = lambda q, c: F.expr(f"percentile_disc({q}) within group (order by {c})")
    by_group = statistics.groupBy("replicate", "n").agg(
        F.avg("mean_distance").alias("weighted_mean"),
        F.max("max_distance").alias("unweighted_max"),
        disc(0.5, "mean_distance").alias("median_group_mean"),
        disc(0.95, "mean_distance").alias("p95_group_mean"),
        F.max("mean_distance").alias("max_group_mean"),
        disc(0.5, "max_distance").alias("median_group_max"),
        disc(0.95, "max_distance").alias("p95_group_max"),
        F.max("max_distance").alias("max_group_max"),
    )
    return by_group.join(quantiles, ["replicate", "n"])


def scale_percentiles(values: DataFrame, item: str, group: str) -> DataFrame:
    """(item, group, k, family, percentile) of a long table (item, group, k, family, value): balanced within each scale and family."""
    half = values.join(balance.half_weights(values.select(item, group).distinct(), group), group)
    distinct = half.groupBy("k", "family", "value").agg(F.sum("half_weight").cast(balance.WEIGHT).alias("_w"))
    summed = running_sum(distinct, ["k", "family"], "value", "_w", "_below")
    share = (F.col("_below") + F.col("_below") + F.col("_w")).cast("double")
    return values.join(summed.select("k", "family", "value", share.alias("percentile")), ["k", "family", "value"]).select(item, group, "k", "family", "percentile")


def scale_distances(percentiles: DataFrame, item: str, group: str) -> DataFrame:
    """(left_k, right_k, distance): root of the mean over families of the mean over groups of the mean squared difference."""
    a = percentiles.select(item, group, "family", F.col("k").alias("left_k"), F.col("percentile").alias("_a"))
    b = percentiles.select(item, "family", F.col("k").alias("right_k"), F.col("percentile").alias("_b"))
    pairs = a.join(b, [item, "family"]).where("left_k < right_k")
    by_group = pairs.groupBy("left_k", "right_k", "family", group).agg(F.avg((F.col("_a") - F.col("_b")) * (F.col("_a") - F.col("_b"))).alias("_d"))
    by_family = by_group.groupBy("left_k", "right_k", "family").agg(F.avg("_d").alias("_d"))
    return by_family.groupBy("left_k", "right_k").agg(F.sqrt(F.avg("_d")).alias("distance"))


def scale_pairs(distances: DataFrame) -> DataFrame:
    """(left_k, right_k, r_max, r_mean): how far any scale is from the nearer of two, at most and on average; the best pair first."""
    both = distances.unionByName(distances.select(F.col("right_k").alias("left_k"), F.col("left_k").alias("right_k"), "distance"))
    scales = both.select(F.col("left_k").alias("k")).distinct()
    full = both.select(F.col("left_k").alias("k"), F.col("right_k").alias("to"), "distance").unionByName(scales.select("k", F.col("k").alias("to"), F.lit(0.0).alias("distance")))
    a, b = full.select("k", F.col("to").alias("left_k"), F.col("distance").alias("_a")), full.select("k", F.col("to").alias("right_k"), F.col("distance").alias("_b"))
    near = a.join(b, "k").where("left_k < right_k").withColumn("_n", F.least("_a", "_b"))
    return near.groupBy("left_k", "right_k").agg(F.max("_n").alias("r_max"), F.avg("_n").alias("r_mean")).orderBy("r_max", "r_mean", "left_k", "right_k")


def swap_scales(features: DataFrame, values: DataFrame, item: str, group: str, keep: list[str], pair: tuple[int, int], families: list[str]) -> DataFrame:
    """Percentiles of the kept features with each family's values at the chosen pair of scales."""
    chosen = values.where(F.col("k").isin(*pair)).select(item, F.concat_ws("_", "family", F.col("k").cast("string")).alias("_c"), "value")
    columns = [f"{f}_{k}" for f in families for k in pair]
    wide = chosen.groupBy(item).pivot("_c", columns).agg(F.first("value"))
    return balance.percentiles(features.select(item, group, *keep).join(wide, item), item, group, [*keep, *columns])


SCENARIOS = ("add", "remove", "replace", "grow_largest", "new_groups", "split_largest", "merge_singletons")


def scenario(df: DataFrame, item: str, group: str, name: str, n: int, namespace: str = "scenario-v1") -> DataFrame:
    """The universe after a change; ids and groups are text. New items are copies of drawn ones under ids made by a hash.

    add, remove, replace: ``n`` drawn items. grow_largest: ``n`` items, a tenth from each of the ten largest groups.
    new_groups: ``n`` copies, each in a group of its own. split_largest: ``n`` of the largest group move to a new one.
    merge_singletons: up to ``n`` groups of one item become one group.
    """
    rows = df.withColumns({item: F.col(item).cast("string"), group: F.col(group).cast("string")})
    key = draw_key(item, namespace, name)
    new_id = F.concat(F.lit("new-"), F.substring(key, 1, 16))
    drawn = lambda d, k: d.orderBy(key, item).limit(k)
    copies = lambda d: d.withColumn(item, new_id)
    if name == "add":
        return rows.unionByName(copies(drawn(rows, n)))
    if name == "remove":
        return rows.join(drawn(rows, n).select(item), item, "left_anti").select(rows.columns)
    if name == "replace":
        out = drawn(rows, n)
        return rows.join(out.select(item), item, "left_anti").select(rows.columns).unionByName(copies(out))
    if name == "grow_largest":
        top = [r[0] for r in selection.largest_groups(rows, group, 10).collect()]
        return reduce(DataFrame.unionByName, [copies(drawn(rows.where(F.col(group) == g), n // 10)) for g in top], rows)
    if name == "new_groups":
        return rows.unionByName(copies(drawn(rows, n)).withColumn(group, F.concat(F.lit("group-"), F.col(item))))
    if name == "split_largest":
        top = selection.largest_groups(rows, group, 1).first()[0]
        moved = drawn(rows.where(F.col(group) == top), n).select(item, F.lit(True).alias("_m"))
        return rows.join(moved, item, "left").withColumn(group, F.when(F.col("_m"), F.concat(group, F.lit("-split"))).otherwise(F.col(group))).select(rows.columns)
    if name == "merge_singletons":
        alone = rows.groupBy(group).agg(F.count("*").alias("_n"), F.min(item).alias(item)).where("_n = 1")
        merged = drawn(alone, n).select(group, F.lit(True).alias("_m"))
        return rows.join(merged, group, "left").withColumn(group, F.when(F.col("_m"), F.lit("merged")).otherwise(F.col(group))).select(rows.columns)
    raise ValueError(name)


def invariant(df: DataFrame, plan: Callable[[DataFrame], DataFrame], parts: int = 7) -> bool:
    """Whether a plan gives the same rows when its input is dealt and ordered anew."""
    other = df.repartition(parts, F.rand(1)).sortWithinPartitions(F.rand(2))
    a, b = plan(df), plan(other)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def holdout_resolution(baseline: DataFrame, queries: DataFrame, item: str, group: str, features: list[str], ladders: dict[str, DataFrame], sizes: list[int]) -> DataFrame:
    """(selector, n, weighted_p95): hold-out items on the baseline's scale, their distance to each ladder's panels, balanced.

    Ladders are of baseline items. The scale of the query items is the baseline's, the panel's is its own.
    """
    own = keep(balance.percentiles(baseline, item, group, features))
    asked = balance.project(baseline, queries, item, group, features).groupBy(item).pivot("feature", features).agg(F.first("percentile"))
    asked = keep(asked.withColumn("coords", F.array(*features)).join(queries.select(item, group), item))
    parts = []
    for name, ladder in ladders.items():
        d = coverage.nearest_panel_distance(asked, ladder, item, sizes, same_universe=False, panel_coords=own)
        d = keep(d.join(asked.select(item, group), item))
        parts.append(coverage.balanced_quantile(d, group, "n", "distance", 0.95, "weighted_p95").select(F.lit(name).alias("selector"), "n", "weighted_p95"))
    return reduce(DataFrame.unionByName, parts)
