"""Comparisons of memberships, ladders, panels and coverage."""

from __future__ import annotations

from fractions import Fraction
from math import prod

from pyspark.sql import DataFrame, functions as F

from ..functions.prefix import running_sum
from .coverage import quantiles


def membership(left: DataFrame, right: DataFrame, item: str) -> DataFrame:
    """One row: items of both, of the left and of the right only; the three add up to the union."""
    a, b = left.select(item, F.lit(True).alias("_l")).distinct(), right.select(item, F.lit(True).alias("_r")).distinct()
    l, r = F.col("_l").isNotNull(), F.col("_r").isNotNull()
    return a.join(b, item, "full").agg(F.count_if(l & r).alias("in_both"), F.count_if(l & ~r).alias("left_only"), F.count_if(~l & r).alias("right_only"), F.count("*").alias("in_any"))


def retained_absent(retained: DataFrame, baseline: DataFrame, item: str) -> DataFrame:
    return retained.join(baseline, item, "left_anti")


def holdout(universe: DataFrame, absent: DataFrame, item: str) -> DataFrame:
    return universe.join(absent, item, "left_semi")


def holdout_summary(members: DataFrame, group: str, least_items: int = 1000, least_groups: int = 200) -> DataFrame:
    """One row: items, groups, and whether both reach their minimum."""
    row = members.agg(F.count("*").alias("n_items"), F.count_distinct(group).alias("n_groups"))
    return row.withColumn("status", F.when((F.col("n_items") >= least_items) & (F.col("n_groups") >= least_groups), "PASS").otherwise("FAIL"))


def holdout_composition(members: DataFrame, baseline: DataFrame, group: str) -> DataFrame:
    """(in_baseline, n_groups, n_items): hold-out groups that the baseline has or lacks, and their items."""
    sizes = members.groupBy(group).agg(F.count("*").alias("_n"))
    known = baseline.select(group).distinct().withColumn("_k", F.lit(True))
    return sizes.join(known, group, "left").groupBy(F.col("_k").isNotNull().alias("in_baseline")).agg(F.count("*").alias("n_groups"), F.sum("_n").alias("n_items"))


def empirical_rank(candidates: DataFrame, randoms: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by, value, empirical_rank): 1 + how many random values are lower; equal ones don't count."""
    own = candidates.select(*by, F.col(value).alias("_c"))
    lower = randoms.join(own, by).groupBy(*by).agg(F.count_if(F.col(value) < F.col("_c")).alias("_n"))
    return own.join(lower, by, "left").select(*by, F.col("_c").alias(value), (1 + F.coalesce("_n", F.lit(0))).alias("empirical_rank"))


def average_ranks(df: DataFrame, item: str, features: list[str]) -> DataFrame:
    """(item, feature, rank): ranks from 1, equal values sharing their mean, from counts of distinct values and running sums."""
    long = df.select(item, *[F.col(f).cast("double").alias(f) for f in features]).unpivot([item], features, "feature", "value")
    sizes = long.groupBy("feature", "value").agg(F.count("*").alias("_n"))
    ranked = running_sum(sizes, ["feature"], "value", "_n", "_below").withColumn("rank", F.col("_below") + (F.col("_n") + 1) / 2)
    return long.join(ranked.select("feature", "value", "rank"), ["feature", "value"]).select(item, "feature", "rank")


def spearman(df: DataFrame, item: str, features: list[str]) -> DataFrame:
    """(left_feature, right_feature, correlation) of every pair of features; a constant feature fails.

    An item sends its ranks once for each pair, which tasks sum before anything moves: a task sends one row a pair.
    """
    ranks = average_ranks(df, item, features).groupBy(item).pivot("feature", features).agg(F.first("rank"))
    pairs = [(a, b) for i, a in enumerate(features) for b in features[i:]]
    each = F.explode(F.array(*[F.struct(F.lit(a).alias("left_feature"), F.lit(b).alias("right_feature"), F.col(a).alias("x"), F.col(b).alias("y")) for a, b in pairs]))
    summed = ranks.select(each.alias("p")).select("p.*").groupBy("left_feature", "right_feature")
    found = summed.agg(F.covar_pop("x", "y").alias("_both"), F.sqrt(F.var_pop("x") * F.var_pop("y")).alias("_each"), ((F.min("x") < F.max("x")) & (F.min("y") < F.max("y"))).alias("_vary"))
    constant = F.raise_error(F.concat(F.lit("constant: "), "left_feature", F.lit(" or "), "right_feature")).cast("double")
    return found.select("left_feature", "right_feature", F.when(F.col("_vary"), F.col("_both") / F.col("_each")).otherwise(constant).alias("correlation"))


def overlap(left: DataFrame, right: DataFrame, item: str, sizes: list[int]) -> DataFrame:
    """(n, shared, fraction): items in both first-n panels of two ladders."""
    both = left.select(item, F.col("rank").alias("_a")).join(right.select(item, F.col("rank").alias("_b")), item)
    ns = F.explode(F.array(*[F.lit(n) for n in sizes]))
    spread = both.select(F.greatest("_a", "_b").alias("_r"), ns.alias("n"))
    return spread.groupBy("n").agg(F.count_if(F.col("_r") <= F.col("n")).alias("shared")).withColumn("fraction", F.col("shared") / F.col("n"))


def first_divergence(left: DataFrame, right: DataFrame, item: str) -> DataFrame:
    """One row: the smallest rank at which two ladders differ, both items and a reason; no row if they agree.

    Reasons: a ladder ends; the other ladder's item is not in this one; it comes later because its score is lower, or equal.
    """
    a = left.select("rank", F.col(item).alias("left_item"), F.col("score").alias("left_score"))
    b = right.select("rank", F.col(item).alias("right_item"), F.col("score").alias("right_score"))
    first = a.join(b, "rank", "full").where(~F.col("left_item").eqNullSafe(F.col("right_item"))).orderBy("rank").limit(1)
    later = right.select(F.col(item).alias("left_item"), F.lit(True).alias("_later"))
    reason = F.when(F.col("left_item").isNull() | F.col("right_item").isNull(), "ladder_ends").when(F.col("_later").isNull(), "unavailable").when(F.col("right_score") > F.col("left_score"), "higher_score").otherwise("tie_break")
    return first.join(later, "left_item", "left").select("rank", "left_item", "right_item", reason.alias("reason"))


def geometry_shift(before: DataFrame, after: DataFrame, item: str, coords: str = "coords") -> DataFrame:
    """One row: shared items, and the mean and greatest absolute change of a coordinate over them."""
    both = before.select(item, F.col(coords).alias("_a")).join(after.select(item, F.col(coords).alias("_b")), item)
    steps = both.select(F.posexplode(F.zip_with("_a", "_b", lambda x, y: F.abs(x - y))).alias("_i", "_d"))
    return steps.agg(F.count_if(F.col("_i") == 0).alias("n_shared"), F.avg("_d").alias("mean_change"), F.max("_d").alias("max_change"))


def winner(scores: DataFrame, left: str, right: str) -> DataFrame:
    """One row: whether one of two selectors is lower at every n, they tie at every n, or neither. ``scores``: n and both columns."""
    row = scores.agg(F.count("*").alias("n_sizes"), F.count_if(F.col(left) < F.col(right)).alias("left_lower"), F.count_if(F.col(left) > F.col(right)).alias("right_lower"))
    status = F.when(F.col("left_lower") == F.col("n_sizes"), "LEFT_LOWER_AT_ALL").when(F.col("right_lower") == F.col("n_sizes"), "RIGHT_LOWER_AT_ALL").when((F.col("left_lower") == 0) & (F.col("right_lower") == 0), "TIE_AT_ALL").otherwise("NOT_UNIFORMLY_ORDERED")
    return row.withColumn("status", status)


def product_decision(scores: DataFrame, left: str, right: str) -> str:
    """A, B or UNRESOLVED by the exact product of each selector's metrics, a dozen numbers."""
    rows = scores.select(left, right).collect()
    a, b = (prod((Fraction(float(r[c])) for r in rows), start=Fraction(1)) for c in (left, right))
    return "A" if a < b else "B" if b < a else "UNRESOLVED"


def abundance(ladder: DataFrame, group: str, sizes: list[int]) -> DataFrame:
    """(n, distinct_groups, max_per_group, multiplicity): how often groups occur in each panel, as "1x:45,2x:1"."""
    spread = ladder.select(group, "rank", F.explode(F.array(*[F.lit(n) for n in sizes])).alias("n")).where("rank <= n")
    each = spread.groupBy("n", group).agg(F.count("*").alias("_k"))
    times = each.groupBy("n", "_k").agg(F.count("*").alias("_m"))
    return times.groupBy("n").agg(F.sum("_m").alias("distinct_groups"), F.max("_k").alias("max_per_group"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_k", "_m"))), lambda x: F.concat(x["_k"].cast("string"), F.lit("x:"), x["_m"].cast("string"))), ",").alias("multiplicity"))


def prefix_breaks(ladder: DataFrame, item: str, sizes: list[int], longer: DataFrame) -> DataFrame:
    """(n, members, missing): panel members, and how many of them the panel of the same ladder run further lacks; 0 when panels are nested."""
    spread = lambda df: df.select(item, "rank", F.explode(F.array(*[F.lit(n) for n in sizes])).alias("n")).where("rank <= n").select("n", item)
    both = spread(ladder).join(spread(longer).withColumn("_there", F.lit(True)), ["n", item], "left")
    return both.groupBy("n").agg(F.count("*").alias("members"), F.count_if(F.col("_there").isNull()).cast("int").alias("missing"))


def stability(before: DataFrame, after: DataFrame, universe: DataFrame, item: str, sizes: list[int]) -> DataFrame:
    """(n, shared, changed, unavailable, new_items): how a panel changes when the universe does.

    ``universe``: the items after the change. unavailable: former members that are gone; new_items: members that were not in
    the former ladder at all.
    """
    ns = F.explode(F.array(*[F.lit(n) for n in sizes])).alias("n")
    old = before.select(item, F.col("rank").alias("_a")).join(universe.select(item, F.lit(True).alias("_u")).distinct(), item, "left")
    new = after.select(item, F.col("rank").alias("_b"))
    rows = old.join(new, item, "full").select("_a", "_b", "_u", ns)
    a, b = F.coalesce(F.col("_a") <= F.col("n"), F.lit(False)), F.coalesce(F.col("_b") <= F.col("n"), F.lit(False))
    return rows.groupBy("n").agg(F.count_if(a & b).alias("shared"), F.count_if(b & ~a).alias("changed"), F.count_if(a & F.col("_u").isNull()).alias("unavailable"), F.count_if(b & F.col("_a").isNull()).alias("new_items"))


def random_summary(values: DataFrame, by: list[str], metrics: list[str]) -> DataFrame:
    """(by, metric, low, median, high): the 2.5, 50 and 97.5 percent points over replicates, without interpolation."""
    long = values.unpivot(by, metrics, "metric", "value")
    return quantiles(long, [*by, "metric"], "value", {"low": 0.025, "median": 0.5, "high": 0.975})
