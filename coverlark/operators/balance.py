"""Group-balanced percentiles: every group weighs the same, and so does every item of a group."""

from __future__ import annotations

from decimal import Context, Decimal

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..functions.prefix import running_sum, with_bucket
from ..functions.state import keep
from .checks import require_clean

WEIGHT = T.DecimalType(38, 36)


@F.pandas_udf(WEIGHT)
def _half_weight(size: pd.Series, groups: pd.Series) -> pd.Series:
    exact = Context(prec=38)
    unit = Decimal(1).scaleb(-36)
    return pd.Series([exact.quantize(exact.divide(Decimal(1), Decimal(2 * int(n) * int(s))), unit) for n, s in zip(size, groups, strict=True)])


def half_weights(df: DataFrame, group: str) -> DataFrame:
    """(group, group_size, half_weight): 1 / (2 * group size * number of groups), to 36 places, so that sums don't depend on order."""
    sizes = df.groupBy(group).agg(F.count("*").alias("group_size"))
    n = sizes.agg(F.count("*").alias("_groups"))
    return sizes.join(F.broadcast(n)).select(group, "group_size", _half_weight("group_size", "_groups").alias("half_weight"))


def _long(df: DataFrame, keep: list[str], features: list[str]) -> DataFrame:
    return df.select(*keep, *[F.col(f).cast("double").alias(f) for f in features]).unpivot(keep, features, "feature", "value")


def steps(df: DataFrame, group: str, features: list[str], by: list[str] = ()) -> DataFrame:
    """(by, feature, value, below, equal): half the balanced weight below and at each distinct value of each feature."""
    weighted = df.join(half_weights(df.select(group), group), group)
    long = _long(weighted, [*by, "half_weight"], features)
    distinct = long.groupBy(*by, "feature", "value").agg(F.sum("half_weight").cast(WEIGHT).alias("equal"))
    return running_sum(distinct, [*by, "feature"], "value", "equal", "below")


def percentiles_long(df: DataFrame, item: str, group: str, features: list[str]) -> DataFrame:
    """(item, group, feature, value, percentile): (weight below + half the weight at the value) / all weight. Ties share it; a constant gets 0.5."""
    require_clean(df, not_null=[item], finite=features, filled=[group])
    share = (F.col("below") + F.col("below") + F.col("equal")).cast("double")
    found = steps(df, group, features).select("feature", "value", share.alias("percentile"))
    return _long(df, [item, group], features).join(found, ["feature", "value"]).select(item, group, "feature", "value", "percentile")


def percentiles(df: DataFrame, item: str, group: str, features: list[str]) -> DataFrame:
    """(item, group, one percentile column a feature, coords in the order of ``features``)."""
    long = percentiles_long(df, item, group, features)
    wide = long.groupBy(item, group).pivot("feature", features).agg(F.first("percentile"))
    return wide.withColumn("coords", F.array(*features))


def percentile_integrity(before: DataFrame, after: DataFrame, features: list[str]) -> DataFrame:
    """For each feature: range of its percentiles, and its numbers of distinct values before and after, which must agree."""
    def counted(df: DataFrame, name: str) -> DataFrame:
        long = df.select(*[F.col(f).cast("double").alias(f) for f in features]).unpivot([], features, "feature", "value")
        return long.groupBy("feature").agg(F.count_distinct("value").alias(name), F.min("value").alias(f"{name}_low"), F.max("value").alias(f"{name}_high"))

    both = counted(before, "values_before").join(counted(after, "values_after"), "feature")
    return both.select("feature", "values_before", "values_after", F.col("values_after_low").alias("low"), F.col("values_after_high").alias("high"), ((F.col("values_before") == F.col("values_after")) & (F.col("values_after_low") >= 0) & (F.col("values_after_high") <= 1)).alias("intact"))


def project(baseline: DataFrame, queries: DataFrame, item: str, group: str, features: list[str]) -> DataFrame:
    """(item, feature, value, percentile) of query items on the baseline's scale, an as-of join.

    An observed value has its own percentile; one between two values has all weight below the higher one; below the least
    it is 0 and above the greatest 1. Nothing is interpolated.
    """
    known_steps = keep(steps(baseline, group, features))
    stairs = known_steps.select(
        "feature", "value", (F.col("below") + F.col("below") + F.col("equal")).cast("double").alias("at"), (F.col("below") + F.col("below") + F.col("equal") + F.col("equal")).cast("double").alias("past"), F.lit(None).cast(queries.schema[item].dataType).alias(item)
    )
    asked = _long(queries, [item], features).select("feature", "value", F.lit(None).cast("double").alias("at"), F.lit(None).cast("double").alias("past"), item)
    both = keep(with_bucket(stairs.unionByName(asked), ["feature"], "value", source=stairs))
    within = Window.partitionBy("feature", "_bucket").orderBy(F.col("value"), F.col("past").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    known = F.when(F.col("past").isNotNull(), F.struct("value", "at", "past"))
    found = both.withColumn("_last", F.last(known, ignorenulls=True).over(within))
    tops = with_bucket(stairs, ["feature"], "value").groupBy("feature", "_bucket").agg(F.max("past").alias("_top"))
    carried = F.max("_top").over(Window.partitionBy("feature").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    every = both.select("feature", "_bucket").distinct().join(tops, ["feature", "_bucket"], "left").withColumn("_carried", carried).drop("_top")
    rows = found.where(F.col("past").isNull()).join(F.broadcast(every), ["feature", "_bucket"])
    share = F.when(F.col("_last.value") == F.col("value"), F.col("_last.at")).otherwise(F.coalesce("_last.past", "_carried", F.lit(0.0)))
    return rows.select(item, "feature", "value", share.alias("percentile"))


def out_of_range(baseline: DataFrame, queries: DataFrame, features: list[str]) -> DataFrame:
    """For each feature, how many query values lie below and above the baseline's range."""
    plain = lambda df: df.select(*[F.col(f).cast("double").alias(f) for f in features]).unpivot([], features, "feature", "value")
    limits = plain(baseline).groupBy("feature").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    return plain(queries).join(F.broadcast(limits), "feature").groupBy("feature").agg(F.count_if(F.col("value") < F.col("low")).alias("below"), F.count_if(F.col("value") > F.col("high")).alias("above"), F.count("*").alias("n_items"))
