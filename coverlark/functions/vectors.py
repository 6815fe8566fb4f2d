"""Coordinates as array<double>."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T


def coords(columns: list[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in columns])


def squared_distance(a: Column, b: Column) -> Column:
    """Squared Euclidean distance, summed from the first feature to the last."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of rows from a point, summed from the first feature to the last, as in the table."""
    total = np.zeros(len(x))
    for k in range(x.shape[1]):
        total += (x[:, k] - y[k]) * (x[:, k] - y[k])
    return total


#: A double is taken as a whole number of units of its band, which spans this many binary exponents, and cut into limbs.
BAND, SLACK, LIMB, LIMBS = 32, 4, 23, 4
#: The least band: its unit is below the least double.
LOWEST = -32


def _unit(band: int) -> int:
    """The binary exponent of a band's unit: 53 bits below the band's least exponent, and a little more for a logarithm that is a hair off."""
    return BAND * band - 52 - SLACK


def exact_means(df: DataFrame, by: list[str], values: str, name: str) -> DataFrame:
    """(by, name): the means of arrays of doubles, place by place, each rounded once from its exact sum, whatever the order.

    A value is a whole number of units of its band of exponents, of at most 92 bits. Its four limbs of 23 bits are summed as
    long numbers by key, place and band, so that tasks add up before anything moves and 2 ** 40 values of a key can't
    overflow. A key then has at most 65 rows a place; these alone are put together and divided. An array that is null
    or empty and a value that is null or not finite fail; arrays of a key have the same length. Without rows and ``by`` there is no row.
    """
    x = F.col("_x")
    sound = F.when(F.abs(x) < float("inf"), x).otherwise(F.raise_error(F.lit("an exact mean needs finite values")).cast("double"))
    long = df.select(*by, F.posexplode_outer(F.col(values).cast("array<double>")).alias("_place", "_x")).withColumn("_x", sound)
    band = F.greatest(F.coalesce(F.floor(F.log2(F.abs(x)) / BAND), F.lit(0)), F.lit(LOWEST)).cast("int")
    # half of the scale at a time, for a power of two above 2 ** 1023 is no double
    halves = F.array(*[F.lit(2.0 ** (-_unit(b) // 2)) for b in range(LOWEST, 34)])
    half = F.element_at(halves, F.col("_band") - LOWEST + 1)
    rest = long.withColumn("_band", band).withColumn("_half", half).withColumn("_rest", F.abs(x) * F.col("_half") * F.col("_half"))
    limbs = []
    for k in reversed(range(LIMBS)):
        limb = F.floor(F.col("_rest") / 2.0 ** (LIMB * k))
        rest = rest.withColumn(f"_l{k}", limb).withColumn("_rest", F.col("_rest") - F.col(f"_l{k}") * 2.0 ** (LIMB * k))
        limbs.append(F.sum(F.when(x < 0, -F.col(f"_l{k}")).otherwise(F.col(f"_l{k}"))).alias(f"_l{k}"))
    bands = rest.groupBy(*by, "_place", "_band").agg(*limbs, F.count("*").alias("_n"))
    parts = bands.groupBy(*by).agg(F.collect_list(F.struct("_place", "_band", "_n", *[f"_l{k}" for k in range(LIMBS)])).alias("_parts"))
    if not by:
        parts = parts.where(F.size("_parts") > 0)
    fields = [F.col("_parts")[f].alias(f) for f in ("_place", "_band", "_n", *[f"_l{k}" for k in range(LIMBS)])]

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def divided(places: pd.Series, bands: pd.Series, counts: pd.Series, *limbs: pd.Series) -> pd.Series:
        out = []
        for place, band, n, *cut in zip(places, bands, counts, *limbs, strict=True):
            totals, rows = [0] * (max(place) + 1), [0] * (max(place) + 1)
            for p, b, m, *own in zip(place, band, n, *cut, strict=True):
                totals[p] += sum(int(v) << (LIMB * k) for k, v in enumerate(own)) << (BAND * (int(b) - LOWEST))
                rows[p] += int(m)
            low = -_unit(LOWEST)
            out.append([t / (m << low) for t, m in zip(totals, rows, strict=True)])  # whole numbers divide with one rounding
        return pd.Series(out)

    return parts.select(*by, divided(*fields).alias(name))


def same_binary(a: Column, b: Column) -> Column:
    """Equal doubles, with null equal to null and NaN to NaN."""
    return a.eqNullSafe(b)
