"""Tables that are published."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T


@F.pandas_udf(T.StringType())
def seventeen_digits(x: pd.Series) -> pd.Series:
    """A double as text with 17 significant digits, which reads back as the same double."""
    return x.map(lambda v: None if v is None or v != v else format(v, ".17g"))


def as_text(df: DataFrame) -> DataFrame:
    """All columns as text, doubles with 17 digits, for text sinks."""
    return df.select(*[seventeen_digits(c).alias(c) if kind == "double" else F.col(c).cast("string").alias(c) for c, kind in df.dtypes])


def write_ladder(ladder: DataFrame, path: str) -> None:
    """A ladder as one tab-separated file in the order of ranks; ladders are small."""
    as_text(ladder.orderBy("rank").coalesce(1)).write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def write_ids(ladder: DataFrame, item: str, path: str) -> None:
    """The ids alone, a line each, in the order of ranks."""
    ladder.orderBy("rank").coalesce(1).select(F.col(item).cast("string").alias("value")).write.mode("overwrite").text(path)


def distance_matrix(distances: DataFrame, item: str, sizes: list[int]) -> DataFrame:
    """One row an item, a column nearest_distance_n{N} a panel size."""
    wide = distances.groupBy(item).pivot("n", sizes).agg(F.first("distance"))
    return wide.select(item, *[F.col(str(n)).alias(f"nearest_distance_n{n}") for n in sizes])
