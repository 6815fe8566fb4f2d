"""Gates that fail a batch. Each is one aggregate or one limited read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


class BadInput(ValueError):
    """Input that an operator refuses."""


def require_clean(df: DataFrame, not_null: list[str] = (), finite: list[str] = (), filled: list[str] = ()) -> DataFrame:
    """Fails if any row has a null in ``not_null``, a null, NaN or infinity in ``finite``, or null or "" in ``filled``."""
    bad: dict[str, Column] = {f"null {c}": F.col(c).isNull() for c in not_null}
    bad |= {f"not finite {c}": F.col(c).isNull() | F.isnan(F.col(c).cast("double")) | (F.abs(F.col(c).cast("double")) == float("inf")) for c in finite}
    bad |= {f"empty {c}": F.coalesce(F.col(c).cast("string"), F.lit("")) == "" for c in filled}
    row = df.agg(F.count("*").alias("rows"), *[F.count_if(c).alias(f"b{i}") for i, c in enumerate(bad.values())]).first()
    if not row["rows"]:
        raise BadInput("no rows")
    found = {name: row[f"b{i}"] for i, name in enumerate(bad) if row[f"b{i}"]}
    if found:
        raise BadInput(str(found))
    return df


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def require_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    if row := duplicates(df, keys).limit(1).first():
        raise BadInput(f"repeated key {row.asDict()}")
    return df


def require_rows(df: DataFrame, expected: int) -> DataFrame:
    if (n := df.count()) != expected:
        raise BadInput(f"{n} rows; {expected} expected")
    return df


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of either table that the other lacks, repeats counted, with the side they are missing from."""
    return left.exceptAll(right).withColumn("missing_from", F.lit("right")).unionByName(right.exceptAll(left).withColumn("missing_from", F.lit("left")))


def require_same(left: DataFrame, right: DataFrame) -> None:
    if row := set_difference(left, right).limit(1).first():
        raise BadInput(f"tables differ: {row.asDict()}")
