"""Panels: prefixes of a ladder, and what is published with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .checks import BadInput

SIZES = (10, 20, 50, 100, 200, 500)


def first_panel(rank: Column, sizes: tuple[int, ...] = SIZES) -> Column:
    """The smallest panel size that holds a rank, or null."""
    return F.coalesce(*[F.when(rank <= n, F.lit(n)) for n in sorted(sizes)])


def panel(ladder: DataFrame, n: int, low: int = 10, high: int = 500) -> DataFrame:
    """The first ``n`` of a ladder; fails if n is out of bounds or the ladder is too short."""
    if not low <= n <= high:
        raise BadInput(f"a panel of {n}; {low} to {high} are allowed")
    rows = ladder.where(F.col("rank") <= n)
    if (found := rows.count()) != n:
        raise BadInput(f"the ladder has {found} of {n} ranks")
    return rows


def metadata_ladder(ladder: DataFrame, groups: DataFrame, records: DataFrame, names: DataFrame, item: str) -> DataFrame:
    """A ladder joined to its groups (item, group_id), records (item, sample, organism) and names (group_id, group_name).

    An item without any of them fails when its row is made.
    """
    rows = ladder.select("rank", item).join(groups, item, "left").join(records, item, "left").join(names, "group_id", "left")
    whole = F.col("group_id").isNotNull() & F.col("sample").isNotNull() & F.col("group_name").isNotNull()
    checked = F.when(whole, F.col("rank")).otherwise(F.raise_error(F.concat(F.lit("incomplete metadata of "), F.col(item).cast("string"))).cast("int"))
    return rows.select(checked.alias("rank"), first_panel(F.col("rank")).alias("first_panel_n"), item, "sample", "organism", "group_id", "group_name")
