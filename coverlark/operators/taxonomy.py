"""Trees of nodes: merged ids, and the nearest ancestor of a rank, by pointer doubling."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.state import keep


def _doubled(pointers: DataFrame, rounds: int) -> DataFrame:
    """(id, far, steps): where 2^rounds steps along (id, next) lead, or the end of the chain before that."""
    at = pointers.select("id", F.col("next").alias("far"), F.lit(1).cast("long").alias("steps"))
    for _ in range(rounds):
        ahead = at.select(F.col("id").alias("far"), F.col("far").alias("_far"), F.col("steps").alias("_steps"))
        at = keep(at.join(ahead, "far", "left").select("id", F.coalesce("_far", "far").alias("far"), (F.col("steps") + F.coalesce("_steps", F.lit(0))).alias("steps")))
    return at


def _rounds(df: DataFrame) -> int:
    return max(1, int(df.count()).bit_length())


def normalize_ids(ids: DataFrame, merged: DataFrame, deleted: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, current, status): ids through their chains of merges; MERGED_CYCLE, DELETED and MISSING ones have no current id.

    ``ids``: id; ``merged``: old, new; ``deleted``: id; ``nodes``: id. Chains of any length take log2 rounds.
    """
    pointers = merged.select(F.col("old").alias("id"), F.col("new").alias("next"))
    ends = _doubled(pointers, _rounds(pointers)).select("id", "far")
    found = ids.select("id").distinct().join(ends, "id", "left").select("id", F.coalesce("far", "id").alias("end"))
    flag = lambda df, c, name: df.select(F.col(c).alias("end"), F.lit(True).alias(name)).distinct()
    found = found.join(flag(merged, "old", "_merged"), "end", "left").join(flag(deleted, "id", "_deleted"), "end", "left").join(flag(nodes, "id", "_there"), "end", "left")
    status = F.when(F.col("_merged"), "MERGED_CYCLE").when(F.col("_deleted"), "DELETED").when(F.col("_there").isNull(), "MISSING").otherwise("PASS")
    return found.withColumn("status", status).select("id", F.when(F.col("status") == "PASS", F.col("end")).alias("current"), "status")


def ranked_ancestor(ids: DataFrame, nodes: DataFrame, rank: str = "species", root: int = 1) -> DataFrame:
    """(id, ancestor, status): the first node of ``rank`` from an id upwards, itself included.

    ``nodes``: id, parent, rank. Without one: NO_RANKED_ANCESTOR at the root, MISSING_NODE where the way leaves the table,
    LINEAGE_CYCLE where it never ends. Distinct ids are resolved once.
    """
    stops = (F.col("rank") == rank) | (F.col("id") == root)
    pointers = nodes.where(~F.coalesce(stops, F.lit(False))).select("id", F.col("parent").alias("next"))
    ends = _doubled(pointers, _rounds(pointers)).select("id", "far")
    found = ids.select("id").distinct().join(ends, "id", "left").select("id", F.coalesce("far", "id").alias("end"))
    found = found.join(nodes.select(F.col("id").alias("end"), F.col("rank").alias("_rank"), F.lit(True).alias("_there")), "end", "left")
    ranked = F.coalesce(F.col("_rank") == rank, F.lit(False))
    status = F.when(F.col("_there").isNull(), "MISSING_NODE").when(ranked, "PASS").when(F.col("end") == root, "NO_RANKED_ANCESTOR").otherwise("LINEAGE_CYCLE")
    return found.select("id", F.when(ranked, F.col("end")).alias("ancestor"), status.alias("status"))


def resolve(items: DataFrame, item: str, tax: str, merged: DataFrame, deleted: DataFrame, nodes: DataFrame) -> DataFrame:
    """(item, status, reason, species): PASS, or REVIEW_UNRESOLVED with the reason of the step that failed."""
    ids = items.select(F.col(tax).alias("id"))
    normal = normalize_ids(ids, merged, deleted, nodes).select(F.col("id").alias(tax), "current", F.col("status").alias("_first"))
    above = ranked_ancestor(normal.where("current is not null").select(F.col("current").alias("id")), nodes).select(F.col("id").alias("current"), "ancestor", F.col("status").alias("_second"))
    rows = items.join(normal, tax, "left").join(above, "current", "left")
    reason = F.when(F.col("_first") != "PASS", F.col("_first")).otherwise(F.coalesce("_second", F.lit("MISSING")))
    return rows.withColumn("reason", reason).select(item, F.when(F.col("reason") == "PASS", "PASS").otherwise("REVIEW_UNRESOLVED").alias("status"), "reason", F.col("ancestor").alias("species"))
