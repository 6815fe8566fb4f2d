"""What a new snapshot can reuse of an earlier one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.prefix import BUCKETS
from .eligibility import reasons


def first_failure(checks: list[tuple[str, Column]]) -> Column:
    """The name of the first condition that does not hold (null counts as not), or null."""
    return reduce(lambda rest, c: F.when(~F.coalesce(c[1], F.lit(False)), F.lit(c[0])).otherwise(rest), reversed(checks), F.lit(None).cast("string"))


def batches(df: DataFrame, item: str, size: int = 500, buckets: int = BUCKETS) -> DataFrame:
    """Adds batch: items in order, ``size`` to a batch from 0. Positions come from counts of ranges, so no task sorts all items."""
    if df.schema[item].dataType.typeName() in ("long", "integer"):
        cuts = [i / buckets for i in range(1, buckets)]
        bounds = df.agg(F.percentile_approx(item, cuts, 1000).alias("_b"))
        placed = df.join(F.broadcast(bounds)).withColumn("_bucket", F.size(F.filter("_b", lambda b: b < F.col(item)))).drop("_b")
    else:
        placed = df.withColumn("_bucket", F.substring(F.col(item).cast("string"), 1, 6))
    totals = placed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    offsets = totals.withColumn("_offset", F.coalesce(F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(item))
    numbered = placed.withColumn("_k", within).join(F.broadcast(offsets), "_bucket")
    return numbered.withColumn("batch", F.floor((F.col("_k") + F.col("_offset") - 1) / size).cast("int")).drop("_k", "_offset", "_bucket")


def incremental_plan(retained: DataFrame, cache: DataFrame, item: str, snapshot: str) -> DataFrame:
    """(item, action, reason): REUSE what is verified for this snapshot and agrees, FRESH all else.

    ``retained``: item, sample; ``cache``: item, sample, verified_snapshot.
    """
    c = cache.select(item, F.col("sample").alias("_sample"), "verified_snapshot", F.lit(True).alias("_there"))
    why = first_failure([
        ("no_verified_cache", F.col("_there")),
        ("cache_not_verified_for_current_snapshot", F.col("verified_snapshot") == snapshot),
        ("cache_metadata_mismatch", F.col("_sample") == F.col("sample")),
    ])
    return retained.join(c, item, "left").withColumn("reason", why).select(item, F.when(F.col("reason").isNull(), "REUSE").otherwise("FRESH").alias("action"), "reason")


def cache_plan(retained: DataFrame, audit: DataFrame, item: str) -> DataFrame:
    """(item, action, reason): the plan by an ordered list of conditions on an audit of cached records.

    ``retained``: item, sample; ``audit``: item, verified, current_id, status, level, expected_sample, observed_sample.
    """
    a = audit.withColumn("_there", F.lit(True))
    why = first_failure([
        ("not_in_cache", F.col("_there")),
        ("cache_not_verified", F.col("verified")),
        ("current_id_differs", F.col("current_id") == F.col(item)),
        ("status_not_current", F.col("status") == "current"),
        ("level_differs", F.col("level") == "Complete Genome"),
        ("expected_sample_differs", F.col("expected_sample") == F.col("sample")),
        ("observed_sample_differs", F.col("observed_sample") == F.col("sample")),
    ])
    return retained.join(a, item, "left").withColumn("reason", why).select(item, F.when(F.col("reason").isNull(), "REUSE").otherwise("FRESH").alias("action"), "reason")


def merge_features(current: DataFrame, first: DataFrame, second: DataFrame, fresh: DataFrame, item: str, features: list[str]) -> DataFrame:
    """(item, group, features, provenance): tier 1 if its identity agrees, else tier 2, else freshly computed.

    ``current``: item, grp, identity; the others: item, identity, features. The current group always holds. Items that no
    tier has get provenance "missing": ``to_compute`` lists them.
    """
    keys = [item, "identity"]
    rows = current
    for name, tier in (("_1", first), ("_2", second), ("_3", fresh)):
        rows = rows.join(tier.select(*keys, F.struct(*features).alias(name)), keys, "left")
    chosen = F.coalesce("_1", "_2", "_3")
    source = F.when(F.col("_1").isNotNull(), "tier_1").when(F.col("_2").isNotNull(), "tier_2").when(F.col("_3").isNotNull(), "fresh").otherwise("missing")
    return rows.withColumn("_f", chosen).select(item, "grp", *[F.col(f"_f.{f}").alias(f) for f in features], source.alias("provenance"))


def to_compute(current: DataFrame, first: DataFrame, second: DataFrame, item: str) -> DataFrame:
    """Items whose features neither tier has."""
    keys = [item, "identity"]
    return current.join(first, keys, "left_anti").join(second, keys, "left_anti").select(*keys)


def unused_fresh(current: DataFrame, first: DataFrame, second: DataFrame, fresh: DataFrame, item: str) -> DataFrame:
    """Fresh rows that nothing asked for; a batch with any fails."""
    return fresh.select(item, "identity").join(to_compute(current, first, second, item), [item, "identity"], "left_anti")


def reconcile_metadata(targets: DataFrame, observed: DataFrame, item: str) -> DataFrame:
    """(item, mismatches): targets and observed records that differ in membership, sample, status or level."""
    a = targets.select(item, F.struct("sample", "status", "level").alias("_t"))
    b = observed.select(item, F.struct("sample", "status", "level").alias("_o"))
    both = F.col("_t").isNotNull() & F.col("_o").isNotNull()
    checks = {"missing": F.col("_o").isNull(), "unexpected": F.col("_t").isNull()} | {f"{c}_differs": both & ~F.col(f"_t.{c}").eqNullSafe(F.col(f"_o.{c}")) for c in ("sample", "status", "level")}
    return a.join(b, item, "full").select(item, reasons(checks).alias("mismatches")).where(F.size("mismatches") > 0)


def snapshot_changes(targets: DataFrame, old: DataFrame, new: DataFrame, item: str) -> DataFrame:
    """(item, change): targets that were current and are still CURRENT, or are SUPERSEDED; UNRESOLVED changes fail a batch."""
    rows = targets.select(item).join(old.select(item, F.col("status").alias("_old")), item, "left").join(new.select(item, F.col("status").alias("_new")), item, "left")
    change = F.when((F.col("_old") == "current") & (F.col("_new") == "current"), "CURRENT").when((F.col("_old") == "current") & (F.col("_new") == "previous"), "SUPERSEDED").otherwise("UNRESOLVED")
    return rows.select(item, change.alias("change"))


def upsert(previous: DataFrame, batch: DataFrame, item: str) -> DataFrame:
    """The catalogue after a batch, with entry: carried_forward, replaced or new."""
    known = previous.select(item, F.lit(True).alias("_known"))
    fresh = batch.join(known, item, "left").withColumn("entry", F.when(F.col("_known"), "replaced").otherwise("new")).drop("_known")
    return previous.join(batch, item, "left_anti").withColumn("entry", F.lit("carried_forward")).unionByName(fresh)


def verify_cache(expected: DataFrame, evidence: DataFrame, item: str) -> DataFrame:
    """(item, action, reason): reuse a cached item if its evidence agrees in all of a fixed order of checks.

    ``expected``: item, sample, identity, manifest_hash, record_hash; ``evidence`` the same, observed, and n_files.
    """
    names = ["sample", "identity", "manifest_hash", "record_hash"]
    e = evidence.select(item, "n_files", *[F.col(c).alias(f"_{c}") for c in names], F.lit(True).alias("_there"))
    why = first_failure([
        ("evidence_missing", F.col("_there")),
        ("files_missing", F.col("n_files") > 0),
        ("component_identity_missing", F.col("_identity").isNotNull()),
        *[(f"{c}_mismatch", F.col(f"_{c}") == F.col(c)) for c in names],
    ])
    return expected.join(e, item, "left").withColumn("reason", why).select(item, F.when(F.col("reason").isNull(), "REUSE").otherwise("FRESH").alias("action"), "reason")


def current_members(catalogue: DataFrame, retained: DataFrame, item: str) -> DataFrame:
    """Catalogue rows of this snapshot's retained items with the same sample."""
    return catalogue.join(retained.select(item, "sample"), [item, "sample"])


def audit_manifest(expected: DataFrame, found: DataFrame) -> DataFrame:
    """(batch, path, status): pass, size_mismatch, sha256_mismatch, missing_or_ambiguous_path, or unexpected for unlisted files.

    ``expected``: batch, path, size, sha256; ``found``: path, size, sha256, which may list a path more than once.
    """
    once = found.groupBy("path").agg(F.count("*").alias("_n"), F.first("size").alias("_size"), F.first("sha256").alias("_sha"))
    status = F.when(F.col("_want").isNull(), "unexpected").when(F.coalesce("_n", F.lit(0)) != 1, "missing_or_ambiguous_path").when(F.col("size") != F.col("_size"), "size_mismatch").when(F.col("sha256") != F.col("_sha"), "sha256_mismatch").otherwise("pass")
    return expected.withColumn("_want", F.lit(True)).join(once, "path", "full").select("batch", "path", status.alias("status"))


def audit_totals(audited: DataFrame) -> DataFrame:
    """(batch, n_files, n_pass, verified)."""
    return audited.groupBy("batch").agg(F.count("*").alias("n_files"), F.count_if(F.col("status") == "pass").alias("n_pass")).withColumn("verified", F.col("n_files") == F.col("n_pass"))
