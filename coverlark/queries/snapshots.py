"""Reuse between snapshots, catalogues, manifests and published ladders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.keys import membership_hash
from ..operators import checks, incremental, panels
from ..sources import scans, sinks
from .base import query, table, vectors
from .panels import DISTANCES_SQL, PANEL_SQL, SIZES, _distances, _panel


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("item"), F.concat(F.lit("S"), F.col("o_custkey").cast("string")).alias("sample"), "o_orderstatus", "o_orderpriority", "o_totalprice")


def _cache(rows):
    return rows.where("item % 3 > 0").select("item", F.expr("if(item % 7 = 0, 'S-other', sample)").alias("sample"), F.expr("if(item % 5 = 0, 'old', 'now')").alias("verified_snapshot"))


@query("""WITH r AS (SELECT o_orderkey AS item, CASE WHEN o_orderkey % 3 = 0 THEN 'no_verified_cache' WHEN o_orderkey % 5 = 0 THEN 'cache_not_verified_for_current_snapshot' WHEN o_orderkey % 7 = 0 THEN 'cache_metadata_mismatch' END AS reason FROM orders)
SELECT item, CASE WHEN reason IS NULL THEN 'REUSE' ELSE 'FRESH' END AS action, reason FROM r""")
def incremental_plan(spark, sf_dir):
    rows = _orders(spark, sf_dir)
    return incremental.incremental_plan(rows.select("item", "sample"), _cache(rows), "item", "now")


@query("SELECT o_orderkey AS item, (row_number() OVER (ORDER BY o_orderkey) - 1) // 500 AS batch FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 5 = 0")
def fresh_batches(spark, sf_dir):
    rows = _orders(spark, sf_dir)
    plan = incremental.incremental_plan(rows.select("item", "sample"), _cache(rows), "item", "now")
    return incremental.batches(plan.where("action = 'FRESH' and reason <> 'cache_metadata_mismatch'").select("item"), "item", 500)


@query("""WITH r AS (SELECT o_orderkey AS item, CASE WHEN o_orderkey % 3 = 0 THEN 'not_in_cache' WHEN o_orderkey % 4 = 0 THEN 'cache_not_verified' WHEN o_orderkey % 5 = 0 THEN 'current_id_differs' WHEN o_orderstatus <> 'O' THEN 'status_not_current'
  WHEN o_orderpriority = '5-LOW' THEN 'level_differs' WHEN o_orderkey % 7 = 0 THEN 'expected_sample_differs' WHEN o_orderkey % 11 = 0 THEN 'observed_sample_differs' END AS reason FROM orders)
SELECT item, CASE WHEN reason IS NULL THEN 'REUSE' ELSE 'FRESH' END AS action, reason FROM r""")
def audited_cache_plan(spark, sf_dir):
    rows = _orders(spark, sf_dir)
    audit = rows.where("item % 3 > 0").select(
        "item", F.expr("item % 4 > 0").alias("verified"), F.expr("if(item % 5 = 0, item + 1, item)").alias("current_id"), F.expr("if(o_orderstatus = 'O', 'current', 'previous')").alias("status"),
        F.expr("if(o_orderpriority = '5-LOW', 'Contig', 'Complete Genome')").alias("level"), F.expr("if(item % 7 = 0, 'x', sample)").alias("expected_sample"), F.expr("if(item % 11 = 0, 'x', sample)").alias("observed_sample"),
    )
    return incremental.cache_plan(rows.select("item", "sample"), audit, "item")


def _tiers(spark, sf_dir):
    rows = _orders(spark, sf_dir)
    current = rows.select("item", F.col("o_orderpriority").alias("grp"), F.sha2("sample", 256).alias("identity"), "o_totalprice")
    first = current.where("item % 2 = 0").select("item", F.expr("if(item % 6 = 0, 'stale', identity)").alias("identity"), (F.col("o_totalprice") + 1).alias("x"))
    second = current.where("item % 3 = 0").select("item", "identity", (F.col("o_totalprice") + 2).alias("x"))
    fresh = current.where("item % 5 > 0").select("item", "identity", (F.col("o_totalprice") + 3).alias("x"))
    return current.drop("o_totalprice"), first, second, fresh


TIERS_SQL = """t AS (SELECT o_orderkey AS item, o_orderpriority AS grp, sha256('S' || o_custkey) AS identity, o_totalprice AS p, CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 6 <> 0 THEN 'tier_1' WHEN o_orderkey % 3 = 0 THEN 'tier_2' WHEN o_orderkey % 5 > 0 THEN 'fresh' ELSE 'missing' END AS provenance FROM orders)"""


@query(f"WITH {TIERS_SQL} SELECT item, grp, round(CASE provenance WHEN 'tier_1' THEN p + 1 WHEN 'tier_2' THEN p + 2 WHEN 'fresh' THEN p + 3 END, 4) AS x, provenance FROM t")
def tiered_features(spark, sf_dir):
    current, first, second, fresh = _tiers(spark, sf_dir)
    return incremental.merge_features(current, first, second, fresh, "item", ["x"]).withColumn("x", F.round("x", 4))


@query(f"WITH {TIERS_SQL} SELECT item, identity FROM t WHERE provenance IN ('fresh', 'missing')")
def features_to_compute(spark, sf_dir):
    current, first, second, _ = _tiers(spark, sf_dir)
    return incremental.to_compute(current, first, second, "item")


@query(f"WITH {TIERS_SQL} SELECT item, identity FROM t WHERE item % 5 > 0 AND provenance IN ('tier_1', 'tier_2')")
def unused_fresh_features(spark, sf_dir):
    current, first, second, fresh = _tiers(spark, sf_dir)
    return incremental.unused_fresh(current, first, second, fresh, "item")


@query("""WITH r AS (SELECT o_orderkey AS item, list_filter([CASE WHEN o_orderkey % 11 = 0 THEN 'missing' END, CASE WHEN o_orderkey % 13 = 0 AND o_orderkey % 11 <> 0 THEN 'unexpected' END,
  CASE WHEN o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0 AND o_orderkey % 7 = 0 THEN 'level_differs' END, CASE WHEN o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0 AND o_orderkey % 5 = 0 THEN 'sample_differs' END], lambda x: x IS NOT NULL) AS m
  FROM orders WHERE NOT (o_orderkey % 11 = 0 AND o_orderkey % 13 = 0))
SELECT item, array_to_string(list_sort(m), '|') AS mismatches FROM r WHERE len(m) > 0""")
def metadata_reconciliation(spark, sf_dir):
    rows = _orders(spark, sf_dir).select("item", "sample", F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("level"))
    observed = rows.where("item % 11 > 0").withColumn("sample", F.expr("if(item % 5 = 0, 'x', sample)")).withColumn("level", F.expr("if(item % 7 = 0, 'x', level)"))
    return incremental.reconcile_metadata(rows.where("item % 13 > 0"), observed, "item").withColumn("mismatches", F.array_join("mismatches", "|"))


@query("SELECT o_orderkey AS item, CASE WHEN o_orderkey % 17 = 0 THEN 'UNRESOLVED' WHEN o_orderkey % 5 = 0 THEN 'SUPERSEDED' ELSE 'CURRENT' END AS change FROM orders")
def snapshot_changes(spark, sf_dir):
    rows = _orders(spark, sf_dir)
    old = rows.where("item % 17 > 0").select("item", F.lit("current").alias("status"))
    new = rows.select("item", F.expr("if(item % 5 = 0, 'previous', 'current')").alias("status"))
    return incremental.snapshot_changes(rows, old, new, "item")


@query("""SELECT o_orderkey AS item, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS price, CASE WHEN o_orderkey % 3 > 0 THEN 'carried_forward' WHEN o_orderkey % 4 > 0 THEN 'replaced' ELSE 'new' END AS entry
FROM orders WHERE o_orderkey % 4 > 0 OR o_orderkey % 3 = 0""")
def catalogue_upsert(spark, sf_dir):
    rows = _orders(spark, sf_dir).select("item", F.col("o_totalprice").alias("price"))
    return incremental.upsert(rows.where("item % 4 > 0"), rows.where("item % 3 = 0").withColumn("price", F.col("price") + 1), "item")


@query("""WITH r AS (SELECT o_orderkey AS item, CASE WHEN o_orderkey % 3 = 0 THEN 'evidence_missing' WHEN o_orderkey % 5 = 0 THEN 'files_missing' WHEN o_orderkey % 7 = 0 THEN 'component_identity_missing' WHEN o_orderkey % 11 = 0 THEN 'sample_mismatch' WHEN o_orderkey % 13 = 0 THEN 'manifest_hash_mismatch' WHEN o_orderkey % 17 = 0 THEN 'record_hash_mismatch' END AS reason FROM orders)
SELECT item, CASE WHEN reason IS NULL THEN 'REUSE' ELSE 'FRESH' END AS action, reason FROM r""")
def cache_verification(spark, sf_dir):
    rows = _orders(spark, sf_dir).select("item", "sample", F.sha2("o_orderstatus", 256).alias("identity"), F.sha2("o_orderpriority", 256).alias("manifest_hash"), F.sha2("sample", 256).alias("record_hash"))
    seen = rows.where("item % 3 > 0").select("item", F.expr("if(item % 11 = 0, 'x', sample)").alias("sample"), F.expr("if(item % 7 = 0, null, identity)").alias("identity"), F.expr("if(item % 13 = 0, 'x', manifest_hash)").alias("manifest_hash"), F.expr("if(item % 17 = 0, 'x', record_hash)").alias("record_hash"), F.expr("if(item % 5 = 0, 0, 2)").alias("n_files"))
    return incremental.verify_cache(rows, seen, "item")


@query("SELECT o_orderkey AS item, 'S' || o_custkey AS sample FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey % 3 > 0")
def current_members(spark, sf_dir):
    rows = _orders(spark, sf_dir).select("item", "sample")
    return incremental.current_members(rows.where("item % 2 = 0"), rows.withColumn("sample", F.expr("if(item % 3 = 0, 'x', sample)")), "item")


def _manifest(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select((F.col("doc_id") % 20).alias("batch"), F.concat(F.lit("f/"), F.col("doc_id").cast("string")).alias("path"), F.octet_length("text").cast("long").alias("size"), F.sha2("text", 256).alias("sha256"), "doc_id")
    found = d.where("doc_id % 11 > 0").select(F.when(F.col("doc_id") % 19 == 0, F.concat("path", F.lit("x"))).otherwise(F.col("path")).alias("path"), (F.col("size") + F.when(F.col("doc_id") % 13 == 0, 1).otherwise(0)).alias("size"), F.when(F.col("doc_id") % 17 == 0, "x").otherwise(F.col("sha256")).alias("sha256"))
    return d.drop("doc_id"), found.unionByName(found.where("path like '%7'"))


MANIFEST_SQL = """e AS (SELECT doc_id, doc_id % 20 AS batch, 'f/' || doc_id AS path FROM documents),
audited AS (SELECT batch, path, CASE WHEN doc_id % 11 = 0 OR doc_id % 19 = 0 OR doc_id % 10 = 7 THEN 'missing_or_ambiguous_path' WHEN doc_id % 13 = 0 THEN 'size_mismatch' WHEN doc_id % 17 = 0 THEN 'sha256_mismatch' ELSE 'pass' END AS status FROM e
UNION ALL SELECT NULL, path || 'x', 'unexpected' FROM e WHERE doc_id % 11 > 0 AND doc_id % 19 = 0)"""


@query(f"WITH {MANIFEST_SQL} SELECT * FROM audited")
def manifest_audit(spark, sf_dir):
    return incremental.audit_manifest(*_manifest(spark, sf_dir))


@query(f"WITH {MANIFEST_SQL} SELECT batch, count(*) AS n_files, count(*) FILTER (status = 'pass') AS n_pass, count(*) = count(*) FILTER (status = 'pass') AS verified FROM audited GROUP BY 1")
def manifest_totals(spark, sf_dir):
    return incremental.audit_totals(incremental.audit_manifest(*_manifest(spark, sf_dir)))


@query("SELECT c_nationkey AS grp, sha256(string_agg(c_custkey::VARCHAR, chr(10) ORDER BY c_custkey::VARCHAR) || chr(10)) AS membership FROM customer GROUP BY 1")
def membership_hashes(spark, sf_dir):
    return table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("grp")).agg(membership_hash("c_custkey").alias("membership"))


@query("SELECT c_nationkey AS grp, sha256('nsspecies|' || string_agg(c_custkey::VARCHAR, chr(10) ORDER BY c_custkey::VARCHAR)) AS k FROM customer GROUP BY 1")
def group_tie_keys(spark, sf_dir):
    from ..functions.keys import member_key

    return table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("grp")).agg(member_key("c_custkey", "ns").alias("k"))


@query(f"WITH {PANEL_SQL} SELECT rank, CASE WHEN rank <= 10 THEN 10 WHEN rank <= 20 THEN 20 END AS first_panel_n, item, 'S' || item AS sample, 'organism ' || item % 7 AS organism, item % 50 AS group_id, 'group ' || item % 50 AS group_name FROM panel WHERE rank <= 20")
def metadata_ladder(spark, sf_dir):
    items = vectors(spark, sf_dir)
    key = F.col("item").cast("string")
    groups = items.select("item", F.col("grp").alias("group_id"))
    records = items.select("item", F.concat(F.lit("S"), key).alias("sample"), F.concat(F.lit("organism "), (F.col("item") % 7).cast("string")).alias("organism"))
    names = items.select(F.col("grp").alias("group_id"), F.concat(F.lit("group "), F.col("grp").cast("string")).alias("group_name")).distinct()
    return panels.metadata_ladder(_panel(spark, sf_dir), groups, records, names, "item")


@query(f"WITH {PANEL_SQL} SELECT rank, item FROM panel WHERE rank <= 15")
def custom_panel(spark, sf_dir):
    return panels.panel(_panel(spark, sf_dir), 15)


@query(f"WITH {DISTANCES_SQL} SELECT item, {', '.join(f'round(max(distance) FILTER (n = {n}), 9) AS nearest_distance_n{n}' for n in SIZES)} FROM distances GROUP BY 1")
def distance_matrix(spark, sf_dir):
    m = sinks.distance_matrix(_distances(spark, sf_dir), "item", SIZES)
    return m.select("item", *[F.round(c, 9).alias(c) for c in m.columns[1:]])


@query("SELECT o_orderkey AS item, o_totalprice AS price FROM orders")
def binary64_text(spark, sf_dir):
    """Prices written as text with 17 digits and read back."""
    text = sinks.as_text(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("item"), F.col("o_totalprice").alias("price")))
    return text.select(F.col("item").cast("long"), F.col("price").cast("double"))


@query("SELECT o_orderkey AS item, o_custkey AS owner, 'right' AS missing_from FROM orders WHERE o_orderkey % 10 = 0 UNION ALL SELECT o_orderkey, o_custkey, 'left' FROM orders WHERE o_orderkey % 7 = 0 AND o_orderkey % 10 > 0 AND o_orderstatus = 'F'")
def table_difference(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("item"), F.col("o_custkey").alias("owner"), "o_orderstatus")
    left = rows.where("not (item % 7 = 0 and item % 10 > 0 and o_orderstatus = 'F')").drop("o_orderstatus")
    return checks.set_difference(left, rows.where("item % 10 > 0").drop("o_orderstatus"))


def _fasta(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.concat(F.lit(">d"), F.col("doc_id").cast("string"), F.lit(" a description\n"), F.regexp_replace(F.translate(F.lower("text"), "abcdefghijklmnopqrstuvwxyz", ("acgt" * 7)[:26]), "[^acgt\n]", ""), F.lit("A\n")).alias("value"))


@query(r"""SELECT 'd' || doc_id AS component, sha256(upper(regexp_replace(translate(lower(text), 'abcdefghijklmnopqrstuvwxyz', 'acgtacgtacgtacgtacgtacgtac'), '[^acgt]', '', 'g')) || 'A') AS hash FROM documents""")
def fasta_records(spark, sf_dir):
    return scans.parse_fasta(_fasta(spark, sf_dir)).select("component", F.sha2("sequence", 256).alias("hash"))


@query(r"""SELECT 'd' || doc_id || '.1' AS component, length(s) AS declared_length, CASE WHEN doc_id % 2 = 0 THEN 'linear' ELSE 'circular' END AS topology, 'record ' || doc_id || ' complete' AS definition, sha256(s) AS hash
FROM (SELECT doc_id, upper(regexp_replace(translate(lower(text), 'abcdefghijklmnopqrstuvwxyz', 'acgtacgtacgtacgtacgtacgtac'), '[^acgt]', '', 'g')) || 'A' AS s FROM documents)""")
def flat_file_records(spark, sf_dir):
    rows = scans.parse_fasta(_fasta(spark, sf_dir)).select("component", "sequence", F.substring("component", 2, 20).cast("long").alias("k"))
    text = F.concat(
        F.lit("LOCUS       x "), F.char_length("sequence").cast("string"), F.lit(" bp    DNA     "), F.expr("if(k % 2 = 0, 'linear', 'circular')"), F.lit("   BCT\nDEFINITION  record "), F.col("k").cast("string"),
        F.lit("\n            complete\nACCESSION   x\nVERSION     "), F.col("component"), F.lit(".1\nFEATURES\nORIGIN\n        1 "), F.regexp_replace(F.lower("sequence"), "(.{10})", "$1 "), F.lit("\n"),
    )
    return scans.parse_flat(rows.select(text.alias("value"))).select("component", "declared_length", "topology", "definition", F.sha2("sequence", 256).alias("hash"))


@query("SELECT c_custkey + 1000 AS id, c_nationkey + 100 AS parent, lower(c_mktsegment) AS rank FROM customer")
def taxonomy_dump(spark, sf_dir):
    line = F.concat_ws("\t|\t", (F.col("c_custkey") + 1000).cast("string"), (F.col("c_nationkey") + 100).cast("string"), F.lower("c_mktsegment"), F.lit("more\t|"))
    rows = scans.parse_dump(table(spark, sf_dir, "customer").select(line.alias("value")), ["id", "parent", "rank"])
    return rows.select(F.col("id").cast("long"), F.col("parent").cast("long"), "rank")


@query("SELECT 'G' || o_custkey AS item, 'C' || o_orderkey AS component, o_totalprice::BIGINT AS length, o_orderstatus AS molecule_class FROM (SELECT * REPLACE (floor(o_totalprice) AS o_totalprice) FROM orders) WHERE o_orderpriority <> '1-URGENT'")
def sequence_report(spark, sf_dir):
    record = F.struct(F.concat(F.lit("G"), F.col("o_custkey").cast("string")).alias("assembly_accession"), F.concat(F.lit("C"), F.col("o_orderkey").cast("string")).alias("genbank_accession"), F.floor("o_totalprice").alias("length"), F.col("o_orderstatus").alias("assigned_molecule_location_type"), F.expr("if(o_orderpriority = '1-URGENT', 'Other', 'Primary Assembly')").alias("assembly_unit"))
    return scans.parse_sequence_report(table(spark, sf_dir, "orders").select(F.to_json(record).alias("value")))
