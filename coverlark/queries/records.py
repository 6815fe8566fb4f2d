"""Eligibility, reconciliation and taxonomy."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import eligibility, taxonomy
from ..sources import scans
from .base import query, table


def _records(spark, sf_dir):
    """Source records as JSON text, a record an event; keys decide what is wrong with which."""
    e = table(spark, sf_dir, "events")
    acc = F.expr("concat('GCA_', event_id, if(event_id % 11 = 0, '', '.1'))")
    warnings = F.expr("case when event_id % 29 = 0 then array(' Chimeric\t') when event_id % 31 = 0 then array('other', cast(null as string)) when event_id % 37 = 0 then array('Fine', 'CONTAMINATED') end")
    info = F.struct(
        F.expr("if(event_id % 5 = 0, 'previous', 'current')").alias("assembly_status"),
        F.expr("if(user_id % 3 = 0, 'Contig', 'Complete Genome')").alias("assembly_level"),
        F.expr("case when event_id % 19 = 0 then null else named_struct('accession', if(event_id % 23 = 0, 'BAD', concat('SAMN', user_id))) end").alias("biosample"),
        F.when(warnings.isNotNull(), F.struct(warnings.alias("warnings"))).alias("atypical"),
    )
    record = F.struct(
        acc.alias("accession"),
        F.when(F.col("event_id") % 13 == 0, "x").otherwise(acc).alias("current_accession"),
        F.expr("if(user_id % 7 = 0, 'REFSEQ', 'SOURCE_DATABASE_GENBANK')").alias("source_database"),
        F.when(F.col("event_id") % 17 != 0, info).alias("assembly_info"),
    )
    return e.select(F.to_json(record, {"ignoreNullFields": "false"}).alias("value"))


def _assessed(spark, sf_dir):
    return eligibility.assess_metadata(scans.parse_records(_records(spark, sf_dir)))


ASSESSED_SQL = r"""r AS (SELECT event_id AS e, user_id AS u, 'GCA_' || event_id || CASE WHEN event_id % 11 = 0 THEN '' ELSE '.1' END AS accession FROM events),
a AS (SELECT accession, e % 17 = 0 AS missing,
  CASE WHEN e % 17 <> 0 AND e % 19 <> 0 AND e % 23 <> 0 THEN 'SAMN' || u END AS sample,
  CASE WHEN e % 29 <> 0 AND e % 31 = 0 THEN ['atypical_warning_non_string'] ELSE [] END AS opens,
  list_filter([CASE WHEN e % 11 = 0 THEN 'invalid_canonical_GCA_accession' END, CASE WHEN e % 13 = 0 THEN 'current_accession_mismatch' END, CASE WHEN u % 7 = 0 THEN 'source_database_not_GenBank' END,
    CASE WHEN e % 5 = 0 THEN 'assembly_status_not_current' END, CASE WHEN u % 3 = 0 THEN 'assembly_level_not_Complete_Genome' END, CASE WHEN e % 19 = 0 THEN 'biosample_object_missing_or_malformed' END,
    CASE WHEN e % 19 <> 0 AND e % 23 = 0 THEN 'biosample_accession_missing_or_malformed' END, CASE WHEN e % 29 = 0 THEN 'automatic_atypical_exclusion:chimeric' END,
    CASE WHEN e % 29 <> 0 AND e % 31 <> 0 AND e % 37 = 0 THEN 'automatic_atypical_exclusion:contaminated' END], lambda x: x IS NOT NULL) AS outs,
  CASE WHEN e % 29 = 0 THEN 'chimeric' WHEN e % 31 = 0 THEN 'other' WHEN e % 37 = 0 THEN 'fine|contaminated' ELSE '' END AS warnings FROM r),
assessed AS (SELECT accession, sample, CASE WHEN missing OR len(opens) > 0 THEN 'WITHHOLD_UNRESOLVED' WHEN len(outs) > 0 THEN 'EXCLUDE_METADATA' ELSE 'RETAIN_METADATA' END AS decision,
  CASE WHEN missing THEN 'assembly_info_missing_or_malformed' ELSE array_to_string(list_sort(list_concat(opens, outs)), '|') END AS reasons, CASE WHEN missing THEN '' ELSE warnings END AS normalized_warnings FROM a)"""


@query(f"WITH {ASSESSED_SQL} SELECT * FROM assessed")
def metadata_eligibility(spark, sf_dir):
    rows = _assessed(spark, sf_dir)
    return rows.withColumns({c: F.array_join(c, "|") for c in ("reasons", "normalized_warnings")})


@query(f"""WITH {ASSESSED_SQL} SELECT 'decision' AS kind, decision AS value, count(*) AS n FROM assessed GROUP BY 2
UNION ALL SELECT 'reason', x, count(*) FROM (SELECT unnest(string_split(reasons, '|')) AS x FROM assessed WHERE reasons <> '') GROUP BY 2
UNION ALL SELECT 'warning', x, count(*) FROM (SELECT unnest(string_split(normalized_warnings, '|')) AS x FROM assessed WHERE normalized_warnings <> '') GROUP BY 2""")
def metadata_summary(spark, sf_dir):
    return eligibility.counts(_assessed(spark, sf_dir), decision="decision", reason="reasons", warning="normalized_warnings")


@query("SELECT o_custkey, count(*) AS n_rows FROM orders GROUP BY 1 HAVING count(*) > 1")
def repeated_keys(spark, sf_dir):
    from ..operators.checks import duplicates

    return duplicates(table(spark, sf_dir, "orders"), ["o_custkey"])


def _members(spark, sf_dir):
    """Documents as items; a sample is a source and language, a fingerprint that of the text."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("item"), F.concat_ws("/", F.col("source"), F.col("lang"), (F.col("doc_id") % 97).cast("string")).alias("sample"), F.expr("case when n_chars % 11 = 0 then 'EXCLUDE' when n_chars % 13 = 0 then 'REVIEW_UNRESOLVED' else 'SUITABLE' end").alias("truth_status"), F.sha2("text", 256).alias("fingerprint"))


MEMBERS_SQL = """members AS (SELECT doc_id AS item, source || '/' || lang || '/' || (doc_id % 97) AS sample, CASE WHEN n_chars % 11 = 0 THEN 'EXCLUDE' WHEN n_chars % 13 = 0 THEN 'REVIEW_UNRESOLVED' ELSE 'SUITABLE' END AS truth_status, sha256(text) AS fingerprint FROM documents),
groups AS (SELECT sample, count(*) AS n, min(item) AS first, count(DISTINCT fingerprint) AS f FROM members WHERE truth_status = 'SUITABLE' GROUP BY 1),
reasons AS (SELECT item, truth_status, CASE WHEN truth_status = 'EXCLUDE' THEN 'SOURCE_TRUTH_EXCLUDED' WHEN truth_status <> 'SUITABLE' THEN 'SOURCE_TRUTH_UNRESOLVED' WHEN n = 1 THEN 'SAMPLE_SINGLETON' WHEN f > 1 THEN 'SAMPLE_FINGERPRINTS_DIFFER' WHEN item = first THEN 'SAMPLE_IDENTICAL_REPRESENTATIVE' ELSE 'SAMPLE_IDENTICAL_NONREPRESENTATIVE' END AS reason FROM members LEFT JOIN groups USING (sample)),
samples AS (SELECT item, truth_status, CASE WHEN reason LIKE 'SOURCE_TRUTH%' THEN 'NOT_APPLICABLE' WHEN reason = 'SAMPLE_FINGERPRINTS_DIFFER' THEN 'REVIEW_UNRESOLVED' WHEN reason = 'SAMPLE_IDENTICAL_NONREPRESENTATIVE' THEN 'NONREPRESENTATIVE' ELSE 'CONTINUE' END AS status, reason FROM reasons)"""


@query(f"WITH {MEMBERS_SQL} SELECT item, status, reason FROM samples")
def sample_reconciliation(spark, sf_dir):
    return eligibility.reconcile_samples(_members(spark, sf_dir), "item", "sample")


def _composed(spark, sf_dir):
    m = _members(spark, sf_dir)
    truth = m.select("item", F.col("truth_status").alias("status"), F.lower("truth_status").alias("reason"))
    integrity = m.select("item", F.expr("case when item % 7 = 0 then 'EXCLUDE' when item % 5 = 0 then 'REVIEW_UNRESOLVED' else 'PASS' end").alias("status"), F.lit("integrity").alias("reason"))
    tax = m.select("item", F.expr("if(item % 3 = 0, 'REVIEW_UNRESOLVED', 'PASS')").alias("status"), F.lit("tax").alias("reason"), (F.col("item") % 10).alias("species"))
    return eligibility.compose(truth, eligibility.reconcile_samples(m, "item", "sample"), integrity, tax, "item")


COMPOSED_SQL = MEMBERS_SQL + """,
composed AS (SELECT item,
  CASE WHEN truth_status = 'EXCLUDE' THEN 'EXCLUDED' WHEN truth_status <> 'SUITABLE' THEN 'WITHHELD_UNRESOLVED' WHEN status = 'NONREPRESENTATIVE' THEN 'NONREPRESENTATIVE' WHEN status <> 'CONTINUE' THEN 'WITHHELD_UNRESOLVED'
       WHEN item % 7 = 0 THEN 'EXCLUDED' WHEN item % 5 = 0 THEN 'WITHHELD_UNRESOLVED' WHEN item % 3 = 0 THEN 'WITHHELD_UNRESOLVED' ELSE 'ELIGIBLE' END AS disposition,
  CASE WHEN truth_status <> 'SUITABLE' THEN 'source_truth' WHEN status <> 'CONTINUE' THEN 'repeated_sample' WHEN item % 7 = 0 OR item % 5 = 0 THEN 'integrity' WHEN item % 3 = 0 THEN 'taxonomy' ELSE 'eligible' END AS layer,
  CASE WHEN truth_status <> 'SUITABLE' THEN truth_status WHEN status <> 'CONTINUE' THEN status WHEN item % 7 = 0 THEN 'EXCLUDE' WHEN item % 5 = 0 OR item % 3 = 0 THEN 'REVIEW_UNRESOLVED' ELSE 'PASS' END AS status,
  CASE WHEN truth_status <> 'SUITABLE' THEN lower(truth_status) WHEN status <> 'CONTINUE' THEN reason WHEN item % 7 = 0 OR item % 5 = 0 THEN 'integrity' WHEN item % 3 = 0 THEN 'tax' ELSE 'POST_SEQUENCE_ELIGIBLE' END AS reason,
  CASE WHEN truth_status = 'SUITABLE' AND status = 'CONTINUE' AND item % 7 <> 0 AND item % 5 <> 0 AND item % 3 <> 0 THEN item % 10 END AS species FROM samples)"""


@query(f"WITH {COMPOSED_SQL} SELECT * FROM composed")
def terminal_composition(spark, sf_dir):
    return _composed(spark, sf_dir)


@query(f"WITH {COMPOSED_SQL} SELECT disposition, count(*) AS n FROM composed GROUP BY ROLLUP (disposition)")
def disposition_accounting(spark, sf_dir):
    return eligibility.disposition_totals(_composed(spark, sf_dir))


@query(f"WITH {COMPOSED_SQL} SELECT item, species AS grp FROM composed WHERE disposition = 'ELIGIBLE'")
def eligible_universe(spark, sf_dir):
    return eligibility.eligible_universe(_composed(spark, sf_dir), "item")


@query(f"WITH {MEMBERS_SQL} SELECT item, sample FROM members WHERE truth_status = 'SUITABLE'")
def stage_population(spark, sf_dir):
    return eligibility.continuing(_members(spark, sf_dir), "truth_status", "SUITABLE").select("item", "sample")


def _tree(spark, sf_dir):
    """The root, regions, nations (the species) and customers below them; some ids merged, deleted or without a parent."""
    r, n, c = (table(spark, sf_dir, t) for t in ("region", "nation", "customer"))
    nodes = (
        spark.range(1).select(F.lit(1).cast("long").alias("id"), F.lit(1).cast("long").alias("parent"), F.lit("no rank").alias("rank"))
        .unionByName(r.select((F.col("r_regionkey") + 10).cast("long").alias("id"), F.lit(1).cast("long").alias("parent"), F.lit("genus").alias("rank")))
        .unionByName(n.select((F.col("n_nationkey") + 100).cast("long").alias("id"), (F.col("n_regionkey") + 10).cast("long").alias("parent"), F.lit("species").alias("rank")))
        .unionByName(c.select((F.col("c_custkey") + 1000).cast("long").alias("id"), F.expr("case when c_custkey % 41 = 0 then 999 when c_custkey % 43 = 0 then 10 when c_custkey % 47 = 0 then c_custkey + 1000 else c_nationkey + 100 end").cast("long").alias("parent"), F.lit("strain").alias("rank")))
    )
    key = F.col("c_custkey").cast("long")
    merged = c.where("c_custkey % 10 = 0").select(F.explode(F.array(F.struct((key + 10_000_000).alias("old"), (key + 1000).alias("new")), F.struct((key + 20_000_000).alias("old"), (key + 10_000_000).alias("new")), F.struct((key + 30_000_000).alias("old"), (key + 30_000_001).alias("new")), F.struct((key + 30_000_001).alias("old"), (key + 30_000_000).alias("new")))).alias("x")).select("x.*")
    deleted = c.where("c_custkey % 50 = 1").select((key + 40_000_000).alias("id"))
    items = c.select(F.col("c_custkey").alias("item"), F.explode(F.array(*[key + k for k in (1000, 10_000_000, 20_000_000, 30_000_000, 40_000_000)])).alias("tax"))
    return items, merged, deleted, nodes


TREE_SQL = """asked AS (SELECT c_custkey AS item, c_custkey::BIGINT + k AS tax, k FROM customer, (SELECT unnest([1000, 10000000, 20000000, 30000000, 40000000]) AS k)),
normal AS (SELECT a.item, a.tax, CASE WHEN k = 1000 THEN 'PASS' WHEN k IN (10000000, 20000000) AND item % 10 = 0 THEN 'PASS' WHEN k = 30000000 AND item % 10 IN (0, 1) THEN 'MERGED_CYCLE' WHEN k = 40000000 AND item % 50 = 1 THEN 'DELETED' ELSE 'MISSING' END AS status FROM asked a),
above AS (SELECT c_custkey AS item, CASE WHEN c_custkey % 41 = 0 THEN 'MISSING_NODE' WHEN c_custkey % 43 = 0 THEN 'NO_RANKED_ANCESTOR' WHEN c_custkey % 47 = 0 THEN 'LINEAGE_CYCLE' ELSE 'PASS' END AS status, c_nationkey + 100 AS species FROM customer)"""


@query(f"""WITH {TREE_SQL} SELECT n.tax AS id, CASE WHEN n.status = 'PASS' THEN n.item + 1000 END AS current, n.status FROM normal n""")
def merged_ids(spark, sf_dir):
    items, merged, deleted, nodes = _tree(spark, sf_dir)
    return taxonomy.normalize_ids(items.select(F.col("tax").alias("id")), merged, deleted, nodes)


@query("""WITH RECURSIVE nodes AS (
  SELECT 1 AS id, 1 AS parent, 'no rank' AS rank UNION ALL SELECT r_regionkey + 10, 1, 'genus' FROM region UNION ALL SELECT n_nationkey + 100, n_regionkey + 10, 'species' FROM nation
  UNION ALL SELECT c_custkey + 1000, CASE WHEN c_custkey % 41 = 0 THEN 999 WHEN c_custkey % 43 = 0 THEN 10 WHEN c_custkey % 47 = 0 THEN c_custkey + 1000 ELSE c_nationkey + 100 END, 'strain' FROM customer),
walk AS (SELECT id, id AS place, 0 AS step FROM nodes UNION ALL SELECT w.id, n.parent, step + 1 FROM walk w JOIN nodes n ON n.id = w.place WHERE n.rank <> 'species' AND n.id <> 1 AND step < 8),
ends AS (SELECT id, arg_max(place, step) AS place FROM walk GROUP BY 1)
SELECT e.id, CASE WHEN n.rank = 'species' THEN e.place END AS ancestor, CASE WHEN n.id IS NULL THEN 'MISSING_NODE' WHEN n.rank = 'species' THEN 'PASS' WHEN e.place = 1 THEN 'NO_RANKED_ANCESTOR' ELSE 'LINEAGE_CYCLE' END AS status FROM ends e LEFT JOIN nodes n ON n.id = e.place""")
def species_ancestors(spark, sf_dir):
    nodes = _tree(spark, sf_dir)[3]
    return taxonomy.ranked_ancestor(nodes.select("id"), nodes)


@query(f"""WITH {TREE_SQL} SELECT n.item, CASE WHEN n.status = 'PASS' AND a.status = 'PASS' THEN 'PASS' ELSE 'REVIEW_UNRESOLVED' END AS status,
CASE WHEN n.status <> 'PASS' THEN n.status ELSE a.status END AS reason, CASE WHEN n.status = 'PASS' AND a.status = 'PASS' THEN a.species END AS species FROM normal n JOIN above a USING (item)""")
def taxonomy_resolution(spark, sf_dir):
    items, merged, deleted, nodes = _tree(spark, sf_dir)
    return taxonomy.resolve(items, "item", "tax", merged, deleted, nodes)


@query("SELECT c_custkey, c_acctbal FROM customer")
def checked_table(spark, sf_dir):
    """Customers read under a schema, refused if a key is missing or repeated or a balance is not finite."""
    return scans.read_checked(spark, f"{sf_dir}/customer.parquet", "c_custkey long, c_acctbal double", ["c_custkey"], ["c_acctbal"])
