"""Which records go on, and why others don't."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

ITEM_ID = r"^GCA_[0-9]+\.[0-9]+$"
SAMPLE_ID = r"^(SAMN[0-9]+|SAMEA[0-9]+|SAMD[0-9]+)$"
ASCII_SPACE = " \t\n\r\x0b\f"
#: Warnings that exclude a record.
EXCLUDING_WARNINGS = ["chimeric", "contaminated", "mixed culture"]


def normalized_warning(warning: Column) -> Column:
    """ASCII white space off both ends, lower case (which differs from case folding outside ASCII only)."""
    return F.lower(F.trim(warning, F.lit(ASCII_SPACE)))


def reasons(found: dict[str, Column]) -> Column:
    """The sorted, distinct names whose condition holds; a null condition does not."""
    every = F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in found.items()])
    return F.array_sort(F.array_distinct(F.filter(every, lambda x: x.isNotNull())))


def assess_metadata(records: DataFrame) -> DataFrame:
    """(accession, sample, decision, reasons, normalized_warnings) of nested source records.

    WITHHOLD_UNRESOLVED wins over EXCLUDE_METADATA, and that over RETAIN_METADATA. A record without assembly_info is
    withheld for that one reason. A null warning is malformed.
    """
    same = lambda c, v: ~F.coalesce(F.col(c) == v, F.lit(False))
    info = "assembly_info"
    accession = F.coalesce("accession", F.lit(""))
    sample = F.when(F.col(f"{info}.biosample.accession").rlike(SAMPLE_ID), F.col(f"{info}.biosample.accession"))
    warnings = F.coalesce(F.col(f"{info}.atypical.warnings"), F.array().cast("array<string>"))
    plain = F.transform(F.filter(warnings, lambda w: w.isNotNull()), normalized_warning)
    #: The names of reasons here and below.
    excluded = {
        "invalid_canonical_GCA_accession": ~accession.rlike(ITEM_ID),
        "current_accession_mismatch": ~F.coalesce(F.col("current_accession") == accession, F.lit(False)),
        "source_database_not_GenBank": same("source_database", "SOURCE_DATABASE_GENBANK"),
        "assembly_status_not_current": same(f"{info}.assembly_status", "current"),
        "assembly_level_not_Complete_Genome": same(f"{info}.assembly_level", "Complete Genome"),
        "biosample_object_missing_or_malformed": F.col(f"{info}.biosample").isNull(),
        "biosample_accession_missing_or_malformed": F.col(f"{info}.biosample").isNotNull() & sample.isNull(),
        **{f"automatic_atypical_exclusion:{w}": F.array_contains(plain, w) for w in EXCLUDING_WARNINGS},
    }
    withheld = {"atypical_warning_non_string": F.exists(warnings, lambda w: w.isNull())}
    missing = F.col(info).isNull()
    open_, out = reasons(withheld), reasons(excluded)
    decision = F.when(missing | (F.size(open_) > 0), "WITHHOLD_UNRESOLVED").when(F.size(out) > 0, "EXCLUDE_METADATA").otherwise("RETAIN_METADATA")
    return records.select(
        accession.alias("accession"),
        F.when(~missing, sample).alias("sample"),
        decision.alias("decision"),
        F.when(missing, F.array(F.lit("assembly_info_missing_or_malformed"))).otherwise(F.array_sort(F.concat(open_, out))).alias("reasons"),
        F.when(missing, F.array().cast("array<string>")).otherwise(plain).alias("normalized_warnings"),
    )


def counts(df: DataFrame, **columns: str) -> DataFrame:
    """(kind, value, n): how often each value occurs, for columns and (where a column is an array) its elements.

    ``df`` is read once: equal rows are counted first, and their counts are added up for each value.
    """
    rows = df.groupBy(*dict.fromkeys(columns.values())).agg(F.count("*").alias("_n"))

    def values(kind: str, column: str) -> Column:
        each = F.coalesce(F.col(column), F.array().cast(df.schema[column].dataType)) if df.schema[column].dataType.typeName() == "array" else F.array(column)
        return F.transform(each, lambda x: F.struct(F.lit(kind).alias("kind"), x.cast("string").alias("value")))

    found = rows.select(F.explode(F.concat(*[values(*x) for x in columns.items()])).alias("_x"), "_n")
    return found.groupBy("_x.kind", "_x.value").agg(F.sum("_n").alias("n"))


def sequence_eligibility(components: DataFrame, item: str) -> DataFrame:
    """(item, eligible, reasons): items with ambiguous letters or a component without a topology are not eligible."""
    ambiguous = F.coalesce(F.regexp_count("sequence", F.lit("[^ACGT]")), F.lit(0))
    no_topology = ~F.coalesce(F.lower(F.trim("topology")).isin("linear", "circular"), F.lit(False))
    found = components.groupBy(item).agg(F.sum(ambiguous).alias("_ambiguous"), F.count_if(no_topology).alias("_open"))
    why = reasons({"ambiguous_sequence": F.col("_ambiguous") > 0, "unspecified_topology": F.col("_open") > 0})
    return found.select(item, (F.size(why) == 0).alias("eligible"), F.array_join(why, "|").alias("reasons"))


def closure_supported(topology: Column, definition: Column) -> Column:
    """Circular, or described by the whole word "complete"."""
    return F.coalesce(F.lower(F.trim(topology)) == "circular", F.lit(False)) | F.coalesce(definition.rlike(r"(?i)\bcomplete\b"), F.lit(False))


def integrity_trigger(components: DataFrame, item: str) -> DataFrame:
    """(item, chromosomes, supported, unsupported, triggered): two or more chromosomes, one or more of them without closure."""
    chromosome = F.col("molecule_class") == "Chromosome"
    closed = closure_supported(F.col("topology"), F.col("definition"))
    found = components.groupBy(item).agg(F.count_if(chromosome).alias("chromosomes"), F.count_if(chromosome & closed).alias("supported"), F.count_if(chromosome & ~closed).alias("unsupported"))
    return found.withColumn("triggered", (F.col("chromosomes") >= 2) & (F.col("unsupported") >= 1))


def integrity_decision(trigger: DataFrame, prior: DataFrame, item: str) -> DataFrame:
    """(item, status, reason): items that are not triggered pass; others reuse a prior adjudication or wait for review.

    ``prior``: item, from_package boolean, verification, adjudicated_id, outcome; the first condition that fails decides.
    """
    p = prior.select(item, "from_package", "verification", "adjudicated_id", "outcome", F.lit(True).alias("_there"))
    # the reasons in their order
    why = (
        F.when(~F.col("triggered"), "NO_INTEGRITY_TRIGGER")
        .when(F.col("_there").isNull(), "NO_REUSABLE_ADJUDICATION")
        .when(~F.coalesce("from_package", F.lit(False)), "NOT_FROM_REUSABLE_PACKAGE")
        .when(~F.coalesce(F.col("verification") == "pass", F.lit(False)), "CACHE_NOT_VERIFIED")
        .when(F.col("outcome").isNull(), "ADJUDICATION_ABSENT")
        .when(~F.col("adjudicated_id").eqNullSafe(F.col(item)), "ADJUDICATED_ID_MISMATCH")
        .when(F.col("outcome") == "RETAIN", "RETAIN_CONFIRMED")
        .when(F.col("outcome") == "EXCLUDE", "FRAGMENTED_SET")
        .otherwise("ADJUDICATION_UNRESOLVED")
    )
    status = F.when(F.col("reason").isin("NO_INTEGRITY_TRIGGER", "RETAIN_CONFIRMED"), "PASS").when(F.col("reason") == "FRAGMENTED_SET", "EXCLUDE").otherwise("REVIEW_UNRESOLVED")
    return trigger.join(p, item, "left").withColumn("reason", why).select(item, status.alias("status"), "reason")


def truth_decision(items: DataFrame, duplicate_pairs: DataFrame, containments: DataFrame, item: str) -> DataFrame:
    """(item, status, reason): duplicates exclude, then contained linear components, then unknown topologies leave it open."""
    twice = duplicate_pairs.groupBy(item).agg(F.count("*").alias("_pairs"))
    kind = F.lower(F.trim("inner_topology"))
    inside = containments.groupBy(item).agg(F.count("*").alias("_inside"), F.count_if(kind == "linear").alias("_linear"), F.count_if(F.coalesce(kind, F.lit("")) != "circular").alias("_other"))
    reason = (
        F.when(F.col("_pairs") > 0, "EXACT_DUPLICATE_COMPONENTS")
        .when(F.col("_linear") > 0, "LINEAR_COMPONENT_CONTAINED")
        .when((F.col("_inside") > 0) & (F.col("_other") == 0), "CIRCULAR_CONTAINMENT_RETAINED")
        .when(F.col("_inside") > 0, "UNRESOLVED_SOURCE_TRUTH")
        .otherwise("NO_SOURCE_REDUNDANCY")
    )
    status = F.when(F.col("reason").isin("EXACT_DUPLICATE_COMPONENTS", "LINEAR_COMPONENT_CONTAINED"), "EXCLUDE").when(F.col("reason") == "UNRESOLVED_SOURCE_TRUTH", "REVIEW_UNRESOLVED").otherwise("SUITABLE")
    return items.select(item).distinct().join(twice, item, "left").join(inside, item, "left").withColumn("reason", reason).select(item, status.alias("status"), "reason")


def reconcile_samples(members: DataFrame, item: str, sample: str) -> DataFrame:
    """(item, status, reason) from (item, sample, truth_status, fingerprint).

    Only SUITABLE items take part. One of a sample continues if it is alone, or if all fingerprints are equal and its id is
    the smallest; differing fingerprints send all of a sample to review. Samples are summed up before they are joined back.
    """
    suitable = F.col("truth_status") == "SUITABLE"
    summary = members.where(suitable).groupBy(sample).agg(F.count("*").alias("_n"), F.min(item).alias("_first"), (F.min("fingerprint") == F.max("fingerprint")).alias("_same"))
    reason = (
        F.when(F.col("truth_status") == "EXCLUDE", "SOURCE_TRUTH_EXCLUDED")
        .when(~suitable, "SOURCE_TRUTH_UNRESOLVED")
        .when(F.col("_n") == 1, "SAMPLE_SINGLETON")
        .when(~F.col("_same"), "SAMPLE_FINGERPRINTS_DIFFER")
        .when(F.col(item) == F.col("_first"), "SAMPLE_IDENTICAL_REPRESENTATIVE")
        .otherwise("SAMPLE_IDENTICAL_NONREPRESENTATIVE")
    )
    status = (
        F.when(F.col("reason").like("SOURCE_TRUTH%"), "NOT_APPLICABLE")
        .when(F.col("reason") == "SAMPLE_FINGERPRINTS_DIFFER", "REVIEW_UNRESOLVED")
        .when(F.col("reason") == "SAMPLE_IDENTICAL_NONREPRESENTATIVE", "NONREPRESENTATIVE")
        .otherwise("CONTINUE")
    )
    return members.join(summary, sample, "left").withColumn("reason", reason).select(item, status.alias("status"), "reason")


def compose(truth: DataFrame, samples: DataFrame, integrity: DataFrame, taxonomy: DataFrame, item: str) -> DataFrame:
    """(item, disposition, layer, status, reason, species): the first layer that ends an item's way decides.

    Each layer's table has (item, status, reason), taxonomy also species; only items that go on are joined to the next.
    """
    layers = [("source_truth", truth, "SUITABLE"), ("repeated_sample", samples, "CONTINUE"), ("integrity", integrity, "PASS"), ("taxonomy", taxonomy, "PASS")]
    none = F.lit(None).cast(taxonomy.schema["species"].dataType)
    ended, going = [], truth.select(item)
    for layer, table, on in layers:
        rows = going.join(table, item, "left")
        status = F.coalesce("status", F.lit("MISSING"))
        disposition = F.when(status == "EXCLUDE", "EXCLUDED").when(status == "NONREPRESENTATIVE", "NONREPRESENTATIVE").otherwise("WITHHELD_UNRESOLVED")
        ended.append(rows.where(status != on).select(item, disposition.alias("disposition"), F.lit(layer).alias("layer"), status.alias("status"), "reason", none.alias("species")))
        going = rows.where(F.col("status") == on).select(item, *(["species"] if layer == "taxonomy" else []))
    passed = going.select(item, F.lit("ELIGIBLE").alias("disposition"), F.lit("eligible").alias("layer"), F.lit("PASS").alias("status"), F.lit("POST_SEQUENCE_ELIGIBLE").alias("reason"), "species")
    return reduce(DataFrame.unionByName, ended, passed)


def eligible_universe(composed: DataFrame, item: str) -> DataFrame:
    return composed.where("disposition = 'ELIGIBLE'").select(item, F.col("species").alias("grp"))


def disposition_totals(composed: DataFrame) -> DataFrame:
    """(disposition, n), and under the null disposition the total."""
    return composed.rollup("disposition").agg(F.count("*").alias("n"))


def continuing(df: DataFrame, status: str, value: str) -> DataFrame:
    """The rows that go on to the next stage."""
    return df.where(F.col(status) == value)
