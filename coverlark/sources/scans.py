"""Scans with fixed schemas. Malformed input fails when it is read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.checks import require_clean, require_rows, require_unique

RECORD_DDL = (
    "accession string, current_accession string, source_database string, "
    "assembly_info struct<assembly_status:string, assembly_level:string, biosample:struct<accession:string>, atypical:struct<warnings:array<string>>>, "
    "organism struct<organism_name:string, tax_id:bigint>"
)


def _fail_unless(good: Column, value: Column, what: str) -> Column:
    return F.when(good, value).otherwise(F.raise_error(F.concat(F.lit(f"{what}: "), F.coalesce(F.left(value.cast("string"), F.lit(80)), F.lit("null")))))


def parse_records(lines: DataFrame, column: str = "value") -> DataFrame:
    """Source records from JSON text, a record a row. A line that is not an object fails; both spellings of names do."""
    camel = "accession string, currentAccession string, sourceDatabase string, assemblyInfo struct<assemblyStatus:string, assemblyLevel:string, biosample:struct<accession:string>, atypical:struct<warnings:array<string>>>, organism struct<organismName:string, taxId:bigint>"
    text = F.trim(F.col(column))
    whole = _fail_unless(text.startswith("{") & F.get_json_object(text, "$").isNotNull(), text, "not a JSON object")
    # Text without a name of the other spelling, or an escape that may hide one, is parsed once.
    other = F.col("_t").rlike(r"currentAccession|sourceDatabase|assemblyInfo|organismName|taxId|\\u")
    parsed = lines.select(whole.alias("_t")).select(F.from_json("_t", RECORD_DDL).alias("a"), F.when(other, F.from_json("_t", camel)).alias("b"))
    info = F.when(
        F.col("a.assembly_info").isNotNull() | F.col("b.assemblyInfo").isNotNull(),
        F.struct(
            F.coalesce("a.assembly_info.assembly_status", "b.assemblyInfo.assemblyStatus").alias("assembly_status"),
            F.coalesce("a.assembly_info.assembly_level", "b.assemblyInfo.assemblyLevel").alias("assembly_level"),
            F.coalesce("a.assembly_info.biosample", "b.assemblyInfo.biosample").alias("biosample"),
            F.coalesce("a.assembly_info.atypical", "b.assemblyInfo.atypical").alias("atypical"),
        ),
    )
    organism = F.struct(F.coalesce("a.organism.organism_name", "b.organism.organismName").alias("organism_name"), F.coalesce("a.organism.tax_id", "b.organism.taxId").alias("tax_id"))
    return parsed.select("a.accession", F.coalesce("a.current_accession", "b.currentAccession").alias("current_accession"), F.coalesce("a.source_database", "b.sourceDatabase").alias("source_database"), info.alias("assembly_info"), organism.alias("organism"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    return parse_records(spark.read.text(path))


def read_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A tab-separated table whose header must be exactly that of ``schema``."""
    return spark.read.schema(schema).option("sep", "\t").option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)


def parse_fasta(records: DataFrame, column: str = "value") -> DataFrame:
    """(component, sequence) from FASTA records, one a row, with or without their ">": the id is the header's first word."""
    body = F.regexp_replace(F.regexp_replace(F.col(column), "^>", ""), "\\r", "")
    head = F.regexp_extract(body, r"^([^\n]*)", 1)
    sequence = F.upper(F.regexp_replace(F.regexp_replace(body, r"^[^\n]*", ""), r"\s", ""))
    return records.where(F.trim(body) != "").select(
        _fail_unless(F.regexp_extract(head, r"^(\S+)", 1) != "", F.regexp_extract(head, r"^(\S+)", 1), "no id").alias("component"),
        _fail_unless(sequence.rlike("^[ACGTURYSWKMBDHVN]+$"), sequence, "empty, or a symbol that is not a nucleotide code").alias("sequence"),
    )


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """Components of FASTA files, with the file they are from. Repeated ids fail ``checks.require_unique``."""
    rows = spark.read.option("lineSep", "\n>").text(path).select("value", F.col("_metadata.file_path").alias("file"))
    return rows.withColumn("_r", F.col("value")).transform(lambda d: parse_fasta(d, "_r"))


def parse_flat(records: DataFrame, column: str = "value") -> DataFrame:
    """(component, declared_length, topology, definition, sequence) from flat-file records, one a row."""
    text = F.col(column)
    take = lambda pattern: F.regexp_extract(text, pattern, 1)
    sequence = F.upper(F.regexp_replace(take(r"(?s)\nORIGIN[^\n]*\n(.*)$"), r"[\s\d/]", ""))
    length = take(r"LOCUS\s+\S+\s+(\d+) bp").cast("long")
    topology = F.lower(F.regexp_extract(text, r"LOCUS[^\n]*\s(linear|circular)\b", 1))
    definition = F.regexp_replace(take(r"(?s)\nDEFINITION\s+(.*?)\n\S"), r"\s+", " ")
    rows = records.where(F.trim(text) != "").select(take(r"\nVERSION\s+(\S+)").alias("component"), length.alias("declared_length"), F.when(topology != "", topology).alias("topology"), definition.alias("definition"), sequence.alias("_s"))
    return rows.select("component", "declared_length", "topology", "definition", _fail_unless(F.char_length("_s") == F.col("declared_length"), F.col("_s"), "length differs from LOCUS").alias("sequence"))


def read_flat(spark: SparkSession, path: str) -> DataFrame:
    return parse_flat(spark.read.option("lineSep", "\n//\n").text(path))


def parse_dump(lines: DataFrame, columns: list[str], column: str = "value") -> DataFrame:
    """Fields of a taxonomy dump line, separated by bars, trimmed; too few fields fail. Fields are text: cast what is a number."""
    fields = F.transform(F.split(column, r"\|"), lambda x: F.trim(x, F.lit(" \t")))
    return lines.select(fields.alias("_f"), F.col(column).alias("_t")).select(*[_fail_unless(F.size("_f") >= len(columns), F.col("_f")[i], "too few fields").alias(c) for i, c in enumerate(columns)])


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    return parse_dump(spark.read.text(path), ["id", "parent", "rank"]).select(F.col("id").cast("long"), F.col("parent").cast("long"), "rank")


def parse_sequence_report(lines: DataFrame, column: str = "value") -> DataFrame:
    """(item, component, length, molecule_class) of the components of the primary assembly, from JSON lines."""
    r = F.from_json(column, "assembly_accession string, genbank_accession string, length bigint, assigned_molecule_location_type string, assembly_unit string")
    return lines.select(r.alias("r")).where("r.assembly_unit = 'Primary Assembly'").select(F.col("r.assembly_accession").alias("item"), F.col("r.genbank_accession").alias("component"), F.col("r.length").alias("length"), F.col("r.assigned_molecule_location_type").alias("molecule_class"))


def read_checked(spark: SparkSession, path: str, schema: str, keys: list[str], finite: list[str] = (), rows: int | None = None) -> DataFrame:
    """A typed Parquet table that passes its composition checks: all rows there, keys unique, numbers finite."""
    df = spark.read.schema(schema).parquet(path)
    require_unique(require_clean(df, not_null=keys, finite=list(finite)), keys)
    return df if rows is None else require_rows(df, rows)


def file_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(path, size, sha256) of every file below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))
