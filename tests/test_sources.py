import pytest

from coverlark.operators import kmers, selection, taxonomy
from coverlark.operators.checks import BadInput
from coverlark.sources import scans, sinks


def test_files(spark, tmp_path):
    (tmp_path / "a.fasta").write_text(">x one\nACGT\nac\n>y\nNNN\n")
    got = {r.component: r.sequence for r in scans.read_fasta(spark, str(tmp_path / "a.fasta")).collect()}
    assert got == {"x": "ACGTAC", "y": "NNN"}
    (tmp_path / "bad.fasta").write_text(">x\nAC!\n")
    with pytest.raises(Exception, match="not a nucleotide"):
        scans.read_fasta(spark, str(tmp_path / "bad.fasta")).collect()
    (tmp_path / "a.gbff").write_text("LOCUS       x    6 bp    DNA     circular BCT\nDEFINITION  a complete\n            thing\nVERSION     x.1\nORIGIN\n        1 acgtac\n//\n")
    row = scans.read_flat(spark, str(tmp_path / "a.gbff")).first()
    assert (row.component, row.topology, row.definition, row.sequence) == ("x.1", "circular", "a complete thing", "ACGTAC")
    (tmp_path / "t.tsv").write_text("a\tb\n1\tx\n")
    assert scans.read_tsv(spark, str(tmp_path / "t.tsv"), "a int, b string").first().b == "x"
    with pytest.raises(Exception):
        scans.read_tsv(spark, str(tmp_path / "t.tsv"), "a int, c string").collect()
    (tmp_path / "n.dmp").write_text("1\t|\t1\t|\tno rank\t|\n")
    assert scans.read_nodes(spark, str(tmp_path / "n.dmp")).first().rank == "no rank"
    assert scans.file_manifest(spark, str(tmp_path)).count() == 5
    ladder = spark.createDataFrame([(2, "b", 0.1), (1, "a", 1 / 3)], "rank int, item string, score double")
    sinks.write_ladder(ladder, str(tmp_path / "ladder"))
    back = spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "ladder")).collect()
    assert [r.item for r in back] == ["a", "b"] and float(back[0].score) == 1 / 3


def test_records_both_spellings(spark):
    lines = [('{"accession":"GCA_1.1","assembly_info":{"assembly_status":"current"}}',), ('{"accession":"GCA_2.1","assemblyInfo":{"assemblyStatus":"previous"}}',), ('{"accession":"GCA_3.1"}',)]
    got = {r.accession: r.assembly_info for r in scans.parse_records(spark.createDataFrame(lines, "value string")).collect()}
    assert got["GCA_1.1"].assembly_status == "current" and got["GCA_2.1"].assembly_status == "previous" and got["GCA_3.1"] is None
    with pytest.raises(Exception, match="not a JSON object"):
        scans.parse_records(spark.createDataFrame([("[1]",)], "value string")).collect()


def test_repeats_of_a_periodic_circle(spark):
    rows = [(1, "a", "circular", "ACGGT" * 3), (2, "a", "linear", "A"), (3, "a", "linear", "ACCCTTGCA"), (3, "b", "linear", "TGCAAGGGT")]
    c = spark.createDataFrame(rows, "item int, component string, topology string, sequence string")
    assert {r["item"]: r["longest_repeat"] for r in kmers.longest_repeat(c, "item").collect()} == {1: 15, 2: 0, 3: 9}
    f = kmers.repeat_features(c, "item", [15]).collect()
    assert [(r["item"], r["valid_starts"], r["non_unique_fraction"], r["max_multiplicity"]) for r in f] == [(1, 15, 1.0, 3)]


def test_merged_chains(spark):
    ids = spark.createDataFrame([(k,) for k in (1, 2, 3, 7, 8, 9, 10)], "id long")
    merged = spark.createDataFrame([(2, 3), (3, 4), (4, 1), (8, 9), (9, 8)], "old long, new long")
    got = {r.id: (r.current, r.status) for r in taxonomy.normalize_ids(ids, merged, spark.createDataFrame([(7,)], "id long"), spark.createDataFrame([(1,)], "id long")).collect()}
    assert got == {1: (1, "PASS"), 2: (1, "PASS"), 3: (1, "PASS"), 7: (None, "DELETED"), 8: (None, "MERGED_CYCLE"), 9: (None, "MERGED_CYCLE"), 10: (None, "MISSING")}


def test_checked_reading_refuses_bad_tables(spark, tmp_path):
    schema = "item string, value double"
    for name, rows in {"good": [("a", 1.0), ("b", 2.0)], "repeated": [("a", 1.0), ("a", 2.0)], "infinite": [("a", float("inf"))], "null": [(None, 1.0)]}.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}")
    assert scans.read_checked(spark, f"{tmp_path}/good", schema, ["item"], ["value"], 2).count() == 2
    for name, rows in (("repeated", None), ("infinite", None), ("null", None), ("good", 3)):
        with pytest.raises(BadInput):
            scans.read_checked(spark, f"{tmp_path}/{name}", schema, ["item"], ["value"], rows)


def test_ladders_refuse_repeated_and_null_ids(spark):
    for ids in (["a", "b", "a"], ["a", None, "b"]):
        df = spark.createDataFrame([(i, f"g{k}", [float(k)]) for k, i in enumerate(ids)], "item string, grp string, coords array<double>")
        with pytest.raises(BadInput):
            selection.maximin_ladder(df, "item", size=2)
        with pytest.raises(BadInput):
            selection.random_ladders(df, "item", "grp", 2, 2)
