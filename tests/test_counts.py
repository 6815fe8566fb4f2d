import json

from coverlark.operators import eligibility
from coverlark.sources import scans


def test_counts_read_their_input_once(spark):
    rows = [("a", ["x", "y"], [1]), ("a", ["x", "y"], None), (None, [], [1, None, 1]), ("b", ["x", None], [2])]
    df = spark.createDataFrame(rows, "kind string, many array<string>, number array<int>")
    read = spark.sparkContext.accumulator(0)
    seen = df.rdd.map(lambda r: (read.add(1), r)[1])
    got = eligibility.counts(spark.createDataFrame(seen, df.schema), one="kind", many="many", number="number", again="kind").collect()
    assert {(r.kind, r.value): r.n for r in got} == {
        ("one", "a"): 2, ("one", "b"): 1, ("one", None): 1, ("again", "a"): 2, ("again", "b"): 1, ("again", None): 1,
        ("many", "x"): 3, ("many", "y"): 2, ("many", None): 1, ("number", "1"): 3, ("number", "2"): 1, ("number", None): 1,
    }
    assert len(got) == 12 and read.value == 4
    assert eligibility.counts(df.limit(0), one="kind", many="many").count() == 0


def test_other_spellings_are_found_wherever_they_are(spark):
    rows = [{"accession": "A", "currentAccession": "C"}, {"sourceDatabase": "S"}, {"assemblyInfo": {"assemblyStatus": "current"}}, {"organism": {"organismName": "O"}}, {"organism": {"taxId": 7}}, {"current_accession": "D"}]
    lines = [json.dumps(r) for r in rows] + [r'{"currentAccession": "E"}']
    got = scans.parse_records(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [r.current_accession for r in got] == ["C", None, None, None, None, "D", "E"]
    assert got[1].source_database == "S" and got[2].assembly_info.assembly_status == "current" and got[3].organism.organism_name == "O" and got[4].organism.tax_id == 7
    assert [r.assembly_info is None for r in got] == [True, True, False, True, True, True, True]
