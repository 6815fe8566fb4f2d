import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from coverlark.operators import balance, checks, coverage, selection
from coverlark.operators.sequences import rotations
from coverlark.functions.dna import least_rotation


def items(spark, rows):
    return spark.createDataFrame(rows, "item string, grp string, x double, y double")


def test_percentile_worked_case(spark):
    rows = items(spark, [("a", "A", 1.0, 5.0), ("b", "A", 2.0, 5.0), ("c", "B", 2.0, 5.0)])
    got = {r["item"]: (r["x"], r["y"]) for r in balance.percentiles(rows, "item", "grp", ["x", "y"]).collect()}
    assert got == {"a": (0.125, 0.5), "b": (0.625, 0.5), "c": (0.625, 0.5)}


def test_percentiles_are_the_exact_ones_rounded_once(spark):
    rng = random.Random(3)
    rows = [(f"i{k}", f"g{rng.randint(0, 12)}", float(rng.randint(0, 40)), rng.random()) for k in range(300)]
    sizes = {g: sum(r[1] == g for r in rows) for g in {r[1] for r in rows}}
    w = {r[0]: Fraction(1, sizes[r[1]] * len(sizes)) for r in rows}
    want = {r[0]: float(sum(w[o[0]] * (2 if o[2] < r[2] else 1 if o[2] == r[2] else 0) for o in rows) / 2) for r in rows}
    got = {r["item"]: r["x"] for r in balance.percentiles(items(spark, rows).repartition(5), "item", "grp", ["x"]).collect()}
    assert got == want


@pytest.mark.parametrize("row", [("a", None, 1.0, 1.0), ("a", "", 1.0, 1.0), ("a", "A", float("nan"), 1.0), (None, "A", 1.0, 1.0)])
def test_unclean_input_fails(spark, row):
    with pytest.raises(checks.BadInput):
        balance.percentiles(items(spark, [row]), "item", "grp", ["x"])


def test_projection_rules(spark):
    base = items(spark, [("a", "A", 1.0, 0.0), ("b", "B", 2.0, 0.0), ("c", "C", 4.0, 0.0)])
    asked = items(spark, [(k, "Q", v, 0.0) for k, v in (("low", 0.5), ("same", 2.0), ("between", 3.0), ("high", 9.0))])
    got = {r["item"]: r["percentile"] for r in balance.project(base, asked, "item", "grp", ["x"]).collect()}
    assert got == pytest.approx({"low": 0.0, "same": 0.5, "between": 2 / 3, "high": 1.0})


def plain_ladder(points, ties, size):
    d = len(points[0])
    mid = [sum(p[i] for p in points) / len(points) for i in range(d)]
    d2 = lambda a, b: sum((x - y) * (x - y) for x, y in zip(a, b))
    out = [min(range(len(points)), key=lambda i: (d2(points[i], mid), ties[i]))]
    low = [d2(p, points[out[0]]) for p in points]
    while len(out) < min(size, len(points)):
        best = min((i for i in range(len(points)) if i not in out), key=lambda i: (-low[i], ties[i]))
        out.append(best)
        low = [min(a, d2(p, points[best])) for a, p in zip(low, points)]
    return out


@pytest.mark.parametrize("batch,coarse", [(1, True), (5, True), (64, False)])
def test_lazy_ladder_equals_the_plain_one(spark, batch, coarse):
    import hashlib

    rng = random.Random(batch)
    points = [[rng.randint(0, 3) / 4 if coarse else rng.random() for _ in range(3)] for _ in range(60)]
    ties = [hashlib.sha256(f"{selection.NAMESPACE}i{k}".encode()).hexdigest() for k in range(60)]
    df = spark.createDataFrame([(f"i{k}", p) for k, p in enumerate(points)], "item string, coords array<double>").repartition(3)
    got = [r["item"] for r in selection.maximin_ladder(df, "item", size=12, batch=batch).orderBy("rank").collect()]
    assert got == [f"i{k}" for k in plain_ladder(points, ties, 12)]


def test_exact_mean_does_not_depend_on_order(spark):
    values = [1e16, 1.0, -1e16, 1.0, 0.1] * 7
    df = spark.createDataFrame([("g", v) for v in values], "g string, v double")
    want = math.fsum(values) / len(values)
    for parts in (1, 4):
        assert coverage.exact_mean(df.repartition(parts), ["g"], "v", "m").first()["m"] == want


def test_balanced_quantile_at_an_exact_boundary(spark):
    df = spark.createDataFrame([(1, "A", 1.0), (1, "B", 2.0)], "n int, g string, v double")
    assert coverage.balanced_quantile(df, "g", "n", "v", 0.5, "q").first()["q"] == 1.0


def test_rotation_searches_by_brute_force():
    rng = random.Random(1)
    for k in range(2000):
        letters = "AC" if k % 2 else "ACGT"
        a = "".join(rng.choices(letters, k=rng.randint(1, 7)))
        b = "".join(rng.choices(letters, k=rng.randint(len(a) + 1, 14)))
        assert least_rotation(a) == min(a[i:] + a[:i] for i in range(len(a)))
        for wrap in (False, True):
            ring = b + (b[: len(a) - 1] if wrap else "")
            at = [i for i in range(len(ring) - len(a) + 1) if ring[i : i + len(a)] in a + a]
            assert rotations(a, b, wrap) == (bool(at), bool(at) and all(i + len(a) > len(b) for i in at))
