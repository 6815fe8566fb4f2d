import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from coverlark.llm import negatives as hn
from coverlark.llm.cover_tree import CoverTree

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, cell int"


def plain(rows, anchors=100):
    """(anchor, positive, rank, negative, scores) by looking at every row for every anchor."""
    seen = set()
    for vec_id, e, label, *_ in rows:
        if vec_id is None or label is None or e is None or any(c is None or not math.isfinite(c) for c in e):
            continue
        seen.add((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, tuple(math.floor(256 * float(np.float32(c))) for c in e)))
    out = []
    for vec_id, label, x in seen:
        if vec_id % anchors:
            continue
        scored = [(sum(a * b for a, b in zip(x, y, strict=False)), i, own) for i, own, y in seen]
        scored.sort(key=lambda s: (-s[0], s[1]))
        for p, i, _ in [s for s in scored if s[2] == label and s[1] != vec_id][:5]:
            found = [s for s in scored if s[2] != label and 80 * p <= 100 * s[0] <= 100 * p][:5]
            out += [(vec_id, i, k, j, p, n) for k, (n, j, _) in enumerate(found, 1)]
    return sorted(out)


def vectors(n=900, dim=8, centres=12, spread=0.03, seed=5):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dim))
    return [(i, (middle[rng.integers(centres)] + spread * rng.normal(size=dim)).astype(np.float32).tolist(), int(rng.integers(4)), "r", 3) for i in range(n)]


def ran(spark, rows, **kwargs):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in hn.hard_negatives(df, **kwargs).collect())


@pytest.mark.parametrize("spread", [0.03, 2.0])
def test_negatives_by_a_plain_version(spark, monkeypatch, spread):
    for name, value in (("BLOCK", 100), ("GROUP", 4), ("SAMPLE", 200)):
        monkeypatch.setattr(hn, name, value)
    rows = vectors(spread=spread)
    want = plain(rows)
    assert len(want) > 50 and ran(spark, rows) == want


def test_ties_copies_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(hn, "BLOCK", 50)
    rng = random.Random(1)
    rows = vectors(200, centres=3, spread=0.0)
    rows += [(1000 + i, rows[0][1], rng.randrange(3), "r", 3) for i in range(300)]  # copies of one vector
    rows += [rows[100], rows[100], (100, rows[7][1], 2, "r", 3), (100, rows[0][1], rows[100][2], "r", 3)]  # repeats, and other rows of one id
    rows += [(None, rows[0][1], 1, "r", 3), (300, None, 1, "r", 3), (400, rows[0][1], None, "r", 3), (500, [None] * 8, 1, "r", 3), (600, [math.nan] * 8, 1, "r", 3), (700, [math.inf] * 8, 1, "r", 3)]
    rows += [(800, [0.0] * 8, 1, "r", 3), (801, [], 1, "r", 3), (802, [1.0], 2, "r", 3), (-100, [-x for x in rows[0][1]], 1, "r", 3), (900, rows[1][1], 9, "r", 3)]
    clean = [r for r in rows if r[0] is None or r[0] < 801 or r[0] > 802]
    assert ran(spark, clean) == plain(clean) and len(plain(clean)) > 50
    padded = [(i, None if e is None else e + [0.0] * (8 - len(e)), *rest) for i, e, *rest in rows]
    assert ran(spark, rows) == plain(padded)


def test_few_rows_and_none(spark):
    assert ran(spark, []) == [] and ran(spark, [(None, [1.0], 1, "r", 3)]) == []
    assert ran(spark, [(100, [1.0], 1, "r", 3)]) == []
    two = [(100, [1.0], 1, "r", 3), (2, [2.0], 1, "r", 3), (3, [1.8], 2, "r", 3)]
    assert ran(spark, two) == plain(two) == [(100, 2, 1, 3, 256 * 512, 256 * 460)]
    with pytest.raises(ValueError):
        ran(spark, [(100, [1e30], 1, "r", 3)])


def test_large_numbers_are_exact(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-90_000, 90_000) for _ in range(40)], rng.randrange(2), "r", 3) for i in range(0, 300, 5)]
    assert ran(spark, rows, anchors=10) == plain(rows, 10) and len(plain(rows, 10)) > 10


def test_bounds_leave_out_nodes_and_lose_nothing():
    rng = np.random.default_rng(7)
    middle = 300 * rng.normal(size=(20, 16))
    x = np.floor(middle[rng.integers(20, size=1500)] + 6 * rng.normal(size=(1500, 16)))
    top = float((x**2).sum(1).max())
    tree = CoverTree.of(x, rng.integers(3, size=1500), [[i] for i in range(1500)], top)
    assert sorted(i for own in tree.ids for i in own) == [*range(1500)]
    lifted = np.column_stack([tree.vectors, np.sqrt(np.maximum(top - (tree.vectors**2).sum(1), 0))])
    for k in range(len(tree.centre)):
        own = lifted[tree.first[k] : tree.last[k]]
        assert (np.linalg.norm(own - lifted[tree.centre[k]], axis=1) <= tree.radius[k]).all()
        assert sum(tree.last[c] - tree.first[c] for c in tree.children[k]) in (0, len(own))
    looked = 0
    for a in range(0, 1500, 50):
        wanted = tree.labels == 1
        scores = sorted(((-int(p), i) for p, (i,), w in zip(x[a] @ tree.vectors.T, tree.ids, wanted, strict=True) if w))
        top5 = [(-p, i) for p, i in scores[:5]]
        window = [(-p, i) for p, i in scores if 0.5 * top5[0][0] <= -p <= 0.7 * top5[0][0]][:5]
        got, n = tree.search(x[a], wanted, [(-(2**62), 2**62), (0.5 * top5[0][0], 0.7 * top5[0][0])], 5)
        assert got == [top5, window]
        looked += n
    assert looked < 0.5 * 1500 * 30


def test_cells_bound_all_products(spark, monkeypatch):
    for name, value in (("BLOCK", 100), ("SAMPLE", 200)):
        monkeypatch.setattr(hn, name, value)
    rows = hn.whole_vectors(spark.createDataFrame(vectors(), SCHEMA))
    searcher = hn.Searcher(rows, 6)
    cells = searcher.cells
    assert 1 < len(cells.centres) <= hn.CELLS and sum(cells.blocks.values()) >= 9
    x = np.array([r.x for r in rows.collect()], float)
    cell, far = cells.nearest(x)
    low, high = cells.bounds(x[:50])
    products = x[:50] @ x.T
    assert (products >= low[:, cell]).all() and (products <= high[:, cell]).all() and (far <= cells.radii[cell]).all()
    asked = searcher.cells_of(rows.limit(50).withColumn("windows", F.array(hn._windows(F.lit(0), F.lit(10**5), F.lit(hn.HIGHEST)))), hn._within)
    assert asked.count() < 50 * len(cells.centres)


def test_copies_of_anchors_are_never_broadcast(spark, monkeypatch):
    for name, value in (("BLOCK", 20), ("GROUP", 4), ("SAMPLE", 200), ("BUNDLE", 3), ("BUNDLES", 4)):
        monkeypatch.setattr(hn, name, value)
    rows = vectors(spread=2.0)
    searcher = hn.Searcher(hn.whole_vectors(spark.createDataFrame(rows, SCHEMA)), 6)
    assert searcher.bundle == 3
    asked = hn.whole_vectors(spark.createDataFrame(rows[::100], SCHEMA)).withColumn("key", F.col("vec_id")).withColumn("windows", F.array(hn._windows(F.lit(0), F.lit(hn.LOWEST), F.lit(hn.HIGHEST))))
    found = searcher.best(searcher.cells_of(asked, hn._within), True, 5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert found.select("vec_id").distinct().count() == 9
    assert ran(spark, rows) == plain(rows)


@pytest.mark.parametrize("dtype", [np.float64, np.int64])
@pytest.mark.parametrize("centres", [0, 20])
def test_many_queries_at_once(dtype, centres):
    rng = np.random.default_rng(9)
    x = 9 * rng.normal(size=(400, 16))
    if centres:
        x = 40 * rng.normal(size=(centres, 16))[rng.integers(centres, size=400)] + x / 9
    x = np.floor(x).astype(dtype)
    x[300:] = x[:100]  # equal products
    tree = CoverTree.of(x, rng.integers(3, size=400), [[i, 1000 + i] if i % 5 == 0 else [i] for i in range(400)], float((x**2).sum(1).max()))
    queries, labels, apart = x[:40], rng.integers(4, size=40), [None if k % 4 == 0 else k for k in range(40)]
    windows = [[(500, 2**62), (100 + k, 300), (10**6, 10**7)] for k in range(40)]
    for same in (True, False):
        want = [tree.search(q, (tree.labels == label) == same, own, 5, a)[0] for q, label, own, a in zip(queries, labels, windows, apart, strict=True)]
        assert tree.search_all(queries, labels, same, windows, 5, apart) == want and any(w[0] for w in want)
