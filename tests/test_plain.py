"""Operators that SQL expresses badly, against plain versions in memory."""

import hashlib
import math
import random
from collections import Counter
from fractions import Fraction
from functools import reduce

import pytest
from pyspark.sql import functions as F

from coverlark.functions.prefix import ranked
from coverlark.functions.vectors import exact_means
from coverlark.operators import compare, coverage, kmers, selection
from coverlark.plans import sensitivity

NS = selection.NAMESPACE
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
d2 = lambda a, b: sum((x - y) * (x - y) for x, y in zip(a, b))


def mean(points):
    return [float(sum((Fraction(p[k]) for p in points), Fraction(0)) / len(points)) for k in range(len(points[0]))]


def universe(seed, coarse, n=70, groups=9):
    rng = random.Random(seed)
    return [(f"i{k}", f"g{rng.randint(0, groups)}", [rng.randint(0, 2) / 2 if coarse else rng.random() for _ in range(3)]) for k in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "item string, grp string, coords array<double>").repartition(3)


def plain_residual(rows, size):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    key = {g: sha(NS + "species|" + "\n".join(sorted(r[0] for r in own))) for g, own in groups.items()}
    centers = {g: mean([r[2] for r in own]) for g, own in groups.items()}
    middle = mean([*centers.values()])
    g = min(groups, key=lambda g: (d2(centers[g], middle), key[g]))
    picks = [min(groups[g], key=lambda r: (d2(r[2], middle), sha(NS + r[0])))]
    low = {r[0]: d2(r[2], picks[0][2]) for r in rows}
    while len(picks) < min(size, len(rows)):
        taken = {p[0] for p in picks}
        able = [g for g, own in groups.items() if any(r[0] not in taken for r in own)]
        score = {g: math.fsum(low[r[0]] for r in groups[g]) / len(groups[g]) for g in able}
        g = min(able, key=lambda g: (-score[g], key[g]))
        picks.append(min((r for r in groups[g] if r[0] not in taken), key=lambda r: (-low[r[0]], sha(NS + r[0]))))
        low = {r[0]: min(low[r[0]], d2(r[2], picks[-1][2])) for r in rows}
    return [p[0] for p in picks]


@pytest.mark.parametrize("seed,coarse,held", [(1, False, 20_000), (2, True, 20_000), (3, False, 15), (4, True, 1)])
def test_residual_ladder(spark, seed, coarse, held):
    rows = universe(seed, coarse)
    got = selection.residual_ladder(frame(spark, rows), "item", "grp", size=25, held=held).orderBy("rank").collect()
    assert [r["item"] for r in got] == plain_residual(rows, 25)


def test_residual_ladder_takes_all_and_none(spark):
    rows = universe(5, True, n=12, groups=2)
    got = selection.residual_ladder(frame(spark, rows), "item", "grp", size=50).orderBy("rank").collect()
    assert [r["item"] for r in got] == plain_residual(rows, 50) and len(got) == 12
    assert selection.residual_ladder(frame(spark, rows).where("false"), "item", "grp").count() == 0


@pytest.mark.parametrize("parts", [1, 5])
def test_exact_means_of_any_doubles(spark, parts):
    rng = random.Random(parts)
    odd = [0.0, -0.0, 5e-324, -5e-324, 2.0**-1022, 2.0**1023, -(2.0**1023), 2.0**32, 2.0**32 - 2.0**-20, -(2.0**64), 0.1, 1e300, -1e300, 2.0**-31, 3 * 2.0**-1074]
    odd += [s * 2.0**e * (1 + d * 2.0**-52) for e in range(-992, 1000, 32) for s in (1, -1) for d in (0, 1, 2**52 - 1)]
    rows = [(g, [rng.choice(odd) if rng.random() < 0.5 else rng.uniform(-1, 1) * 2.0 ** rng.randint(-1060, 1000) for _ in range(3)]) for g in "abc" for _ in range(400)]
    rows += [("tiny", [5e-324, rng.choice(odd), 5e-324]), ("tiny", [0.0, 1.0, 5e-324]), (None, [1.0, 2.0, 3.0])]
    got = exact_means(spark.createDataFrame(rows, "g string, v array<double>").repartition(parts), ["g"], "v", "m").collect()
    assert {r["g"]: r["m"] for r in got} == {g: mean([v for h, v in rows if h == g]) for g in ("a", "b", "c", "tiny", None)}


@pytest.mark.parametrize("bad", ["array(double('NaN'))", "array(double('-Infinity'))", "array(cast(null as double))", "cast(null as array<double>)"])
def test_exact_means_refuse_what_is_no_number(spark, bad):
    assert exact_means(spark.range(0).selectExpr("array(1D) AS v"), [], "v", "m").collect() == []
    with pytest.raises(Exception, match="finite"):
        exact_means(spark.range(3).selectExpr(f"if(id = 1, {bad}, array(1D)) AS v"), [], "v", "m").collect()


def test_quantiles_by_plain_ranks(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, *range(7)]) if k % 2 else rng.random() * 10) for k in range(3000)] + [("none", None), ("one", -3.5)]
    rows = [(g, None if v is None else float(v)) for g, v in rows]
    at = {"least": 0.0, "low": 0.025, "mid": 0.5, "p95": 0.95, "most": 1.0}
    got = {r["g"]: r for r in coverage.quantiles(spark.createDataFrame(rows, "g string, v double").repartition(5), ["g"], "v", at).collect()}
    assert set(got) == {"a", "b", None, "none", "one"} and all(got["none"][name] is None for name in at)
    for g in ("a", "b", None, "one"):
        own = sorted(v for h, v in rows if h == g and v is not None)
        for name, q in at.items():
            assert got[g][name] == own[max(1, math.ceil(Fraction(str(q)) * len(own))) - 1]
    whole = coverage.quantiles(spark.createDataFrame(rows, "g string, v double"), [], "v", {"mid": 0.5}).collect()
    own = sorted(v for _, v in rows if v is not None)
    assert [r["mid"] for r in whole] == [own[(len(own) + 1) // 2 - 1]]
    assert coverage.quantiles(spark.createDataFrame([], "g string, v double"), ["g"], "v", at).count() == 0


def test_nearest_panel_distance_by_plain_search(spark):
    rng = random.Random(8)
    rows = [(f"i{k}", [rng.random() for _ in range(3)]) for k in range(90)] + [("nowhere", None)]
    other = [(f"i{k}", [rng.random() for _ in range(3)]) for k in range(0, 90, 2)]
    ladder = [(k + 1, f"i{n}") for k, n in enumerate(rng.sample(range(0, 90, 2), 20))]
    items, panel = spark.createDataFrame(rows, "item string, coords array<double>").repartition(4), spark.createDataFrame(ladder, "rank int, item string")
    for own, same, source in ((rows, True, None), (other, False, spark.createDataFrame(other, "item string, coords array<double>"))):
        got = {(r["item"], r["n"]): r["distance"] for r in coverage.nearest_panel_distance(items, panel, "item", [5, 1, 20], same_universe=same, panel_coords=source).collect()}
        at = dict(own)
        in_turn = lambda a, b: reduce(lambda s, p: s + (p[0] - p[1]) * (p[0] - p[1]), zip(a, b), 0.0)  # noqa: E731  sum() would compensate
        want = {(i, n): math.inf if x is None else min(math.sqrt(in_turn(x, at[m])) for k, m in ladder if k <= n) for i, x in rows for n in (1, 5, 20)}
        assert got == want
    assert {r["distance"] for r in coverage.nearest_panel_distance(items, panel.limit(0), "item", [3]).collect()} == {math.inf}
    assert coverage.nearest_panel_distance(items.limit(0), panel, "item", [3]).count() == 0


@pytest.mark.parametrize("values", [3, 1000])
def test_spearman(spark, values):
    rng = random.Random(values)
    rows = [(k, *[rng.randint(0, values) for _ in range(4)]) for k in range(200)]
    got = compare.spearman(spark.createDataFrame(rows, "item long, a long, b long, c long, d long"), "item", [*"abcd"]).collect()
    ranks = {f: [sum(y < x for y in col) + (col.count(x) + 1) / 2 for x in col] for f, col in zip("abcd", [*zip(*rows)][1:])}

    def corr(x, y):
        mx, my = math.fsum(x) / len(x), math.fsum(y) / len(y)
        return math.fsum((a - mx) * (b - my) for a, b in zip(x, y)) / math.sqrt(math.fsum((a - mx) ** 2 for a in x) * math.fsum((b - my) ** 2 for b in y))

    want = {(p, q): corr(ranks[p], ranks[q]) for i, p in enumerate("abcd") for q in "abcd"[i:]}
    assert {(r[0], r[1]): r[2] for r in got} == pytest.approx(want)
    with pytest.raises(Exception, match="constant"):
        compare.spearman(spark.createDataFrame(rows, "item long, a long, b long, c long, d long").withColumn("b", F.lit(1)), "item", [*"abcd"]).collect()


def test_representatives_by_exact_centroids(spark):
    rows = [(f"i{k}", "g", [v, 0.0, 0.0]) for k, v in enumerate([1e16, 1.0, -1e16, 1.0, 0.5])]
    groups = exact_means(frame(spark, rows), ["grp"], "coords", "m").first()["m"]
    assert groups == mean([r[2] for r in rows])
    for parts in (1, 5):
        assert selection.representatives(frame(spark, rows).repartition(parts), "item", "grp").first()["item"] == "i4"


def plain_repeats(parts, k):
    turn = str.maketrans("ACGT", "TGCA")
    seen = {}
    for name, topology, s in parts:
        if k <= len(s):
            ring = s + s[: k - 1] if topology == "circular" else s
            for i in range(len(ring) - k + 1):
                w = ring[i : i + k]
                seen.setdefault(min(w, w.translate(turn)[::-1]), []).append(name)
    n = sum(map(len, seen.values()))
    return (n, sum(len(v) for v in seen.values() if len(v) > 1), max(map(len, seen.values()), default=0), sum(len(v) for v in seen.values() if len(set(v)) > 1))


@pytest.mark.parametrize("most", [60, 8_000_000])
def test_structural_features(spark, most):
    rng = random.Random(6)
    dna = lambda n: "".join(rng.choices("ACGT", k=n))
    items = {}
    for k in range(12):
        unit = dna(rng.randint(4, 30))
        items[k] = [(f"c{j}", rng.choice(["circular", "linear"]), rng.choice([unit * rng.randint(1, 3), dna(rng.randint(1, 40)), unit + dna(5), unit.translate(str.maketrans("ACGT", "TGCA"))[::-1]])) for j in range(rng.randint(1, 4))]
    c = spark.createDataFrame([(k, *p, "Chromosome") for k, own in items.items() for p in own], "item int, component string, topology string, sequence string, molecule_class string").repartition(3)
    got = {(r["item"], r["k"]): r for r in kmers.repeat_features(c, "item", [3, 9], most).collect()}
    for k, own in items.items():
        for size in (3, 9):
            n, many, top, several = plain_repeats(own, size)
            r = got.pop((k, size), None)
            assert (r is None) == (n == 0)
            if n:
                assert (r["valid_starts"], r["non_unique_fraction"], r["max_multiplicity"], r["shared_fraction"]) == (n, many / n, top, several / n)
    assert not got
    longest = {r["item"]: r["longest_repeat"] for r in kmers.longest_repeat(c, "item", most).collect()}
    assert longest == {k: max((s for s in range(1, 100) if plain_repeats(own, s)[1]), default=0) for k, own in items.items()}
    whole = {r["item"]: r for r in kmers.structural_features(c, "item", (3, 9)).collect()}
    for k, own in items.items():
        n, many, top, several = plain_repeats(own, 9)
        assert whole[k]["longest_repeat"] == longest[k] and whole[k]["non_unique_9"] == (many / n if n else 0) and whole[k]["max_mult_9"] == top
        assert whole[k]["total_length"] == sum(len(s) for _, _, s in own) and whole[k]["shared_9"] == (several / n if n else 0)


def plain_scenario(rows, name, n):
    key = lambda i: sha(f"scenario-v1|{name}|{i}")
    drawn = lambda some, k: sorted(some, key=lambda r: (key(r[0]), r[0]))[:k]
    new = lambda r: ("new-" + key(r[0])[:16], r[1])
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    ordered = sorted(groups, key=lambda g: (-len(groups[g]), sha(NS + g)))
    out = drawn(rows, n)
    if name == "add":
        return rows + [new(r) for r in out]
    if name == "remove":
        return [r for r in rows if r not in out]
    if name == "replace":
        return [r for r in rows if r not in out] + [new(r) for r in out]
    if name == "grow_largest":
        return rows + [new(r) for g in ordered[:10] for r in drawn(groups[g], n // 10)]
    if name == "new_groups":
        return rows + [(new(r)[0], "group-" + new(r)[0]) for r in out]
    if name == "split_largest":
        moved = drawn(groups[ordered[0]], n)
        return [(r[0], r[1] + "-split") if r in moved else r for r in rows]
    alone = {r[1] for r in drawn([own[0] for own in groups.values() if len(own) == 1], n)}
    return [(r[0], "merged") if r[1] in alone else r for r in rows]


def test_scenarios_and_stability(spark):
    rng = random.Random(7)
    rows = [(f"i{k}", f"g{min(rng.randint(0, 40), rng.randint(0, 40))}") for k in range(90)]
    df = spark.createDataFrame(rows, "item string, grp string").repartition(3)
    for name in sensitivity.SCENARIOS:
        got = sorted((r["item"], r["grp"]) for r in sensitivity.scenario(df, "item", "grp", name, 20).select("item", "grp").collect())
        assert got == sorted(plain_scenario(rows, name, 20)), name
    before, after = rng.sample(range(90), 20), rng.sample(range(90), 20)
    there = {r[0] for r in plain_scenario(rows, "remove", 20)}
    ladder = lambda order: spark.createDataFrame([(k + 1, f"i{i}") for k, i in enumerate(order)], "rank int, item string")
    got = {r["n"]: (r["shared"], r["changed"], r["unavailable"], r["new_items"]) for r in compare.stability(ladder(before), ladder(after), spark.createDataFrame([(i,) for i in there], "item string"), "item", [5, 20]).collect()}
    for n in (5, 20):
        a, b = {f"i{i}" for i in before[:n]}, {f"i{i}" for i in after[:n]}
        assert got[n] == (len(a & b), len(b - a), len(a - there), len(b - {f"i{i}" for i in before}))


def test_invariance_finds_plans_that_depend_on_order(spark):
    df = frame(spark, universe(8, False))
    assert sensitivity.invariant(df, lambda d: selection.representatives(d, "item", "grp"))
    assert not sensitivity.invariant(df, lambda d: d.withColumn("n", F.monotonically_increasing_id()))


def test_product_decision(spark):
    scores = lambda rows: spark.createDataFrame(rows, "a double, b double")
    assert compare.product_decision(scores([(0.1, 0.2), (0.3, 0.1)]), "a", "b") == "B"
    assert compare.product_decision(scores([(0.1, 0.3), (0.3, 0.1)]), "a", "b") == "UNRESOLVED"
    assert compare.product_decision(scores([(0.1, 0.3), (0.3, math.nextafter(0.1, 0))]), "a", "b") == "B"


def test_ranks_of_a_whole_table(spark):
    rng = random.Random(2)
    rows = [(k, rng.randint(0, 300) / 7) for k in range(2000)]
    got = {r["k"]: r["rank"] for r in ranked(spark.createDataFrame(rows, "k int, v double").repartition(5), "v", ["v", "k"]).collect()}
    assert got == {k: n for n, (k, _) in enumerate(sorted(rows, key=lambda r: (r[1], r[0])), 1)}


def test_ablation_and_swapped_scales(spark):
    rows = universe(9, False, n=40, groups=6)
    df = frame(spark, rows).select("item", "grp", *[F.col("coords")[k].alias(c) for k, c in enumerate("xyz")]).withColumn("coords", F.array("x", "y", "z"))
    got = {(r["dropped"], r["n"]): r for r in sensitivity.ablation(df, "item", "grp", ["x", "y", "z"], {"no x": ["x"]}, 5, [2, 5]).collect()}

    def ladder(points):
        groups = {}
        for i, g, _ in rows:
            groups.setdefault(g, []).append(i)
        reps = [min(own, key=lambda i: (d2(points[i], mean([points[j] for j in own])), sha(NS + i))) for own in groups.values()]
        out = [min(reps, key=lambda i: (d2(points[i], mean([points[j] for j in reps])), sha(NS + i)))]
        while len(out) < 5:
            out.append(min((i for i in reps if i not in out), key=lambda i: (-min(d2(points[i], points[j]) for j in out), sha(NS + i))))
        return out

    full, less = ladder({i: c for i, _, c in rows}), ladder({i: c[1:] for i, _, c in rows})
    sizes = {g: sum(r[1] == g for r in rows) for _, g, _ in rows}
    for n in (2, 5):
        panel = [c for i, _, c in rows if i in less[:n]]
        far = sum(math.sqrt(min(d2(c, p) for p in panel)) / sizes[g] for _, g, c in rows) / len(sizes)
        r = got["no x", n]
        assert r["shared"] == len(set(full[:n]) & set(less[:n])) and r["weighted_mean"] == pytest.approx(far)
    values = spark.createDataFrame([(i, g, k, f, c[j] * k) for i, g, c in rows for k in (1, 2, 3) for j, f in enumerate("ab")], "item string, grp string, k int, family string, value double")
    swapped = {r["item"]: r for r in sensitivity.swap_scales(df, values, "item", "grp", ["z"], (1, 3), ["a", "b"]).collect()}
    share = lambda j, c: sum((2 if o[2][j] < c[j] else 1 if o[2][j] == c[j] else 0) / sizes[o[1]] / len(sizes) for o in rows) / 2
    for i, _, c in rows:
        assert [swapped[i][x] for x in ("z", "a_1", "a_3", "b_1", "b_3")] == pytest.approx([share(2, c), share(0, c), share(0, c), share(1, c), share(1, c)])


def plain_quantile(distances, groups, q):
    """The least distance with at least the share ``q`` of the weight, in exact fractions."""
    sizes = Counter(groups)
    total, reached = Fraction(0), q * len(sizes)
    for d, g in sorted(zip(distances, groups, strict=True)):
        total += Fraction(1, sizes[g])
        if total >= reached:
            return d
    raise AssertionError


@pytest.mark.parametrize(("points", "coarse"), [(1 << 29, False), (200, True)])
def test_random_quantiles_by_a_plain_version(spark, monkeypatch, points, coarse):
    """With ties and distances of 0, with panels in one slice and in several, and with blocks smaller than a task."""
    monkeypatch.setattr(sensitivity, "POINTS", points)
    rows = universe(9, coarse, 150, 7)
    df = spark.createDataFrame(rows, "item string, grp string, coords array<double>").repartition(3)
    ladders = selection.random_ladders(df, "item", "grp", 5, 6)
    sizes, at = [1, 3, 6, 50], sensitivity.QUANTILES | {"all": Fraction(1), "third": Fraction(1, 3)}
    got = {(r.replicate, r.n): r for r in sensitivity.random_quantiles(df, "item", "grp", ladders, sizes, at).collect()}
    by, panels = {i: c for i, _, c in rows}, {}
    for r in ladders.collect():
        panels.setdefault(r.replicate, []).append((r["rank"], by[r.item]))
    assert set(got) == {(r, n) for r in panels for n in sizes}
    for replicate, panel in panels.items():
        for n in sizes:
            near = [math.sqrt(min(reduce(lambda s, x: s + (x[0] - x[1]) * (x[0] - x[1]), zip(c, p, strict=True), 0.0) for k, p in panel if k <= n)) for _, _, c in rows]
            for name, q in at.items():
                assert got[replicate, n][name] == plain_quantile(near, [g for _, g, _ in rows], q), (replicate, n, name)
    means = sensitivity.random_coverage(df, "item", "grp", ladders, sizes)
    assert means.count() == 5 * 4 * len({g for _, g, _ in rows}) and sensitivity.random_metrics(means, sensitivity.random_quantiles(df, "item", "grp", ladders, sizes)).count() == 20


def test_no_random_panels(spark):
    df = spark.createDataFrame([], "item string, grp string, coords array<double>")
    ladders = spark.createDataFrame([], "replicate int, rank int, grp string, item string")
    assert sensitivity.random_quantiles(df, "item", "grp", ladders, [1]).count() == 0 and sensitivity.random_coverage(df, "item", "grp", ladders, [1]).count() == 0


def test_random_ladders_are_permutations_and_nest(spark):
    rows = universe(4, False, 300, 40)
    df = frame(spark, rows)
    groups = {i: g for i, g, _ in rows}
    n = len(set(groups.values()))
    long = selection.random_ladders(df, "item", "grp", 30, 100).collect()
    assert len(long) == 30 * n
    by = {}
    for r in long:
        assert groups[r.item] == r.grp
        by.setdefault(r.replicate, {})[r["rank"]] = (r.grp, r.item)
    assert all(sorted(own) == [*range(1, n + 1)] and len({g for g, _ in own.values()}) == n for own in by.values())
    assert len({tuple(own[k][0] for k in range(1, n + 1)) for own in by.values()}) == 30
    short = selection.random_ladders(df.repartition(7), "item", "grp", 30, 5).collect()
    assert len(short) == 150 and all(by[r.replicate][r["rank"]] == (r.grp, r.item) for r in short)
    firsts, drawn = Counter(own[1][0] for own in by.values()), Counter(i for own in by.values() for _, i in own.values())
    assert max(firsts.values()) <= 8 and len(drawn) > 0.7 * len(rows)
    assert selection.random_ladders(df.where("false"), "item", "grp", 3, 5).count() == 0
    one = selection.random_ladders(df.where("item = 'i0'"), "item", "grp", 2, 5).collect()
    assert [(r["rank"], r.item) for r in one] == [(1, one[0].item)] * 2
