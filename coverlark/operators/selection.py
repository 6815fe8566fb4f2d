"""Representatives and farthest-first ladders."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.keys import MULTIPLIERS, PRIME, draw_key, item_key, member_key, mixed, permuted, round_key
from ..functions.prefix import ranked
from ..functions.state import keep
from ..functions.vectors import distances, exact_means, squared_distance
from .checks import BadInput

NAMESPACE = "panel-v1|"


def representatives(df: DataFrame, item: str, group: str, coords: str = "coords", namespace: str = NAMESPACE) -> DataFrame:
    """(group, item, coords, tie, d2): of each group the item nearest its exact centroid; ties go by a hash of the id."""
    keyed = df.select(item, group, coords, item_key(item, namespace).alias("tie"))
    centers = exact_means(df, [group], coords, "_center")
    near = keyed.join(centers, group).select(group, F.struct(squared_distance(F.col(coords), F.col("_center")).alias("d2"), "tie", item, coords).alias("x"))
    return near.groupBy(group).agg(F.min("x").alias("x")).select(group, f"x.{item}", f"x.{coords}", "x.tie", "x.d2")


def _once(df: DataFrame, item: str) -> int:
    """How many rows there are; refuses null and repeated ids."""
    rows, ids = df.agg(F.count("*"), F.count_distinct(item)).first()
    if rows != ids:
        raise BadInput(f"{rows} rows have {ids} different {item}")
    return rows


def _nearer(state: DataFrame, picked: list, new: int) -> DataFrame:
    """``state`` (coords, d2, near and others) with each item's squared distance to the nearest pick, and that pick's number.

    ``picked`` has all picks' coordinates, and those from number ``new`` on have not been looked at yet. Items near one pick
    form a cell around it. By the triangle inequality a pick that lies at least twice as far from the cell's centre as an item
    does can't be nearer to that item, so only items beyond half that distance are compared with it; most cells have none.
    """
    picks = np.array(picked, float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at = {n: batch.schema.get_field_index(n) for n in ("coords", "d2", "near")}
            x = batch.column(at["coords"]).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            low = np.array(batch.column(at["d2"]))
            near = np.array(batch.column(at["near"]))
            cells = np.union1d(near, np.arange(new, len(picks)))
            centers, cell = picks[cells], np.searchsorted(cells, near)
            for k in range(new, len(picks)):
                rows = np.flatnonzero(np.isinf(low) | (distances(centers, picks[k])[cell] < low * (4 * (1 + 1e-9))))
                found = distances(x[rows], picks[k])
                less = found < low[rows]
                low[rows[less]] = found[less]
                cell[rows[less]] = len(cells) - len(picks) + k
            columns = list(batch.columns)
            columns[at["d2"]], columns[at["near"]] = pa.array(low), pa.array(cells[cell].astype(np.int32))
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return state.mapInArrow(run, state.schema)


def maximin_ladder(df: DataFrame, item: str, coords: str = "coords", size: int | None = None, namespace: str = NAMESPACE, batch: int = 1024) -> DataFrame:
    """(rank, item, score): the item nearest the centroid first, then always the one farthest from all chosen so far.

    A pass over the data updates every item's squared distance to the nearest chosen item against the last picks alone,
    and of these against the few that can be nearer (``_nearer``). It brings the ``batch`` + 1 farthest to the driver. Picks
    among them are exact as long as the best of them beats what the last of them had before, for distances only fall.
    ``size`` bounds what the driver holds; without it the ladder is complete.
    """
    spark = df.sparkSession
    state = keep(df.select(item, F.col(coords).cast("array<double>").alias("coords"), item_key(item, namespace).alias("tie"), F.lit(float("inf")).alias("d2"), F.lit(0).alias("near")))
    n = _once(state, item)
    size = n if size is None else min(size, n)
    schema = f"rank int, {item} {df.schema[item].dataType.simpleString()}, score double"
    if not n:
        return spark.createDataFrame([], schema)
    center = exact_means(state, [], "coords", "c").first()["c"]
    to_center = squared_distance(F.col("coords"), F.array(*[F.lit(float(x)) for x in center]))
    first = state.select(to_center.alias("to_center"), "tie", item, "coords").orderBy("to_center", "tie").first()
    ladder = [(1, first[item], first["to_center"])]
    picked, seen = [list(first["coords"])], 0
    while len(ladder) < size:
        before, state = state, keep(_nearer(state.where(~F.col(item).isin([i for _, i, _ in ladder[seen:]])), picked, seen))
        seen = len(picked)
        top = state.orderBy(F.desc("d2"), "tie").limit(batch + 1).select(item, "coords", "tie", "d2").collect()
        before.unpersist()
        bound = (-top[batch]["d2"], top[batch]["tie"]) if len(top) > batch else None
        top = top[:batch]
        x, low, ties = np.array([r["coords"] for r in top]), np.array([r["d2"] for r in top]), [r["tie"] for r in top]
        while len(ladder) < size and low.max() >= 0:
            best = min(np.flatnonzero(low == low.max()).tolist(), key=ties.__getitem__)
            if bound is not None and (-low[best], ties[best]) > bound:
                break
            ladder.append((len(ladder) + 1, top[best][item], float(low[best])))
            picked.append(list(top[best]["coords"]))
            low = np.minimum(low, distances(x, x[best]))
            low[best] = -1.0  # taken, and stays the least
    return spark.createDataFrame(ladder, schema)


def group_ladder(df: DataFrame, item: str, group: str, coords: str = "coords", size: int | None = None, namespace: str = NAMESPACE) -> DataFrame:
    """(rank, item, group, score): a maximin ladder of the groups' representatives, one item a group."""
    chosen = keep(representatives(df, item, group, coords, namespace))
    ladder = maximin_ladder(chosen.select(item, F.col(coords).alias("coords")), item, "coords", size, namespace)
    return ladder.join(chosen.select(item, group), item).select("rank", item, group, "score")


def _point(values) -> Column:
    return F.array(*[F.lit(float(x)) for x in values])


def _first_group(state: DataFrame, level: DataFrame, item: str, group: str, namespace: str):
    """Of the groups in the table ``level``, which are equally good, the one whose key, made from all its members, is least.

    Keys are made for these groups alone, and none for a group by itself. Only the least comes to the driver.
    """
    few = level.select(group).limit(2).collect()
    if len(few) == 1:
        return few[0][group]
    keys = state.join(level.select(group), group).groupBy(group).agg(member_key(item, namespace).alias("key"))
    return keys.orderBy("key").first()[group]


def residual_ladder(df: DataFrame, item: str, group: str, coords: str = "coords", size: int = 500, namespace: str = NAMESPACE, held: int = 20_000) -> DataFrame:
    """(rank, item, group, score): always from the group whose members lie farthest, on average, from what is chosen.

    The first group is that whose centroid is nearest the centroid of all groups' centroids, and its item nearest that
    point. Then, of groups with an item that is not chosen, the one with the greatest mean squared distance over all its
    members (chosen ones count 0), and in it the farthest open item. score is that mean. The ladder ends when no item is left.

    A pass updates every item's distance to the nearest chosen item against the last picks alone, and brings the groups
    with the highest means to the driver, at most ``held`` items together. Means only fall, so picks among these groups are
    right as long as the best of them is above the next group's mean. A group of over ``held`` items stays where it is, and
    the pass gives one pick. Means are sums rounded once, so they don't depend on order.
    """
    spark = df.sparkSession
    kinds = {c: df.schema[c].dataType.simpleString() for c in (item, group)}
    schema = f"rank int, {item} {kinds[item]}, {group} {kinds[group]}, score double"
    state = keep(df.select(item, group, F.col(coords).cast("array<double>").alias("coords"), item_key(item, namespace).alias("tie"), F.lit(float("inf")).alias("d2"), F.lit(0).alias("near"), F.lit(True).alias("open")))
    centers = keep(exact_means(state, [group], "coords", "center"))
    middle = exact_means(centers, [], "center", "c").first()
    if middle is None:
        return spark.createDataFrame([], schema)
    to_middle = lambda c: squared_distance(F.col(c), _point(middle["c"]))
    near = centers.select(group, to_middle("center").alias("d2"))
    first_group = _first_group(state, near.where(F.col("d2") == near.agg(F.min("d2")).first()[0]), item, group, namespace)
    largest = state.groupBy(group).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    near_by = max(1e-12, largest * 2.0**-51)  # how far a mean of doubles may be from the exact one
    first = state.where(F.col(group) == F.lit(first_group)).orderBy(to_middle("coords"), "tie").first()
    ladder = [(1, first[item], first_group, 0.0)]
    chosen = [(first[item], list(first["coords"]))]
    picked: list = []
    while len(ladder) < size:
        still = F.col("open") & ~F.col(item).isin([i for i, _ in chosen])
        seen, picked = len(picked), picked + [c for _, c in chosen]
        before, state = state, keep(_nearer(state.withColumn("open", still), picked, seen))
        means = state.groupBy(group).agg(F.avg("d2").alias("mean"), F.count("*").alias("n"), F.max("open").alias("any")).where("any")
        top = means.orderBy(F.desc("mean")).limit(257).collect()
        before.unpersist()
        if not top:
            break
        fits = [k for k, total in enumerate(accumulate(r["n"] for r in top), 1) if total <= held and k <= 256]
        bound = top[len(fits)]["mean"] if len(fits) < len(top) else None
        close = lambda a, b: abs(a - b) <= near_by * max(abs(a), abs(b))
        chosen = []
        if fits and (bound is None or not close(top[0]["mean"], bound)):
            names = [r[group] for r in top[: len(fits)]]
            chosen = _picks(state.where(F.col(group).isin(names)).collect(), state, item, group, bound and bound * (1 + near_by), size - len(ladder), namespace, ladder)
        if not chosen:  # the best groups are too large for the driver, or too many are level
            level = means.where(F.col("mean") >= top[0]["mean"] * (1 - near_by))
            exact = exact_means(state.join(level.select(group), group).withColumn("_d", F.array("d2")), [group], "_d", "m").select(group, F.col("m")[0].alias("m"))
            exact = keep(exact)
            best = exact.agg(F.max("m")).first()[0]
            name = _first_group(state, exact.where(F.col("m") == best), item, group, namespace)
            far = state.where((F.col(group) == F.lit(name)) & F.col("open")).orderBy(F.desc("d2"), "tie").first()
            chosen = [(far[item], list(far["coords"]))]
            ladder.append((len(ladder) + 1, far[item], name, best))
    return spark.createDataFrame(ladder, schema)


def _picks(rows: list, state: DataFrame, item: str, group: str, bound: float | None, most: int, namespace: str, ladder: list) -> list[tuple]:
    """Picks among the members of a few groups, which are added to ``ladder`` too; it ends where another group could be better."""
    members: dict = {}
    for r in rows:
        members.setdefault(r[group], []).append([r["d2"], r["tie"], r[item], list(r["coords"]), r["open"]])
    x = {g: np.array([m[3] for m in own]) for g, own in members.items()}
    low = {g: np.array([m[0] for m in own]) for g, own in members.items()}
    mean = {g: math.fsum(v.tolist()) / len(v) for g, v in low.items()}
    picks: list[tuple] = []
    while len(picks) < most:
        able = [g for g, own in members.items() if any(m[4] for m in own)]
        if not able:
            break
        top = max(mean[g] for g in able)
        if bound is not None and top <= bound:
            break
        level = [g for g in able if mean[g] == top]
        name = level[0] if len(level) == 1 else _first_group(state, state.where(F.col(group).isin(level)).select(group).distinct(), item, group, namespace)
        at = min((k for k, m in enumerate(members[name]) if m[4]), key=lambda k: (-low[name][k], members[name][k][1]))
        pick = members[name][at]
        pick[4] = False
        picks.append((pick[2], pick[3]))
        ladder.append((len(ladder) + 1, pick[2], name, top))
        for g, points in x.items():
            low[g] = np.minimum(low[g], distances(points, pick[3]))
            mean[g] = math.fsum(low[g].tolist()) / len(points)
    return picks


def draw(df: DataFrame, item: str, n: int, namespace: str, scenario: str) -> DataFrame:
    """The first ``n`` items in the order of a hash of the scenario and the id."""
    return df.withColumn("draw_key", draw_key(item, namespace, scenario)).orderBy("draw_key", item).limit(n).drop("draw_key")


def largest_groups(df: DataFrame, group: str, n: int, namespace: str = NAMESPACE) -> DataFrame:
    """(group, group_size) of the ``n`` largest groups; ties go by a hash of the group."""
    sizes = df.groupBy(group).agg(F.count("*").alias("group_size"))
    return sizes.orderBy(F.desc("group_size"), item_key(group, namespace)).limit(n)


def random_ladders(df: DataFrame, item: str, group: str, replicates: int, size: int, seed: int = 20260824) -> DataFrame:
    """(replicate, rank, group, item): groups in a random order for each replicate, a random item of each; nested in size.

    Groups are numbered once by a hash, and items within their group. A replicate permutes the numbers of groups by
    arithmetic (``functions.keys.permuted``) and looks up the first ``size``, so that its cost does not grow with the table.
    The permutation is one of a few more numbers than there are groups; those beyond them are left out, and as many more
    places are looked at. Repeated ids are refused. Results depend on neither order nor partitions. Items of a group are drawn evenly up to 2 ** 31.
    """
    spark = df.sparkSession
    key = lambda c: F.sha2(F.concat(F.lit(f"{seed}|"), F.col(c).cast("string")), 256)
    share = lambda c: F.conv(F.substring(c, 1, 13), 16, 10).cast("double") / float(1 << 52)
    sizes = df.groupBy(group).agg(F.count("*").alias("_size")).withColumn("_key", key(group)).withColumn("_number", share("_key"))
    groups = keep(ranked(sizes, "_number", ["_key", group], "_g", "long").select(group, "_size", (F.col("_g") - 1).alias("_g")))
    n = groups.count()
    if not n:
        return spark.createDataFrame([], f"replicate int, rank int, {group} {df.schema[group].dataType.simpleString()}, {item} {df.schema[item].dataType.simpleString()}")
    items = df.select(item, group).join(groups.select(group, "_g"), group).withColumn("_key", key(item)).withColumn("_number", F.col("_g") + share("_key"))
    items = keep(ranked(items, "_number", ["_g", "_key", item], "_i", "long").select(item, "_g", "_i"))
    _once(items, item)
    groups = groups.join(items.groupBy("_g").agg(F.min("_i").alias("_first")), "_g")
    rows = math.isqrt(n - 1) + 1
    columns = -(-n // rows)
    looked = min(rows * columns, size + rows * columns - n)
    places = spark.range(replicates * looked).select((F.floor(F.col("id") / looked) + 1).cast("int").alias("replicate"), (F.col("id") % looked).alias("_k"))
    drawn = places.withColumn("_g", permuted(F.col("_k"), F.col("replicate"), rows, columns, seed)).where(F.col("_g") < n)
    drawn = drawn.withColumn("rank", F.row_number().over(Window.partitionBy("replicate").orderBy("_k"))).where(F.col("rank") <= size)
    found = drawn.join(groups, "_g").withColumn("_i", F.col("_first") + mixed(F.col("_g"), F.col("replicate"), F.lit(round_key(seed, -1))) % F.col("_size"))
    return found.select("replicate", "rank", group, "_i").join(items.select(item, "_i"), "_i").select("replicate", "rank", group, item)


def random_ladders_sql(items: str, item: str, group: str, replicates: int, size: int, seed: int = 20260824) -> str:
    """The same in SQL, as common table expressions that end with ``picks`` (replicate, rank, group, item)."""

    def mix(value: str, step: int) -> str:
        x = f"(({value} + (replicate::BIGINT * {MULTIPLIERS[1]} + {round_key(seed, step)}) % {PRIME}) % {PRIME})"
        return f"(({x} * {x}) % {PRIME} * {MULTIPLIERS[1]} % {PRIME})"

    steps = [f"s0 AS (SELECT replicate, k, k // nc AS x, k % nc AS y, n, nr, nc FROM shape, generate_series(1, {replicates}) r(replicate), LATERAL (SELECT unnest(range(0, least(nr * nc, {size} + nr * nc - n))) AS k))"]
    for step in range(6):
        moved = f"x, (y + {mix('x', step)}) % nc AS y" if step % 2 else f"(x + {mix('y', step)}) % nr AS x, y"
        steps.append(f"s{step + 1} AS (SELECT replicate, k, {moved}, n, nr, nc FROM s{step})")
    return f"""numbered AS (SELECT {group} AS grp, count(*) AS size, row_number() OVER (ORDER BY sha256('{seed}|' || {group}), {group}) - 1 AS g FROM {items} GROUP BY {group}),
shape AS (SELECT n, nr, (n + nr - 1) // nr AS nc FROM (SELECT n, ceil(sqrt(n::DOUBLE))::BIGINT AS nr FROM (SELECT count(*) AS n FROM numbered))),
{", ".join(steps)},
places AS (SELECT replicate, x * nc + y AS g, row_number() OVER (PARTITION BY replicate ORDER BY k) AS rank FROM s6 WHERE x * nc + y < n),
positions AS (SELECT {item} AS item, {group} AS grp, row_number() OVER (PARTITION BY {group} ORDER BY sha256('{seed}|' || {item}), {item}) - 1 AS place FROM {items}),
picks AS (SELECT replicate, rank, p.grp, p.item FROM (SELECT replicate, rank, grp, {mix("g", -1)} % size AS place FROM places JOIN numbered USING (g) WHERE rank <= {size}) JOIN positions p USING (grp, place))"""


def audit_ladder(ladder: DataFrame, item: str) -> DataFrame:
    """One row: how many ranks, distinct items, gaps and repeated ranks a ladder has, and whether it is sound."""
    row = ladder.agg(F.count("*").alias("n_rows"), F.count_distinct("rank").alias("ranks"), F.count_distinct(item).alias("items"), F.min("rank").alias("low"), F.max("rank").alias("high"))
    sound = (F.col("n_rows") == F.col("ranks")) & (F.col("n_rows") == F.col("items")) & (F.col("low") == 1) & (F.col("high") == F.col("n_rows"))
    return row.withColumn("sound", sound)
