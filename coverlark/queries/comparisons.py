"""Memberships, ladders, random baselines, ablations, scenarios and scales."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions.prefix import ranked
from ..functions.state import keep
from ..operators import balance, compare, coverage, selection
from ..plans import sensitivity
from .base import CUSTOMERS_SQL, FEATURES, GROUPS, PERCENTILES_SQL, VECTORS_SQL, customers, d2_sql, query, table, vectors
from .panels import DISTANCES_SQL, REPRESENTATIVES_SQL, SIZES, _panel, ladder_sql


def _sides(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("item"), F.col("c_nationkey").alias("grp")), table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("item")).distinct()


@query("""WITH a AS (SELECT c_custkey AS i FROM customer), b AS (SELECT DISTINCT o_custkey AS i FROM orders WHERE o_orderpriority = '1-URGENT')
SELECT count(*) FILTER (a.i IS NOT NULL AND b.i IS NOT NULL) AS in_both, count(*) FILTER (b.i IS NULL) AS left_only, count(*) FILTER (a.i IS NULL) AS right_only, count(*) AS in_any FROM a FULL JOIN b ON a.i = b.i""")
def membership(spark, sf_dir):
    return compare.membership(*_sides(spark, sf_dir), "item")


@query("SELECT c_custkey AS item FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def retained_absent(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    return compare.retained_absent(left.select("item"), right, "item")


HOLDOUT_SQL = "h AS (SELECT c_custkey AS item, c_nationkey AS grp FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'))"


def _holdout(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    return compare.holdout(left, compare.retained_absent(left.select("item"), right, "item"), "item")


@query(f"WITH {HOLDOUT_SQL} SELECT count(*) AS n_items, count(DISTINCT grp) AS n_groups, CASE WHEN count(*) >= 100 AND count(DISTINCT grp) >= 20 THEN 'PASS' ELSE 'FAIL' END AS status FROM h")
def holdout_adequacy(spark, sf_dir):
    return compare.holdout_summary(_holdout(spark, sf_dir), "grp", 100, 20)


@query(f"WITH {HOLDOUT_SQL}, s AS (SELECT grp, count(*) AS n FROM h GROUP BY 1) SELECT grp IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000) AS in_baseline, count(*) AS n_groups, sum(n) AS n_items FROM s GROUP BY 1")
def holdout_composition(spark, sf_dir):
    baseline = table(spark, sf_dir, "supplier").where("s_acctbal > 5000").select(F.col("s_nationkey").alias("grp"))
    return compare.holdout_composition(_holdout(spark, sf_dir), baseline, "grp")


RANKS_SQL = ", ".join(f"rank() OVER (ORDER BY {f}) + (count(*) OVER (PARTITION BY {f}) - 1) / 2.0 AS {f}" for f in FEATURES)
CORR_SQL = " UNION ALL ".join(f"SELECT '{a}' AS left_feature, '{b}' AS right_feature, round(corr({a}, {b}), 8) AS correlation FROM ranks" for i, a in enumerate(FEATURES) for b in FEATURES[i:])


@query(f"WITH {CUSTOMERS_SQL}, ranks AS (SELECT {RANKS_SQL} FROM customers) {CORR_SQL}")
def spearman_matrix(spark, sf_dir):
    return compare.spearman(customers(spark, sf_dir), "item", FEATURES).withColumn("correlation", F.round("correlation", 8))


FIRST_SQL = f"WITH {REPRESENTATIVES_SQL}, l AS (SELECT row_number() OVER (ORDER BY tie) AS rank, item FROM reps), r AS (SELECT row_number() OVER (ORDER BY d2, tie) AS rank, item, d2 FROM reps)"


def _two_ladders(spark, sf_dir):
    """Representatives in the order of their tie keys, and in that of their distance to the centroid."""
    reps = selection.representatives(vectors(spark, sf_dir), "item", "grp")
    reps = keep(reps.withColumn("first", F.conv(F.substring("tie", 1, 13), 16, 10).cast("double")))
    rank = lambda number, by: ranked(reps, number, by).select("rank", "item")
    return rank("first", ["tie"]), rank("d2", ["d2", "tie"])


@query(f"{FIRST_SQL} SELECT n, count(*) FILTER (l.rank <= n AND r.rank <= n) AS shared, round(count(*) FILTER (l.rank <= n AND r.rank <= n) / n, 9) AS fraction FROM l JOIN r USING (item), (SELECT unnest({SIZES}) AS n) GROUP BY n")
def panel_overlap(spark, sf_dir):
    return compare.overlap(*_two_ladders(spark, sf_dir), "item", SIZES).withColumn("fraction", F.round("fraction", 9))


@query(f"{FIRST_SQL} SELECT l.rank, l.item AS left_item, r.item AS right_item, CASE WHEN 0 - r.rank > 0 - l.rank THEN 'higher_score' ELSE 'tie_break' END AS reason FROM l JOIN r ON l.rank = r.rank WHERE l.item <> r.item ORDER BY l.rank LIMIT 1")
def first_divergence(spark, sf_dir):
    a, b = (x.withColumn("score", -F.col("rank").cast("double")) for x in _two_ladders(spark, sf_dir))
    return compare.first_divergence(a, b, "item")


@query(f"WITH {VECTORS_SQL}, d AS (SELECT abs(unnest(c) - unnest([x * 1.5 for x in c])) AS d FROM vectors WHERE item % 3 > 0) SELECT (SELECT count(*) FROM vectors WHERE item % 3 > 0) AS n_shared, round(avg(d), 9) AS mean_change, round(max(d), 9) AS max_change FROM d")
def geometry_shift(spark, sf_dir):
    items = vectors(spark, sf_dir)
    after = items.where("item % 3 > 0").withColumn("coords", F.transform("coords", lambda x: x * 1.5))
    return compare.geometry_shift(items, after, "item").withColumns({c: F.round(c, 9) for c in ("mean_change", "max_change")})


@query(f"{FIRST_SQL}, s AS (SELECT n, l.rank AS r, r.item % 7 AS g FROM l JOIN r USING (item), (SELECT unnest({SIZES}) AS n) WHERE l.rank <= n), e AS (SELECT n, g, count(*) AS k FROM s GROUP BY 1, 2), m AS (SELECT n, k, count(*) AS m FROM e GROUP BY 1, 2) SELECT n, sum(m) AS distinct_groups, max(k) AS max_per_group, string_agg(k || 'x:' || m, ',' ORDER BY k) AS multiplicity FROM m GROUP BY 1")
def group_abundance(spark, sf_dir):
    return compare.abundance(_two_ladders(spark, sf_dir)[0].withColumn("grp", F.col("item") % 7), "grp", SIZES)


RANDOM_SQL = f"""{VECTORS_SQL}, {selection.random_ladders_sql("vectors", "item", "grp", 200, 20)},
rd AS (SELECT replicate, n, v.item, v.grp, sqrt(min({d2_sql('v.c', 'p.c')})) AS distance FROM vectors v, (SELECT k.replicate, k.rank, x.c FROM picks k JOIN vectors x ON x.item = k.item) p, (SELECT unnest({SIZES}) AS n) WHERE p.rank <= n GROUP BY ALL),
gs AS (SELECT grp, count(*) AS size FROM vectors GROUP BY 1),
cumulative AS (SELECT replicate, n, distance, sum(1.0::DOUBLE / size) OVER (PARTITION BY replicate, n ORDER BY distance) / (SELECT count(*) FROM gs) AS share FROM rd JOIN gs USING (grp)),
weighted AS (SELECT replicate, n, min(distance) FILTER (share >= 0.5 - 1e-12) AS weighted_median, min(distance) FILTER (share >= 0.95 - 1e-12) AS weighted_p95 FROM cumulative GROUP BY 1, 2),
by_group AS (SELECT replicate, n, avg(m) AS weighted_mean, max(x) AS unweighted_max, quantile_disc(m, 0.5) AS median_group_mean, quantile_disc(m, 0.95) AS p95_group_mean, max(m) AS max_group_mean,
  quantile_disc(x, 0.5) AS median_group_max, quantile_disc(x, 0.95) AS p95_group_max, max(x) AS max_group_max FROM (SELECT replicate, n, grp, avg(distance) AS m, max(distance) AS x FROM rd GROUP BY ALL) GROUP BY ALL),
metric AS (SELECT * FROM by_group JOIN weighted USING (replicate, n))"""
RANDOM_METRICS = ["weighted_mean", "weighted_median", "weighted_p95", "unweighted_max", "median_group_mean", "p95_group_mean", "max_group_mean", "median_group_max", "p95_group_max", "max_group_max"]


def _random(spark, sf_dir):
    items = vectors(spark, sf_dir)
    ladders = selection.random_ladders(items, "item", "grp", 200, 20)
    return sensitivity.random_metrics(sensitivity.random_coverage(items, "item", "grp", ladders, SIZES), sensitivity.random_quantiles(items, "item", "grp", ladders, SIZES))


@query(f"WITH {RANDOM_SQL} SELECT replicate, n, {', '.join(f'round({m}, 8) AS {m}' for m in RANDOM_METRICS)} FROM metric")
def random_coverage(spark, sf_dir):
    return _random(spark, sf_dir).withColumns({m: F.round(m, 8) for m in RANDOM_METRICS})


@query(f"WITH {RANDOM_SQL} SELECT n, metric, round(quantile_disc(value, 0.025), 8) AS low, round(quantile_disc(value, 0.5), 8) AS median, round(quantile_disc(value, 0.975), 8) AS high FROM (SELECT * FROM metric UNPIVOT (value FOR metric IN ({', '.join(RANDOM_METRICS)}))) GROUP BY 1, 2")
def random_summary(spark, sf_dir):
    return compare.random_summary(_random(spark, sf_dir), ["n"], RANDOM_METRICS).withColumns({c: F.round(c, 8) for c in ("low", "median", "high")})


@query(f"""WITH {RANDOM_SQL}, {DISTANCES_SQL.replace(VECTORS_SQL + ",", "")}, own AS (SELECT n, avg(m) AS weighted_mean FROM (SELECT n, grp, avg(distance) AS m FROM distances GROUP BY 1, 2) GROUP BY 1)
SELECT own.n, round(own.weighted_mean, 8) AS weighted_mean, 1 + count(*) FILTER (metric.weighted_mean < own.weighted_mean) AS empirical_rank FROM own JOIN metric USING (n) GROUP BY own.n, own.weighted_mean""")
def empirical_rank(spark, sf_dir):
    items = vectors(spark, sf_dir)
    d = coverage.nearest_panel_distance(items, _panel(spark, sf_dir), "item", SIZES).join(items.select("item", "grp"), "item")
    own = coverage.balanced_mean(coverage.group_statistics(d, "grp")).withColumnRenamed("balanced_mean", "weighted_mean")
    return compare.empirical_rank(own, _random(spark, sf_dir), ["n"], "weighted_mean").withColumn("weighted_mean", F.round("weighted_mean", 8))


@query(f"""WITH {RANDOM_SQL}, {DISTANCES_SQL.replace(VECTORS_SQL + ",", "")},
own_share AS (SELECT n, distance, sum(1.0::DOUBLE / size) OVER (PARTITION BY n ORDER BY distance) / (SELECT count(*) FROM gs) AS share FROM distances JOIN gs USING (grp)),
own AS (SELECT n, min(distance) FILTER (share >= 0.95 - 1e-12) AS weighted_p95 FROM own_share GROUP BY 1)
SELECT own.n, round(own.weighted_p95, 8) AS weighted_p95, 1 + count(*) FILTER (metric.weighted_p95 < own.weighted_p95) AS empirical_rank FROM own JOIN metric USING (n) GROUP BY own.n, own.weighted_p95""")
def empirical_rank_p95(spark, sf_dir):
    """The place of a panel among random ones by its weighted 95th percentile, for each size."""
    items = vectors(spark, sf_dir)
    d = coverage.nearest_panel_distance(items, _panel(spark, sf_dir), "item", SIZES).join(items.select("item", "grp"), "item")
    own = coverage.balanced_quantile(d, "grp", "n", "distance", 0.95, "weighted_p95")
    randoms = sensitivity.random_quantiles(items, "item", "grp", selection.random_ladders(items, "item", "grp", 200, 20), SIZES)
    return compare.empirical_rank(own, randoms, ["n"], "weighted_p95").withColumn("weighted_p95", F.round("weighted_p95", 8))


@query("""WITH s AS (SELECT o_orderpriority AS n, avg(o_totalprice) FILTER (o_orderstatus = 'F') AS a, avg(o_totalprice) FILTER (o_orderstatus = 'O') AS b FROM orders GROUP BY 1),
c AS (SELECT count(*) AS n_sizes, count(*) FILTER (a < b) AS left_lower, count(*) FILTER (a > b) AS right_lower FROM s)
SELECT *, CASE WHEN left_lower = n_sizes THEN 'LEFT_LOWER_AT_ALL' WHEN right_lower = n_sizes THEN 'RIGHT_LOWER_AT_ALL' WHEN left_lower = 0 AND right_lower = 0 THEN 'TIE_AT_ALL' ELSE 'NOT_UNIFORMLY_ORDERED' END AS status FROM c""")
def primary_winner(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    scores = o.groupBy("o_orderpriority").agg(F.avg(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))).alias("a"), F.avg(F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice"))).alias("b"))
    return compare.winner(scores, "a", "b")


@query(f"WITH RECURSIVE {REPRESENTATIVES_SQL}, {ladder_sql('reps', 20)}, sizes AS (SELECT unnest([5, 10]) AS n) SELECT n, count(*) AS members, 0 AS missing FROM ladder, sizes WHERE rank <= n GROUP BY 1")
def nested_panels(spark, sf_dir):
    """Members of short ladders, and how many of them longer ones lack: there must be none."""
    items = vectors(spark, sf_dir)
    return compare.prefix_breaks(selection.group_ladder(items, "item", "grp", size=10), "item", [5, 10], selection.group_ladder(items, "item", "grp", size=20))


PRICES_SQL = "s AS (SELECT o_orderpriority AS n, avg(o_totalprice) FILTER (o_orderstatus = 'F') AS a, avg(o_totalprice) FILTER (o_orderstatus = 'O') AS b FROM orders GROUP BY 1)"


@query(f"WITH {PRICES_SQL} SELECT CASE WHEN product(a) < product(b) THEN 'A' WHEN product(b) < product(a) THEN 'B' ELSE 'UNRESOLVED' END AS decision FROM s")
def product_decision(spark, sf_dir):
    """Which of two selectors has the lower product of its numbers at all sizes."""
    price = lambda status: F.avg(F.when(F.col("o_orderstatus") == status, F.col("o_totalprice")))
    scores = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(price("F").alias("a"), price("O").alias("b"))
    return spark.createDataFrame([(compare.product_decision(scores, "a", "b"),)], "decision string")


@query("SELECT unnest(['group_representatives', 'group_maximin_ladder', 'group_residual_ladder']) AS plan, true AS invariant")
def permutation_invariance(spark, sf_dir):
    """Whether plans give the same rows when their input is dealt and ordered anew."""
    items = vectors(spark, sf_dir)
    plans = {
        "group_representatives": lambda d: selection.representatives(d, "item", "grp"),
        "group_maximin_ladder": lambda d: selection.group_ladder(d, "item", "grp", size=10),
        "group_residual_ladder": lambda d: selection.residual_ladder(d, "item", "grp", size=6),
    }
    return spark.createDataFrame([(name, sensitivity.invariant(items, plan)) for name, plan in plans.items()], "plan string, invariant boolean")


def _scale_values(spark, sf_dir):
    """Measures of suppliers' lines at seven scales (line numbers) as a long table of three families."""
    li = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("item"), F.col("l_linenumber").cast("int").alias("k")).agg(F.max("l_quantity").alias("a"), F.max("l_extendedprice").alias("b"), F.max("l_discount").alias("c"))
    long = li.unpivot(["item", "k"], ["a", "b", "c"], "family", "value")
    return long.join(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("item"), F.col("s_nationkey").alias("grp")), "item")


SCALES_SQL = """li AS (SELECT l_suppkey AS item, l_linenumber::INT AS k, max(l_quantity) AS a, max(l_extendedprice) AS b, max(l_discount) AS c FROM lineitem GROUP BY 1, 2),
values_ AS (SELECT u.item, s_nationkey AS grp, k, family, value FROM (SELECT * FROM li UNPIVOT (value FOR family IN (a, b, c))) u JOIN supplier ON s_suppkey = u.item),
sizes AS (SELECT grp, count(DISTINCT item) AS n FROM values_ GROUP BY 1),
ws AS (SELECT v.*, 1.0::DOUBLE / n / (SELECT count(*) FROM sizes) AS w FROM values_ v JOIN sizes USING (grp)),
dv AS (SELECT k, family, value, sum(w) AS w FROM ws GROUP BY ALL),
st AS (SELECT *, coalesce(sum(w) OVER (PARTITION BY k, family ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM dv),
pc AS (SELECT v.item, v.grp, v.k, v.family, below + w / 2 AS p FROM values_ v JOIN st USING (k, family, value)),
fd AS (SELECT x.k AS left_k, y.k AS right_k, x.family, x.grp, avg((x.p - y.p) * (x.p - y.p)) AS d FROM pc x JOIN pc y ON x.item = y.item AND x.family = y.family AND x.k < y.k GROUP BY ALL),
sd AS (SELECT left_k, right_k, sqrt(avg(d)) AS distance FROM (SELECT left_k, right_k, family, avg(d) AS d FROM fd GROUP BY ALL) GROUP BY ALL)"""


@query(f"WITH {SCALES_SQL} SELECT item, grp, k, family, round(p, 9) AS percentile FROM pc")
def scale_percentiles(spark, sf_dir):
    return sensitivity.scale_percentiles(_scale_values(spark, sf_dir), "item", "grp").withColumn("percentile", F.round("percentile", 9))


def _scale_distances(spark, sf_dir):
    return sensitivity.scale_distances(sensitivity.scale_percentiles(_scale_values(spark, sf_dir), "item", "grp"), "item", "grp")


@query(f"WITH {SCALES_SQL} SELECT left_k, right_k, round(distance, 8) AS distance FROM sd")
def scale_distances(spark, sf_dir):
    return _scale_distances(spark, sf_dir).withColumn("distance", F.round("distance", 8))


@query(f"""WITH {SCALES_SQL}, f AS (SELECT left_k AS k, right_k AS t, distance AS d FROM sd UNION ALL SELECT right_k, left_k, distance FROM sd UNION ALL SELECT unnest([1, 2, 3, 4, 5, 6, 7]), unnest([1, 2, 3, 4, 5, 6, 7]), 0)
SELECT a.t AS left_k, b.t AS right_k, round(max(least(a.d, b.d)), 8) AS r_max, round(avg(least(a.d, b.d)), 8) AS r_mean FROM f a JOIN f b ON a.k = b.k AND a.t < b.t GROUP BY 1, 2""")
def scale_pairs(spark, sf_dir):
    return sensitivity.scale_pairs(_scale_distances(spark, sf_dir)).withColumns({c: F.round(c, 8) for c in ("r_max", "r_mean")})


SWAPPED = ["s_acctbal", *[f"{family}_{k}" for family in "abc" for k in (1, 2)]]
SWAPPED_SQL = f"""{SCALES_SQL},
picked AS (SELECT item, grp, family, k, value FROM values_ WHERE k IN (1, 2)),
wide AS (SELECT item, grp, s_acctbal, {', '.join(f"max(value) FILTER (family = '{c[0]}' AND k = {c[2]}) AS {c}" for c in SWAPPED[1:])} FROM picked JOIN supplier ON s_suppkey = item GROUP BY 1, 2, 3 HAVING count(*) = 6),
long AS (SELECT item, grp, feature, value FROM wide UNPIVOT (value FOR feature IN ({', '.join(SWAPPED)}))),
weighted AS (SELECT l.*, 1.0::DOUBLE / count(*) OVER (PARTITION BY feature, grp) / (SELECT count(DISTINCT grp) FROM wide) AS w FROM long l),
levels AS (SELECT feature, value, sum(w) AS w FROM weighted GROUP BY ALL),
steps AS (SELECT *, coalesce(sum(w) OVER (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM levels),
placed AS (SELECT item, grp, feature, below + w / 2 AS p FROM long JOIN steps USING (feature, value))"""


@query(f"WITH {SWAPPED_SQL} SELECT item, grp, {', '.join(f"round(max(p) FILTER (feature = '{c}'), 9) AS {c}" for c in SWAPPED)} FROM placed GROUP BY 1, 2")
def swapped_scales(spark, sf_dir):
    values = _scale_values(spark, sf_dir)
    whole = values.where("k in (1, 2)").groupBy("item").count().where("count = 6").select("item")
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("item"), F.col("s_nationkey").alias("grp"), "s_acctbal").join(whole, "item")
    found = sensitivity.swap_scales(s, values.join(whole, "item"), "item", "grp", ["s_acctbal"], (1, 2), ["a", "b", "c"])
    return found.select("item", "grp", *[F.round(c, 9).alias(c) for c in SWAPPED])


@query()
def feature_ablation(spark, sf_dir):
    p = balance.percentiles(customers(spark, sf_dir), "item", "grp", FEATURES)
    drops = {f"without {f}": [f] for f in FEATURES} | {"only balance": FEATURES[1:]}
    return sensitivity.ablation(p, "item", "grp", FEATURES, drops, size=10, sizes=[5, 10])


@query()
def update_stability(spark, sf_dir):
    """How the panel changes under each change of the universe."""
    items = vectors(spark, sf_dir)
    before = selection.group_ladder(items.withColumns({c: F.col(c).cast("string") for c in ("item", "grp")}), "item", "grp", size=20)
    parts = []
    for name in sensitivity.SCENARIOS:
        after = keep(sensitivity.scenario(items, "item", "grp", name, 50))
        parts.append(compare.stability(before, selection.group_ladder(after, "item", "grp", size=20), after, "item", [10, 20]).select(F.lit(name).alias("scenario"), "*"))
    return reduce(lambda a, b: a.unionByName(b), parts)


SCENARIOS_SQL = f"""v AS (SELECT vec_id::VARCHAR AS item, (vec_id % {GROUPS})::VARCHAR AS grp FROM embeddings),
sizes AS (SELECT grp, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, sha256('{selection.NAMESPACE}' || grp)) AS big FROM v GROUP BY grp),
keyed AS (SELECT name, item, grp, n, big, sha256('scenario-v1|' || name || '|' || item) AS key FROM v JOIN sizes USING (grp), (SELECT unnest({list(sensitivity.SCENARIOS)}) AS name)),
drawn AS (SELECT *, 'new-' || key[1:16] AS copy, row_number() OVER (PARTITION BY name ORDER BY key, item) AS place, row_number() OVER (PARTITION BY name, grp ORDER BY key, item) AS own, row_number() OVER (PARTITION BY name, n = 1 ORDER BY key, item) AS lone FROM keyed),
changed AS (
  SELECT name, item, CASE WHEN name = 'split_largest' AND big = 1 AND own <= 50 THEN grp || '-split' WHEN name = 'merge_singletons' AND n = 1 AND lone <= 50 THEN 'merged' ELSE grp END AS grp FROM drawn WHERE NOT (name IN ('remove', 'replace') AND place <= 50)
  UNION ALL SELECT name, copy, CASE WHEN name = 'new_groups' THEN 'group-' || copy ELSE grp END FROM drawn WHERE (name IN ('add', 'replace', 'new_groups') AND place <= 50) OR (name = 'grow_largest' AND big <= 10 AND own <= 5))"""


@query(f"WITH {SCENARIOS_SQL} SELECT name AS scenario, count(*) AS n_rows, count(DISTINCT item) AS items, count(DISTINCT grp) AS groups FROM changed GROUP BY 1")
def scenario_sizes(spark, sf_dir):
    """Items, distinct items and groups of each scenario's universe."""
    items = vectors(spark, sf_dir).select("item", "grp")
    parts = [sensitivity.scenario(items, "item", "grp", name, 50).agg(F.lit(name).alias("scenario"), F.count("*").alias("n_rows"), F.count_distinct("item").alias("items"), F.count_distinct("grp").alias("groups")) for name in sensitivity.SCENARIOS]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query(f"""WITH {CUSTOMERS_SQL.replace("customers AS", "everyone AS")}, customers AS (SELECT * FROM everyone WHERE item % 2 = 0), {PERCENTILES_SQL},
own AS (SELECT item, max(percentile) FILTER (feature = 'balance') AS a, max(percentile) FILTER (feature = 'n_orders') AS b, max(percentile) FILTER (feature = 'top_price') AS c FROM percentiles GROUP BY 1),
asked AS (SELECT item, grp, feature, value FROM (SELECT item, grp, balance, n_orders, top_price FROM everyone WHERE item % 2 = 1) UNPIVOT (value FOR feature IN (balance, n_orders, top_price))),
proj AS (SELECT a.item, a.grp, a.feature, CASE WHEN s.value IS NULL THEN 0 WHEN s.value = a.value THEN s.below + s.w / 2 ELSE s.below + s.w END AS p FROM asked a ASOF LEFT JOIN stairs s ON a.feature = s.feature AND a.value >= s.value),
q AS (SELECT item, grp, max(p) FILTER (feature = 'balance') AS a, max(p) FILTER (feature = 'n_orders') AS b, max(p) FILTER (feature = 'top_price') AS c FROM proj GROUP BY 1, 2),
l AS (SELECT 'ids' AS selector, item, row_number() OVER (ORDER BY sha256('h|ids|' || item)) AS rank FROM own UNION ALL SELECT 'other', item, row_number() OVER (ORDER BY sha256('h|other|' || item)) FROM own),
d AS (SELECT selector, n, q.item, q.grp, sqrt(min((q.a - o.a) ** 2 + (q.b - o.b) ** 2 + (q.c - o.c) ** 2)) AS distance FROM q, l JOIN own o ON o.item = l.item, (SELECT unnest([10, 20]) AS n) WHERE l.rank <= n GROUP BY ALL),
w AS (SELECT *, 1.0::DOUBLE / count(*) OVER (PARTITION BY selector, n, grp) / (SELECT count(DISTINCT grp) FROM q) AS w FROM d),
cum AS (SELECT *, sum(w) OVER (PARTITION BY selector, n ORDER BY distance RANGE UNBOUNDED PRECEDING) AS s FROM w)
SELECT selector, n, round(min(distance) FILTER (s + 1e-12 >= 0.95), 8) AS weighted_p95 FROM cum GROUP BY 1, 2""")
def holdout_resolution(spark, sf_dir):
    rows = customers(spark, sf_dir)
    base = rows.where("item % 2 = 0")

    def ladder(name):
        drawn = selection.draw(base.select("item"), "item", 20, "h", name).agg(F.collect_list("item").alias("a"))
        keyed = drawn.select(F.explode("a").alias("item")).withColumn("k", F.sha2(F.concat(F.lit(f"h|{name}|"), F.col("item").cast("string")), 256))
        return keyed.agg(F.array_sort(F.collect_list(F.struct("k", "item"))).alias("a")).select(F.posexplode("a").alias("rank", "x")).select((F.col("rank") + 1).alias("rank"), "x.item")

    found = sensitivity.holdout_resolution(base, rows.where("item % 2 = 1"), "item", "grp", FEATURES, {n: ladder(n) for n in ("ids", "other")}, [10, 20])
    return found.withColumn("weighted_p95", F.round("weighted_p95", 8))
