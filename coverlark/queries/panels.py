"""Balance, selection and coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import balance, coverage, selection
from .base import CUSTOMERS_SQL, FEATURES, GROUPS, PERCENTILES_SQL, VECTORS_SQL, center_sql, customers, d2_sql, query, table, vectors

NS = selection.NAMESPACE
SIZES = [5, 10, 20]


@query(f"WITH {CUSTOMERS_SQL} SELECT grp, count(*) AS group_size, round(1.0 / (count(*) * sum(1) OVER ()) / 2, 9) AS half_weight FROM customers GROUP BY grp")
def balanced_weights(spark, sf_dir):
    w = balance.half_weights(customers(spark, sf_dir), "grp")
    return w.select("grp", "group_size", F.round(F.col("half_weight").cast("double"), 9).alias("half_weight"))


@query(f"WITH {CUSTOMERS_SQL}, {PERCENTILES_SQL} SELECT item, grp, feature, value, round(percentile, 9) AS percentile FROM percentiles")
def balanced_percentiles(spark, sf_dir):
    return balance.percentiles_long(customers(spark, sf_dir), "item", "grp", FEATURES).withColumn("percentile", F.round("percentile", 9))


@query(f"""WITH {CUSTOMERS_SQL}, {PERCENTILES_SQL}
SELECT feature, count(DISTINCT value) AS values_before, count(DISTINCT round(percentile, 12)) AS values_after, round(min(percentile), 9) AS low, round(max(percentile), 9) AS high, true AS intact FROM percentiles GROUP BY feature""")
def percentile_integrity(spark, sf_dir):
    rows = customers(spark, sf_dir)
    found = balance.percentile_integrity(rows, balance.percentiles(rows, "item", "grp", FEATURES), FEATURES)
    return found.withColumn("low", F.round("low", 9)).withColumn("high", F.round("high", 9))


@query(f"""WITH {CUSTOMERS_SQL.replace("customers AS", "everyone AS")}, customers AS (SELECT * FROM everyone WHERE item % 2 = 0), {PERCENTILES_SQL},
asked AS (SELECT item, feature, value FROM (SELECT item, balance, n_orders, top_price FROM everyone WHERE item % 2 = 1) UNPIVOT (value FOR feature IN (balance, n_orders, top_price)))
SELECT a.item, a.feature, a.value, round(CASE WHEN s.value IS NULL THEN 0 WHEN s.value = a.value THEN s.below + s.w / 2 ELSE s.below + s.w END, 9) AS percentile
FROM asked a ASOF LEFT JOIN stairs s ON a.feature = s.feature AND a.value >= s.value""")
def baseline_projection(spark, sf_dir):
    rows = customers(spark, sf_dir)
    found = balance.project(rows.where("item % 2 = 0"), rows.where("item % 2 = 1"), "item", "grp", FEATURES)
    return found.withColumn("percentile", F.round("percentile", 9))


@query(f"""WITH {CUSTOMERS_SQL}, limits AS (SELECT min(balance) AS bl, max(balance) AS bh, min(n_orders) AS nl, max(n_orders) AS nh, min(top_price) AS tl, max(top_price) AS th FROM customers WHERE item % 2 = 0),
q AS (SELECT * FROM customers, limits WHERE item % 2 = 1)
SELECT 'balance' AS feature, count(*) FILTER (balance < bl) AS below, count(*) FILTER (balance > bh) AS above, count(*) AS n_items FROM q
UNION ALL SELECT 'n_orders', count(*) FILTER (n_orders < nl), count(*) FILTER (n_orders > nh), count(*) FROM q
UNION ALL SELECT 'top_price', count(*) FILTER (top_price < tl), count(*) FILTER (top_price > th), count(*) FROM q""")
def projection_out_of_range(spark, sf_dir):
    rows = customers(spark, sf_dir)
    return balance.out_of_range(rows.where("item % 2 = 0"), rows.where("item % 2 = 1"), FEATURES)


REPRESENTATIVES_SQL = f"""{VECTORS_SQL},
centers AS (SELECT grp, {center_sql('c')} AS m FROM vectors GROUP BY 1),
near AS (SELECT item, grp, c, {d2_sql('c', 'm')} AS d2, sha256('{NS}' || item::VARCHAR) AS tie FROM vectors JOIN centers USING (grp)),
reps AS (SELECT * FROM near QUALIFY row_number() OVER (PARTITION BY grp ORDER BY d2, tie) = 1)"""


@query(f"WITH {REPRESENTATIVES_SQL} SELECT grp, item, tie, round(d2, 9) AS d2 FROM reps")
def group_representatives(spark, sf_dir):
    return selection.representatives(vectors(spark, sf_dir), "item", "grp").select("grp", "item", "tie", F.round("d2", 9).alias("d2"))


def ladder_sql(source: str, size: int) -> str:
    """CTEs (after WITH RECURSIVE) that end in ladder(rank, item, score), the maximin ladder of ``source``(item, c, tie)."""
    return f"""middle AS (SELECT {center_sql('c')} AS m FROM {source}),
state AS (
  SELECT 1 AS step, item, c, tie, 'Infinity'::DOUBLE AS d2, {d2_sql('c', 'm')} AS score, row_number() OVER (ORDER BY {d2_sql('c', 'm')}, tie) = 1 AS sel, row_number() OVER (ORDER BY {d2_sql('c', 'm')}, tie) = 1 AS now FROM {source}, middle
  UNION ALL
  SELECT step + 1, item, c, tie, d, d AS score, sel OR pick, pick FROM (
    SELECT *, NOT sel AND row_number() OVER (ORDER BY sel, d DESC, tie) = 1 AS pick FROM (
      SELECT *, least(d2, {d2_sql('c', 'p')}) AS d FROM (SELECT *, first_value(c) OVER (ORDER BY now DESC, tie) AS p FROM state WHERE step < {size})))
),
ladder AS (SELECT step AS rank, item, score FROM state WHERE now)"""


@query(f"WITH RECURSIVE {REPRESENTATIVES_SQL}, {ladder_sql('reps', 20)} SELECT rank, item, grp, round(score, 9) AS score FROM ladder JOIN reps USING (item)")
def group_maximin_ladder(spark, sf_dir):
    return selection.group_ladder(vectors(spark, sf_dir), "item", "grp", size=20).withColumn("score", F.round("score", 9))


@query(f"WITH RECURSIVE {VECTORS_SQL}, src AS (SELECT item, c, sha256('{NS}' || item::VARCHAR) AS tie FROM vectors), {ladder_sql('src', 20)} SELECT rank, item, round(score, 9) AS score FROM ladder")
def all_items_maximin_ladder(spark, sf_dir):
    return selection.maximin_ladder(vectors(spark, sf_dir), "item", size=20).withColumn("score", F.round("score", 9))


RESIDUAL_SQL = f"""{VECTORS_SQL},
centers AS (SELECT grp, {center_sql('c')} AS m FROM vectors GROUP BY 1), middle AS (SELECT {center_sql('m')} AS p FROM centers),
first_group AS (SELECT grp FROM centers, middle ORDER BY {d2_sql('m', 'p')} LIMIT 1),
start AS (SELECT item, vectors.grp, c, sha256('{NS}' || item::VARCHAR) AS tie, row_number() OVER (ORDER BY vectors.grp <> first_group.grp, {d2_sql('c', 'p')}, item) = 1 AS sel FROM vectors, middle, first_group),
state AS (
  SELECT 1 AS step, item, grp, c, tie, 'Infinity'::DOUBLE AS d2, sel, sel AS now, 0.0::DOUBLE AS score FROM start
  UNION ALL
  SELECT step + 1, item, grp, c, tie, d, sel OR pick, pick, mean FROM (
    SELECT *, NOT sel AND row_number() OVER (ORDER BY sel, mean DESC, grp, d DESC, tie) = 1 AS pick FROM (
      SELECT *, avg(d) OVER (PARTITION BY grp) AS mean FROM (
        SELECT *, least(d2, {d2_sql('c', 'q')}) AS d FROM (SELECT *, first_value(c) OVER (ORDER BY now DESC, tie) AS q FROM state WHERE step < 12))))
)"""


@query(f"WITH RECURSIVE {RESIDUAL_SQL} SELECT step AS rank, item, grp, round(score, 9) AS score FROM state WHERE now")
def group_residual_ladder(spark, sf_dir):
    return selection.residual_ladder(vectors(spark, sf_dir), "item", "grp", size=12).withColumn("score", F.round("score", 9))


#: A panel that needs no loop: representatives in the order of their tie key.
PANEL_SQL = f"{REPRESENTATIVES_SQL}, panel AS (SELECT row_number() OVER (ORDER BY tie) AS rank, item, c FROM reps)"
DISTANCES_SQL = f"""{PANEL_SQL}, distances AS (
  SELECT v.item, v.grp, n, sqrt(min({d2_sql('v.c', 'p.c')})) AS distance FROM vectors v, panel p, (SELECT unnest({SIZES}) AS n) WHERE p.rank <= n GROUP BY 1, 2, 3)"""


def _panel(spark, sf_dir):
    reps = selection.representatives(vectors(spark, sf_dir), "item", "grp")
    n = max(SIZES)
    return reps.orderBy("tie").limit(n).agg(F.array_sort(F.collect_list(F.struct("tie", "item"))).alias("a")).select(F.posexplode("a").alias("rank", "x")).select((F.col("rank") + 1).alias("rank"), "x.item")


def _distances(spark, sf_dir):
    items = vectors(spark, sf_dir)
    return coverage.nearest_panel_distance(items, _panel(spark, sf_dir), "item", SIZES).join(items.select("item", "grp"), "item")


@query(f"WITH {DISTANCES_SQL} SELECT item, n, round(distance, 9) AS distance FROM distances")
def nearest_panel_distances(spark, sf_dir):
    return _distances(spark, sf_dir).select("item", "n", F.round("distance", 9).alias("distance"))


@query(f"""WITH {PANEL_SQL}, q AS (SELECT item, [{', '.join(f'c[{i}]' for i in range(12, 0, -1))}] AS c FROM vectors)
SELECT q.item, n, round(sqrt(min({d2_sql('q.c', 'p.c')})), 9) AS distance FROM q, panel p, (SELECT unnest({SIZES}) AS n) WHERE p.rank <= n GROUP BY 1, 2""")
def cross_universe_distances(spark, sf_dir):
    items = vectors(spark, sf_dir)
    other = items.withColumn("coords", F.reverse("coords"))
    return coverage.nearest_panel_distance(other, _panel(spark, sf_dir), "item", SIZES, same_universe=False, panel_coords=items).withColumn("distance", F.round("distance", 9))


@query(f"WITH {DISTANCES_SQL} SELECT n, grp, round(avg(distance), 9) AS mean_distance, round(max(distance), 9) AS max_distance, count(*) AS group_size FROM distances GROUP BY 1, 2")
def group_distance_statistics(spark, sf_dir):
    found = coverage.group_statistics(_distances(spark, sf_dir), "grp")
    return found.withColumn("mean_distance", F.round("mean_distance", 9)).withColumn("max_distance", F.round("max_distance", 9))


SUMMARY_SQL = """by_group AS (SELECT n, grp, avg(distance) AS mean_distance, max(distance) AS max_distance FROM distances GROUP BY 1, 2),
weights AS (SELECT n, grp, distance, 1.0::DOUBLE / count(*) OVER (PARTITION BY n, grp) / (SELECT count(DISTINCT grp) FROM distances) AS w FROM distances),
cumulated AS (SELECT n, distance, sum(w) OVER (PARTITION BY n ORDER BY distance RANGE UNBOUNDED PRECEDING) AS cum FROM weights),
weighted AS (SELECT n, min(distance) FILTER (cum + 1e-12 >= 0.5) AS weighted_median, min(distance) FILTER (cum + 1e-12 >= 0.95) AS weighted_p95 FROM cumulated GROUP BY 1),
summary AS (
  SELECT n, avg(mean_distance) AS weighted_mean, max(max_distance) AS unweighted_max, quantile_disc(mean_distance, 0.5) AS median_group_mean, quantile_disc(mean_distance, 0.95) AS p95_group_mean, max(mean_distance) AS max_group_mean,
    quantile_disc(max_distance, 0.5) AS median_group_max, quantile_disc(max_distance, 0.95) AS p95_group_max, max(max_distance) AS max_group_max
  FROM by_group GROUP BY 1)"""
METRICS = ["weighted_mean", "weighted_median", "weighted_p95", "unweighted_max", "median_group_mean", "p95_group_mean", "max_group_mean", "median_group_max", "p95_group_max", "max_group_max"]
ROUNDED_SQL = ", ".join(f"round({m}, 8) AS {m}" for m in METRICS)


def rounded(df):
    return df.select("n", *[F.round(m, 8).alias(m) for m in METRICS])


@query(f"WITH {DISTANCES_SQL}, {SUMMARY_SQL} SELECT n, {ROUNDED_SQL} FROM summary JOIN weighted USING (n)")
def coverage_of_representatives(spark, sf_dir):
    return rounded(coverage.coverage_summary(_distances(spark, sf_dir), "grp"))


@query(f"""WITH RECURSIVE {REPRESENTATIVES_SQL}, {ladder_sql('reps', 20)},
distances AS (SELECT v.item, v.grp, n, sqrt(min({d2_sql('v.c', 'r.c')})) AS distance FROM vectors v, ladder l JOIN reps r ON l.item = r.item, (SELECT unnest({SIZES}) AS n) WHERE l.rank <= n GROUP BY 1, 2, 3),
{SUMMARY_SQL} SELECT n, {ROUNDED_SQL} FROM summary JOIN weighted USING (n)""")
def panel_coverage(spark, sf_dir):
    """The flagship: representatives, their maximin ladder, and how well its prefixes cover every item."""
    items = vectors(spark, sf_dir)
    ladder = selection.group_ladder(items, "item", "grp", size=max(SIZES))
    found = coverage.nearest_panel_distance(items, ladder, "item", SIZES).join(items.select("item", "grp"), "item")
    return rounded(coverage.coverage_summary(found, "grp"))


@query(f"WITH {DISTANCES_SQL} SELECT n, grp, round(avg(distance), 9) AS mean_distance FROM distances GROUP BY 1, 2")
def exact_group_means(spark, sf_dir):
    return coverage.exact_mean(_distances(spark, sf_dir), ["n", "grp"], "distance", "mean_distance").withColumn("mean_distance", F.round("mean_distance", 9))


@query("SELECT o_orderpriority AS priority, quantile_disc(o_totalprice, 0.025) AS low, quantile_disc(o_totalprice, 0.5) AS median, quantile_disc(o_totalprice, 0.975) AS high FROM orders GROUP BY 1")
def inverse_ecdf_quantiles(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").withColumnRenamed("o_orderpriority", "priority")
    return coverage.quantiles(rows, ["priority"], "o_totalprice", {"low": 0.025, "median": 0.5, "high": 0.975})


@query("""WITH w AS (SELECT o_orderpriority AS grp, o_totalprice AS v, 1.0::DOUBLE / count(*) OVER (PARTITION BY o_orderpriority) / (SELECT count(DISTINCT o_orderpriority) FROM orders) AS w FROM orders),
c AS (SELECT v, sum(w) OVER (ORDER BY v RANGE UNBOUNDED PRECEDING) AS cum FROM w) SELECT 1 AS one, min(v) AS price FROM c WHERE cum + 1e-12 >= 0.95""")
def balanced_weighted_quantile(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.lit(1).alias("one"), F.col("o_orderpriority").alias("grp"), "o_totalprice")
    return coverage.balanced_quantile(rows, "grp", "one", "o_totalprice", 0.95, "price")


@query(f"WITH {selection.random_ladders_sql('orders', 'o_orderkey', 'o_custkey', 1000, 500)} SELECT * FROM picks")
def random_group_ladders(spark, sf_dir):
    """Orders by customer: a thousand ladders of five hundred customers."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("item"), F.col("o_custkey").alias("grp"))
    return selection.random_ladders(orders, "item", "grp", replicates=1000, size=500)


@query("SELECT c_custkey AS item FROM customer ORDER BY sha256('ns|add|' || c_custkey), 1 LIMIT 100")
def hashed_sample(spark, sf_dir):
    return selection.draw(customers(spark, sf_dir).select("item"), "item", 100, "ns", "add")


@query(f"SELECT c_nationkey AS grp, count(*) AS group_size FROM customer GROUP BY 1 ORDER BY 2 DESC, sha256('{NS}' || c_nationkey) LIMIT 10")
def largest_groups(spark, sf_dir):
    return selection.largest_groups(customers(spark, sf_dir), "grp", 10)


@query("SELECT 20 AS n_rows, 20 AS ranks, 20 AS items, 1 AS low, 20 AS high, true AS sound")
def ladder_audit(spark, sf_dir):
    return selection.audit_ladder(selection.group_ladder(vectors(spark, sf_dir), "item", "grp", size=20), "item")
