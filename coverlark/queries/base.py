"""Inputs of the registered queries, made from the given tables, and a register for a query with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
DIMENSIONS = 12
GROUPS = 50


def query(sql: str | None = None):
    """Registers a function (spark, sf_dir) under its name, with the SQL of the same result."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item, grp, coords): the first coordinates of each embedding, in GROUPS groups."""
    v = table(spark, sf_dir, "embeddings")
    return v.select(F.col("vec_id").alias("item"), (F.col("vec_id") % GROUPS).alias("grp"), F.array(*[F.col("embedding")[i].cast("double") for i in range(DIMENSIONS)]).alias("coords"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item, grp, balance, n_orders, top_price) of each customer."""
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n_orders"), F.max("o_totalprice").alias("top_price"))
    c = table(spark, sf_dir, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    return c.select(F.col("c_custkey").alias("item"), F.col("c_nationkey").alias("grp"), F.col("c_acctbal").alias("balance"), F.coalesce("n_orders", F.lit(0)).alias("n_orders"), F.coalesce("top_price", F.lit(0.0)).alias("top_price"))


FEATURES = ["balance", "n_orders", "top_price"]

VECTORS_SQL = f"vectors AS (SELECT vec_id AS item, vec_id % {GROUPS} AS grp, [{', '.join(f'embedding[{i + 1}]::DOUBLE' for i in range(DIMENSIONS))}] AS c FROM embeddings)"
CUSTOMERS_SQL = """customers AS (
  SELECT c_custkey AS item, c_nationkey AS grp, c_acctbal AS balance, coalesce(n, 0)::DOUBLE AS n_orders, coalesce(p, 0)::DOUBLE AS top_price
  FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, max(o_totalprice) AS p FROM orders GROUP BY 1) ON c_custkey = o_custkey)"""


def d2_sql(a: str, b: str) -> str:
    return "(" + " + ".join(f"({a}[{i + 1}] - {b}[{i + 1}]) * ({a}[{i + 1}] - {b}[{i + 1}])" for i in range(DIMENSIONS)) + ")"


def center_sql(c: str) -> str:
    return "[" + ", ".join(f"avg({c}[{i + 1}])" for i in range(DIMENSIONS)) + "]"


#: Balanced percentiles of the rows of ``customers``, long: (item, grp, feature, value, percentile).
PERCENTILES_SQL = """sizes AS (SELECT grp, count(*) AS n FROM customers GROUP BY 1),
long AS (SELECT item, grp, feature, value FROM (SELECT item, grp, balance, n_orders, top_price FROM customers) UNPIVOT (value FOR feature IN (balance, n_orders, top_price))),
weighted AS (SELECT long.*, 1.0::DOUBLE / (n * (SELECT count(*) FROM sizes)) AS w FROM long JOIN sizes USING (grp)),
distinct_values AS (SELECT feature, value, sum(w) AS w FROM weighted GROUP BY 1, 2),
stairs AS (SELECT feature, value, w, coalesce(sum(w) OVER (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM distinct_values),
percentiles AS (SELECT item, grp, feature, value, below + w / 2 AS percentile FROM long JOIN stairs USING (feature, value))"""
