"""Hard-negative mining with cover trees over norm-augmented vectors (operator 11).

Rows are reduced to points first: vectors of whole numbers with a label and their smallest ids, for of equal vectors only
the first few can be among the best. Points are dealt to cells, the nodes of one level of a cover tree of a bounded
sample, and those of a cell by a hash to blocks of about ``BLOCK`` points, so that no cell is too large for a task. Each
block has a cover tree of its own (``cover_tree``), and each cell the covering radius of all its points.

Anchors meet the blocks in groups of about ``GROUP``. They look for positives in the cell nearest to them, then in those
cells whose bound reaches the worst positive so far; a window of negatives goes to the cells whose bounds meet it. In a
block the tree is descended from the best bound down, or the leaves that meet windows with bounds are taken for all
anchors of a group together, and leaves are verified exactly. Nothing but bounds of products
leaves a cell or node out, so results are exact, and in vectors that gather nowhere every block is looked at.

A group is sent once to each bundle of blocks of a cell, always by a shuffle: copies for the blocks grow with the square of
the table, which Spark's estimate of their size doesn't see, so that it would broadcast them through the driver.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from .common import materialize, only, release, scratch, table, text_batches
from .cover_tree import BASE, CoverTree, net, squares

POSITIVES = NEGATIVES = 5
#: The share, in percent, of a positive's score that a negative has at least.
LEAST_SHARE = 80
SCALE = 256
ANCHORS, SHIFTED, LABELS = 100, 7, 10
#: Points of the sample whose tree has the cells, cells at most, points of a block, and anchors of a group.
SAMPLE, CELLS, BLOCK, GROUP = 2048, 64, 2048, 256
#: Blocks of a cell that get anchors together at most, and bundles of blocks that there should be for tasks to share first.
BUNDLE, BUNDLES = 16, 128
#: Bounds of a window without bounds.
LOWEST, HIGHEST = -(1 << 62), 1 << 62


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, label and x, floor(SCALE * component), of the rows that take part, each once; labels shifted where vec_id says so."""
    rows = only(vectors, ["vec_id", "label", "embedding"]).select("vec_id", F.col("label").cast("long").alias("label"), F.expr("transform(embedding, e -> cast(e as double))").alias("e"))
    rows = rows.where("vec_id is not null and label is not null and e is not null and not exists(e, c -> c is null or isnan(c) or abs(c) = double('infinity'))")
    label = F.when(F.col("vec_id") % SHIFTED == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    # A component that leaves 32 bits becomes null and is refused in ``_bounds``.
    return rows.select("vec_id", label.alias("label"), F.expr(f"transform(e, c -> try_cast(floor({SCALE} * c) as int))").alias("x"))


def _bounds(rows: DataFrame) -> tuple[int, int, int, float]:
    """How many rows there are, the greatest number of components and size of one, and the greatest square of a norm."""
    size = F.aggregate("x", F.lit(0.0), lambda s, c: s + c.cast("double") * c)
    most = F.expr("array_max(transform(x, c -> abs(cast(c as long))))")
    n, bad, dim, top, norm = rows.agg(F.count("*"), F.count_if(F.exists("x", lambda c: c.isNull())), F.max(F.size("x")), F.max(most), F.max(size)).first()
    if bad or 100 * (dim or 0) * (top or 0) ** 2 >= 1 << 62:
        raise ValueError("100 times a score would not fit 64 bits")
    return n, dim or 0, top or 0, norm or 0.0


def points(rows: DataFrame, kept: int) -> DataFrame:
    """x, label and ids: of each vector and label the ``kept`` smallest ids, in order. Tasks cut before they send."""
    order = Window.partitionBy("x", "label").orderBy("vec_id")
    some = rows.withColumn("place", F.dense_rank().over(order)).where(F.col("place") <= kept)
    return some.groupBy("x", "label").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))


class Cells:
    """Centres of the cells, their covering radii, and how many blocks each has."""

    def __init__(self, sample: np.ndarray, top: float, cells: int = CELLS):
        self.top, self.blocks = top, {}
        x = self._lifted(sample)

        def distance(row: int, rows: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(((x[rows] - x[row]) ** 2).sum(1), 0))

        groups, level = [np.arange(len(x))], None
        while len(x) and len(groups) <= cells:
            own = [g[0] for g in groups]
            level = (distance(0, np.arange(len(x))).max() if level is None else level) / BASE
            if level < 1:
                break
            groups = net(distance, np.arange(len(x)), level)
        self.centres = sample[own] if len(x) else sample
        self.radii = np.zeros(len(self.centres))

    def _lifted(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([x, np.sqrt(np.maximum(self.top - squares(x), 0))]).astype(np.float64)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest cell of each point, and how far its centre is."""
        a, c = self._lifted(x), self._lifted(self.centres)
        d = (a**2).sum(1)[:, None] + (c**2).sum(1) - 2 * a @ c.T
        cell = d.argmin(1)
        return cell, np.sqrt(np.maximum(d[np.arange(len(x)), cell], 0)) * (1 + 1e-9) + 1e-3

    def home(self, x: np.ndarray) -> np.ndarray:
        """The cell of each query whose centre has the greatest product with it."""
        return (x.astype(np.float64) @ self.centres.astype(np.float64).T).argmax(1)

    def bounds(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and the greatest product that each query can have in each cell."""
        own = squares(x)[:, None] + self.top
        gap = np.sqrt(np.maximum(own - 2 * x.astype(np.float64) @ self.centres.astype(np.float64).T, 0))
        slack = 1 + 1e-9 * own
        return (own - (gap + self.radii) ** 2) / 2 - slack, (own - np.maximum(gap - self.radii, 0) ** 2) / 2 + slack


def _matrix(x: pd.Series, dim: int, dtype) -> np.ndarray:
    """One row a vector; missing components at the end are 0."""
    out = np.zeros((len(x), dim), dtype)
    for k, v in enumerate(x):
        out[k, : len(v)] = v
    return out


class Searcher:
    """Blocks of all points, and searches of many anchors in them."""

    def __init__(self, rows: DataFrame, kept: int):
        spark = rows.sparkSession
        self.n, dim, most, top = _bounds(rows)
        self.dim = dim
        # Products are exact in doubles below 2 ** 53 and else in whole numbers.
        self.dtype = dtype = np.float64 if dim * most**2 < 1 << 53 else np.int64
        all_points = materialize(points(rows, kept), "points")
        # A few times SAMPLE points pass the first condition, so that tasks don't send SAMPLE points each.
        share = max(1, all_points.count() // (8 * SAMPLE))
        drawn = all_points.where(F.pmod(F.xxhash64("label", "x"), F.lit(share)) == 0)
        sample = drawn.orderBy(F.xxhash64("x", "label"), "x", "label").limit(SAMPLE).toPandas()
        self.cells = cells = Cells(_matrix(sample["x"], dim, dtype), top * (1 + 1e-9) + 1)
        shared = spark.sparkContext.broadcast(cells)  # at most CELLS centres

        @F.pandas_udf("cell int, far double")
        def cell_of(x: pd.Series) -> pd.DataFrame:
            cell, far = shared.value.nearest(_matrix(x, dim, dtype))
            return pd.DataFrame({"cell": cell.astype(np.int32), "far": far})

        if len(sample):
            all_points = materialize(all_points.withColumn("c", cell_of("x")).select("x", "label", "ids", "c.cell", "c.far"), "points")
            for r in all_points.groupBy("cell").agg(F.max("far").alias("far"), F.count("*").alias("n")).collect():
                cells.radii[r.cell], cells.blocks[r.cell] = r.far, -(-r.n // BLOCK)
        else:
            all_points = all_points.withColumns({"cell": F.lit(0), "far": F.lit(0.0)})
        top = cells.top
        self.bundle = max(1, min(BUNDLE, sum(cells.blocks.values()) // BUNDLES))

        def plant(pdf: pd.DataFrame) -> pd.DataFrame:
            tree = CoverTree.of(_matrix(pdf["x"], dim, dtype), pdf["label"].to_numpy(), [[int(i) for i in own] for own in pdf["ids"]], top)
            return pd.DataFrame({"cell": [pdf["cell"].iloc[0]], "block": [pdf["block"].iloc[0]], "tree": [tree.dumps()]})

        dealt = all_points.withColumn("block", F.pmod(F.xxhash64("x", "label"), self._blocks("cell")).cast("int"))
        self.blocks = materialize(dealt.groupBy("cell", "block").applyInPandas(plant, "cell int, block int, tree binary"), "blocks").withColumn("bundle", F.expr(f"block div {self.bundle}"))

    def _blocks(self, cell: str) -> Column:
        if not self.cells.blocks:
            return F.lit(1)
        return F.element_at(F.create_map(*[F.lit(v) for item in self.cells.blocks.items() for v in item]), F.col(cell))

    def cells_of(self, anchors: DataFrame, rule) -> DataFrame:
        """``anchors`` with a row for each cell that ``rule`` names, given the cells, vectors and windows."""
        dim, dtype, shared = self.dim, self.dtype, anchors.sparkSession.sparkContext.broadcast(self.cells)

        @F.pandas_udf(T.ArrayType(T.IntegerType()))
        def named(x: pd.Series, windows: pd.Series) -> pd.Series:
            return pd.Series([np.flatnonzero(row).tolist() for row in rule(shared.value, _matrix(x, dim, dtype), windows)])

        return anchors.withColumn("cell", F.explode(named("x", "windows")))

    def best(self, asked: DataFrame, same: bool, most: int) -> DataFrame:
        """vec_id, key, window, product and id: the ``most`` best of each window in each block that is asked.

        ``asked`` has vec_id, key, label, x, cell and windows, rows of (number, low, high); ``same`` asks for points of the
        anchor's label and leaves its id out, else for other labels.
        """
        dim, dtype = self.dim, self.dtype
        groups = max(1, -(-self.n // (ANCHORS * GROUP)))
        packed = asked.withColumn("group", F.pmod("key", F.lit(groups))).groupBy("cell", "group").agg(F.collect_list(F.struct("vec_id", "key", "label", "x", "windows")).alias("anchors"))
        packed = packed.withColumn("bundle", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((self._blocks("cell") - 1) / self.bundle))))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for data, anchors in zip(pdf["tree"], pdf["anchors"], strict=True):
                    tree, out = pickle.loads(data), []
                    x, labels, apart = _matrix([a["x"] for a in anchors], dim, dtype), np.array([a["label"] for a in anchors]), [a["vec_id"] if same else None for a in anchors]
                    windows = [[(w["low"], w["high"]) for w in a["windows"]] for a in anchors]
                    if min(low for own in windows for low, _ in own) > LOWEST:
                        found = tree.search_all(x, labels, same, windows, most, apart)
                    else:
                        found = [tree.search(q, (tree.labels == label) == same, own, most, a)[0] for q, label, own, a in zip(x, labels, windows, apart, strict=True)]
                    for a, got in zip(anchors, found, strict=True):
                        out += [(a["vec_id"], a["key"], w["number"], p, i) for w, own in zip(a["windows"], got, strict=True) for p, i in own]
                    yield pd.DataFrame(out, columns=["vec_id", "key", "window", "product", "id"])
            release()

        met = packed.hint("merge").join(self.blocks, ["cell", "bundle"]).select("anchors", "tree")
        return met.mapInPandas(run, "vec_id long, key long, window int, product long, id long")


def _first(found: DataFrame, most: int) -> DataFrame:
    """The ``most`` best rows of each window of an anchor, with their rank."""
    order = Window.partitionBy("vec_id", "key", "window").orderBy(F.desc("product"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _windows(*columns: Column) -> Column:
    return F.struct(*[c.alias(n) for c, n in zip(columns, ("number", "low", "high"), strict=True)])


def _at_home(cells: Cells, x: np.ndarray, _: pd.Series) -> np.ndarray:
    return cells.home(x)[:, None] == np.arange(len(cells.centres))


def _elsewhere(cells: Cells, x: np.ndarray, windows: pd.Series) -> np.ndarray:
    low = np.array([w[0]["low"] for w in windows])
    return ~_at_home(cells, x, windows) & (cells.bounds(x)[1] >= low[:, None])


def _within(cells: Cells, x: np.ndarray, windows: pd.Series) -> np.ndarray:
    low, high = cells.bounds(x)
    return np.array([[any(h >= w["low"] and b <= w["high"] for w in own) for b, h in zip(lows, highs, strict=True)] for own, lows, highs in zip(windows, low, high, strict=True)], bool).reshape(low.shape)


def hard_negatives(vectors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, least_share: int = LEAST_SHARE, anchors: int = ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    Rows without a vec_id or label, with a null vector or with a component that is null or not finite take no part. Rows that
    agree in vec_id, label and whole components count once; other rows of one vec_id are rows of their own, but an anchor's
    positives have another vec_id. A vector with fewer components than others is 0 in the rest. Equal scores go by the
    smaller vec_id. Anchors without positives, and positives without negatives, have no row; a negative score of the
    positive leaves no window. An empty table gives no rows. Scores of which 100 would leave 62 bits raise an error. Other columns
    are ignored.
    """
    text_batches(vectors.sparkSession)
    with scratch(vectors.sparkSession):
        rows = whole_vectors(vectors)
        searcher = Searcher(rows, max(positives, negatives) + 1)
        if not searcher.n:
            return vectors.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
        asking = rows.where(F.col("vec_id") % anchors == 0).select("vec_id", "label", "x", F.xxhash64("vec_id", "label", "x").alias("key")).dropDuplicates(["vec_id", "key"])
        asking = materialize(asking, "anchors")
        endless = F.array(_windows(F.lit(0), F.lit(LOWEST), F.lit(HIGHEST)))
        home = materialize(_first(searcher.best(searcher.cells_of(asking.withColumn("windows", endless), _at_home), True, positives), positives), "home")
        worst = home.groupBy("vec_id", "key").agg(F.when(F.count("*") == positives, F.min("product")).alias("low"))
        reached = asking.join(worst, ["vec_id", "key"], "left")
        reached = reached.withColumn("windows", F.array(_windows(F.lit(0), F.coalesce("low", F.lit(LOWEST)), F.lit(HIGHEST)))).drop("low")
        others = searcher.best(searcher.cells_of(reached, _elsewhere), True, positives)
        positive = materialize(_first(home.drop("rank").unionByName(others), positives), "positives")
        window = _windows(F.col("rank"), F.expr(f"(product * {least_share} + 99) div 100"), F.col("product"))
        wide = positive.where("product >= 0").groupBy("vec_id", "key").agg(F.sort_array(F.collect_list(window)).alias("windows"))
        found = _first(searcher.best(searcher.cells_of(asking.join(wide, ["vec_id", "key"]), _within), False, negatives), negatives)
        named = positive.select("vec_id", "key", F.col("rank").alias("window"), F.col("id").alias("positive_id"), F.col("product").alias("positive_score"))
        got = found.join(named, ["vec_id", "key", "window"])
        got = got.select(F.col("vec_id").alias("anchor_id"), "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("product").alias("negative_score"))
        return materialize(got, "negatives", outlive=True)


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


OP11_SQL = f"""
WITH parts AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % {SHIFTED} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label, [floor({SCALE} * c::DOUBLE) FOR c IN embedding] AS x
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS same, list_dot_product(a.x, r.x)::BIGINT AS score
  FROM parts a JOIN parts r ON a.vec_id % {ANCHORS} = 0
), positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same AND vec_id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}
), ranked AS (
  SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INT AS rank, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
  FROM positive p JOIN scored s USING (anchor_id) WHERE NOT s.same AND {LEAST_SHARE} * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
)
SELECT * FROM ranked WHERE rank <= {NEGATIVES}
"""
