"""Quality classifier by co-training of two views (operator 4).

The content view looks at words and characters, the metadata view at what describes the page without reading it: source,
language, size and the layout of its lines. Each view has a logistic regression on standardised columns and their squares.
In every round each view labels those documents of a part of the pool that it is sure of, and these pseudo-labels train the
*other* view: it moves to the minimum of its penalised log loss over its labelled and pseudo-labelled rows. A sixth of the labelled rows guards the
exchange: a view whose log loss there would rise forgets the round and takes no more lessons, though it still teaches. At
the end each view is calibrated on the third of the labelled rows that trained neither, and the calibrated log odds are
combined by a small logistic regression on the same rows; views that are combined worse after the rounds than before them
are taken as they were before.

The pool is the whole corpus. Each round looks at its own part of it, by a hash of the features, so that pseudo-labels are
not those of the oddest documents alone: there a view labels every document whose log odds it puts beyond ``SURE``. The
pseudo-labels of a class weigh together as much as the labelled rows of that class at most, so neither the size of the
corpus nor the share of sure documents moves the balance. Newton steps sum losses, gradients and Hessians of all
pseudo-labelled documents in the tasks; a step that would raise the loss is halved, so no view can run away where labels
are nearly separable. Which round took a document follows from its part, so tasks replay the teachers and no label table
is written. Only labelled rows are sampled: at most ``LABELLED_ROWS``, chosen by a hash of their ids (a documented bound);
others are in the pool.

Every document is scored. A document is rejected when its score is below the threshold that loses at most ``LOSS`` of the
good documents among the calibration rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .common import materialize, only, release, table, text_batches, text_or_empty

LABELLED_ROWS = 8000
ROUNDS = 4
#: Newton steps of a round at most, halved ones included, and the expected gain for each labelled row below which they end.
STEPS, GAIN = 12, 1e-4
#: Log odds beyond which a view is sure.
SURE = 2.0
LOSS = 0.002
HASHED = 32
#: Byte classes of UTF-8 text, by byte.
CLASS = np.zeros(256, np.int64)
CLASS[128:] = 1
for _k, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b".,;:", b"!?", b"#$%&*@^~|\\", b"'\"()[]{}<>/-_=+`"), 2):
    CLASS[list(_chars)] = _k
CLASSES = 11
CONTENT = CLASSES + 6
METADATA = 6 + HASHED
#: Where the views lie in a row of features.
VIEWS = (slice(0, CONTENT), slice(CONTENT, CONTENT + METADATA))


def content_view(text: str) -> list[float]:
    """Shares of character classes, length and variety of words, and repeats."""
    raw = text.encode("utf-8", "surrogatepass")
    words = text.split()
    n, w = max(len(raw), 1), max(len(words), 1)
    shares = np.bincount(CLASS[np.frombuffer(raw, np.uint8)], minlength=CLASSES) / n
    distinct = len(set(words))
    odd = sum(1 for x in words if not x[-1].isalnum() and x[-1] not in ".,;:")
    length = sum(map(len, words)) / w
    return [*shares.tolist(), length / 10, distinct / w, np.log1p(w) * (distinct / w - 0.8), odd / w, sum(map(str.isupper, words)) / w, float(not words)]


def metadata_view(text: str, source: str | None, lang: str | None) -> list[float]:
    """Size and lines of the page, and hashed source and language."""
    lines = text.split("\n")
    hashed = [0.0] * HASHED
    for name in (f"s:{source}", f"l:{lang}"):
        hashed[zlib.crc32(name.encode("utf-8")) % HASHED] += 1.0
    n, k = len(text), len(lines)
    return [np.log1p(n) / 10, np.log1p(k) / 5, np.log1p(n / k) / 8, len(set(lines)) / k, max(map(len, lines)) / (n + 1), len(text.encode("utf-8", "surrogatepass")) / (n + 1), *hashed]


def features(text: str, source: str | None, lang: str | None) -> np.ndarray:
    """Both views of a document, one after the other."""
    return np.array([*content_view(text), *metadata_view(text, source, lang)], np.float32)


def design(z: np.ndarray) -> np.ndarray:
    """A constant, standardised columns, and their squares."""
    z = np.clip(z, -6, 6)
    return np.column_stack([np.ones(len(z)), z, z * z])


def log_loss(d: np.ndarray, y: np.ndarray, theta: np.ndarray) -> float:
    """Log loss, summed over the rows of a design matrix."""
    logit = d @ theta
    return float((np.logaddexp(0, logit) - y * logit).sum())


def slopes(d: np.ndarray, y: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """Log loss, gradient and Hessian in one vector, summed over the rows of a design matrix."""
    p = 1 / (1 + np.exp(-np.clip(d @ theta, -30, 30)))
    return np.concatenate([[log_loss(d, y, theta)], d.T @ (p - y), ((d * (p * (1 - p))[:, None]).T @ d).ravel()])


class Descent:
    """Newton steps to the minimum of a penalised log loss, whose sums come from outside. A step that raises it is halved."""

    def __init__(self, theta: np.ndarray, rows: float, ridge: float = 1.0):
        self.theta, self.best, self.value, self.done = theta, theta, np.inf, False
        self.least = GAIN * rows
        self.penalty = np.full(len(theta), ridge)
        self.penalty[0] = 1e-6

    def take(self, sums: np.ndarray) -> None:
        """Go on from the sums at ``theta``, which is then the next place to look at; ``best`` is the best place so far."""
        k = len(self.theta)
        value = sums[0] + (self.penalty * self.theta**2).sum() / 2
        if value > self.value:
            self.step = self.step / 2
        else:
            self.best, self.value = self.theta, value
            grad = sums[1 : k + 1] + self.penalty * self.theta
            self.step = -np.linalg.solve(sums[k + 1 :].reshape(k, k) + np.diag(self.penalty), grad)
            self.expected = -grad @ self.step / 2
        self.theta = self.best + self.step
        self.done = self.expected < self.least or np.abs(self.step).max() < 1e-9


def fitted(d: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression on rows that are at hand."""
    descent = Descent(np.zeros(d.shape[1]), 1e-6 * len(y))
    for _ in range(10 * STEPS):
        descent.take(slopes(d, y, descent.theta))
        if descent.done:
            break
    return descent.best


@dataclass
class Scaled:
    """A small logistic regression with its own scale, for calibration and combination. Higher log odds never lower the result."""

    mean: np.ndarray
    scale: np.ndarray
    theta: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray, y: np.ndarray) -> Scaled:
        mean, scale = x.mean(0), x.std(0) + 1e-6
        theta = fitted(np.column_stack([np.ones(len(x)), (x - mean) / scale]), y)
        return cls(mean, scale, np.append(theta[0], np.maximum(theta[1:], 0)))

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale @ self.theta[1:] + self.theta[0], -30, 30)


@dataclass
class CoTrained:
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    thetas: list[np.ndarray] = field(default_factory=list)
    calibrate: list[Scaled] = field(default_factory=list)
    combine: Scaled | None = None
    loss: float = np.inf
    threshold: float = 0.0

    def designs(self, x: np.ndarray) -> list[np.ndarray]:
        z = (x - self.mean) / self.scale
        return [design(z[:, v]) for v in VIEWS]

    def logits(self, x: np.ndarray) -> np.ndarray:
        """Calibrated log odds, a column each view."""
        raw = [np.clip(d @ t, -30, 30) for d, t in zip(self.designs(x), self.thetas, strict=True)]
        return np.column_stack([c.logit(r[:, None]) for c, r in zip(self.calibrate, raw, strict=True)])

    def scores(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Calibrated probability of each view, and the combined one."""
        if not self.thetas:
            return np.full((len(x), 2), 0.5), np.full(len(x), 0.5)
        each = self.logits(x)
        return 1 / (1 + np.exp(-each)), 1 / (1 + np.exp(-self.combine.logit(each)))


#: What a pupil has been taught: the number of the part of the pool, and the teacher's theta then.
Lesson = tuple[int, np.ndarray]


def parts_of(x: np.ndarray, parts: int) -> np.ndarray:
    """The part of the pool that each row of features is in; equal rows are in one."""
    bits = np.ascontiguousarray(x, np.float32).view(np.uint32).astype(np.uint64)
    weights = np.arange(1, 2 * bits.shape[1], 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((bits * weights).sum(1, dtype=np.uint64) >> np.uint64(40)).astype(np.int64) % parts


def taught(designs: list[np.ndarray], part: np.ndarray, pupil: int, lessons: list[Lesson]) -> np.ndarray:
    """The pseudo-label that each row has for the pupil; -1 for none."""
    label = np.full(len(part), -1)
    for number, theta in lessons:
        here = np.flatnonzero(part == number)
        logit = designs[1 - pupil][here] @ theta
        label[here] = np.where(logit <= -SURE, 0, np.where(logit >= SURE, 1, -1))
    return label


def _sums(rows: DataFrame, values: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of the vectors that ``values`` gives for matrices of features. Tasks send one vector each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            got = values(_matrix(batch))
            total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_pydict({"k": np.arange(len(total), dtype=np.int32), "v": total})

    got = rows.select("x").mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
    return np.array([r.v for r in sorted(got, key=lambda r: r.k)])


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(-1, CONTENT + METADATA)


def views(docs: DataFrame) -> DataFrame:
    """doc_id and x, the features of both views, of every row of ``docs``. Written once, for they are read in every round."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "x": [features(t, s, x) for t, s, x in zip(pdf["text"], pdf["source"], pdf["lang"], strict=True)]})
        release()

    rows = only(docs, ["doc_id", "text", "source", "lang"]).select("doc_id", text_or_empty().alias("text"), "source", "lang")
    return materialize(rows.mapInPandas(run, "doc_id long, x array<float>"), "views")


def fit(seen: DataFrame, labels: DataFrame, labelled: int = LABELLED_ROWS, rounds: int = ROUNDS, loss: float = LOSS) -> CoTrained:
    """A co-trained classifier from the rows of ``views``. Without labels of both classes it scores every document 0.5 and rejects none.

    A document with several labels counts as bad if one of them says so. Of six labelled rows four train, the others
    calibrate, and one of these guards the exchange.
    """
    ids = seen.select("doc_id").where("doc_id is not null").distinct()
    known = only(labels, ["doc_id", "quality"]).where("quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality")).join(ids, "doc_id", "left_semi")
    some = F.broadcast(materialize(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled), "labelled"))  # at most ``labelled`` rows
    rows = seen.join(some, "doc_id").toPandas()
    rows = rows.iloc[np.lexsort((rows["doc_id"], [zlib.crc32(str(i).encode()) for i in rows["doc_id"]]))]
    x, y = np.array(rows["x"].tolist(), np.float64).reshape(-1, CONTENT + METADATA), rows["quality"].to_numpy(float)
    train, guard, held = (np.isin(np.arange(len(y)) % 6, part) for part in ((0, 1, 3, 4), (2,), (2, 5)))
    if len(set(y[train])) < 2 or len(set(y[held])) < 2:
        return CoTrained()
    moments = _sums(seen, lambda m: np.concatenate([[len(m)], m.sum(0), (m * m).sum(0)]))
    mean, square = np.split(moments[1:] / moments[0], 2)
    net = CoTrained(mean, np.sqrt(np.maximum(square - mean * mean, 0)) + 1e-6)
    own, guards = ([(d, y[part]) for d in net.designs(x[part])] for part in (train, guard))
    net.thetas = [fitted(*o) for o in own]
    before = replace(net, thetas=list(net.thetas))
    _exchange(net, own, guards, seen.join(some, "doc_id", "left_anti"), rounds)
    net = min((_calibrated(n, x[held], y[held]) for n in (net, before)), key=lambda n: n.loss)
    score = np.sort(net.scores(x[held])[1][y[held] == 1])
    net.threshold = float(min(score[int(len(score) * loss)], 0.5))
    return net


def _calibrated(net: CoTrained, x: np.ndarray, y: np.ndarray) -> CoTrained:
    """``net`` with its views calibrated and combined on these rows, and its log loss there."""
    raw = [np.clip(d @ t, -30, 30) for d, t in zip(net.designs(x), net.thetas, strict=True)]
    net.calibrate = [Scaled.of(r[:, None], y) for r in raw]
    net.combine = Scaled.of(net.logits(x), y)
    logit = net.combine.logit(net.logits(x))
    net.loss = float((np.logaddexp(0, logit) - y * logit).sum())
    return net


def _exchange(net: CoTrained, own: list[tuple[np.ndarray, np.ndarray]], guards: list[tuple[np.ndarray, np.ndarray]], pool: DataFrame, rounds: int) -> None:
    """The rounds of co-training. Both views teach with what they know when a round begins."""
    lessons: list[list[Lesson]] = [[], []]
    learns = [0, 1]
    for number in range(rounds):
        for v in learns:
            lessons[v].append((number, net.thetas[1 - v]))
        for v, theta in _descended(net, own, pool, lessons, learns, rounds).items():
            if log_loss(*guards[v], theta) > log_loss(*guards[v], net.thetas[v]):
                lessons[v].pop()
                learns.remove(v)
            else:
                net.thetas[v] = theta


def _descended(net: CoTrained, own: list[tuple[np.ndarray, np.ndarray]], pool: DataFrame, lessons: list[list[Lesson]], pupils: list[int], parts: int) -> dict[int, np.ndarray]:
    """The new theta of each pupil. Each job brings losses, gradients and Hessians by pupil and class to the driver."""
    descents = {v: Descent(net.thetas[v], len(own[v][1])) for v in pupils}
    for _ in range(STEPS):
        moving = {v: d.theta for v, d in descents.items() if not d.done}
        if not moving:
            break

        def summed(m: np.ndarray, moving=moving) -> np.ndarray:
            designs, part, out = net.designs(m), parts_of(m, parts), []
            for v, theta in moving.items():
                label = taught(designs, part, v, lessons[v])
                for k in (0, 1):
                    rows = designs[v][label == k]
                    out.append(np.append(len(rows), slopes(rows, np.full(len(rows), k), theta)))
            return np.concatenate(out)

        got = _sums(pool, summed)
        if not len(got):
            break
        for v, theta in moving.items():
            sums = slopes(*own[v], theta)
            for k in (0, 1):
                taken, got = np.split(got, [2 + len(theta) + len(theta) ** 2])
                sums = sums + min(1.0, (own[v][1] == k).sum() / max(taken[0], 1)) * taken[1:]
            descents[v].take(sums)
    return {v: d.best for v, d in descents.items()}


def score_views(seen: DataFrame, net: CoTrained) -> DataFrame:
    """doc_id, content_score, metadata_score, score and kept of every row of ``views``.

    Null and empty texts are empty; null source and lang are values of their own. Very long texts count whole. Repeated
    rows repeat; equal documents get equal scores; an empty table gives no rows.
    """
    shared = seen.sparkSession.sparkContext.broadcast(net)  # a few hundred numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each, score = shared.value.scores(_matrix(batch))
            out = {"doc_id": batch.column("doc_id"), "content_score": each[:, 0], "metadata_score": each[:, 1], "score": score, "kept": score >= shared.value.threshold}
            yield pa.RecordBatch.from_pydict(out)

    return seen.select("doc_id", "x").mapInArrow(run, "doc_id long, content_score double, metadata_score double, score double, kept boolean")


def keep_good(docs: DataFrame, net: CoTrained) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, judged where they are read, with their columns whatever their names."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    @F.pandas_udf(T.BooleanType())
    def keep(text: pd.Series, source: pd.Series, lang: pd.Series) -> pd.Series:
        x = np.array([features(t, s, x) for t, s, x in zip(text, source, lang, strict=True)], np.float64).reshape(-1, CONTENT + METADATA)
        release()
        return pd.Series(shared.value.scores(x)[1] >= shared.value.threshold)

    return docs.where(keep(text_or_empty(), F.col("source"), F.col("lang")))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_batches(spark)
    seen = views(table(spark, sf_dir, "documents"))
    return score_views(seen, fit(seen, table(spark, sf_dir, "labels")))
