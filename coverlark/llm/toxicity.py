"""Toxicity by a convolutional text classifier in numpy (operator 2).

A word's embedding is the sum of a hashed word vector and a hashed prefix vector. Filters of several widths slide over
the whole text, each keeps its highest response (max pooling), and a logistic layer reads those maxima. Training runs on
at most ``TRAIN_ROWS`` labelled documents (a documented bound; half of them toxic where there are as many), chosen by a
hash of their ids. A held-back fifth of them calibrates the score. A language's threshold comes from all labelled documents
that did not train the net: they are scored on Spark and counted by language, label and score.

For scoring, every filter column is applied to the embedding table once, so that a text costs table look-ups and sums.
Labels, lang, source and doc_id are never inputs of a score; lang only picks the threshold of ``flagged``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import materialize, only, table, text_batches, text_or_empty
from .hashing import BUCKETS, blocks, word_ids

TRAIN_ROWS = 6000
WIDTHS = (1, 2, 3)
FILTERS = 8
DIMENSIONS = 16
EPOCHS = 5
BATCH = 64
CUT = 0.7
#: Steps of the score in which thresholds are counted.
STEPS = 1000
PAD = max(WIDTHS) - 1


@dataclass
class Cnn:
    embedding: np.ndarray  # BUCKETS x DIMENSIONS, row 0 is zero
    filters: dict[int, np.ndarray]  # width -> width x DIMENSIONS x FILTERS
    bias: dict[int, np.ndarray]
    out: np.ndarray
    out_bias: float
    scale: tuple[float, float] = (1.0, 0.0)
    thresholds: dict[str, float] | None = None


def _flat(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words with PAD empty ones after each text (an empty text is one empty word), where each starts, and the padding.

    Windows that start in the padding would reach into the next text: their responses don't count.
    """
    sizes = np.array([max(len(d), 1) for d in docs])
    starts = np.concatenate(([0], np.cumsum(sizes + PAD)[:-1]))
    flat = np.zeros(int((sizes + PAD).sum()), np.uint64)
    for at, d in zip(starts.tolist(), docs, strict=True):
        flat[at : at + len(d)] = d
    padding = ((starts + sizes)[:-1, None] + np.arange(PAD)).ravel()  # the last text has no window there
    return flat, starts, padding


def _packed(words: np.ndarray) -> np.ndarray:
    """Both buckets of a word in 32 bits (BUCKETS is 2^16)."""
    return (words & np.uint64(0xFFFF) | words >> np.uint64(32) << np.uint64(16)).astype(np.uint32).view(np.int32)


def _unpacked(words: np.ndarray) -> np.ndarray:
    both = words.view(np.uint32).astype(np.uint64)
    return both & np.uint64(0xFFFF) | both >> np.uint64(16) << np.uint64(32)


def _buckets(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (flat & np.uint64(0xFFFFFFFF)).astype(np.int64), (flat >> np.uint64(32)).astype(np.int64)


def _start(rng: np.random.Generator) -> Cnn:
    draw = lambda *shape, s: rng.normal(0, s, shape).astype(np.float32)
    embedding = draw(BUCKETS, DIMENSIONS, s=0.1)
    embedding[0] = 0
    return Cnn(embedding, {w: draw(w, DIMENSIONS, FILTERS, s=0.3) for w in WIDTHS}, {w: np.zeros(FILTERS, np.float32) for w in WIDTHS}, draw(len(WIDTHS) * FILTERS, s=0.3), -1.0)


def train(docs: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Cnn:
    """Adagrad on the log loss in batches of whole texts. Max pooling sends the gradient to one window a filter and text."""
    rng = np.random.default_rng(seed)
    net = _start(rng)
    params = {"out": net.out, **{f"f{w}": net.filters[w] for w in WIDTHS}, **{f"b{w}": net.bias[w] for w in WIDTHS}}
    seen = {k: np.full_like(v, 1e-6) for k, v in params.items()} | {"e": np.full(BUCKETS, 1e-6, np.float32)}
    rate, bias_seen = 0.1, 1e-6
    weight = np.where(labels == 1, 0.5 / max(labels.mean(), 1e-3), 0.5 / max(1 - labels.mean(), 1e-3)).astype(np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            flat, starts, padding = _flat([docs[r] for r in rows])
            word, prefix = _buckets(flat)
            x = net.embedding[word] + net.embedding[prefix]
            pooled, best = [], {}
            for w in WIDTHS:
                c = sum(x[k : len(x) - PAD + k] @ net.filters[w][k] for k in range(w)) + net.bias[w]
                c[padding] = -np.inf
                top = np.maximum.reduceat(c, starts, axis=0)
                # the first window that reaches the maximum, of those in the text's own part
                spread = np.repeat(top, np.diff(np.append(starts, len(c))), axis=0)
                hit = np.where(c == spread, np.arange(len(c))[:, None], len(c))
                best[w] = np.minimum.reduceat(hit, starts, axis=0)
                pooled.append(np.maximum(top, 0))
            h = np.concatenate(pooled, axis=1)
            p = 1 / (1 + np.exp(-(h @ net.out + net.out_bias)))
            g = ((p - labels[rows]) * weight[rows]).astype(np.float32) / len(rows)
            gh = g[:, None] * net.out[None, :] * (h > 0)
            grads = {"out": h.T @ g}
            touched, moved = [], []
            for i, w in enumerate(WIDTHS):
                gw = gh[:, i * FILTERS : (i + 1) * FILTERS]
                grads[f"b{w}"] = gw.sum(0)
                gf = np.zeros_like(net.filters[w])
                for k in range(w):
                    at_k = best[w] + k  # texts x filters
                    gf[k] = np.einsum("nf,nfd->df", gw, x[at_k])
                    gx = gw[:, :, None] * net.filters[w][k].T[None]  # texts x filters x dimensions
                    for ids in (word[at_k], prefix[at_k]):
                        touched.append(ids.ravel())
                        moved.append(gx.reshape(-1, DIMENSIONS))
                grads[f"f{w}"] = gf
            for name, grad in grads.items():
                seen[name] += grad * grad
                params[name] -= rate * grad / np.sqrt(seen[name])
            bias_seen += float(g.sum()) ** 2
            net.out_bias -= rate * float(g.sum()) / bias_seen**0.5
            ids, inverse = np.unique(np.concatenate(touched), return_inverse=True)
            total = np.zeros((len(ids), DIMENSIONS), np.float32)
            np.add.at(total, inverse, np.concatenate(moved))
            seen["e"][ids] += (total * total).mean(axis=1)
            net.embedding[ids] -= rate * total / np.sqrt(seen["e"][ids])[:, None]
            net.embedding[0] = 0
    return net


class Scorer:
    """The filters applied to the embedding table: one BUCKETS x FILTERS table for each width and offset."""

    def __init__(self, net: Cnn):
        self.net = net
        self.tables = {w: [np.einsum("vd,df->vf", net.embedding, net.filters[w][k]) for k in range(w)] for w in WIDTHS}

    def logits(self, docs: list[np.ndarray]) -> np.ndarray:
        flat, starts, padding = _flat(docs)
        word, prefix = _buckets(flat)
        out = np.full(len(docs), self.net.out_bias)
        n = len(flat) - PAD
        for i, w in enumerate(WIDTHS):
            c = np.zeros((n, FILTERS), np.float32)
            for k, t in enumerate(self.tables[w]):
                c += np.take(t, word[k : n + k], axis=0)
                c += np.take(t, prefix[k : n + k], axis=0)
            c[padding] = -np.inf
            top = np.maximum(np.maximum.reduceat(c, starts, axis=0) + self.net.bias[w], 0)
            out += (top * self.net.out[i * FILTERS : (i + 1) * FILTERS]).sum(axis=1)  # the same for a text whatever its block
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        out = np.empty(len(texts))
        a, b = self.net.scale
        for docs, first, last in blocks(texts):
            out[first:last] = 1 / (1 + np.exp(-np.clip(a * self.logits(docs) + b, -30, 30)))
        return out.round(6)  # the last bits of exp depend on a row's place in its block


def platt(logits: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the log odds, by Newton steps with smoothed targets; the identity if only one class is there."""
    up, down = int(labels.sum()), int(len(labels) - labels.sum())
    if not up or not down:
        return 1.0, 0.0
    target = np.where(labels == 1, (up + 1) / (up + 2), 1 / (down + 2))
    x, theta = np.column_stack([logits, np.ones(len(logits))]), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2)
        theta = theta - np.linalg.solve(hess, x.T @ (p - target) + 1e-4 * theta)
    return (float(theta[0]), float(theta[1])) if theta[0] > 0 and np.isfinite(theta).all() else (1.0, 0.0)


def best_threshold(clean: np.ndarray, toxic: np.ndarray) -> float:
    """The cut with the highest F1 (the highest of equals), from counts of both labels by step; CUT where there are under ten of either."""
    if toxic.sum() < 10 or clean.sum() < 10:
        return CUT
    hit, wrong = np.cumsum(toxic[::-1]), np.cumsum(clean[::-1])
    f1 = 2 * hit / (hit + wrong + toxic.sum())
    return (len(toxic) - 1 - int(f1.argmax())) / STEPS


def usable(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) that may be learnt from; a document with several labels counts as toxic if one of them says so."""
    some = only(labels, ["doc_id", "toxic"]).where("toxic in (0, 1) and doc_id is not null and crc32(cast(doc_id as string)) % 3 <> 1")
    return some.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> pd.DataFrame:
    """At most ``limit`` labelled documents as hashed words, with their language; only these reach the driver."""
    known = usable(labels)
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    some = known.where("toxic = 1").orderBy(*order).limit(limit // 2).unionByName(known.where("toxic = 0").orderBy(*order).limit(limit // 2))
    rows = only(docs, ["doc_id", "text", "lang"]).join(F.broadcast(some), "doc_id").select(F.crc32(F.col("doc_id").cast("string")).alias("key"), "doc_id", "toxic", F.coalesce("lang", F.lit("")).alias("lang"), text_or_empty().alias("text"))

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"key": pdf["key"], "doc_id": pdf["doc_id"], "toxic": pdf["toxic"], "lang": pdf["lang"], "words": [_packed(word_ids(t)) for t in pdf["text"]]})

    return rows.mapInPandas(hashed, "key long, doc_id long, toxic int, lang string, words array<int>").toPandas().sort_values(["key", "doc_id"], ignore_index=True)


def fit(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> Cnn:
    """A calibrated net with thresholds by language. Without labels of both classes it scores every text alike."""
    net, trained = fit_net(docs, labels, limit)
    net.thresholds = thresholds(_scored(docs, net), labels, trained) if trained else None
    return net


def fit_net(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> tuple[Cnn, list[int]]:
    """A calibrated net without thresholds, and the doc_ids that trained it."""
    rows = training_rows(docs, labels, limit)
    words, toxic = [_unpacked(np.asarray(w, np.int32)) for w in rows["words"]], rows["toxic"].to_numpy()
    held = np.arange(len(rows)) % 5 == 4
    if len(set(toxic[~held])) < 2:
        return _start(np.random.default_rng(7)), []
    net = train([w for w, h in zip(words, held, strict=True) if not h], toxic[~held])
    if held.any():
        scorer, logits = Scorer(net), []
        kept = [w for w, h in zip(words, held, strict=True) if h]
        for k in range(0, len(kept), 200):
            logits.append(scorer.logits(kept[k : k + 200]))
        logits = np.concatenate(logits)
        net.scale = platt(logits, toxic[held])
    return net, rows["doc_id"][~held].tolist()


def _scored(docs: DataFrame, net: Cnn) -> DataFrame:
    """doc_id, held_out, lang (null: empty) and score of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(net)  # of a fixed size: BUCKETS x DIMENSIONS numbers

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "held_out": pdf["held_out"], "lang": pdf["lang"], "score": scorer.scores(pdf["text"].tolist())})

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    rows = only(docs, ["doc_id", "text", "lang"]).select("doc_id", held.alias("held_out"), F.coalesce("lang", F.lit("")).alias("lang"), text_or_empty().alias("text"))
    return rows.mapInPandas(run, "doc_id long, held_out boolean, lang string, score double")


def thresholds(scored: DataFrame, labels: DataFrame, trained: list[int]) -> dict[str, float]:
    """A threshold for each language, from the labelled documents that did not train. The driver gets counts: STEPS numbers a label and language."""
    ids = scored.sparkSession.createDataFrame([(int(i),) for i in trained], "doc_id long")  # at most TRAIN_ROWS
    known = usable(labels).join(F.broadcast(ids), "doc_id", "left_anti")
    step = F.least(F.floor(F.col("score") * STEPS), F.lit(STEPS - 1)).cast("int")
    counted: dict[str, np.ndarray] = {}
    for r in scored.select("doc_id", "lang", step.alias("step")).join(known, "doc_id").groupBy("lang", "toxic", "step").count().collect():
        counted.setdefault(r["lang"], np.zeros((2, STEPS), np.int64))[r["toxic"], r["step"]] = r["count"]
    return {lang: best_threshold(*both) for lang, both in sorted(counted.items())}


def _flagged(scored: DataFrame, limits: dict[str, float] | None, cut: float = CUT) -> DataFrame:
    known = scored.sparkSession.createDataFrame([*(limits or {}).items()], "lang string, threshold double")  # a row a language that has one
    rows = scored.join(F.broadcast(known), "lang", "left").withColumn("threshold", F.coalesce("threshold", F.lit(cut)))
    return rows.select("doc_id", "held_out", "score", (F.col("score") >= cut).cast("int").alias("predicted"), "threshold", (F.col("score") >= F.col("threshold")).alias("flagged"))


def score_documents(docs: DataFrame, net: Cnn, cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score, predicted, threshold and flagged of every row of ``docs``.

    Null and empty texts have no words and get the score of the empty text; very long texts are read whole. A null doc_id is
    not held out. A language without a threshold uses ``cut``. A score at a threshold is flagged. Repeated rows repeat; an
    empty table gives no rows. Other columns are ignored.
    """
    return _flagged(_scored(docs, net), net.thresholds, cut)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents are scored once; the thresholds come from the same scores."""
    text_batches(spark)
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    net, trained = fit_net(docs, labels)
    scored = materialize(_scored(docs, net), "scores")
    return _flagged(scored, thresholds(scored, labels, trained) if trained else None)
