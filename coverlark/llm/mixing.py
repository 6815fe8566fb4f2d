"""Mixing sources to target weights with soft membership (operator 7).

A softmax classifier over hashed words learns the domains of the labelled table: a document that ``labels`` marks toxic
belongs to the domain "toxic", any other to that of its language. It gives every document posteriors, and the expected
tokens of a domain are the sum of tokens times rate times posterior. Nonnegative rates whose totals match the targets
come from projected gradient steps on

    1/2 sum_d (total_d - target_d)^2 / target_d  +  damping/2 sum_i tokens_i (rate_i - 1)^2

(totals and tokens as shares of all tokens). One step is one Spark job that sums D numbers. A document's rate follows
from its posteriors and the D residuals of each step so far, so tasks replay the steps and no rate table is rewritten.
Between two jobs the driver takes several steps: as long as no rate reaches or leaves zero, a step moves the totals by
the Gram matrix of the documents with positive rates, D x D numbers that the job sums too. The next job takes the same
steps for every document, with the projection. If the objective has not fallen they are taken back and fewer are tried;
a single step always lowers it.

Steps go on until every total is within ``CLOSE`` of its target or, where targets can't be met (a domain without tokens),
until the totals stand still; the totals that were reached are part of the result.

Fitting the classifier uses at most ``TRAIN_ROWS`` labelled documents, chosen by a hash of their ids (a documented bound).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .common import fresh, materialize, only, release, scratch, table, text_batches, text_or_empty
from .hashing import BUCKETS, blocks, word_ids

TRAIN_ROWS = 3000
#: Target shares of tokens (a parameter); what is missing to 1 goes to domains that are not named, in equal parts.
TARGETS = {"en": 0.45, "de": 0.2, "fr": 0.2, "es": 0.13, "toxic": 0.02}
DAMPING = 0.0005
#: Shares within which a total meets its target, and below whose change over LONG steps or more totals stand still.
CLOSE = 1e-4
STILL = 1e-5
LONG = 32
#: Most steps between two jobs.
MOST = 256
SPACE = BUCKETS // 4


@dataclass
class Softmax:
    domains: list[str]
    weights: np.ndarray  # SPACE x D
    bias: np.ndarray

    def posteriors(self, docs: list[np.ndarray]) -> np.ndarray:
        sizes = np.array([len(d) for d in docs])
        out = np.tile(self.bias, (len(docs), 1)).astype(float)
        flat = np.concatenate(docs) if sizes.sum() else np.empty(0, np.uint64)
        if len(flat):
            rows = self.weights[_bucket(flat)]
            full = np.flatnonzero(sizes)
            sums = np.add.reduceat(rows, (np.cumsum(sizes) - sizes)[full], axis=0)
            out[full] += sums / np.sqrt(sizes[full])[:, None]
        out -= out.max(axis=1, keepdims=True)
        e = np.exp(out)
        return e / e.sum(axis=1, keepdims=True)


def _bucket(words: np.ndarray) -> np.ndarray:
    return (words.astype(np.uint64) & np.uint64(0xFFFFFFFF)).astype(np.int64) % SPACE


def train(docs: list[np.ndarray], domains: list[str], epochs: int = 12, seed: int = 3) -> Softmax:
    """Adagrad on the log loss of bags of hashed words, each divided by the root of its size."""
    names = sorted(set(domains)) or ["all"]
    y = np.array([names.index(d) for d in domains], np.int64)
    net = Softmax(names, np.zeros((SPACE, len(names)), np.float32), np.zeros(len(names), np.float32))
    seen, seen_bias, rng = np.full((SPACE, len(names)), 1e-6, np.float32), np.full(len(names), 1e-6, np.float32), np.random.default_rng(seed)
    for _ in range(epochs if len(names) > 1 else 0):
        order = rng.permutation(len(docs))
        for at in range(0, len(order), 64):
            rows = order[at : at + 64]
            g = net.posteriors([docs[r] for r in rows])
            g[np.arange(len(rows)), y[rows]] -= 1
            sizes = np.array([len(docs[r]) for r in rows])
            flat = _bucket(np.concatenate([docs[r] for r in rows]))
            each = np.repeat(g / np.sqrt(np.maximum(sizes, 1))[:, None] / len(rows), sizes, axis=0)
            ids, inverse = np.unique(flat, return_inverse=True)
            total = np.column_stack([np.bincount(inverse, each[:, d], len(ids)) for d in range(len(names))]).astype(np.float32)
            seen[ids] += total * total
            net.weights[ids] -= 0.1 * total / np.sqrt(seen[ids])
            b = g.mean(0).astype(np.float32)
            seen_bias += b * b
            net.bias -= 0.1 * b / np.sqrt(seen_bias)
    return net


def fit_domains(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> Softmax:
    """The domain classifier, from at most ``limit`` labelled documents; without labels there is the one domain "all"."""
    known = only(labels, ["doc_id", "toxic"]).where("doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).join(only(docs, ["doc_id"]).distinct(), "doc_id", "left_semi")
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    rows = only(docs, ["doc_id", "text", "lang"]).join(F.broadcast(some), "doc_id")
    rows = rows.select("doc_id", F.when(F.col("toxic") == 1, "toxic").otherwise(F.coalesce("lang", F.lit("none"))).alias("domain"), text_or_empty().alias("text"))

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "domain": pdf["domain"], "words": [_bucket(word_ids(t)).astype(np.int32) for t in pdf["text"]]})

    pdf = rows.mapInPandas(hashed, "doc_id long, domain string, words array<int>").toPandas().sort_values("doc_id", ignore_index=True)
    return train([np.asarray(w, np.int32) for w in pdf["words"]], pdf["domain"].tolist())


def memberships(docs: DataFrame, net: Softmax) -> DataFrame:
    """doc_id, tokens (words of the text) and posteriors (array<double> in the order of ``net.domains``)."""
    shared = docs.sparkSession.sparkContext.broadcast(net)  # of a fixed size: SPACE x D numbers

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            p, sizes = [], []
            for words, _, _ in blocks(pdf["text"].tolist()):
                p += list(shared.value.posteriors(words))
                sizes += [len(w) for w in words]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "tokens": sizes, "posteriors": p}, columns=["doc_id", "tokens", "posteriors"])
        release()

    return only(docs, ["doc_id", "text"]).select("doc_id", text_or_empty().alias("text")).mapInPandas(run, "doc_id long, tokens long, posteriors array<double>")


def target_shares(domains: list[str], targets: dict[str, float]) -> np.ndarray:
    """Positive shares that add up to 1, in the order of ``domains``."""
    named = sum(max(targets.get(d, 0.0), 0.0) for d in domains)
    other = [d for d in domains if targets.get(d, 0.0) <= 0]
    rest = max(1 - named, 0.01) / max(len(other), 1)
    shares = np.array([rest if d in other else targets[d] for d in domains])
    return shares / shares.sum()


#: A step: the relative residuals at which it was taken, and how far the next one starts beyond it.
Step = tuple[np.ndarray, float]


def replay(posteriors: np.ndarray, steps: list[Step], size: float, damping: float = DAMPING) -> np.ndarray:
    """The rates after accelerated projected gradient steps."""
    rate = ahead = np.ones(len(posteriors))
    for residual, beyond in steps:
        last, rate = rate, np.maximum(0.0, ahead - size * (posteriors @ residual + damping * (ahead - 1)))
        ahead = rate + beyond * (rate - last)
    return rate


def _of(batch: pa.RecordBatch, d: int) -> tuple[np.ndarray, np.ndarray]:
    p = batch.column("posteriors").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
    return p, batch.column("tokens").to_numpy(zero_copy_only=False).astype(float)


def fit_rates(members: DataFrame, shares: np.ndarray, close: float = CLOSE, still: float = STILL) -> tuple[list[Step], float, np.ndarray]:
    """The steps, their size, and the shares reached. A job sums D numbers a partition."""
    d = len(shares)

    def summed(values) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                got = np.ravel(values(*_of(batch, d)))
                total = got if total is None else total + got
            if total is not None:
                yield pa.RecordBatch.from_pydict({"k": np.arange(len(total), dtype=np.int32), "v": total})

        got = members.select("tokens", "posteriors").mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
        return np.array([r.v for r in sorted(got, key=lambda r: r.k)])

    first = summed(lambda p, n: np.concatenate([[n.sum()], ((p * n[:, None]).T @ p).ravel()]))
    total = first[0] if len(first) else 0.0
    if len(first) < 2 or total <= 0:
        return [], 0.0, np.zeros(d)
    gram, root = first[1:].reshape(d, d) / total, np.sqrt(shares)
    size = 1 / (np.linalg.eigvalsh(gram / root[:, None] / root[None, :])[-1] + DAMPING)
    done: list[Step] = []
    new: list[Step] = []
    span, best, foreseen = 1, None, None

    def sums(p: np.ndarray, n: np.ndarray) -> np.ndarray:
        rate = replay(p, done + new, size)
        held = p[rate > 0] * n[rate > 0, None]
        return np.concatenate([(p * (n * rate)[:, None]).sum(0), held.sum(0), (held.T @ p[rate > 0]).ravel(), [(n * (rate - 1) ** 2).sum()]])

    while True:
        got = summed(sums) / total
        reached = got[:d]
        objective = ((reached - shares) ** 2 / shares).sum() / 2 + DAMPING / 2 * got[-1]
        if best is not None and objective >= best[0]:
            if len(new) == 1:  # nothing is left to gain but rounding errors
                return done, size, best[1][:d]
            span = max(1, len(new) // 4)
        else:
            moved = np.inf if best is None else np.abs(reached - best[1][:d]).max()
            done, taken = done + new, len(new)
            if np.abs(reached - shares).max() < close or (taken >= LONG and moved < still):
                return done, size, reached
            if foreseen is not None:
                off = np.abs(reached - foreseen).max()
                span = min(MOST, 2 * span) if off < 0.1 * moved else max(1, span // 2) if off > 0.5 * moved else span
            best = (objective, got)
        ahead = now = best[1][:d]
        one, gram, new = best[1][d : 2 * d], best[1][2 * d : -1].reshape(d, d), []
        for k in range(span):
            residual, beyond = (ahead - shares) / shares, k / (k + 3) if k < span - 1 else 0.0
            new.append((residual, beyond))
            before, now = now, ahead - size * (gram @ residual + DAMPING * (ahead - one))
            ahead = now + beyond * (now - before)
        foreseen = now


def mix(docs: DataFrame, net: Softmax, targets: dict[str, float] = TARGETS) -> DataFrame:
    """doc_id, tokens, domain (the likeliest), posterior, posteriors, rate, copies, target and reached of every row of ``docs``.

    posteriors are in the order of ``net.domains``; of equal ones the first domain by name is the likeliest. target is the
    share of all tokens that its likeliest domain shall have, reached what the sum of tokens * rate * posterior gives it.
    copies is the rate rounded to a whole number, up or down by a hash of the doc_id so that its mean is the rate. Null and
    empty texts have no tokens and the posteriors of the empty text; very long texts count whole. Repeated rows get the
    same answer; a null doc_id rounds down. An empty table, or one without words, gets rate 1 and reaches 0.
    """
    members = materialize(memberships(docs, net), "members")
    shares = target_shares(net.domains, targets)
    done, size, reached = fit_rates(members, shares)
    names = np.array(net.domains, dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, _ = _of(batch, len(names))
            best = p.argmax(1)
            more = {"domain": pa.array(names[best], pa.string()), "posterior": p.max(1), "posteriors": batch.column("posteriors"), "rate": replay(p, done, size), "target": shares[best], "reached": reached[best]}
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "tokens": batch.column("tokens")} | more)

    schema = "doc_id long, tokens long, domain string, posterior double, posteriors array<double>, rate double, target double, reached double"
    return members.mapInArrow(run, schema).withColumn("copies", _copies())


def _copies(rate: str = "rate"):
    """The rate up or down to a whole number, by a hash of the doc_id."""
    part = F.coalesce(F.pmod(F.xxhash64(F.col("doc_id"), F.lit("mix")), F.lit(1 << 30)) / F.lit(float(1 << 30)), F.lit(1.0))
    return (F.floor(rate) + F.when(part < F.col(rate) - F.floor(rate), 1).otherwise(0)).cast("int")


def mixed(docs: DataFrame, net: Softmax, targets: dict[str, float] = TARGETS) -> DataFrame:
    """The rows of ``docs``, each as often as its copies say (see ``mix``). Rows without a doc_id stay once.

    Once the steps are known a rate follows from the text alone, so rows are rated where they are read, and no text is
    shuffled. Columns of ``docs`` stay whatever their names.
    """
    with scratch(docs.sparkSession):
        done, size, _ = fit_rates(materialize(memberships(docs, net), "members"), target_shares(net.domains, targets))
    shared = docs.sparkSession.sparkContext.broadcast(net)  # of a fixed size

    @F.pandas_udf(T.DoubleType())
    def rate_of(text: pd.Series) -> pd.Series:
        rates = [replay(shared.value.posteriors(words), done, size) for words, _, _ in blocks(text.tolist())]
        release()
        return pd.Series(np.concatenate(rates) if rates else np.empty(0))

    rate, copies, each = (fresh(docs, name) for name in ("rate", "copies", "each"))
    rated = docs.select(*docs.columns, rate_of(text_or_empty()).alias(rate))
    counted = rated.withColumn(copies, F.when(F.col("doc_id").isNull(), 1).otherwise(_copies(rate)))
    return counted.withColumn(each, F.explode(F.array_repeat(F.lit(0), F.col(copies)))).select(docs.columns)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_batches(spark)
    docs = table(spark, sf_dir, "documents")
    return mix(docs, fit_domains(docs, table(spark, sf_dir, "labels")))
