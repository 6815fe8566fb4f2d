"""Document fingerprints by winnowing (operator 1).

Every k-gram of code points is hashed by doubling (two hashes of 2^i code points make one of 2^(i+1)), so the cost per
code point does not grow with k. Of each window of ``window`` consecutive hashes the least is chosen, the rightmost of
equals, and its position is kept. Two texts that share ``k + window - 1`` code points share a fingerprint entry.

One k and one window hold for all texts, so that any two fingerprints can be compared. A text of fewer than ``K`` code
points is one gram, and a text with fewer grams than the window is one window: it has one entry.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .common import only, table, text_batches, text_or_empty

K = 12
WINDOW = 32
#: An odd multiplier and the two multipliers of a 64-bit finaliser (fixed values).
BASE = 0x9E3779B97F4A7C15
MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)


def gram_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """32-bit hashes of all k-grams, as uint64."""
    n = len(codes) - k + 1
    power, size = codes.astype(np.uint64) + np.uint64(1), 1
    out, done = None, 0
    base = BASE
    while True:
        if k & size:
            part = power[done : done + n]
            out = part.copy() if out is None else out * np.uint64(base) + part
            done += size
        if done == k:
            break
        power = power[:-size] * np.uint64(base) + power[size:]
        base, size = base * base % 2**64, 2 * size
    for m in MIX:
        out ^= out >> np.uint64(33)
        out *= np.uint64(m)
    return out >> np.uint64(32)


def window_minima(keys: np.ndarray, window: int) -> np.ndarray:
    """The minimum of every ``window`` consecutive keys, from running minima of blocks forwards and backwards."""
    n = len(keys)
    blocks = -(-n // window)
    full = np.full(blocks * window, np.iinfo(np.uint64).max, np.uint64)
    full[:n] = keys
    grid = full.reshape(blocks, window)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - window + 1], ahead[window - 1 : n])


def fingerprint(text: str, k: int = K, window: int = WINDOW) -> np.ndarray:
    """Chosen entries in the order of the text: hash in the high 32 bits, position in the low 32. Empty for an empty text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(codes):
        return np.empty(0, np.uint64)
    hashes = gram_hashes(codes, min(k, len(codes)))
    keys = hashes << np.uint64(32) | (np.uint64(0xFFFFFFFF) - np.arange(len(hashes), dtype=np.uint64))  # the rightmost of equals is least
    low = window_minima(keys, min(window, len(keys)))
    chosen = low[np.concatenate(([True], low[1:] != low[:-1]))]
    return chosen ^ np.uint64(0xFFFFFFFF)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard likeness of the hashes of two fingerprints; 1 for two empty ones."""
    a, b = np.unique(a >> np.uint64(32)), np.unique(b >> np.uint64(32))
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 1.0


def as_text(entries: np.ndarray) -> str:
    """Base64 of the entries in big-endian order, 8 bytes each: hash, then position."""
    return base64.b64encode(entries.astype(">u8").tobytes()).decode("ascii")


def from_text(value: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(value), ">u8").astype(np.uint64)


def fingerprints(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """doc_id and fingerprint (array of structs hash, position) of every text; null and empty texts have no entries."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            prints = [fingerprint(t, k, window) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "hashes": [(p >> np.uint64(32)).astype(np.int64) for p in prints], "positions": [(p & np.uint64(0xFFFFFFFF)).astype(np.int64) for p in prints]})

    got = only(docs, ["doc_id", "text"]).select("doc_id", text_or_empty().alias("text")).mapInPandas(run, "doc_id long, hashes array<long>, positions array<long>")
    return got.select("doc_id", F.arrays_zip(F.col("hashes").alias("hash"), F.col("positions").alias("position")).alias("fingerprint"))


def with_next(docs: DataFrame, rows_per_range: int = 1024, most_ranges: int = 20_000) -> DataFrame:
    """(range, own, key, doc_id, text): documents dealt into ranges of doc_id, each with one borrowed row.

    The borrowed row (own = false) is the highest document of the range below or, in the lowest range, the highest of
    all. Only ids are looked at to find the ranges; the driver holds a bound and the highest id of each, at most
    ``most_ranges`` of them. Beyond that ranges grow; a task sorts its range and streams it, so it holds two texts at a
    time however long the range is. A null doc_id comes after all others.
    """
    rows = only(docs, ["doc_id", "text"]).select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("key"), "doc_id", text_or_empty().alias("text"))
    ids = rows.select("key")
    wanted = max(1, min(-(-ids.count() // rows_per_range), most_ranges))
    bounds = np.array(sorted(set(ids.agg(F.percentile_approx("key", [i / wanted for i in range(1, wanted)], 20 * wanted)).first()[0] or ())) if wanted > 1 else [], np.int64)

    @F.pandas_udf(T.IntegerType())
    def range_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, key.to_numpy()), dtype="int32")

    tops = sorted((r[0], r[1]) for r in ids.select("key", range_of("key").alias("range")).groupBy("range").agg(F.max("key")).collect())
    highest = np.array([top for _, top in tops], np.int64)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def ranges_of(key: pd.Series) -> pd.Series:
        at = np.searchsorted(highest, key.to_numpy())  # ranges in order of their highest ids
        return pd.Series([[k] if highest[k] != x else [k, (k + 1) % len(highest)] for k, x in zip(at.tolist(), key.tolist(), strict=True)])

    dealt = rows.select("key", "doc_id", "text", F.posexplode(ranges_of("key")).alias("borrowed", "range"))
    return dealt.select("range", (F.col("borrowed") == 0).alias("own"), "key", "doc_id", "text")


def edit(text: str, after: str) -> str:
    """``text`` with its last third replaced by as many of the first code points of ``after``, or all of them."""
    m = len(text) // 3
    return text[: len(text) - m] + after[:m]


def compare_with_next(docs: DataFrame, k: int = K, window: int = WINDOW, rows_per_range: int = 1024) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness (see ``likeness``), one row a document.

    Null texts are empty: no entries, an empty fingerprint string, likeness 1 to another empty text and 0 to any other.
    Equal hashes in a window choose the rightmost. Very long texts are taken whole. Rows of one doc_id follow each other in
    the order of their texts; a null doc_id comes after all others. An empty table gives no rows. Other columns are ignored.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for pdf in batches:
            out = []
            for place, own, doc_id, text in zip(pdf["range"], pdf["own"], pdf["doc_id"], pdf["text"], strict=True):
                now = (place, doc_id, text, fingerprint(text, k, window)) if own or held else None
                if held and held[0] == place:
                    _, before, old, mark = held
                    new = edit(old, text)
                    other = fingerprint(new, k, window)
                    sha = hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest()
                    out.append((before, len(old), sha, as_text(mark), as_text(other), likeness(mark, other), likeness(mark, now[3])))
                held = now if own else None
            yield pd.DataFrame(out, columns=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    dealt = with_next(docs, rows_per_range).repartition("range").sortWithinPartitions("range", F.desc("own"), F.desc("key"), "text")
    return dealt.select("range", "own", "doc_id", "text").mapInPandas(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )


def op1_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_batches(spark)
    return compare_with_next(table(spark, sf_dir, "documents"))
