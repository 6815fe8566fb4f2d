"""SimHash near-dedup by a byte-position inverted index with count filtering (operator 5).

A fingerprint has eight positional bytes. Two fingerprints within ``MAX_BITS`` = 2 differing bits differ in at most two
bytes, so they share at least six positional bytes: the guaranteed minimum. The index lists distinct fingerprints under
four positional bytes at a time (two of the four byte pairs; any link shares at least one such combination), for lists of
single bytes would hold a 256th of the corpus each. ``tallied`` adds to the four bytes that a pair of a list shares those
that it shares of the four posted with the entry, and keeps pairs that reach the minimum: without looking at bits it
drops all but a few of the pairs that meet by chance. ``links`` verifies what is left by the differing bits.

A list of over ``LIST_ROWS`` fingerprints would make too many pairs. Its members are linked exactly in another way: two
words are within two bits if and only if some word is within one bit of both, so each member is entered under the 65
words within one bit of it, and the members under one word are linked to the least of them. No pair is lost, and the
rows are 65 for each fingerprint, however large the list.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .common import materialize, only, table, text_batches, text_or_empty
from .components import components

SEED = 42
SHINGLE = 3
MAX_BITS = 2
MIN_BYTES = 8 - MAX_BITS
LIST_ROWS = 64
#: Byte pairs of a fingerprint, by how far they are from its right end in bits.
BLOCKS = (48, 32, 16, 0)


def simhash(text: str, shingle: int = SHINGLE) -> int:
    """The fingerprint of a whole text, as a signed 64-bit integer; 0 for a text without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line, size = b" ".join(words), min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - size + 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[size - 1 :].tolist(), strict=True)), np.uint64, n)
    set_bits = np.zeros(64, np.int64)
    for k in range(0, n, 65536):
        set_bits += np.unpackbits(hashes[k : k + 65536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n).view(">i8")[0])


@F.pandas_udf(T.LongType())
def simhash_column(texts: pd.Series) -> pd.Series:
    return pd.Series([simhash(t or "") for t in texts], dtype="int64")


def postings(prints: DataFrame) -> DataFrame:
    """(list, key, fp, rest): each fingerprint under its six combinations of two byte pairs, with its four other positional bytes."""
    byte = lambda s: F.shiftrightunsigned("fp", s).bitwiseAND(F.lit(255)).cast("int")
    pair = lambda s: F.shiftrightunsigned("fp", s).bitwiseAND(F.lit(0xFFFF))
    keys = []
    for i in range(4):
        for j in range(i + 1, 4):
            rest = [byte(s + 8 * k) for s in BLOCKS if s not in (BLOCKS[i], BLOCKS[j]) for k in (1, 0)]
            keys.append(F.struct(F.lit(4 * i + j).alias("list"), (F.shiftleft(pair(BLOCKS[i]), 16) + pair(BLOCKS[j])).alias("key"), F.array(*rest).alias("rest")))
    return prints.select("fp", F.explode(F.array(*keys)).alias("x")).select("x.list", "x.key", "fp", "x.rest")


def tallied(listed: DataFrame, least: int = MIN_BYTES) -> DataFrame:
    """(u, v, shared) of the pairs of a list, u < v, that share at least ``least`` positional bytes."""
    both = listed.alias("a").join(listed.alias("b"), ["list", "key"]).where("a.fp < b.fp")
    tally = 4 + sum((F.when(F.col("a.rest")[k] == F.col("b.rest")[k], 1).otherwise(0) for k in range(4)), F.lit(0))
    return both.select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v"), tally.alias("shared")).where(F.col("shared") >= least)


def links(prints: DataFrame, list_rows: int = LIST_ROWS) -> DataFrame:
    """(u, v) edges among the distinct fingerprints in column fp; their components are those of all pairs within two bits."""
    listed = postings(prints)
    sizes = listed.groupBy("list", "key").agg(F.count("*").alias("n")).where("n > 1")
    listed = materialize(listed.join(sizes, ["list", "key"]), "postings")
    near = tallied(listed.where(F.col("n") <= list_rows).drop("n")).where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= MAX_BITS).select("u", "v")
    members = listed.where(F.col("n") > list_rows).select("fp").distinct()
    ball = members.select("fp", F.explode(F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(1 << b if b < 63 else -(1 << 63))) for b in range(64)])).alias("word"))
    least = ball.groupBy("word").agg(F.min("fp").alias("v"), F.count("*").alias("n")).where("n > 1").select("word", "v")
    star = ball.join(least, "word").select(F.col("fp").alias("u"), "v").where("u <> v")
    return near.unionByName(star).distinct()


def near_groups(docs: DataFrame, list_rows: int = LIST_ROWS) -> DataFrame:
    """doc_id, fp (bigint) and component_id for every row of ``docs``.

    Null, empty and white-space texts have the fingerprint 0, which links like any other. Very long texts count whole.
    Repeated rows and equal fingerprints are one node. A null doc_id gets its component's id and is never one. An empty
    table gives no rows. Other columns are ignored.
    """
    prints = materialize(only(docs, ["doc_id", "text"]).select("doc_id", simhash_column(text_or_empty()).alias("fp")), "fingerprints")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    linked = materialize(components(links(nodes.select("fp"), list_rows)).withColumnsRenamed({"node": "fp"}), "components")
    of_node = nodes.join(linked, "fp", "left").select("fp", "first_id", F.coalesce("component", "fp").alias("component"))
    least = of_node.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = of_node.join(least, "component").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def drop_near_copies(docs: DataFrame, list_rows: int = LIST_ROWS) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the document with the smallest doc_id.

    The ids to drop are written as a table, so that Spark broadcasts it if it is small and shuffles otherwise. Rows
    without a doc_id can't be told apart by it, and all stay.
    """
    out = near_groups(docs, list_rows).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(materialize(out, "dropped"), "doc_id", "left_anti").select(docs.columns)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_batches(spark)
    found = near_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
