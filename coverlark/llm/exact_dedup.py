"""Exact dedup by a heavy-hitter split (operator 6).

Texts are equal when they are identical after deleting white space. A Misra-Gries summary of ``counters`` entries for
each partition, added up over partitions, names at most ``counters`` digests that can be frequent. Their groups are
counted exactly, and the verified winners (at most ``counters`` rows: the proven bound of the broadcast) mark their
copies on the map side, without a shuffle. Every other digest is known to be infrequent and takes the ordinary shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import materialize, only, scratch, table, text_batches, text_or_empty

WHITE_SPACE = " \t\n\x0b\f\r"
COUNTERS = 1024


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars (code points of the original text), text_sha256 (of the text without white space; null is empty)."""
    bare = text_or_empty()
    for c in WHITE_SPACE:
        bare = F.replace(bare, F.lit(c), F.lit(""))
    return only(docs, ["doc_id", "text"]).select(
        "doc_id", F.char_length(text_or_empty()).cast("long").alias("n_chars"), F.sha2(bare, 256).alias("text_sha256")
    )


def misra_gries(batches: Iterator[pd.DataFrame], counters: int) -> dict[str, int]:
    """A summary whose counts are too low by at most n / (counters + 1); keys that are more frequent than that are in it."""
    held: dict[str, int] = {}
    for pdf in batches:
        for key, n in pdf.iloc[:, 0].value_counts().items():
            held[key] = held.get(key, 0) + int(n)
        if len(held) > counters:
            cut = sorted(held.values(), reverse=True)[counters]
            held = {k: n - cut for k, n in held.items() if n > cut}
    return held


def heavy_digests(hashed: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` candidate digests, the most frequent by their summed Misra-Gries counts."""

    def summarize(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = misra_gries(batches, counters)
        if held:
            yield pd.DataFrame({"text_sha256": list(held), "low": list(held.values())})

    return (
        hashed.select("text_sha256")
        .mapInPandas(summarize, "text_sha256 string, low long")
        .groupBy("text_sha256")
        .agg(F.sum("low").alias("low"))
        .where("low > 1")
        .orderBy(F.desc("low"), "text_sha256")
        .limit(counters)
        .select("text_sha256")
    )


def _winners(hashed: DataFrame) -> DataFrame:
    """Of each digest the row with the most code points, then the smallest doc_id. A null doc_id comes after all others."""
    best = F.min(F.struct((-F.col("n_chars")).alias("minus"), F.col("doc_id").isNull().alias("none"), "doc_id"))
    return hashed.groupBy("text_sha256").agg(best.alias("best"), F.count("*").alias("group_size")).select(
        "text_sha256", F.col("best.doc_id").alias("keep_id"), "group_size"
    )


def exact_dedup(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``.

    Null and empty texts are equal to each other and to texts of white space alone. Very long texts are hashed whole. Of
    equally long texts the smallest doc_id stays. Repeated rows of one doc_id are one document and get the same answer. An
    empty table gives an empty result. Other columns are ignored.
    """
    hashed = materialize(digests(docs), "digests")
    candidates = heavy_digests(hashed, counters)
    heavy = materialize(_winners(hashed.join(F.broadcast(candidates), "text_sha256", "left_semi")).where("group_size > 1"), "heavy")
    marked = hashed.join(F.broadcast(heavy), "text_sha256", "left")
    light = marked.where("group_size is null").select("text_sha256", "doc_id", "n_chars")
    rest = light.join(_winners(light), "text_sha256")
    columns = ["doc_id", "keep_id", "group_size", F.expr("doc_id <=> keep_id").alias("kept"), "text_sha256"]
    return marked.where("group_size is not null").select(*columns).unionByName(rest.select(*columns))


def drop_copies(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group of equal texts.

    The ids to drop are written as a table, so that Spark broadcasts it if it is small and shuffles otherwise. Repeated
    rows of one document leave one. Rows without a doc_id can't be told apart by it, and all stay.
    """
    with scratch(docs.sparkSession):
        decided = materialize(exact_dedup(docs, counters), "decided")
        out = materialize(decided.where("not kept and doc_id is not null").select("doc_id").distinct(), "dropped", outlive=True)
        twice = decided.where("kept and doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
        twice = materialize(twice, "repeated", outlive=True)
    stay = docs.join(out, "doc_id", "left_anti").select(docs.columns)
    once = stay.join(twice, "doc_id", "left_semi").select(docs.columns).dropDuplicates(["doc_id"])
    return stay.join(twice, "doc_id", "left_anti").select(docs.columns).unionByName(once)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_batches(spark)
    return exact_dedup(table(spark, sf_dir, "documents"))


OP6_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), h AS (
  SELECT doc_id, length(text) AS n_chars, sha256(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM t
)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id) AS kept,
       text_sha256
FROM h
"""
