"""Removal of repeated byte strings by a common-prefix-aware distributed merge sort of suffixes (operator 3).

Which suffixes are sorted. Every string of ``LENGTH`` = 400 bytes has an anchor, the position of the least hash among its
``GRAM``-byte grams (the leftmost of equals). Equal strings have their anchors at equal offsets, and successive starts
with one anchor form its run. An anchor whose gram occurs nowhere else cannot belong to a repeated string. Anchors with
equal runs (the whole stretch of bytes that the run's strings cover) form a class, and a class of two or more is repeated
from end to end. What is left are classes that share a gram and differ somewhere: these are sorted, once by the bytes
after the anchor and once by the bytes before it, read backwards.

How they are sorted. A task sorts pieces of its records, front-codes them (the length of the prefix shared with the record
before, and the rest) and merges them into one run. The stretch of the run between two splitters goes to that range's
task, where a loser tree merges the stretches. It keeps for each loser how many bytes it shares with the winner above, so
two records are compared from their first unknown byte on, and it hands out each record with the length of the prefix
that it shares with the one before. Splitters are records themselves, so no range but the first is empty, and the last
record of a range meets the first of the next one in a join on the range's number.

What the order says. A string that starts l bytes before anchor a is repeated if and only if some other class shares at
least l bytes before and 400 - l bytes after. A record's neighbours in the two orders bound both lengths from above, and
give pairs that reach them. If these pairs don't cover all l between the bounds, the open ones are settled by hashes of
the 400-byte strings themselves.
"""

from __future__ import annotations

import bisect
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import materialize, only, scratch, table, text_batches, text_or_empty

LENGTH = 400
GRAM = 32
#: Records that a task sorts at a time, and of a range of the merged order.
RUN_RECORDS = 20_000
RANGE_RECORDS = 20_000
#: Sampled keys a range; the driver sorts about SAMPLES of them, which bounds the number of ranges, not what they hold.
OVERSAMPLE = 8
SAMPLES = 50_000
#: Rows that a task hands out at a time.
OUT_ROWS = 50_000
BASE, MIX = 0x9E3779B97F4A7C15, 0xFF51AFD7ED558CCD


def gram_hashes(raw: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of all grams of ``size`` bytes (a power of two), by doubling."""
    h, base, have = raw.astype(np.uint64) + np.uint64(1), BASE, 1
    while have < size:
        h = h[:-have] * np.uint64(base) + h[have:]
        base, have = base * base % 2**64, 2 * have
    h ^= h >> np.uint64(33)
    h *= np.uint64(MIX)
    return h ^ h >> np.uint64(29)


def _minima(keys: np.ndarray, window: int) -> np.ndarray:
    n = len(keys)
    rows = -(-n // window)
    grid = np.full(rows * window, np.iinfo(np.uint64).max, np.uint64)
    grid[:n] = keys
    grid = grid.reshape(rows, window)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - window + 1], ahead[window - 1 : n])


def anchors(raw: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Of each anchor: its position, the first and last start of its run, and the hash of its gram."""
    none = np.empty(0, np.int64)
    if len(raw) < length:
        return none, none, none, none
    h = gram_hashes(np.frombuffer(raw, np.uint8), gram)
    keys = h & np.uint64(0xFFFFFFFF00000000) | np.arange(len(h), dtype=np.uint64)
    at = (_minima(keys, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.concatenate(([0], np.flatnonzero(np.diff(at)) + 1))
    last = np.concatenate((first[1:], [len(at)])) - 1
    where = at[first]
    return where, first, last, h[where].view(np.int64)


def shared(a: bytes, b: bytes, known: int = 0) -> int:
    """How many bytes two strings share at their start; they are known to share ``known``."""
    end = min(len(a), len(b))
    while known < end:
        stop = min(end, known + 64)
        x, y = a[known:stop], b[known:stop]
        if x != y:
            differ = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
            return known + len(x) - (differ.bit_length() + 7) // 8
        known = stop
    return end


class Record:
    """A key, what lies on the anchor's other side, and whose it is: ``rid`` is (doc, rid), ``at`` the anchor's place."""

    __slots__ = ("key", "other", "rid", "at")

    def __init__(self, key: bytes, other: bytes, rid: tuple[int, int], at: int):
        self.key, self.other, self.rid, self.at = key, other, rid, at

    def order(self) -> tuple:
        return self.key, self.other, self.rid, self.at


HEAD = struct.Struct("<HHHqqi")


class Encoder:
    """Front-codes records that come in order."""

    def __init__(self):
        self.out, self.last = [], b""

    def add(self, r: Record, known: int | None = None) -> None:
        n = (shared(self.last, r.key) if known is None else known) if self.out else 0
        self.out += (HEAD.pack(n, len(r.key) - n, len(r.other), *r.rid, r.at), r.key[n:], r.other)
        self.last = r.key

    def block(self) -> bytes:
        return zstandard.ZstdCompressor(level=1).compress(b"".join(self.out))


def encode_run(records: list[Record]) -> bytes:
    """A sorted run, front-coded and compressed."""
    e = Encoder()
    for r in records:
        e.add(r)
    return e.block()


def decode_run(block: bytes) -> Iterator[tuple[int, Record]]:
    """The records of a run, each with the length of the prefix it shares with the one before."""
    data, at, last = zstandard.ZstdDecompressor().decompress(block), 0, b""
    while at < len(data):
        n, rest, other, doc, rid, where = HEAD.unpack_from(data, at)
        at += HEAD.size
        last = last[:n] + data[at : at + rest]
        at += rest
        yield n, Record(last, data[at : at + other], (doc, rid), where)
        at += other


def merge(runs: list[Iterator[tuple[int, Record]]]) -> Iterator[tuple[int, Record]]:
    """Merge sorted runs with a loser tree; each record comes with the length of the prefix it shares with the one before.

    ``known[i]`` is what the head of run i shares with the last winner that beat it or preceded it in its run. The head
    that shares more with the last record handed out comes first; only equal lengths need bytes to be compared.
    """
    n = 1
    while n < len(runs):
        n *= 2
    runs = [*runs, *(iter(()) for _ in range(n - len(runs)))]
    heads: list[Record | None] = [None] * n
    known = [0] * n
    for i, run in enumerate(runs):
        known[i], heads[i] = next(run, (0, None))
    known = [0] * n  # nothing has been handed out

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two runs; the loser learns what it shares with the winner."""
        x, y = heads[a], heads[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        both = shared(x.key, y.key, known[a])
        if both < len(x.key) and both < len(y.key):
            less = x.key[both] < y.key[both]
        elif len(x.key) != len(y.key):
            less = len(x.key) < len(y.key)
        else:
            less = (x.other, x.rid, x.at) <= (y.other, y.rid, y.at)
        win, lose = (a, b) if less else (b, a)
        known[lose] = both
        return win, lose

    tree = [0] * n  # tree[k] is the loser of match k, tree[0] the winner of all
    winners = [0] * n + list(range(n))
    for k in range(n - 1, 0, -1):
        winners[k], tree[k] = play(winners[2 * k], winners[2 * k + 1])
    top = winners[1]
    while heads[top] is not None:
        yield known[top], heads[top]
        known[top], heads[top] = next(runs[top], (0, None))
        k = (top + n) // 2
        while k:
            top, tree[k] = play(top, tree[k])
            k //= 2


def _rows(docs: DataFrame) -> DataFrame:
    """doc, rid, doc_id and text. (doc, rid) stands for a document and its text, so that repeated rows are told from
    clashing ids: doc is the doc_id (the least integer for null), rid a hash of the text, which only tells rows of one doc_id apart."""
    rows = only(docs, ["doc_id", "text"]).select("doc_id", text_or_empty().alias("text"))
    return rows.select(F.coalesce("doc_id", F.lit(-(1 << 63))).cast("long").alias("doc"), F.xxhash64("doc_id", "text").alias("rid"), "doc_id", "text")


ROW = ["doc", "rid"]
ANCHOR = [*ROW, "at"]


def find_anchors(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            parts = []
            for doc, rid, text in zip(pdf["doc"].tolist(), pdf["rid"].tolist(), pdf["text"], strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                at, first, last, gram = anchors(raw)
                if len(at):
                    spans = [xxhash.xxh3_64_intdigest(raw[a : b + LENGTH]) for a, b in zip(first.tolist(), last.tolist(), strict=True)]
                    parts.append((np.full(len(at), doc), np.full(len(at), rid), at, first, last, gram, np.array(spans, np.uint64).view(np.int64)))
            if parts:
                yield pd.DataFrame(dict(zip((*ANCHOR, "first", "last", "gram", "span"), map(np.concatenate, zip(*parts, strict=True)), strict=True)))

    return rows.where(F.octet_length("text") >= LENGTH).select(*ROW, "text").mapInPandas(run, "doc long, rid long, at int, first int, last int, gram long, span long")


def contexts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(gram, doc, rid, at, before, after) of the wanted anchors: bytes before the anchor read backwards, and from it on."""
    lists = wanted.groupBy(*ROW).agg(F.collect_list(F.struct("at", "first", "last", "gram")).alias("list"))  # as long as the text at most
    joined = rows.select(*ROW, "text").join(lists, ROW).select(*ROW, "text", *[F.col(f"list.{c}").alias(c) for c in ("at", "first", "last", "gram")])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc, rid, text, ats, firsts, lasts, grams in pdf.itertuples(index=False):
                raw = text.encode("utf-8", "surrogatepass")
                out += [(g, doc, rid, a, raw[f:a][::-1], raw[a : e + LENGTH]) for a, f, e, g in zip(ats, firsts, lasts, grams, strict=True)]
            yield pd.DataFrame(out, columns=["gram", *ANCHOR, "before", "after"])

    return joined.mapInPandas(run, "gram long, doc long, rid long, at int, before binary, after binary")


def separators(drawn: list[tuple[bytes, bytes]], ranges: int) -> list[tuple[bytes, bytes]]:
    """At most ``ranges`` - 1 splitters from drawn records, each as short as tells it from the splitter before."""
    keys = sorted(set(drawn))
    chosen = [keys[i * len(keys) // ranges] for i in range(1, ranges)] if len(keys) >= ranges else keys
    out: list[tuple[bytes, bytes]] = []
    for k, (key, other) in enumerate(chosen):
        same = shared(chosen[k - 1][0], key) if k else len(key)
        out.append((key[: same + 1], b"") if same < len(key) else (key, other))
    return out


def neighbours(records: DataFrame, key: str, other: str) -> DataFrame:
    """(doc, rid, at, key_shared, other_shared): what each record shares with its neighbours in the order of ``key``.

    Ranges are found from a sample of keys; how well it is drawn changes only how even they are. A task holds its own
    records, compressed, and a range's stretches; both are merged as streams.
    """
    count, run_records = records.count(), RUN_RECORDS
    ranges = max(1, min(-(-count // RANGE_RECORDS), SAMPLES // OVERSAMPLE))
    splitters: list[tuple[bytes, bytes]] = []
    if ranges > 1:
        rate = max(1, count // (ranges * OVERSAMPLE))
        drawn = records.where(F.pmod(F.xxhash64(*ANCHOR), F.lit(rate)) == 0).select(key, other)
        splitters = separators([(bytes(r[0]), bytes(r[1])) for r in drawn.toLocalIterator()], ranges)
    shipped = records.sparkSession.sparkContext.broadcast(splitters)  # at most SAMPLES / OVERSAMPLE short keys

    def sort_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[Record] = []
        pieces: list[bytes] = []
        cuts = shipped.value

        def flush() -> None:
            held.sort(key=Record.order)
            pieces.append(encode_run(held))
            held.clear()

        for pdf in batches:
            for x, y, doc, rid, at in zip(pdf[key], pdf[other], pdf["doc"].tolist(), pdf["rid"].tolist(), pdf["at"].tolist(), strict=True):
                held.append(Record(bytes(x), bytes(y), (doc, rid), at))
                if len(held) >= run_records:
                    flush()
        if held:
            flush()
        place, stretch = 0, Encoder()
        for n, r in merge([decode_run(b) for b in pieces]):
            to = bisect.bisect_right(cuts, (r.key, r.other), lo=place)
            if to != place and stretch.out:
                yield pd.DataFrame({"range": [place], "block": [stretch.block()]})
                stretch = Encoder()
            place = to
            stretch.add(r, n)
        if stretch.out:
            yield pd.DataFrame({"range": [place], "block": [stretch.block()]})

    def merge_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, blocks = None, []
        columns = [*ANCHOR, "key_shared", "other_shared", "range", "key", "other"]

        def merged() -> Iterator[pd.DataFrame]:
            last = None
            out = []
            for n, r in merge([decode_run(b) for b in blocks]):
                if last is None:
                    out.append((*r.rid, r.at, None, None, now, r.key, r.other))  # the first of the range
                else:
                    m = shared(last.other, r.other)
                    out += [(*x.rid, x.at, n, m, None, None, None) for x in (last, r)]
                last = r
                if len(out) >= OUT_ROWS:
                    yield pd.DataFrame(out, columns=columns)
                    out = []
            out.append((*last.rid, last.at, None, None, -now - 1, last.key, last.other))  # the last of the range
            yield pd.DataFrame(out, columns=columns)

        for pdf in batches:
            for place, block in zip(pdf["range"].tolist(), pdf["block"], strict=True):
                if place != now and blocks:
                    yield from merged()
                    blocks = []
                now = place
                blocks.append(block)
        if blocks:
            yield from merged()

    def across(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            n = [shared(a, b) for a, b in zip(pdf["a_key"], pdf["b_key"], strict=True)]
            m = [shared(a, b) for a, b in zip(pdf["a_other"], pdf["b_other"], strict=True)]
            for side in ("a", "b"):
                yield pd.DataFrame({c: pdf[f"{side}_{c}"] for c in ANCHOR} | {"key_shared": n, "other_shared": m})

    sorted_runs = records.select(*ANCHOR, key, other).mapInPandas(sort_runs, "range int, block binary")
    schema = "doc long, rid long, at int, key_shared int, other_shared int"
    found = sorted_runs.repartition("range").sortWithinPartitions("range").mapInPandas(merge_runs, f"{schema}, range int, key binary, other binary")
    found = materialize(found, "neighbours")
    inside = found.where("range is null").select(*ANCHOR, "key_shared", "other_shared")
    ends = found.where("range is not null")
    side = lambda of, number, name: ends.where(of).select(number.alias("number"), *[F.col(c).alias(f"{name}_{c}") for c in (*ANCHOR, "key", "other")])
    meet = side("range < 0", -F.col("range"), "a").join(side("range >= 0", F.col("range"), "b"), "number")  # the last of k meets the first of k + 1
    return inside.unionByName(meet.mapInPandas(across, schema))


def settle(pairs: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """From (shared before, shared after) with several others: the ranges of l that are repeated, and those that are open."""
    spans = sorted((LENGTH - after, before) for before, after in pairs if LENGTH - after <= before)
    low, high = LENGTH - max(after for _, after in pairs), max(before for before, _ in pairs)
    found, free, at = [], [], low
    for a, b in spans:
        if a > at:
            free.append((at, a - 1))
        if b >= at:
            found.append((max(a, at), b))
            at = b + 1
    if at <= high:
        free.append((at, high))
    return found, free


def repeated_ranges(records: DataFrame) -> DataFrame:
    """(doc, rid, at, low, high, route): the l for which the string from l bytes before the anchor on is shared with another class.

    route is "order" where the neighbours settle it, "open" where hashes of the strings had to.
    """

    def both_orders() -> DataFrame:
        after = neighbours(records, "after", "before").select(*ANCHOR, F.col("other_shared").alias("before"), F.col("key_shared").alias("after"))
        before = neighbours(records, "before", "after").select(*ANCHOR, F.col("key_shared").alias("before"), F.col("other_shared").alias("after"))
        return after.unionByName(before).groupBy(*ANCHOR).agg(F.collect_list("before").alias("before"), F.collect_list("after").alias("after"))  # four at most

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc, rid, at, b, a in pdf.itertuples(index=False):
                found, free = settle(list(zip(b, a, strict=True)))
                out += [(doc, rid, at, low, high, False) for low, high in found] + [(doc, rid, at, low, high, True) for low, high in free]
            yield pd.DataFrame(out, columns=[*ANCHOR, "low", "high", "open"])

    with scratch(records.sparkSession):
        settled = materialize(both_orders().mapInPandas(run, "doc long, rid long, at int, low int, high int, open boolean"), "settled", outlive=True)
    sure = settled.where("not open").drop("open").withColumn("route", F.lit("order"))
    return sure.unionByName(open_ranges(records, settled.where("open").drop("open")).withColumn("route", F.lit("open")))


def open_ranges(records: DataFrame, free: DataFrame) -> DataFrame:
    """Settle open l by hashes of the strings themselves, for the grams that have any."""
    grams = records.select("gram", *ANCHOR).join(free, ANCHOR).groupBy("gram").agg(F.min("low").alias("low"), F.max("high").alias("high"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for gram, doc, rid, at, before, after, low, high in pdf.itertuples(index=False):
                whole, n = bytes(before)[::-1] + bytes(after), len(before)
                for k in range(max(low, LENGTH - len(after)), min(high, n) + 1):
                    out.append((gram, doc, rid, at, k, xxhash.xxh3_64_intdigest(whole[n - k : n - k + LENGTH]) - 2**63))
            yield pd.DataFrame(out, columns=["gram", *ANCHOR, "low", "hash"])

    strings = records.select("gram", *ANCHOR, "before", "after").join(grams, "gram").mapInPandas(run, "gram long, doc long, rid long, at int, low int, hash long")
    strings = materialize(strings, "strings")
    several = strings.groupBy("gram", "low", "hash").agg(F.count("*").alias("n")).where("n > 1").select("gram", "low", "hash")
    return strings.join(several, ["gram", "low", "hash"], "left_semi").select(*ANCHOR, "low", F.col("low").alias("high"))


def ranges_by_route(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All anchors, and (gram, span, low, high, route) of the repeated ranges of their classes; route "whole" is a class of several anchors."""
    found = materialize(find_anchors(rows), "anchors")
    one = F.min(F.struct(*ANCHOR, "first", "last"))
    classes = materialize(found.groupBy("gram", "span").agg(F.count("*").alias("n"), one.alias("one")).select("gram", "span", "n", "one.*"), "classes")
    several = classes.groupBy("gram").agg(F.count("*").alias("classes")).where("classes > 1").select("gram")
    shared_grams = classes.join(several, "gram")
    with scratch(rows.sparkSession):
        settled = materialize(repeated_ranges(materialize(contexts(rows, shared_grams), "contexts")), "ranges", outlive=True)
    whole = classes.where("n > 1").select("gram", "span", (F.col("at") - F.col("last")).alias("low"), (F.col("at") - F.col("first")).alias("high"), F.lit("whole").alias("route"))
    part = settled.join(shared_grams.where("n = 1").select("gram", "span", *ANCHOR), ANCHOR).select("gram", "span", "low", "high", "route")
    return found, whole.unionByName(part)


def repeated_starts(rows: DataFrame) -> DataFrame:
    """(doc, rid, first, last): ranges of starts of repeated strings of LENGTH bytes in each text."""
    found, ranges = ranges_by_route(rows)
    return found.select("gram", "span", *ANCHOR).join(ranges.drop("route"), ["gram", "span"]).select(*ROW, (F.col("at") - F.col("high")).alias("first"), (F.col("at") - F.col("low")).alias("last"))


def cut(raw: bytes, first: np.ndarray, last: np.ndarray, length: int = LENGTH) -> tuple[int, int, bytes]:
    """Bytes removed, maximal removed runs, and what is left of ``raw``, given the ranges of repeated starts."""
    if not len(first):
        return 0, 0, raw
    order = np.argsort(first, kind="stable")
    a, b = first[order], np.maximum.accumulate(last[order]) + length
    new = np.concatenate(([True], a[1:] > b[:-1]))  # runs that touch are one
    starts, ends = a[new], b[np.append(np.flatnonzero(new)[1:] - 1, len(b) - 1)]
    edges = [0, *np.column_stack([starts, ends]).ravel().tolist(), len(raw)]
    kept = b"".join(raw[edges[k] : edges[k + 1]] for k in range(0, len(edges), 2))
    return int((ends - starts).sum()), len(starts), kept


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (binary) of every row of ``docs``.

    Null texts are empty. Texts of under LENGTH bytes lose nothing. Very long texts are treated whole. Repeated rows are
    copies of each other, so long ones lose everything, each. A null doc_id stays null. An empty table gives no rows.
    """
    rows = _rows(docs)
    starts = repeated_starts(rows).groupBy(*ROW).agg(F.collect_list("first").alias("first"), F.collect_list("last").alias("last"))  # as long as the text at most

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc_id, text, first, last in zip(pdf["doc_id"], pdf["text"], pdf["first"], pdf["last"], strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                some = first is not None
                removed, spans, kept = cut(raw, np.asarray(first if some else [], np.int64), np.asarray(last if some else [], np.int64))
                out.append((doc_id, len(raw), removed, spans, hashlib.sha256(kept).hexdigest(), kept))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    joined = rows.join(starts, ROW, "left").select("doc_id", "text", "first", "last")
    return joined.mapInPandas(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_batches(spark)
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")
