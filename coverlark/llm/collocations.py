"""Phrase collocation mining over weighted acyclic automata (operator 13).

A sequence is a language and up to ``LONGEST`` words; the sequence of the language alone counts all its words. Every shard (some
million words of a task) sorts its sequences and builds count transducers from them, entry by entry, one for each prefix
range: ranges are cut between sequences, by a bounded sample of them, so that none depends on a single frequent first
word. The automata of a range are united with summed weights, and what stays below the least count loses its weight.
The parts of the candidates are looked up by composing an automaton of the parts asked for in a range with that of its counts.

A sequence can only be frequent if each of its words and word pairs is, so a first pass counts hashes of words and pairs
in buckets, and shards leave out sequences with a word or pair whose bucket is below the least count. That leaves out nothing
frequent, whatever the hashes. The buckets grow with the corpus up to 2 ** ``MOST_BITS``, of which each task gets one
bit; beyond that the filter holds less back, and the results stay the same.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from .automata import Automaton, compose, union
from .common import materialize, only, release, scratch, table, text_batches

LONGEST = 5
LEAST = 100
TOP = 2000
UNKNOWN = "und"
#: Words of a shard, bytes of text of a prefix range, rows of the sample that cuts ranges, and sequences for each that a shard gives to it.
SHARD, RANGE, SAMPLE, STRIDE = 1 << 21, 4 << 20, 20_000, 4096
LEAST_BITS, MOST_BITS, CHUNK = 20, 28, 16
#: A-Z become lower case, ends of pieces a line feed, tabs spaces.
FOLD = bytes.maketrans(bytes(range(65, 91)) + b".,;:!?\x0b\x0c\r\t", bytes(range(97, 123)) + b"\n" * 9 + b" ")
_tokens = re.compile(rb"[^ \n]+|\n").findall
MIX = np.uint64(0x9E3779B97F4A7C15)

Sequence = tuple[bytes, ...]


class _Numbers(dict):
    """token -> number in the order of first sight; the end of a piece is 0."""

    def __missing__(self, token: bytes) -> int:
        self[token] = n = len(self)
        return n


class Shard:
    """Words of some texts, by place: ``word`` is the number of a sorted word or -1 at an end of a piece, ``lang`` that of a sorted language."""

    def __init__(self, texts: list[tuple[bytes, bytes]]):
        numbers, ids, sizes = _Numbers({b"\n": 0}), [], []
        for _, text in texts:
            tokens = _tokens(text.translate(FOLD) + b"\n")
            ids.append(np.fromiter(map(numbers.__getitem__, tokens), np.int32, len(tokens)))
            sizes.append(len(tokens))
        names = [*numbers][1:]
        order = sorted(range(len(names)), key=names.__getitem__)
        place = np.empty(len(names) + 1, np.int64)
        place[0] = -1
        place[np.array(order, np.int64) + 1] = np.arange(len(names))
        self.words = [names[k] for k in order]
        self.langs = sorted({lang for lang, _ in texts})
        number = {lang: k for k, lang in enumerate(self.langs)}
        self.word = place[np.concatenate(ids)]
        self.lang = np.repeat(np.array([number[lang] for lang, _ in texts], np.int64), sizes)

    def buckets(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """The bucket of the word at each place, and of the pair that begins there; -1 for none."""
        shift = np.uint64(64 - bits)
        of = lambda names: np.array([xxhash.xxh64_intdigest(x) for x in names], np.uint64)
        words, langs, here = np.append(of(self.words), np.uint64(0)), of(self.langs), self.word >= 0
        one = (words[self.word] ^ langs[self.lang] * MIX) * MIX
        one ^= one >> np.uint64(29)
        single = np.where(here, (one * MIX >> shift).astype(np.int64), -1)
        two = (one[:-1] * MIX + words[self.word[1:]]) * MIX
        two ^= two >> np.uint64(31)
        pair = np.where(here[:-1] & here[1:], (two * MIX >> shift).astype(np.int64), -1)
        return single, np.append(pair, -1)

    def sequences(self, longest: int, word_passes: np.ndarray, pair_passes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct sequences (rows of language and words, -1 after the last) in order, and how often each occurs.

        Only those that begin at a place where all words and pairs pass; those of a language alone count every word.
        """
        rows, counts = [], []
        found = np.bincount(self.lang[self.word >= 0], minlength=len(self.langs))
        prefix = np.arange(len(self.langs))[:, None]
        rows.append(prefix[found > 0])
        counts.append(found[found > 0])
        at = np.flatnonzero(word_passes)
        rank = self.lang[at]
        for k in range(longest):
            if k:
                stays = pair_passes[at + k - 1]
                at, rank = at[stays], rank[stays]
            keys, rank, found = np.unique(rank * len(self.words) + self.word[at + k], return_inverse=True, return_counts=True)
            if not len(keys):
                break
            prefix = np.column_stack([prefix[keys // len(self.words)], keys % len(self.words)])
            rows.append(prefix)
            counts.append(found)
        whole = np.concatenate([np.pad(r, ((0, 0), (0, longest + 1 - r.shape[1])), constant_values=-1) for r in rows])
        order = np.lexsort(whole.T[::-1])
        return whole[order], np.concatenate(counts)[order]

    def spelled(self, row: np.ndarray) -> Sequence:
        return (self.langs[row[0]], *(self.words[w] for w in row[1:].tolist() if w >= 0))

    def automata(self, rows: np.ndarray, counts: np.ndarray, cuts: list[Sequence]) -> Iterator[tuple[int, Automaton]]:
        """A count transducer of the sorted rows for each prefix range that has some. Labels are languages' and words' places together."""
        words = sorted({*self.langs, *self.words})
        place = {w: k for k, w in enumerate(words)}
        lang, word = ([place[x] for x in names] for names in (self.langs, self.words))
        first = 0
        for k in range(len(cuts) + 1):
            last = len(rows) if k == len(cuts) else first + bisect_left(range(len(rows) - first), cuts[k], key=lambda i, first=first: self.spelled(rows[first + i]))
            if last > first:
                part = rows[first:last].tolist()
                used = sorted({lang[r[0]] for r in part} | {word[w] for r in part for w in r[1:] if w >= 0})
                own = {w: i for i, w in enumerate(used)}
                entries = (((own[lang[r[0]]], *(own[word[w]] for w in r[1:] if w >= 0)), n) for r, n in zip(part, counts[first:last].tolist(), strict=True))
                yield k, Automaton.of_sorted([words[w] for w in used], entries)
            first = last


def _shards(batches: Iterator[pd.DataFrame], size: int = SHARD) -> Iterator[Shard]:
    """Shards of about ``size`` words; a long text makes a larger one. Six bytes are taken for a word."""
    held, n = [], 0
    for pdf in batches:
        for lang, text in zip(pdf["lang"], pdf["text"], strict=True):
            held.append((bytes(lang), bytes(text)))
            n += len(text)
            if n >= 6 * size:
                yield Shard(held)
                held, n = [], 0
    if held:
        yield Shard(held)


def _chunks(found: np.ndarray, most: int) -> Iterator[tuple[int, bytes, bytes]]:
    """Chunk number, places in it and counts (at most ``most``) of buckets given once for each occurrence."""
    buckets, counts = np.unique(found, return_counts=True)
    counts = np.minimum(counts, most).astype(np.uint16)
    cut = np.flatnonzero(np.diff(buckets >> CHUNK)) + 1
    for b, c in zip(np.split(buckets, cut), np.split(counts, cut), strict=True):
        if len(b):
            yield int(b[0] >> CHUNK), (b & ((1 << CHUNK) - 1)).astype(np.uint16).tobytes(), c.tobytes()


def _filter(rows: DataFrame, bits: int, least: int) -> tuple[np.ndarray, list[Sequence]]:
    """A bit for each bucket with the least count, and the sample of sequences in order."""
    most = min(least, 65_535)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for shard in _shards(batches):
            single, pair = shard.buckets(bits)
            yield pd.DataFrame([*_chunks(np.concatenate([single[single >= 0], pair[pair >= 0]]), most)], columns=["chunk", "places", "counts"]).assign(key=None, sequence=None)
            begins = np.flatnonzero(shard.word >= 0)[STRIDE // 2 :: STRIDE]
            some = []
            for at in begins.tolist():
                own = shard.word[at : at + LONGEST]
                some.append(b"\n".join([shard.langs[shard.lang[at]], *(shard.words[w] for w in own[: int(np.argmax(np.append(own, -1) < 0))].tolist())]))
            yield pd.DataFrame({"chunk": -1, "places": None, "counts": None, "key": [xxhash.xxh64_intdigest(s, k) >> 1 for k, s in enumerate(some)], "sequence": some})
        release()

    counted = materialize(rows.mapInPandas(count, "chunk int, places binary, counts binary, key long, sequence binary"), "buckets")

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for pdf in batches:
            for chunk, places, counts in zip(pdf["chunk"], pdf["places"], pdf["counts"], strict=True):
                own = total.setdefault(chunk, np.zeros(1 << CHUNK, np.uint32))
                at = np.frombuffer(places, np.uint16)
                own[at] = np.minimum(own[at] + np.frombuffer(counts, np.uint16), most)
        if total:
            yield pd.DataFrame({"chunk": [*total], "bits": [np.packbits(v >= most).tobytes() for v in total.values()]})

    passes = np.zeros(1 << bits >> 3, np.uint8)
    for r in counted.where("chunk >= 0").select("chunk", "places", "counts").repartition("chunk").mapInPandas(add, "chunk int, bits binary").toLocalIterator():
        passes[r.chunk << CHUNK >> 3 : (r.chunk + 1) << CHUNK >> 3] = np.frombuffer(r.bits, np.uint8)
    some = counted.where("chunk < 0").orderBy("key", "sequence").limit(SAMPLE).select("sequence").collect()
    return passes, sorted(tuple(bytes(r.sequence).split(b"\n")) for r in some)


def _passing(passes: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    at = np.maximum(buckets, 0)
    return (buckets >= 0) & (passes[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


def count_automata(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, range_bytes: int = RANGE) -> tuple[DataFrame, list[Sequence]]:
    """(range, automaton) of all sequences with the least count and of every language, and the sequences between which ranges are cut."""
    spark = docs.sparkSession
    rows = only(docs, ["text", "lang"]).select(F.coalesce("lang", F.lit(UNKNOWN)).cast("binary").alias("lang"), F.col("text").cast("binary").alias("text")).where("length(text) > 0")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(size / 32 + 1))))
    passes, sample = _filter(rows, bits, least)
    ranges = max(1, math.ceil(size / range_bytes))
    cuts = sorted({sample[len(sample) * k // ranges] for k in range(1, ranges)}) if sample else []
    shared = spark.sparkContext.broadcast((passes, cuts))  # at most 2 ** (MOST_BITS - 3) bytes and SAMPLE sequences

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        passes, cuts = shared.value
        for shard in _shards(batches):
            single, pair = shard.buckets(bits)
            single, pair = _passing(passes, single), _passing(passes, pair)
            pair[:-1] &= single[:-1] & single[1:]
            made = [(k, a.dumps()) for k, a in shard.automata(*shard.sequences(longest, single, pair), cuts)]
            yield pd.DataFrame(made, columns=["range", "automaton"])
        release()

    def unite(pdf: pd.DataFrame) -> pd.DataFrame:
        got = union([Automaton.loads(x) for x in pdf["automaton"]], lambda depth, weight: weight >= least or depth == 1)
        return pd.DataFrame({"range": [pdf["range"].iloc[0]], "automaton": [got.dumps()]})

    shards = rows.mapInPandas(build, "range int, automaton binary")
    return materialize(shards.groupBy("range").applyInPandas(unite, "range int, automaton binary"), "automata"), cuts


def _entries(automata: DataFrame) -> DataFrame:
    """lang, words (space-joined, null for the language alone), size and f of all that the automata accept."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for data in pdf["automaton"]:
                got = [(k[0], b" ".join(k[1:]), len(k) - 1, n) for k, n in Automaton.loads(data).entries()]
                yield pd.DataFrame(got, columns=["lang", "phrase", "size", "f"])

    return automata.select("automaton").mapInPandas(run, "lang binary, phrase binary, size int, f long").select(F.col("lang").cast("string"), F.col("phrase").cast("string"), "size", "f")


def look_up(parts: DataFrame, automata: DataFrame, cuts: list[Sequence]) -> DataFrame:
    """lang, part and f of the distinct rows (lang, part) of ``parts`` that the automata accept."""
    shared = parts.sparkSession.sparkContext.broadcast(cuts)

    @F.pandas_udf(T.IntegerType())
    def range_of(lang: pd.Series, part: pd.Series) -> pd.Series:
        return pd.Series([_range(shared.value, (a.encode(), *b.encode().split(b" "))) for a, b in zip(lang, part, strict=True)], dtype="int32")

    def run(asked: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        keys = sorted((a.encode(), *b.encode().split(b" ")) for a, b in zip(asked["lang"], asked["part"], strict=True))
        words = sorted({w for k in keys for w in k})
        place = {w: k for k, w in enumerate(words)}
        wanted = Automaton.of_sorted(words, ((tuple(place[w] for w in k), 1) for k in keys))
        got = [(k[0].decode(), b" ".join(k[1:]).decode(), n) for data in counts["automaton"] for k, n in compose(wanted, Automaton.loads(data))]
        return pd.DataFrame(got, columns=["lang", "part", "f"])

    asked = parts.select("lang", "part").distinct().withColumn("range", range_of("lang", "part"))
    return asked.groupBy("range").cogroup(automata.groupBy("range")).applyInPandas(run, "lang string, part string, f long")


def _range(cuts: list[Sequence], sequence: Sequence) -> int:
    """The number of cuts that are not above the sequence."""
    low, high = 0, len(cuts)
    while low < high:
        middle = (low + high) // 2
        if cuts[middle] <= sequence:
            low = middle + 1
        else:
            high = middle
    return low


@F.pandas_udf(T.LongType())
def _score(a: pd.Series, n: pd.Series, first: pd.Series, rest: pd.Series) -> pd.Series:
    """Whole numbers of any size, so that no product is cut."""
    return pd.Series([1000 * w * x // (y * z) for w, x, y, z in zip(a.tolist(), n.tolist(), first.tolist(), rest.tolist(), strict=True)], dtype="int64")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP, range_bytes: int = RANGE) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the best phrases of each language.

    A phrase of 2 to ``longest`` words that occurs ``least`` times is a candidate. Its worst cut counts, the earliest of equal
    ones. Candidates inside a longer one that occurs as often are left out. A null text is empty, a null language is
    ``und`` and one with languages of that name; an empty language is a language. Repeated rows count as often as they are there; very long
    texts count whole; an empty table gives no rows. Other columns are ignored.
    """
    with scratch(docs.sparkSession):
        automata, cuts = count_automata(docs, longest, least, range_bytes)
        grams = materialize(_entries(automata), "sequences")
        found = grams.where("size >= 2").withColumn("w", F.split("phrase", " "))
        # What holds inside a longer candidate holds inside one of one word more, since counts never rise with words.
        inside = found.where("size > 2").select("lang", "f", F.explode(F.array(F.array_join(F.slice("w", 1, F.col("size") - 1), " "), F.array_join(F.slice("w", 2, F.col("size") - 1), " "))).alias("phrase"))
        inside = inside.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
        kept = found.join(inside, ["lang", "phrase"], "left").where("longer is null or 100 * longer < 100 * f").select("lang", "phrase", "size", "w", F.col("f").alias("a"))
        cut = kept.select("lang", "phrase", "a", "w", "size", F.explode(F.expr("sequence(1, size - 1)")).alias("k")).select(
            "lang", "phrase", "a", "k", F.array_join(F.expr("slice(w, 1, k)"), " ").alias("first"), F.array_join(F.expr("slice(w, k + 1, size)"), " ").alias("rest")
        )
        cut = materialize(cut, "cuts")
        counts = materialize(look_up(cut.select("lang", F.explode(F.array("first", "rest")).alias("part")), automata, cuts), "parts")
        for side, name in (("first", "l"), ("rest", "r")):
            cut = cut.join(counts.select("lang", F.col("part").alias(side), F.col("f").alias(name)), ["lang", side])
        cut = cut.join(grams.where("size = 0").select("lang", F.col("f").alias("n")), "lang")
        worst = cut.withColumn("score", _score("a", "n", "l", "r")).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("x"))
        order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
        best = worst.select("lang", "phrase", "a", "x.l", "x.r", "n", "x.score").withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
        return materialize(best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "collocations", outlive=True)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_batches(spark)
    return collocations(table(spark, sf_dir, "documents"))


OP13_SQL = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), places AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded
), grams AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS f
  FROM places, range(1, {LONGEST} + 1) s(size) WHERE i + size - 1 <= len(w) GROUP BY ALL HAVING count(*) >= {LEAST}
), totals AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang
), candidates AS (
  SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE size >= 2
), inside AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, a, array_to_string(w[b:b + part - 1], ' ') AS phrase
    FROM candidates, range(2, {LONGEST}) p(part), range(1, {LONGEST}) q(b) WHERE part < size AND b + part - 1 <= size
  ) GROUP BY ALL
), kept AS (
  SELECT c.* FROM candidates c LEFT JOIN inside i USING (lang, phrase) WHERE i.longer IS NULL OR 100 * i.longer < 100 * c.a
), cuts AS (
  SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, t.n, ((1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM kept c, range(1, {LONGEST}) s(k)
  JOIN grams x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ')
  JOIN grams y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')
  JOIN totals t ON t.lang = c.lang WHERE k < c.size
), worst AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM worst QUALIFY rank <= {TOP}
"""
