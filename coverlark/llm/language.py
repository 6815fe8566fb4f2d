"""Language identification by cross-parsing entropy (operator 12).

Labelled text of each language is kept as a suffix automaton, which accepts exactly the strings that occur in it. A text is
cross-parsed against a language from left to right into phrases: each is the longest string from there on that occurs in
the language's text, or one character that never does. A text in the language needs few, long phrases. A phrase costs the
logarithm of the size m of the labelled text, so c phrases of a text of n characters give c * log2(m) / n bits a
character, the estimate of cross entropy by Ziv and Merhav, and the language with the fewest bits wins; ties go to the
smaller name.

Characters are lower-cased letters and one separator between words: the ``LETTERS`` most frequent letters of the labelled
text have symbols of their own, rarer letters and marks share ``OTHERS`` by their code points. Texts are parsed whole,
many at a time: all are cut into pieces of ``PIECE`` characters, a phrase ends with its piece, and every step of a task moves
all pieces by one character with one look-up each in a table of state and symbol.

The model is learnt from a bounded sample: at most ``LANGUAGES`` languages, those with most documents; ``ROWS`` documents
together, the same number a language, by a hash of doc_id; and ``CHARS`` characters together, of which a language takes at
most ``OWN``. Tasks get the sample, not the tables, which each worker makes once.
"""

from __future__ import annotations

import math
import unicodedata
import uuid
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import only, release, table, text_batches

LANGUAGES = 256
ROWS = 1200
CHARS, OWN = 400_000, 100_000
#: Documents of more characters are learnt from only where a language has no others.
LONGEST = 20_000
PIECE = 512
SPARE = 8
#: Symbols: 0 between words, then letters of their own, letters that share a symbol, and what no text has, between documents.
LETTERS, OTHERS, BETWEEN, SYMBOLS = 46, 16, 63, 64
UNKNOWN = "und"
#: Characters after which a score grows no surer.
SURE = 24
#: The bit of a look-up that says a phrase begins.
BEGINS = 1 << 30
BLOCK = 1 << 22


def is_letter(char: str) -> bool:
    return char.isalpha()


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


class Alphabet:
    """Symbols of code points, looked up as they are met."""

    def __init__(self, letters: list[int]):
        self.own = {code: k for k, code in enumerate(letters, 1)}
        self.known = np.full(0x110000, -1, np.int8)
        self.letter = np.zeros(0x110000, bool)

    def symbols(self, text: str) -> tuple[np.ndarray, int]:
        """Symbols with one separator before each word and after the last, and how many characters are letters."""
        codes = codes_of(text)
        found = self.known[codes]
        if (found < 0).any():
            for code in np.unique(codes[found < 0]).tolist():
                char = chr(code)
                self.letter[code] = is_letter(char)
                word = self.letter[code] or unicodedata.category(char)[0] == "M"
                self.known[code] = self.own.get(code, 1 + LETTERS + (code >> 7) % OTHERS) if word else 0
            found = self.known[codes]
        found = np.concatenate([[0], found, [0]]).astype(np.uint8)
        keep = np.ones(len(found), bool)
        keep[1:] = (found[1:] != 0) | (found[:-1] != 0)
        return found[keep], int(self.letter[codes].sum())


def suffix_automaton(symbols: np.ndarray) -> np.ndarray:
    """States x SYMBOLS: the state after each symbol, or -1. State 0 is the empty string."""
    none = array("i", [-1] * SYMBOLS)
    after, link, length, last = array("i", none), [-1], [0], 0
    for c in symbols.tolist():
        new = len(link)
        after.extend(none)
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and after[p * SYMBOLS + c] < 0:
            after[p * SYMBOLS + c] = new
            p = link[p]
        if p >= 0:
            q = after[p * SYMBOLS + c]
            if length[p] + 1 != length[q]:
                copy = len(link)
                after.extend(after[q * SYMBOLS : (q + 1) * SYMBOLS])
                length.append(length[p] + 1)
                link.append(link[q])
                link[q] = copy
                while p >= 0 and after[p * SYMBOLS + c] == q:
                    after[p * SYMBOLS + c] = copy
                    p = link[p]
                q = copy
            link[new] = q
        last = new
    return np.frombuffer(after, np.int32).reshape(-1, SYMBOLS)


def parser(symbols: np.ndarray) -> np.ndarray:
    """The look-up of greedy parsing, by state * SYMBOLS + symbol: the next state, with ``BEGINS`` where a phrase begins.

    The last state has no string: a parse starts there, and stays there after a character that the language does not have.
    """
    after = suffix_automaton(symbols)
    nothing = len(after)
    fresh = np.where(after[0] >= 0, after[0], nothing) | BEGINS
    return np.concatenate([np.where(after >= 0, after, fresh), fresh[None]]).astype(np.int32).reshape(-1)


@dataclass
class Model:
    """Symbols of labelled text by language, in the order of their names."""

    letters: list[int] = field(default_factory=list)
    texts: dict[str, np.ndarray] = field(default_factory=dict)
    key: str = field(default_factory=lambda: uuid.uuid4().hex)


class Identifier:
    """A model with its tables."""

    def __init__(self, model: Model):
        self.alphabet = Alphabet(model.letters)
        self.names = [*model.texts]
        self.tables = [parser(t) for t in model.texts.values()]
        self.bits = np.array([math.log2(len(t) + 1) for t in model.texts.values()])

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """How many phrases each text needs in each language: texts x languages."""
        sizes = np.array([len(t) for t in texts], np.int64)
        pieces = -(-sizes // PIECE)
        owner = np.repeat(np.arange(len(texts)), pieces)
        ordinal = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = np.repeat(np.cumsum(sizes) - sizes, pieces) + ordinal * PIECE
        length = np.minimum(sizes[owner] - ordinal * PIECE, PIECE)
        order = np.argsort(-length, kind="stable")
        start, length, owner, flat = start[order], length[order], owner[order], np.concatenate([*texts, np.zeros(0, np.uint8)])
        state = [np.full(len(owner), len(t) // SYMBOLS - 1, np.int32) for t in self.tables]
        count = [np.zeros(len(owner), np.int32) for _ in self.tables]
        for t in range(int(length.max(initial=0))):
            live = int(np.searchsorted(-length, -t, side="left"))
            at = flat[start[:live] + t].astype(np.int32)
            for look, s, n in zip(self.tables, state, count, strict=True):
                got = look[s[:live] * SYMBOLS + at]
                n[:live] += got >> 30
                s[:live] = got & (BEGINS - 1)
        return np.array([np.bincount(owner, n, len(texts)) for n in count]).reshape(len(self.names), len(texts)).T

    def judge(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Of each text its language, how sure that is, and the bits a character in that language."""
        names, score, least = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.full(len(texts), np.nan)
        held: list[tuple[int, np.ndarray]] = []

        def settle() -> None:
            rate = self.phrases([s for _, s in held]) * self.bits / np.array([[len(s)] for _, s in held])
            best = rate.argmin(axis=1)
            for (k, s), r, b in zip(held, rate, best, strict=True):
                names[k], least[k] = self.names[b], r[b]
                score[k] = 1 / np.exp2((r[b] - r) * min(len(s), SURE)).sum()
            held.clear()

        size = 0
        for k, text in enumerate(texts if self.names else []):
            symbols, letters = self.alphabet.symbols(text or "")
            if letters:
                held.append((k, symbols))
                size += len(symbols)
            if size >= BLOCK:
                settle()
                size = 0
        if held:
            settle()
        return names, score, least


def learn(docs: DataFrame, languages: int = LANGUAGES, rows: int = ROWS, chars: int = CHARS) -> Model:
    """A model from the documents that are not held out. Languages without a letter in the sample are not learnt."""
    known = only(docs, ["doc_id", "text", "lang"]).where("lang is not null and text is not null and crc32(cast(doc_id as string)) % 3 <> 1")
    counted = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(languages).collect()
    if not counted:
        return Model()
    each = max(1, rows // len(counted))
    # Of a language with many documents only those with the least hashes are ranked, SPARE for each that is wanted.
    least = [(r.lang, min((1 << 63) - 1, (SPARE * each << 64) // r.n - (1 << 63))) for r in counted]
    known = known.join(F.broadcast(docs.sparkSession.createDataFrame(least, "lang string, most long")), "lang").where("xxhash64(doc_id) <= most")
    long = F.length("text") > LONGEST
    order = Window.partitionBy("lang").orderBy(long, F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
    some = known.withColumn("place", F.row_number().over(order)).where(F.col("place") <= each)
    taken: dict[str, dict[str, None]] = {}
    for r in some.where(~long | (F.col("place") == 1)).orderBy("lang", "place").select("lang", "text").collect():
        taken.setdefault(r.lang, {})[r.text] = None
    seen = Counter()
    for texts in taken.values():
        for text in texts:
            seen.update(c for c in text.lower() if is_letter(c))
    model = Model([ord(c) for c, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:LETTERS]])
    alphabet, own = Alphabet(model.letters), min(OWN, chars // len(taken))
    for lang in sorted(taken):
        parts = [alphabet.symbols(t) for t in taken[lang]]
        if any(n for _, n in parts):
            model.texts[lang] = np.concatenate([np.append(s, np.uint8(BETWEEN)) for s, n in parts if n])[:own]
    return model


#: The identifier that this worker made last, by the model's key.
_made: dict[int, Identifier] = {}


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score and bits (a character, in the predicted language) of every row of ``docs``.

    A null text and one without a letter are ``und`` with score 0, and so is every text where nothing was learnt; marks and
    digits are no letters. Very long texts count whole. Equal texts get equal results; repeated rows repeat; a null doc_id is
    not held out; an empty table gives no rows. Other columns, lang among them, are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most CHARS symbols

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        if model.key not in _made:
            _made.clear()
            _made[model.key] = Identifier(model)
        for pdf in batches:
            names, score, bits = _made[model.key].judge(pdf["text"].tolist())
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "held_out": pdf["held_out"], "lang_pred": names, "score": score, "bits": bits})
        release()

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    rows = only(docs, ["doc_id", "text"]).select("doc_id", held.alias("held_out"), "text")
    return rows.mapInPandas(run, "doc_id long, held_out boolean, lang_pred string, score double, bits double")


def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_batches(spark)
    docs = table(spark, sf_dir, "documents")
    return identify(docs, learn(docs))
