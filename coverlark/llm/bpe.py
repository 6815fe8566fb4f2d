"""BPE encoding and decoding with a contiguous rank array (operator 9).

A word starts as single symbols. Beside the array of parts stands the array of ranks of adjacent parts. It is
scanned for its minimum, the boundary there is deleted, and only the two neighbouring ranks are refreshed. New words of
one length are merged together, a row each. For words of over ``SCAN`` bytes, where scanning would take quadratic time,
the same merges come from a heap over a linked list.

The vocabulary file is a parameter: a JSON file of the public ``tokenizers`` library whose model is BPE with an
end-of-word suffix, NFC, white space and lower-case normalisation and byte-level symbols.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import only, release, table, text_batches, text_or_empty

SCAN = 128
#: Entries of each half of a worker's memo of white-space separated chunks and of words.
MEMO = 150_000
#: Characters of text whose new words are merged together.
BLOCK = 500_000
#: Marks a special token among chunks: a character that no chunk can begin with, for it is white space.
SPECIAL = "\n"
NONE = 1 << 62
#: The white space of the vocabulary's normaliser, and the pattern of its words.
WHITE = r"[\t-\r \x85\xa0  -     　]+"
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if visible in Latin-1, else the next one from U+0100."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(seen) else chr(next(rest)) for b in range(256)]


class Memo:
    """Texts by key, in two halves: once the recent half is full it becomes the older one, and what was in that goes
    unless it has been looked up since. So keys in use stay, and keys seen once don't push them out."""

    def __init__(self, room: int = MEMO):
        self.room = room
        self.recent: dict[str, tuple[str, str]] = {}
        self.older: dict[str, tuple[str, str]] = {}

    def turn(self) -> None:
        """Called between texts: what is in ``recent`` stays there until then."""
        if len(self.recent) > self.room:
            self.recent, self.older = {}, self.recent

    def missing(self, keys: set[str]) -> set[str]:
        """Those of ``keys`` that have to be entered; the others are in ``recent``."""
        new, older = keys.difference(self.recent), self.older
        back = {k: older[k] for k in new if k in older}
        self.recent |= back
        return new.difference(back)


class Bpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in self.vocab.items()}
        self.digits = {i: str(i) for i in self.tokens}
        self.suffix = model["end_of_word_suffix"] or ""
        self.special = regex.compile("|".join(f"({regex.escape(t['content'])})" for t in spec["added_tokens"]) or r"(?!)")
        #: (left id, right id) in one integer -> rank and merged id in one integer, so that a minimum finds both.
        self.ranks = {self.vocab[a] << 20 | self.vocab[b]: rank << 20 | self.vocab[a + b] for rank, (a, b) in enumerate(model["merges"])}
        pairs = sorted(self.ranks.items())
        self.pair_keys, self.pair_ranks = np.array([k for k, _ in pairs] + [NONE]), np.array([r for _, r in pairs] + [NONE])
        signs = byte_symbols()
        self.inner = np.array([self.vocab[s] for s in signs])
        self.last = np.array([self.vocab[s + self.suffix] for s in signs])
        self.words, self.white, self.odd = regex.compile(WORDS), regex.compile(WHITE), regex.compile("[\x1c-\x1f]")
        #: Of a chunk or a word, which is a chunk of its own: ids as text, tokens as text, both joined by spaces.
        self.memo = Memo()
        self.wordless = False

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 20 | right
        at = np.searchsorted(self.pair_keys, keys)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NONE)

    def merge_rows(self, parts: np.ndarray) -> list[list[int]]:
        """Merges words of one length, a row each. Every row that goes on has lost one boundary a round, so rows stay equally long."""
        done: list[list[int]] = [[]] * len(parts)
        rows = np.arange(len(parts))
        ranks = self._ranks_of(parts[:, :-1], parts[:, 1:])
        while len(rows):
            if parts.shape[1] == 1:
                best, at = np.full(len(rows), NONE), np.zeros(len(rows), np.int64)
            else:
                at = ranks.argmin(axis=1)  # the first of equals
                best = ranks[np.arange(len(rows)), at]
            over = best == NONE
            if over.any():
                for row, ids in zip(rows[over].tolist(), parts[over].tolist(), strict=True):
                    done[row] = ids
                more = ~over
                rows, parts, ranks, at, best = rows[more], parts[more], ranks[more], at[more], best[more]
                if not len(rows):
                    break
            every, width = np.arange(len(rows)), parts.shape[1]
            parts[every, at] = best & 0xFFFFF
            keep = np.ones(parts.shape, bool)
            keep[every, at + 1] = False
            parts = parts[keep].reshape(len(rows), width - 1)
            keep = np.ones(ranks.shape, bool)
            keep[every, at] = False
            ranks = ranks[keep].reshape(len(rows), width - 2)
            left, right = at > 0, at < width - 2
            ranks[every[left], at[left] - 1] = self._ranks_of(parts[every[left], at[left] - 1], parts[every[left], at[left]])
            ranks[every[right], at[right]] = self._ranks_of(parts[every[right], at[right]], parts[every[right], at[right] + 1])
        return done

    def merge_long(self, parts: list[int]) -> list[int]:
        """The same merges from a heap over a linked list, for long words."""
        n, get = len(parts), self.ranks.get
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        alive = [True] * n
        heap = [(r >> 20, i, r, parts[i], parts[i + 1]) for i in range(n - 1) if (r := get(parts[i] << 20 | parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, r, a, b = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j < 0 or parts[i] != a or parts[j] != b:
                continue
            parts[i], alive[j], after[i] = r & 0xFFFFF, False, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] >= 0 and (r := get(parts[k] << 20 | parts[after[k]])) is not None:
                    heapq.heappush(heap, (r >> 20, k, r, parts[k], parts[after[k]]))
        return [p for p, there in zip(parts, alive, strict=True) if there]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """The ids of each of several words, which are grouped by their length in bytes."""
        raw = [w.encode("utf-8") for w in words]
        found: list[list[int]] = [[]] * len(raw)
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        order = np.argsort(sizes, kind="stable")
        for group in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1):
            if not len(group):
                continue
            size, at = int(sizes[group[0]]), group.tolist()
            letters = np.frombuffer(b"".join([raw[k] for k in at]), np.uint8).reshape(len(at), size)
            parts = self.inner[letters]
            parts[:, -1] = self.last[letters[:, -1]]
            merged = self.merge_rows(parts) if size <= SCAN else [self.merge_long(p) for p in parts.tolist()]
            for k, ids in zip(at, merged, strict=True):
                found[k] = ids
        return found

    def _learn(self, chunks: set[str]) -> None:
        """Enter chunks, and the words that they consist of, into the memo."""
        split = {c: self.words.findall(c) for c in chunks if not c.isalpha()}
        within = {w for words in split.values() for w in words}
        new = list(chunks.difference(split) | self.memo.missing(within.difference(chunks)) | within.intersection(split))
        memo, digits, tokens = self.memo.recent, self.digits, self.tokens
        for word, ids in zip(new, self.encode_words(new), strict=True):
            memo[word] = (digits[ids[0]], tokens[ids[0]]) if len(ids) == 1 else (" ".join([digits[i] for i in ids]), " ".join([tokens[i] for i in ids]))
        for chunk, words in split.items():
            if len(words) != 1 or words[0] != chunk:
                got = [memo[w] for w in words]
                memo[chunk] = (" ".join([g[0] for g in got]), " ".join([g[1] for g in got]))
                self.wordless |= not got

    def chunks(self, text: str) -> list[str]:
        """The normalised pieces of a text between white space, none of which a word crosses; special tokens are their own."""
        out: list[str] = []
        for section in self.special.split(text) if self.special.search(text) else (text,):
            if not section:
                continue
            if self.special.fullmatch(section):
                out.append(SPECIAL + section)
                continue
            plain = unicodedata.normalize("NFC", section).replace("Σ", "σ").lower()
            out += [c for c in self.white.split(plain) if c] if self.odd.search(plain) else plain.split()
        return out

    def encode_texts(self, texts: list[str]) -> Iterator[tuple[str, str]]:
        """The ids and the tokens of each text, joined by spaces; texts are taken in blocks of about BLOCK characters."""
        block: list[list[str]] = []
        size = 0
        for k, text in enumerate(texts):
            block.append(self.chunks(text))
            size += len(text)
            if size >= BLOCK or k == len(texts) - 1:
                self.memo.turn()
                new = self.memo.missing(set().union(*block))
                memo = self.memo.recent
                for c in [c for c in new if c[0] == SPECIAL]:
                    new.discard(c)
                    memo[c] = (str(self.vocab[c[1:]]), c[1:])
                self._learn(new)
                for chunks in block:
                    got = [*map(memo.__getitem__, chunks)]
                    if self.wordless:
                        got = [g for g in got if g[0]]
                    ids, tokens = zip(*got, strict=True) if got else ((), ())
                    yield " ".join(ids), " ".join(tokens)
                block, size = [], 0

    def encode(self, text: str) -> list[int]:
        return [int(i) for ids, _ in self.encode_texts([text]) for i in ids.split()]

    def decode(self, ids: list[int]) -> str:
        """The vocabulary has no decoder of its own: tokens joined by spaces, special tokens included."""
        return " ".join([self.tokens[i] for i in ids if i in self.tokens])


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    return Bpe(path)


def encode_table(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (array<int>) of every text; null is empty, and an empty text has no ids."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = load(path)
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "ids": [[int(i) for i in ids.split()] for ids, _ in bpe.encode_texts(pdf["text"].tolist())]})

    return only(docs, ["doc_id", "text"]).select("doc_id", text_or_empty().alias("text")).mapInPandas(run, "doc_id long, ids array<int>")


def decode_table(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the decoded text of rows (doc_id, ids); null ids give an empty text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = load(path)
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "text": [bpe.decode([] if ids is None else list(ids)) for ids in pdf["ids"]]})

    return only(encoded, ["doc_id", "ids"]).mapInPandas(run, "doc_id long, text string")


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row, a streaming digest of what encode and decode give.

    Null and empty texts have no tokens and the digests of the empty string; very long texts are encoded whole; of equal
    ranks in a word the first is merged. Repeated rows repeat; an empty table gives no rows. Other columns are ignored.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = load(path)
        sha = lambda text: hashlib.sha256(text.encode("utf-8")).hexdigest()
        for pdf in batches:
            rows = [(ids.count(" ") + 1 if ids else 0, sha(ids), sha(tokens)) for ids, tokens in bpe.encode_texts(pdf["text"].tolist())]
            if not rows:
                continue
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            out.insert(0, "doc_id", pdf["doc_id"])
            yield out
        release()

    return only(docs, ["doc_id", "text"]).select("doc_id", text_or_empty().alias("text")).mapInPandas(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_batches(spark)
    return token_digests(table(spark, sf_dir, "documents"), default_path())
