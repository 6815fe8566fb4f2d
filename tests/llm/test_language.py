import math
import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from coverlark.llm import language

PARTS = {"en": ["th", "ing", "er", "an", "re", "ou"], "de": ["sch", "ei", "un", "ge", "ich", "er"], "ru": ["ст", "ов", "на", "пр", "ен", "ко"]}


def corpus(spark, n=300):
    rng, rows = random.Random(4), []
    for i in range(n):
        lang = [*PARTS][i % 3]
        rows.append((i, " ".join("".join(rng.choices(PARTS[lang], k=rng.randint(1, 4))) for _ in range(rng.randint(3, 40))) + ".", lang, "und", 1))
    rows += [(n, None, "en", "x", 1), (n + 1, "", "en", "x", 1), (n + 2, "123 !?\n", "de", "x", 1), (n + 3, rows[0][1] * 3000, None, "x", 1), (None, rows[1][1], "de", "x", 1), (4, rows[4][1], "de", "x", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, score int").repartition(3)


def strings(symbols):
    return "".join(chr(65 + s) for s in symbols)


def plain_phrases(text, known):
    """Longest matches from left to right, by looking each string up in the labelled text, in pieces of PIECE characters."""
    n = 0
    for k in range(0, len(text), language.PIECE):
        piece, at = text[k : k + language.PIECE], 0
        while at < len(piece):
            size = 1
            while at + size < len(piece) and piece[at : at + size + 1] in known:
                size += 1
            at += size
            n += 1
    return n


def test_phrases_by_a_plain_version():
    rng = np.random.default_rng(3)
    known = {lang: np.append(rng.integers(0, 6, 400 + 100 * k), 63).astype(np.uint8) for k, lang in enumerate("abc")}
    texts = [rng.integers(0, 8, n).astype(np.uint8) for n in (1, 2, 30, 511, 512, 513, 2000, 0, 30)]
    got = language.Identifier(language.Model([], known)).phrases(texts)
    assert got.tolist() == [[plain_phrases(strings(t), strings(k)) for k in known.values()] for t in texts]


def test_an_automaton_accepts_the_strings_of_its_text_and_no_others():
    rng = np.random.default_rng(5)
    text = rng.integers(0, 3, 60).astype(np.uint8)
    after, whole = language.suffix_automaton(text), strings(text)
    for n in range(1, 7):
        for k in range(3**n):
            word, state = [k // 3**i % 3 for i in range(n)], 0
            for c in word:
                state = after[state, c] if state >= 0 else -1
            assert (state >= 0) == (strings(word) in whole)


def test_held_out_texts_and_edges(spark):
    docs = corpus(spark)
    model = language.learn(docs)
    assert [*model.texts] == ["de", "en", "ru"] and all(t[-1] == language.BETWEEN for t in model.texts.values())
    rows = language.identify(docs, model).collect()
    assert len(rows) == 306 and all(0 <= r.score <= 1 for r in rows)
    of = {r.doc_id: r for r in rows}
    assert all(of[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in range(304))
    assert not of[None].held_out and of[None].lang_pred == "de"
    held = [r for r in rows if r.held_out and r.doc_id < 300]
    assert len(held) > 60 and sum(r.lang_pred == [*PARTS][r.doc_id % 3] for r in held) >= 0.97 * len(held)
    assert [(of[i].lang_pred, of[i].score) for i in (300, 301, 302)] == [("und", 0.0)] * 3
    assert of[303].lang_pred == "en" and of[303].score > 0.9
    again = language.identify(docs.withColumn("lang", F.lit("q")).withColumn("doc_id", F.col("doc_id") + 1), model).collect()
    assert sorted((r.doc_id - 1, r.lang_pred, r.score) for r in again if r.doc_id) == sorted((r.doc_id, r.lang_pred, r.score) for r in rows if r.doc_id is not None)
    assert language.identify(docs.where("false"), model).count() == 0


def test_judging_by_a_plain_version(spark):
    docs = corpus(spark, 60)
    model = language.learn(docs)
    alphabet, known = language.Alphabet(model.letters), {k: strings(v) for k, v in model.texts.items()}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None and r.doc_id < 60}
    for r in language.identify(docs, model).where("doc_id < 60").collect():
        s = alphabet.symbols(texts[r.doc_id])[0]
        rate = {k: plain_phrases(strings(s), t) * math.log2(len(t) + 1) / len(s) for k, t in known.items()}
        best = min(rate, key=lambda k: (rate[k], k))
        assert r.lang_pred == best and r.bits == pytest.approx(rate[best])
        assert r.score == pytest.approx(1 / sum(2 ** ((rate[best] - x) * min(len(s), language.SURE)) for x in rate.values()))


def test_nothing_to_learn_and_bounds(spark):
    docs = corpus(spark, 60)
    none = language.identify(docs, language.learn(docs.withColumn("lang", F.lit(None).cast("string")))).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)} and len(none) == 66
    assert language.learn(docs.where("false")).texts == {}
    small = language.learn(docs, languages=2, rows=8, chars=100)
    assert len(small.texts) == 2 and all(len(t) <= 50 for t in small.texts.values())
    assert not {"z"} & {*language.learn(docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, "z").otherwise(F.col("lang")))).texts}
    long = docs.where("length(text) > 50000").withColumns({"lang": F.lit("en"), "doc_id": F.lit(next(i for i in range(9) if zlib.crc32(str(i).encode()) % 3 != 1))})
    assert len(language.learn(long).texts["en"]) == language.OWN


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test data")
def test_given_documents(spark):
    sf = "/root/testdata/sf0.01"
    rows = language.op12_language(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.99 * len(rows) > 300
