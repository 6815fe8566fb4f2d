import hashlib
import random

import numpy as np
import pytest

from coverlark.llm import winnow as W


def brute(text, k, window):
    codes = [ord(c) for c in text]
    if not codes:
        return []
    k = min(k, len(codes))
    hashes = [int(W.gram_hashes(np.array(codes[i : i + k], np.uint32), k)[0]) for i in range(len(codes) - k + 1)]
    window, out = min(window, len(hashes)), []
    for i in range(len(hashes) - window + 1):
        least = min(hashes[i : i + window])
        at = max(j for j in range(i, i + window) if hashes[j] == least)
        if not out or out[-1][1] != at:
            out.append((least, at))
    return out


@pytest.mark.parametrize("text", ["", "a", "ab", "a" * 300, "abcab" * 90, "né 😀" * 60])
def test_fingerprint_by_brute_force(text):
    got = W.fingerprint(text, 5, 16)
    assert [(int(x) >> 32, int(x) & 0xFFFFFFFF) for x in got] == brute(text, 5, 16)
    assert (W.from_text(W.as_text(got)) == got).all()


def test_shared_passage_is_always_found():
    rng = random.Random(3)
    for _ in range(50):
        passage = "".join(rng.choices("abcdefgh ", k=W.K + W.WINDOW - 1))
        a, b = ("".join(rng.choices("xyzuvw", k=900)) + passage + "".join(rng.choices("rstq", k=rng.randint(800, 999))) for _ in range(2))
        assert W.likeness(W.fingerprint(a), W.fingerprint(b)) > 0


def test_one_more_code_point_changes_little_at_any_length():
    rng = random.Random(5)
    for n in [*range(60, 90), 150, 300, 521, 522, 523, 722, 723, 3000]:
        text = "".join(rng.choices("abcdefghij klmnop", k=n))
        assert W.likeness(W.fingerprint(text), W.fingerprint(text + "z")) >= (0.8 if n > 300 else 0.3)
    text = "".join(rng.choices("abcdefghij klmnop", k=4000))
    assert W.likeness(W.fingerprint(text[:3000]), W.fingerprint(text[1000:])) == pytest.approx(0.5, abs=0.08)


def test_very_long_text_and_clashing_columns(spark):
    rng = random.Random(7)
    long = "".join(rng.choices("abcdefghij klmnop", k=700_000))
    docs = spark.createDataFrame([(1, long, 5, 6), (2, long[:600_000], 5, 6)], "doc_id long, text string, key int, own int")
    got = {r.doc_id: r for r in W.compare_with_next(docs).collect()}
    assert got[1].n_chars == 700_000 and got[1].near_next == pytest.approx(6 / 7, abs=0.01)
    assert got[2].fingerprint == W.as_text(W.fingerprint(long[:600_000]))


def test_compare_with_next(spark):
    rng = random.Random(1)
    texts = {i: "".join(rng.choices("abc déf", k=rng.choice([0, 1, 5, 40, 400, 2000]))) for i in range(60)}
    texts[7], texts[8], texts[9] = None, "same text here " * 30, "same text here " * 30
    rows = [(i, t, "x") for i, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, range string").repartition(5)
    got = {r.doc_id: r for r in W.compare_with_next(docs, rows_per_range=7).collect()}
    order = sorted(texts, reverse=True)
    assert set(got) == set(texts)
    for i, after in zip(order, order[1:] + order[:1]):
        text, nxt = texts[i] or "", texts[after] or ""
        m = len(text) // 3
        edited = text[: len(text) - m] + nxt[:m]
        r = got[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == W.as_text(W.fingerprint(text)) and r.edited_fingerprint == W.as_text(W.fingerprint(edited))
        assert r.near_edited == W.likeness(W.fingerprint(text), W.fingerprint(edited)) and 0 <= r.near_next <= 1
    assert got[8].fingerprint == got[9].fingerprint


def test_single_empty_and_repeated(spark):
    one = W.compare_with_next(spark.createDataFrame([(1, "hello world")], "doc_id long, text string")).collect()
    assert one[0].near_next == 1.0
    assert W.compare_with_next(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert W.compare_with_next(spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (None, None)], "doc_id long, text string")).count() == 4
