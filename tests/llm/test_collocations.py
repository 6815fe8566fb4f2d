import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from coverlark.llm import collocations as co
from coverlark.llm.automata import Automaton, compose, union


def automaton(entries):
    words = sorted({w for k in entries for w in k})
    place = {w: k for k, w in enumerate(words)}
    return Automaton.of_sorted(words, [(tuple(place[w] for w in k), n) for k, n in sorted(entries.items())])


def some_entries(rng, n):
    return Counter({tuple(rng.choices([b"a", b"b", b"c", b"dd"], k=rng.randint(1, 4))): rng.randint(1, 3) for _ in range(n)})


def test_automata():
    rng = random.Random(2)
    parts = [some_entries(rng, 40) for _ in range(4)] + [Counter()]
    made = [Automaton.loads(automaton(p).dumps()) for p in parts]
    for p, a in zip(parts, made, strict=True):
        assert [*a.entries()] == sorted(p.items())
    total = sum(parts, Counter())
    whole = union(made)
    assert [*whole.entries()] == sorted(total.items())
    assert [*union(made, lambda depth, weight: weight >= 5 or depth == 1).entries()] == sorted((k, n) for k, n in total.items() if n >= 5 or len(k) == 1)
    assert [*union([]).entries()] == []
    asked = dict.fromkeys(rng.sample(sorted(total), 10), 1) | {(b"zz", b"a"): 1, (b"a",) * 6: 1}
    assert [*compose(automaton(asked), whole)] == sorted((k, total[k]) for k in asked if k in total)


def test_equal_ends_are_kept_once():
    a = automaton({(x, b"of", b"the", b"day"): 3 for x in (b"end", b"start", b"rest")})
    assert len(a) == 5  # start, after the first word, after "of", after "the", end


def plain(rows, longest, least, top):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    frequent = {k: c for k, c in f.items() if len(k) > 2 and c >= least}
    out = []
    for k, a in frequent.items():
        if any(x[0] == k[0] and len(x) > len(k) and 100 * c >= 100 * a and any(x[1 + i : i + len(k)] == k[1:] for i in range(len(x) - len(k) + 1)) for x, c in frequent.items()):
            continue
        cuts = [(1000 * a * n[k[0]] // (f[k[: 1 + j]] * f[(k[0], *k[1 + j :])]), j, f[k[: 1 + j]], f[(k[0], *k[1 + j :])]) for j in range(1, len(k) - 1)]
        score, _, left, right = min(cuts)
        out.append((k[0], " ".join(k[1:]), a, left, right, n[k[0]], score))
    ranked = []
    for lang in {x[0] for x in out}:
        own = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))
        ranked += [(lang, i, *x[1:]) for i, x in enumerate(own[:top], 1)]
    return sorted(ranked)


def corpus(spark):
    rng = random.Random(11)
    words = ["The", "of", "Straße", "day x", "a", "b", "ZZ", "é", "of-the"]
    rows = []
    for i in range(120):
        lang = ["en", "de", None, "und", ""][i % 5]
        ends = rng.choices([" ", "  ", "\t", ", ", "\n", ".", " ", " "], k=30)
        rows.append(("".join(w + e for w, e in zip(rng.choices(words, weights=[9, 8, 3, 2, 5, 5, 1, 1, 2], k=30), ends, strict=True)), lang))
    rows += [("in the end of all days! " * 25, "en")] * 3 + [(None, "en"), ("", "de"), (" \t\n.", None), ("one two " * 4000, "long"), ("x", "few"), (None, "none")]
    df = spark.createDataFrame([(t, x, "e", 7) for t, x in rows], "text string, lang string, phrase string, range int").repartition(3)
    return rows, df


@pytest.mark.parametrize(("least", "top", "range_bytes", "shard"), [(3, 2000, 4 << 20, 1 << 21), (4, 5, 3000, 200)])
def test_collocations_by_a_plain_version(spark, monkeypatch, least, top, range_bytes, shard):
    rows, df = corpus(spark)
    monkeypatch.setattr(co, "STRIDE", 64)
    monkeypatch.setattr(co._shards, "__defaults__", (shard,))
    got = co.collocations(df, least=least, top=top, range_bytes=range_bytes)
    assert got.dtypes == [("lang", "string"), ("rank", "bigint"), ("phrase", "string"), ("a", "bigint"), ("l", "bigint"), ("r", "bigint"), ("n", "bigint"), ("score", "bigint")]
    want = plain(rows, 5, least, top)
    assert len(want) > 10 and sorted(map(tuple, got.collect())) == want


def test_ranges_are_cut_and_hold_all(spark, monkeypatch):
    rows, df = corpus(spark)
    monkeypatch.setattr(co, "STRIDE", 32)
    automata, cuts = co.count_automata(df, least=2, range_bytes=2000)
    assert len(cuts) > 3
    for r in automata.collect():
        for key, _ in Automaton.loads(bytes(r.automaton)).entries():
            assert co._range(cuts, key) == r.range
    totals = {r.lang: r.f for r in co._entries(automata).where("size = 0").collect()}
    assert totals["few"] == 1 and totals["long"] == 8000 and "none" not in totals


def test_exact_products_and_no_rows(spark):
    big = 3_000_000_000_000_000
    got = spark.range(1).select(co._score(F.lit(big), F.lit(7 * big), F.lit(big + 1), F.lit(big)).alias("s")).first().s
    assert got == 1000 * big * 7 * big // ((big + 1) * big) and 1000 * 7 * big * big > 2**64
    none = spark.createDataFrame([], "text string, lang string")
    assert co.collocations(none).count() == 0
    assert co.collocations(spark.createDataFrame([(None, None), ("", "en")], "text string, lang string")).count() == 0


def test_a_bucket_never_holds_a_frequent_sequence_back(spark):
    texts = [(b"en", b"a b c. a b c, a b"), (b"de", b"a b")]
    shard = co.Shard(texts)
    for bits in (3, 20):
        single, pair = shard.buckets(bits)
        assert ((single >= 0) == (shard.word >= 0)).all() and single.max() < 1 << bits
        assert ((pair[:-1] >= 0) == ((shard.word[:-1] >= 0) & (shard.word[1:] >= 0))).all()
        ab = [p for p, w, x in zip(pair, shard.word, shard.lang, strict=True) if w == 0 and x == 1]
        assert len(set(ab)) == 1 and len(ab) == 3
    passes = np.packbits(np.arange(16) % 3 == 0)
    assert co._passing(passes, np.array([-1, 0, 1, 3, 15])).tolist() == [False, True, False, True, True]
