import hashlib
import random

import xxhash
from tokenizers import Tokenizer

from coverlark.llm import bpe, exact_dedup, simhash

WS = " \t\n\x0b\f\r"


def texts(seed=2):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(40)]
    out = [None, "", " \n", "one", "one two", "A b C", "a B c"]
    base = " ".join(rng.choices(words, k=200))
    out += [base] * 12 + [base + " "] + [base.replace("w1 ", "w2 ", k) for k in range(1, 6)]
    out += [" ".join(rng.choices(words, k=rng.randint(1, 30))) for _ in range(150)]
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, keep_id string, component long").repartition(4)


def test_exact_dedup_by_brute_force(spark):
    rows = list(enumerate(texts()))
    bare = {i: "".join(c for c in t or "" if c not in WS) for i, t in rows}
    for counters in (1, 4, 1024):
        got = {r.doc_id: r for r in exact_dedup.exact_dedup(table(spark, rows), counters).collect()}
        assert len(got) == len(rows)
        for i, t in rows:
            group = [(-len(u or ""), j) for j, u in rows if bare[j] == bare[i]]
            keep = min(group)[1]
            assert (got[i].keep_id, got[i].group_size, got[i].kept, got[i].text_sha256) == (keep, len(group), keep == i, hashlib.sha256(bare[i].encode()).hexdigest())
    stay = exact_dedup.drop_copies(table(spark, [*rows, (200, "again and again"), (200, "again and again")]))
    assert sorted(stay.columns) == ["component", "doc_id", "keep_id", "text"]
    assert stay.count() == len(set(bare.values())) + 1


def test_misra_gries_keeps_what_is_frequent():
    import pandas as pd

    rng = random.Random(1)
    keys = ["hot"] * 400 + [f"k{rng.randint(0, 500)}" for _ in range(600)]
    rng.shuffle(keys)
    held = exact_dedup.misra_gries((pd.DataFrame({"k": keys[i : i + 50]}) for i in range(0, 1000, 50)), 8)
    assert len(held) <= 8 and 400 - 1000 / 9 <= held["hot"] <= 400


def brute_components(rows):
    prints = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        s = [b" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) >= 3 else ([b" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(x, 42) for x in s]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    parent = {i: i for i in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (prints[i], root(i)) for i in prints}


def test_simhash_by_brute_force(spark):
    rows = list(enumerate(texts()))
    want = brute_components(rows)
    for list_rows in (1, 64):
        got = {r.doc_id: (r.fp % 2**64, r.component_id) for r in simhash.near_groups(table(spark, rows), list_rows).collect()}
        assert got == want
    assert simhash.drop_near_copies(table(spark, rows)).count() == len({c for _, c in want.values()})


def test_links_within_two_bits_and_none_beyond(spark):
    rng = random.Random(4)
    seeds = [rng.getrandbits(64) for _ in range(6)]
    prints = {s ^ (1 << a) ^ (1 << b) for s in seeds for a in range(0, 64, 9) for b in range(0, 64, 7)} | set(seeds)
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    for list_rows in (2, 10_000):
        edges = [(r.u, r.v) for r in simhash.links(df, list_rows).collect()]
        assert all(((u ^ v) % 2**64).bit_count() <= 2 for u, v in edges)
        from coverlark.llm.components import components

        found = {r.node: r.component for r in components(simhash.links(df, list_rows)).collect()}
        assert len(set(found.values())) == 6 and set(found) == set(signed)


def test_the_tally_decides_before_bits_are_looked_at(spark):
    a = 0x0102030405060708
    others = {"one byte": a ^ 0xFF, "two bytes of a pair": a ^ 0xFFFF, "two bytes": a ^ 0xFF00FF, "three bytes": a ^ 0x010101, "four bytes": a ^ 0x01010101, "two bits": a ^ 0x0100000000000001}
    for name, b in others.items():
        listed = simhash.postings(spark.createDataFrame([(min(a, b),), (max(a, b),)], "fp long"))
        want = sum(x == y for x, y in zip(a.to_bytes(8), b.to_bytes(8)))
        assert {r.shared for r in simhash.tallied(listed, 0).collect()} == {want}, name
        assert simhash.tallied(listed).isEmpty() == (want < 6), name
    prints = spark.createDataFrame([(x,) for x in {a, *others.values()}], "fp long")
    every = sorted({a, *others.values()})
    assert {(r.u, r.v) for r in simhash.links(prints).collect()} == {(u, v) for u in every for v in every if u < v and (u ^ v).bit_count() <= 2}


def test_very_long_texts_and_extreme_ids(spark):
    rng = random.Random(3)
    long = " ".join(rng.choices([f"w{k}" for k in range(900)], k=150_000))
    rows = [(-(1 << 63), long), (5, long + " "), ((1 << 63) - 1, long), (7, "short")]
    got = {r.doc_id: r for r in exact_dedup.exact_dedup(table(spark, rows)).collect()}
    assert [got[i].keep_id for i, _ in rows] == [5, 5, 5, 7] and got[5].group_size == 3
    got = {r.doc_id: r for r in exact_dedup.exact_dedup(table(spark, rows[::2])).collect()}
    assert {r.keep_id for r in got.values()} == {-(1 << 63)}
    near = {r.doc_id: r.component_id for r in simhash.near_groups(table(spark, rows)).collect()}
    assert near == {-(1 << 63): -(1 << 63), 5: -(1 << 63), (1 << 63) - 1: -(1 << 63), 7: 7}


def test_empty_tables(spark):
    none = table(spark, [(1, "x")]).where("false")
    assert exact_dedup.exact_dedup(none).count() == simhash.near_groups(none).count() == bpe.token_digests(none, bpe.default_path()).count() == 0


def test_bpe_equals_the_library(spark):
    rng = random.Random(5)
    path = bpe.default_path()
    theirs, ours = Tokenizer.from_file(path), bpe.load(path)
    signs = [chr(c) for c in (*range(0, 0x250), *range(0x300, 0x330), *range(0x370, 0x400), *range(0x2000, 0x2070), 0x3000, 0x130, 0x3A3, 0xB2, 0x1F600)] + list("   abcdefghABC'sdtll") * 12 + ["<|startoftext|>", "<|endoftext|>", "'ll"]
    samples = ["", "a" * 1000, "ab" * 500 + "!" * 700, *("".join(rng.choices(signs, k=rng.randint(0, 40))) for _ in range(1500))]
    for s in samples:
        e = theirs.encode(s, add_special_tokens=False)
        assert ours.encode(s) == e.ids and ours.decode(e.ids) == theirs.decode(e.ids, skip_special_tokens=False)
    rows = [(i, s) for i, s in enumerate(samples[:200])] + [(None, None)]
    got = {r.doc_id: r for r in bpe.token_digests(table(spark, rows), path).collect()}
    for i, s in rows:
        ids = theirs.encode(s or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids) and got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(theirs.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    back = bpe.decode_table(bpe.encode_table(table(spark, rows[:50]), path), path).collect()
    assert {r.doc_id: r.text for r in back} == {i: theirs.decode(theirs.encode(s, add_special_tokens=False).ids, skip_special_tokens=False) for i, s in rows[:50]}


def test_bpe_keeps_words_in_use_when_its_memo_fills_up():
    path = bpe.default_path()
    theirs, ours = Tokenizer.from_file(path), bpe.Bpe(path)
    ours.memo = bpe.Memo(120)
    merged, encode_words = [], ours.encode_words
    ours.encode_words = lambda words: merged.extend(words) or encode_words(words)
    # Two texts or three fill a half; the words in use are missing from every other text.
    texts = [" ".join([f"{chr(97 + k)}{chr(97 + j)}q." for j in range(26)] + ["inuse", "(inuse)", "kept"] * (k % 2)) for k in range(20)]
    for text in texts:
        assert ours.encode(text) == theirs.encode(text, add_special_tokens=False).ids
    assert merged.count("inuse") == merged.count("kept") == 1
    assert len(ours.memo.recent) + len(ours.memo.older) <= 360
