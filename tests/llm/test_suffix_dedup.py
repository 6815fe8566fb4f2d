import hashlib
import random

import pytest

from coverlark.llm import suffix_dedup as S


def brute(texts):
    raws = [(t or "").encode() for t in texts]
    places = {}
    for i, raw in enumerate(raws):
        for p in range(len(raw) - S.LENGTH + 1):
            places.setdefault(hashlib.md5(raw[p : p + S.LENGTH]).digest(), []).append((i, p))
    cover = [bytearray(len(r)) for r in raws]
    for found in places.values():
        if len(found) > 1:
            for i, p in found:
                cover[i][p : p + S.LENGTH] = b"\1" * S.LENGTH
    out = []
    for raw, c in zip(raws, cover, strict=True):
        spans = sum(1 for k in range(len(c)) if c[k] and (k == 0 or not c[k - 1]))
        kept = bytes(b for b, x in zip(raw, c, strict=True) if not x)
        out.append((len(raw), sum(c), spans, hashlib.sha256(kept).hexdigest()))
    return out


def words(rng, n, alphabet="abcdeéfgh"):
    return " ".join("".join(rng.choices(alphabet, k=rng.randint(1, 7))) for _ in range(n))


def corpus(seed):
    rng = random.Random(seed)
    texts = [None, "", "short", "a" * 399, "b" * 400, "b" * 401, "c" * 2000, "line of junk\n" * 100]
    passages = [words(rng, k) for k in (70, 90, 100, 120, 200)]
    for _ in range(40):
        t = [words(rng, rng.randint(0, 120))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, 40)
            t += [p[a : len(p) - rng.randint(0, 40)], words(rng, rng.randint(0, 30))]
        texts.append("".join(t))
    texts += [texts[10], texts[11], texts[12][:300] + "X" + texts[12][300:], texts[12] + "tail"]
    # combinations of a few pieces around common grams, so that no single neighbour tells all
    pieces = [words(rng, 30) for _ in range(4)]
    middle = "common middle part of more than thirty-two bytes, over and over again; "
    for _ in range(30):
        texts.append("".join(rng.choice(pieces)[-rng.randint(50, 150) :] for _ in range(2)) + middle + "".join(rng.choice(pieces)[: rng.randint(50, 150)] for _ in range(3)))
    return texts


@pytest.mark.parametrize("seed,run,part", [(1, 20_000, 20_000), (2, 7, 11), (3, 50, 5)])
def test_against_brute_force(spark, monkeypatch, seed, run, part):
    monkeypatch.setattr(S, "RUN_RECORDS", run)
    monkeypatch.setattr(S, "RANGE_RECORDS", part)
    texts = corpus(seed)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, rid string").repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.remove_repeats(docs).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts)


def test_repeated_rows_and_empty_table(spark):
    text = words(random.Random(5), 200)
    rows = [(1, text), (1, text), (None, "x" + text), (2, None)]
    got = sorted((r.doc_id or -1, r.n_removed) for r in S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert [g[1] for g in got] == [len(text.encode()), len(text.encode()), len(text.encode()), 0]
    assert S.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_merge_hands_out_shared_lengths():
    rng = random.Random(8)
    records = [S.Record(bytes(rng.choices(b"ab", k=rng.randint(0, 12))), b"", (i, -i), 0) for i in range(400)]
    runs = [sorted(records[k::7], key=S.Record.order) for k in range(7)]
    got = list(S.merge([S.decode_run(S.encode_run(r)) for r in runs]))
    assert [r.key for _, r in got] == sorted(r.key for r in records)
    for (_, a), (n, b) in zip(got, got[1:]):
        assert n == S.shared(a.key, b.key)


def test_splitters_tell_neighbours_apart_and_are_short():
    rng = random.Random(4)
    drawn = [(bytes(rng.choices(b"ab", k=rng.randint(0, 30))), bytes([rng.randint(0, 3)])) for _ in range(300)] + [(b"same", b"a"), (b"same", b"b")]
    for ranges in (2, 10, 100, 1000):
        found = S.separators(drawn, ranges)
        assert found == sorted(set(found)) and len(found) < max(ranges, len(set(drawn)) + 1)
        for a, b in zip(found, found[1:]):
            assert any(a <= x < b for x in drawn)  # no range between two splitters is empty
        assert any(x >= found[-1] for x in drawn)


def test_very_long_text_and_clashing_columns(spark):
    rng = random.Random(6)
    long = words(rng, 60_000)
    docs = spark.createDataFrame([(1, long, 1, 2), (2, long[1000:9000] + "Y", 1, 2)], "doc_id long, text string, at int, gram int")
    got = {r.doc_id: r for r in S.remove_repeats(docs).collect()}
    size = len(long[1000:9000].encode())
    assert (got[1].n_removed, got[1].n_spans, got[2].n_removed) == (size, 1, size) and got[1].n_bytes == len(long.encode())
