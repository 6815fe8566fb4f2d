import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from coverlark.llm import mixing, quality, toxicity
from coverlark.llm.hashing import word_ids


def corpus(spark, n=400):
    """Every fifth document is noise, every seventh has bad words; two languages."""
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(n):
        lang = "en" if i % 3 else "de"
        words = rng.choices([f"{lang}{k}" for k in range(60)], k=rng.randint(5, 80))
        good, toxic = int(i % 5 != 0), int(i % 7 == 0)
        if not good:
            words = [w + "###" for w in words]
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["badword", "badwords"])
        rows.append((i, " ".join(words), lang, f"s{i % 4}", 0, "x"))
        labels.append((i, good, toxic))
    rows += [(n, None, None, None, None, None), (n + 1, "", "en", "s1", 0, "x"), (1, rows[1][1], "en", "s1", 0, "x"), (None, "x " * 50_000, "en", "s1", 0, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string").repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity(spark):
    docs, labels = corpus(spark, 900)
    net = toxicity.fit(docs, labels)
    got = toxicity.score_documents(docs, net)
    assert got.count() == 904
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert sum((r.score >= 0.5) == bool(r.toxic) for r in rows) >= 0.9 * len(rows)
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in got.collect())
    held = {r.doc_id for r in got.where("held_out").collect()}
    assert not held & set(toxicity.training_rows(docs, labels)["doc_id"])
    assert toxicity.score_documents(docs.where("false"), net).count() == 0


def test_thresholds_by_language_by_a_plain_version(spark):
    docs, labels = corpus(spark, 900)
    net = toxicity.fit(docs, labels, limit=60)
    rows = toxicity.training_rows(docs, labels, 60)
    trained = {i for k, i in enumerate(rows["doc_id"]) if k % 5 != 4}
    score = {r.doc_id: r.score for r in toxicity.score_documents(docs, net).collect() if not r.held_out}
    known = [(r.lang or "", score[r.doc_id], r.toxic) for r in docs.join(labels, "doc_id").collect() if r.doc_id in score and r.doc_id not in trained]
    assert len(known) > 300 and set(net.thresholds) == {lang for lang, _, _ in known}
    for lang in ("en", "de"):
        own = [(int(min(s * 1000, 999)), t) for x, s, t in known if x == lang]
        assert sum(t for _, t in own) >= 10
        f1 = {c: 2 * sum(t for s, t in own if s >= c) / (sum(s >= c for s, _ in own) + sum(t for _, t in own)) for c in range(1000)}
        assert net.thresholds[lang] == max(f1, key=lambda c: (round(f1[c], 12), c)) / 1000


def test_scores_do_not_depend_on_language_or_id(spark):
    docs, labels = corpus(spark, 200)
    net = toxicity.fit(docs, labels)
    other = docs.withColumn("lang", F.lit("fr")).withColumn("source", F.lit("z"))
    a, b = (sorted((r.doc_id or -1, r.score) for r in toxicity.score_documents(d, net).collect()) for d in (docs, other))
    assert [x[0] for x in a] == [x[0] for x in b]
    assert max(abs(x[1] - y[1]) for x, y in zip(a, b, strict=True)) <= 2e-6


def test_table_lookups_equal_the_convolution():
    net = toxicity._start(np.random.default_rng(1))
    docs = [word_ids("one two three four"), word_ids(""), word_ids("five")]
    want = []
    for d in docs:
        word, prefix = toxicity._buckets(np.concatenate([d if len(d) else np.zeros(1, np.uint64), np.zeros(toxicity.PAD, np.uint64)]))
        x, out = net.embedding[word] + net.embedding[prefix], net.out_bias
        for i, w in enumerate(toxicity.WIDTHS):
            windows = [sum(x[a + j] @ net.filters[w][j] for j in range(w)) for a in range(max(len(d), 1))]
            out += np.maximum(np.max(windows, axis=0) + net.bias[w], 0) @ net.out[i * toxicity.FILTERS : (i + 1) * toxicity.FILTERS]
        want.append(out)
    assert toxicity.Scorer(net).logits(docs) == pytest.approx(want, abs=1e-4)
    assert toxicity.Scorer(net).logits(docs[::-1]) == pytest.approx(want[::-1], abs=1e-4)
    assert (toxicity._unpacked(toxicity._packed(docs[0])) == docs[0]).all()


def test_quality(spark):
    docs, labels = corpus(spark)
    seen = quality.views(docs)
    net = quality.fit(seen, labels)
    got = quality.score_views(seen, net)
    assert got.count() == 404
    rows = got.join(labels, "doc_id").collect()
    assert sum(r.kept == bool(r.quality) for r in rows) >= 0.95 * len(rows)
    clash = docs.withColumns({"_quality": F.lit(1), "kept": F.lit("k"), "x": F.lit(2)})
    kept = quality.keep_good(clash, net)
    assert kept.columns == clash.columns and kept.count() == got.where("kept").count()
    assert quality.score_views(seen, quality.fit(seen, labels.where("false"))).where("kept").count() == 404
    none = quality.views(docs.where("false"))
    assert quality.score_views(none, quality.fit(none, labels)).count() == 0


def minimum(rows, start):
    """The minimum of the penalised log loss of rows (weight, columns, label), by plain descent with halved steps."""
    w, x, y = (np.array(c, float) for c in zip(*rows, strict=True))
    ridge = np.array([1e-6] + [1.0] * (x.shape[1] - 1))
    value = lambda t: sum(wi * np.log1p(np.exp(-z if yi else z)) for wi, yi, z in zip(w, y, x @ t, strict=True)) + (ridge * t * t).sum() / 2
    theta = np.array(start, float)
    for _ in range(200):
        p = 1 / (1 + np.exp(-(x @ theta)))
        slope = (w * (p - y)) @ x + ridge * theta
        step = np.linalg.lstsq(x.T @ (x * (w * p * (1 - p))[:, None]) + np.diag(ridge), slope, rcond=None)[0]
        size = 1.0
        while size > 1e-9 and value(theta - size * step) > value(theta):
            size /= 2
        theta = theta - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return theta, value(theta)


def loss_of(rows, theta):
    return sum(np.log1p(np.exp(-z if y else z)) for x, y in rows for z in [np.dot(x, theta)])


def part_of(x, parts):
    bits = [int(b) for b in np.float32(x).view(np.uint32)]
    return (sum(b * (2 * k + 1) * 0x9E3779B97F4A7C15 for k, b in enumerate(bits)) % 2**64 >> 40) % parts


def plain_co_training(docs, labels, labelled, rounds):
    """The same method on lists in memory, with its own losses, steps and parts."""
    x = [np.float64(quality.features(d.text or "", d.source, d.lang)) for d in docs]
    mean, scale = np.mean(x, axis=0), np.std(x, axis=0) + 1e-6
    columns = []
    for row in x:
        z = np.clip((row - mean) / scale, -6, 6)
        columns.append([np.concatenate([[1.0], z[v], z[v] ** 2]) for v in quality.VIEWS])
    known = sorted((k for k, d in enumerate(docs) if d.doc_id in labelled), key=lambda k: (zlib.crc32(str(docs[k].doc_id).encode()), docs[k].doc_id))
    label = {k: labels[docs[k].doc_id] for k in known}
    train, guard = [k for i, k in enumerate(known) if i % 6 not in (2, 5)], [k for i, k in enumerate(known) if i % 6 == 2]
    pool = [k for k in range(len(docs)) if k not in label]
    own = [[(1.0, columns[k][v], label[k]) for k in train] for v in (0, 1)]
    thetas = [minimum(own[v], np.zeros(len(columns[0][v])))[0] for v in (0, 1)]
    taught, stopped, counted = [{}, {}], set(), 0
    for number in range(rounds):
        before = list(thetas)
        for pupil in {0, 1} - stopped:
            new = {}
            for k in pool:
                logit = columns[k][1 - pupil] @ before[1 - pupil]
                if part_of(x[k], rounds) == number and abs(logit) >= quality.SURE:
                    new[k] = int(logit > 0)
            lessons = taught[pupil] | new
            rows = list(own[pupil])
            for c in (0, 1):
                mine, theirs = sum(label[k] == c for k in train), [k for k, y in lessons.items() if y == c]
                rows += [(min(1.0, mine / len(theirs)), columns[k][pupil], c) for k in theirs]
            theta, _ = minimum(rows, before[pupil])
            held = [(columns[k][pupil], label[k]) for k in guard]
            if loss_of(held, theta) > loss_of(held, before[pupil]):
                stopped.add(pupil)
            else:
                thetas[pupil], taught[pupil], counted = theta, lessons, counted + 1
    return thetas, taught, counted


def mixed_corpus(spark):
    docs, labels = corpus(spark, 600)
    return docs.where("doc_id is not null").dropDuplicates(["doc_id"]).withColumn("source", F.expr("if(doc_id % 5 = 0 and doc_id % 3 > 0, 'junk', source)")), labels


def test_co_training_by_a_plain_version(spark, monkeypatch):
    monkeypatch.setattr(quality, "GAIN", 1e-13)
    monkeypatch.setattr(quality, "STEPS", 60)
    docs, labels = mixed_corpus(spark)
    seen = quality.views(docs)
    order = [r.doc_id for r in labels.join(docs, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(120).collect()]
    rows, known = docs.collect(), {r.doc_id: r.quality for r in labels.collect()}
    alone = quality.fit(seen, labels, labelled=120, rounds=0)
    for rounds in (1, 2, 3):
        net = quality.fit(seen, labels, labelled=120, rounds=rounds)
        want, taught, counted = plain_co_training(rows, known, set(order), rounds)
        assert counted and any({0, 1} == set(each.values()) and len(each) > 50 for each in taught)
        assert net.loss <= alone.loss
        moved = any(np.abs(a - b).max() > 1e-3 for a, b in zip(net.thetas, alone.thetas, strict=True))
        assert moved or rounds == 3
        for a, b in zip(net.thetas, want if moved else alone.thetas, strict=True):
            assert a == pytest.approx(b, abs=1e-4)


def test_content_view_by_plain_counts():
    text = "Ab ab, 12\n#x ÄÖ"
    raw = text.encode()
    view = quality.content_view(text)
    assert view[1] == pytest.approx(sum(b >= 128 for b in raw) / len(raw))
    assert view[2] == pytest.approx(sum(97 <= b <= 122 for b in raw) / len(raw)) and view[3] == pytest.approx(1 / len(raw))
    assert view[11] == pytest.approx(sum(map(len, text.split())) / 5 / 10) and view[12] == 1
    assert len(quality.metadata_view(text, None, None)) == quality.METADATA and quality.metadata_view(text, "a", "b")[1] == pytest.approx(np.log1p(2) / 5)


def area(y, score):
    """The share of pairs of a good and a bad document that the score puts in order, ties half."""
    good, bad = [s for s, k in zip(score, y, strict=True) if k], [s for s, k in zip(score, y, strict=True) if not k]
    return sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_rounds_lose_nothing_on_held_out_documents(spark, sf):
    """Of given documents four folds are held out in turn; small folds differ by single pairs, so their mean counts."""
    if not os.path.isdir(f"/root/testdata/{sf}"):
        pytest.skip("no test data")
    seen, labels = quality.views(spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")), spark.read.parquet(f"/root/testdata/{sf}/labels.parquet")
    areas, rejected, lost = {0: [], quality.ROUNDS: []}, {0: 0, quality.ROUNDS: 0}, 0
    for k in range(4 if sf == "sf0.01" else 2):
        fold = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == k
        for rounds in areas:
            rows = quality.score_views(seen, quality.fit(seen, labels.where(~fold), rounds=rounds)).join(labels.where(fold), "doc_id").collect()
            areas[rounds].append(area([r.quality for r in rows], [r.score for r in rows]))
            rejected[rounds] += sum(not r.kept and not r.quality for r in rows)
            lost += sum(not r.kept and r.quality for r in rows)
    assert np.mean(areas[quality.ROUNDS]) >= np.mean(areas[0]) - 1e-9 and min(areas[quality.ROUNDS]) > 0.99
    assert rejected[quality.ROUNDS] >= rejected[0] - 1 and lost <= 4
    after, before = (quality.score_views(seen, quality.fit(seen, labels, rounds=r)).join(labels, "doc_id").where("quality = 0 and not kept").count() for r in (quality.ROUNDS, 0))
    assert after >= before > 0


def test_mixing_meets_its_targets_by_a_plain_version(spark):
    docs, labels = corpus(spark)
    net = mixing.fit_domains(docs, labels)
    targets = {"en": 0.5, "de": 0.45, "toxic": 0.05}
    some = docs.where("length(text) < 10000 or text is null")
    shares = mixing.target_shares(net.domains, targets)
    rows = mixing.mix(some, net, targets).collect()
    p, n = np.array([r.posteriors for r in rows]), np.array([r.tokens for r in rows], float)
    reached = (p * (n * [r.rate for r in rows])[:, None]).sum(0) / n.sum()
    assert all(r.reached == pytest.approx(reached[net.domains.index(r.domain)]) and r.target == shares[net.domains.index(r.domain)] for r in rows)
    # the same least squares by plain projected gradient steps on all rates at once, until nothing moves
    w, rate = n / n.sum(), np.ones(len(n))
    size = 0.9 / (np.linalg.eigvalsh((p * w[:, None]).T @ p / np.sqrt(shares)[:, None] / np.sqrt(shares)[None])[-1] + mixing.DAMPING)
    for _ in range(40_000):
        rate = np.maximum(0, rate - size * (p @ (((p * (w * rate)[:, None]).sum(0) - shares) / shares) + mixing.DAMPING * (rate - 1)))
    best = (p * (w * rate)[:, None]).sum(0)
    assert np.abs(best - shares).max() < 0.01
    assert np.abs(reached - shares).max() < mixing.CLOSE or reached == pytest.approx(best, abs=1e-4)
    assert len(rows) == 403 and all(r.rate >= 0 and abs(r.copies - r.rate) <= 1 for r in rows)
    assert all(r.domain == net.domains[int(np.argmax(r.posteriors))] for r in rows)


def test_mixing_edges(spark):
    docs, labels = corpus(spark, 60)
    net = mixing.fit_domains(docs, labels)
    clash = docs.withColumns({"rate": F.lit("r"), "copies": F.lit(7), "each": F.lit(1), "_n": F.lit(2), "posteriors": F.lit(3)})
    copies = {r.doc_id: r.copies for r in mixing.mix(clash, net).collect()}
    got = mixing.mixed(clash, net)
    assert got.columns == clash.columns and got.where("rate = 'r' and copies = 7 and each = 1 and _n = 2").count() == got.count()
    assert got.where("doc_id is null").count() == 1 and got.where("doc_id = 5").count() == copies[5]
    assert mixing.mix(docs.where("false"), net).count() == 0 and mixing.mixed(docs.where("false"), net).count() == 0
    empty = mixing.mix(docs.where("doc_id in (60, 61)"), net).collect()
    assert [(r.tokens, r.rate, r.reached) for r in empty] == [(0, 1.0, 0.0)] * 2
    # a target that no document can meet: the totals stand still and say so
    away = mixing.Softmax(["all", "none"], np.zeros((mixing.SPACE, 2), np.float32), np.array([50.0, -50.0], np.float32))
    assert all(r.reached < r.target + 0.01 for r in mixing.mix(docs, away, {"all": 0.5, "none": 0.5}).collect())
