import random
from collections import Counter

from coverlark.llm import licenses as L


def best_by_brute_force(text, dice):
    """Of every template the best passage over all passages."""
    words, found = L.normalised(text), {}
    pairs = list(zip(words, words[1:]))
    for name, texts in L.TEMPLATES.items():
        for t in texts:
            w = L.normalised(t)
            own = Counter(zip(w, w[1:]))
            for i in range(len(pairs)):
                for j in range(i + 1, min(len(pairs), i + 3 * sum(own.values())) + 1):
                    d = 2 * sum((own & Counter(pairs[i:j])).values()) / (sum(own.values()) + j - i)
                    if d >= dice:
                        found[name] = max(found.get(name, 0), d)
    return found


def test_scan_finds_the_best_passage():
    rng = random.Random(6)
    notices = [t for texts in L.TEMPLATES.values() for t in texts if len(L.normalised(t)) < 16]
    scanner = L.Scanner({k: tuple(t for t in v if t in notices) for k, v in L.TEMPLATES.items()})
    templates, L.TEMPLATES = L.TEMPLATES, {k: tuple(t for t in v if t in notices) for k, v in L.TEMPLATES.items()}
    try:
        for _ in range(40):
            parts = [" ".join(rng.choices(["lorem", "the", "license", "under", "version", "ipsum"], k=rng.randint(0, 8)))]
            words = L.normalised(rng.choice(notices))
            for _ in range(rng.randint(0, 2)):
                words.insert(rng.randint(0, len(words)), rng.choice(["x", "the", "GNU"]))
            text = " ".join([*parts, *words, "ipsum"])
            want, got = best_by_brute_force(text, L.DICE), scanner.scan(text)
            assert bool(want) == bool(got)
            if want:
                top = max(got, key=lambda x: x[1])
                assert all(abs(x[1] - want[x[0]]) < 1e-12 or x[1] <= want[x[0]] for x in got)
                assert max(want.values()) - top[1] < 1e-12
    finally:
        L.TEMPLATES = templates


def test_all_templates_match_themselves_within_other_words():
    scanner = L.Scanner(L.TEMPLATES)
    for name, texts in L.TEMPLATES.items():
        for t in texts:
            got = scanner.scan("some words before. " + t.upper() + " and some after")
            assert [x[0] for x in got] == [name] and got[0][1] == 1.0, (name, got)


def test_whole_licences_and_excerpts_from_their_middle():
    scanner = L.Scanner(L.all_templates())
    shared = {"AGPL-3.0": {"AGPL-3.0", "GPL-3.0"}, "LGPL-2.1": {"LGPL-2.1", "GPL-2.0"}}
    for name, text in L.whole_texts().items():
        assert [(x[0], x[1]) for x in scanner.scan("before " + text + " after")] == [(name, 1.0)]
        words = L.normalised(text)
        for share in (0.25, 0.5, 0.75):
            at = int(len(words) * share)
            got = scanner.scan("it says: " + " ".join(words[at - 200 : at + 200]) + " and so on")
            assert got and {x[0] for x in got} <= shared.get(name, {name}), (name, share, got)
    section = L._AFFERO_13
    assert {x[0] for x in scanner.scan("terms " + section + " end")} == {"AGPL-3.0"}


def test_passages_of_repeated_bigrams_by_brute_force():
    rng = random.Random(11)
    for _ in range(60):
        text = " ".join(rng.choices("abc", k=rng.randint(2, 7)))
        words = rng.choices("abcd", k=rng.randint(0, 25))
        templates, L.TEMPLATES = L.TEMPLATES, {"one": (text,)}
        try:
            want = best_by_brute_force(" ".join(words), 0.6)
        finally:
            L.TEMPLATES = templates
        got = L.Scanner({"one": (text,)}, 0.6).scan(" ".join(words))
        assert bool(got) == bool(want) and (not want or max(x[4] * 2 / (x[3] - x[2] - 1 + len(text.split()) - 1) for x in got) <= want["one"] + 1e-12)


def test_parts_hold_the_whole_text():
    text = "one two\n\n" + "\n \n".join(" ".join(f"w{k}x{i}" for i in range(30)) for k in range(5)) + "\n\nlast words"
    got = L.parts(text)
    assert [w for p in got for w in L.normalised(p)] == L.normalised(text) and min(len(L.normalised(p)) for p in got) >= 40
    assert L.parts("") == [""] and L.parts("short") == ["short"]


def test_near_equal_licences_are_told_apart():
    scanner = L.Scanner(L.TEMPLATES)
    notice = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by the
    Free Software Foundation, either version {} of the License, or (at your option) any later version. This program is distributed in the hope
    that it will be useful, but without any warranty; without even the implied warranty of merchantability or fitness for a particular purpose.
    See the GNU {} for more details. You should have received a copy of the GNU {} along with this program. If not, write to the Foundation."""
    for name, title, version in (("GPL-3.0", "General Public License", "3"), ("AGPL-3.0", "Affero General Public License", "3"), ("LGPL-3.0", "Lesser General Public License", "3"), ("GPL-2.0", "General Public License", "2"), ("LGPL-2.1", "Lesser General Public License", "2.1")):
        got = scanner.scan("/* (c) Somebody. " + notice.format(title, version, title, title) + " */ int main;")
        assert [x[0] for x in got] == [name], (name, got)


def test_very_long_text_full_of_notices():
    line = "Released under the MIT License. some words. "
    got = L.Scanner(L.TEMPLATES).scan(line * 3000 + "end")
    assert len(got) == 3000 and {x[0] for x in got} == {"MIT"}


def test_table(spark):
    rows = [(1, "é Released under the MIT License. İ Licensed under CC BY-NC 4.0."), (2, None), (3, ""), (4, "nothing of the kind"), (4, "nothing of the kind"), (None, "the license")]
    got = {r.doc_id: r for r in L.find_licenses(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, license int")).collect()}
    assert got[1].n_matches == 2 and got[1].license == "CC-BY-NC-4.0" and got[1].dice == 1.0
    assert got[1].spans == "MIT:2:32:1.0000,CC-BY-NC-4.0:36:63:1.0000"
    assert all(got[i].n_matches == 0 and got[i].license is None and got[i].spans == "" for i in (2, 3, 4, None))
    assert L.find_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0
