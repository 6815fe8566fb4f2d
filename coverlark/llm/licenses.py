"""License scans by the Dice coefficient over word bigrams (operator 10).

A passage matches a template when 2 * shared bigrams / (bigrams of both), repeats included, is at least ``DICE``. With B
bigrams in the template, a passage that matches has between B * DICE / (2 - DICE) and B * (2 - DICE) / DICE bigrams and
shares at least the former number. An index from bigrams to templates tells how many of its bigrams a text shares with
each template at most; these bounds drop templates that a text has too few bigrams of, and stretches of a text with too few
of them within the greatest length; what is left is compared bigram by bigram.

Long licences are templates as a whole and by their parts (paragraphs of 40 words or more together), so that an excerpt
from anywhere within one is found. Their texts lie in ``license_texts`` beside this module, as published.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from importlib.resources import files

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import only, table, text_batches, text_or_empty

DICE = 0.8
MEMO = 150_000

#: The licences' own words.
_WARRANTY = """the software is provided "as is", without warranty of any kind, express or implied, including but not limited to the
warranties of merchantability, fitness for a particular purpose and noninfringement. In no event shall the authors or copyright
holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from,
out of or in connection with the software or the use or other dealings in the software."""
_BSD_TERMS = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_DISCLAIMER = """This software is provided by the copyright holders and contributors "as is" and any express or implied warranties,
including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed. In no
event shall the copyright holder or contributors be liable for any direct, indirect, incidental, special, exemplary, or
consequential damages (including, but not limited to, procurement of substitute goods or services; loss of use, data, or profits;
or business interruption) however caused and on any theory of liability, whether in contract, strict liability, or tort (including
negligence or otherwise) arising in any way out of the use of this software, even if advised of the possibility of such damage."""
_GNU_WARRANTY = """ This {work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {title} for more details."""
_GNU_COPY = """ You should have received a copy of the {title} along with this {work}. If not, see <https://www.gnu.org/licenses/>."""


def _gnu(title: str, version: str) -> tuple[str, ...]:
    """The notices of a GNU licence: one line, and one to three paragraphs for programs and libraries, of this version only or later ones."""
    out = [f"This work is licensed under the {title}, version {version}."]
    for work in ("program", "library"):
        for later in ("either version {version} of the License, or (at your option) any later version.", "version {version} of the License."):
            text = "This {work} is free software: you can redistribute it and/or modify it under the terms of the {title} as published by the Free Software Foundation, " + later
            out += [(text + more).format(work=work, title=title, version=version) for more in ("", _GNU_WARRANTY, _GNU_WARRANTY + _GNU_COPY)]
    return tuple(out)


TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished
to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies
or substantial portions of the Software. """ + _WARRANTY,
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        """TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions. "License" shall mean the terms and conditions for
use, reproduction, and distribution as defined by Sections 1 through 9 of this document. "Licensor" shall mean the copyright owner or
entity authorized by the copyright owner that is granting the License. "Legal Entity" shall mean the union of the acting entity and
all other entities that control, are controlled by, or are under common control with that entity.""",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or
agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF
ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the
License.""",
    ),
    "GPL-3.0": (
        *_gnu("GNU General Public License", "3"),
        """The GNU General Public License is a free, copyleft license for software and other kinds of works. The licenses for most
software and other practical works are designed to take away your freedom to share and change the works. By contrast, the GNU General
Public License is intended to guarantee your freedom to share and change all versions of a program--to make sure it remains free
software for all its users.""",
    ),
    "GPL-2.0": (
        *_gnu("GNU General Public License", "2"),
        """The licenses for most software are designed to take away your freedom to share and change it. By contrast, the GNU General
Public License is intended to guarantee your freedom to share and change free software--to make sure the software is free for all its
users. This General Public License applies to most of the Free Software Foundation's software and to any other program whose authors
commit to using it.""",
    ),
    "LGPL-3.0": (
        *_gnu("GNU Lesser General Public License", "3"),
        """This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General
Public License, supplemented by the additional permissions listed below.""",
    ),
    "LGPL-2.1": (
        *_gnu("GNU Lesser General Public License", "2.1"),
        """The licenses for most software are designed to take away your freedom to share and change it. By contrast, the GNU General
Public Licenses are intended to guarantee your freedom to share and change free software--to make sure the software is free for all
its users. This license, the Lesser General Public License, applies to some specially designated software packages--typically
libraries--of the Free Software Foundation and other authors who decide to use it.""",
    ),
    "AGPL-3.0": (
        *_gnu("GNU Affero General Public License", "3"),
        """The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically designed
to ensure cooperation with the community in the case of network server software.""",
    ),
    "MPL-2.0": (
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed
with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
        """1.1. "Contributor" means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software.
1.2. "Contributor Version" means the combination of the Contributions of others (if any) used by a Contributor and that particular
Contributor's Contribution. 1.3. "Contribution" means Covered Software of a particular Contributor.""",
    ),
    "BSL-1.0": (
        "Distributed under the Boost Software License, Version 1.0.",
        """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying
documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and
to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to
the following:""",
    ),
    "Zlib": (
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any
damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including
commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:""",
    ),
    "BSD-2-Clause": (_BSD_TERMS + " " + _BSD_DISCLAIMER, "Licensed under the BSD 2-Clause License."),
    "BSD-3-Clause": (
        _BSD_TERMS + """ 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission. """ + _BSD_DISCLAIMER,
        "Licensed under the BSD 3-Clause License.",
    ),
    "ISC": (
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies. The software is provided "as is" and the
author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness. In no
event shall the author be liable for any special, direct, indirect, or consequential damages or any damages whatsoever resulting
from loss of use, data or profits, whether in an action of contract, negligence or other tortious action, arising out of or in
connection with the use or performance of this software.""",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-ND-4.0": ("Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    "CC0-1.0": ("Licensed under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        """Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a
compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
    ),
}

_words = re.compile(r"[^\W_]+")


def normalised(text: str) -> list[str]:
    return _words.findall(text.lower())


class _Known(dict):
    """word -> its number in the templates, 0 for all others; bounded."""

    def __init__(self, words: dict[str, int]):
        super().__init__(words)
        self.words = words

    def __missing__(self, word: str) -> int:
        if len(self) > MEMO:
            self.clear()
            self.update(self.words)
        self[word] = 0
        return 0


#: What the Affero licence says where the GPL 3 has its section 13.
_AFFERO_13 = """13. Remote Network Interaction; Use with the GNU General Public License.

Notwithstanding any other provision of this License, if you modify the Program, your modified version must prominently offer all
users interacting with it remotely through a computer network (if your version supports such interaction) an opportunity to receive
the Corresponding Source of your version by providing access to the Corresponding Source from a network server at no charge, through
some standard or customary means of facilitating copying of software. This Corresponding Source shall include the Corresponding Source
for any work covered by version 3 of the GNU General Public License that is incorporated pursuant to the following paragraph.

Notwithstanding any other provision of this License, you have permission to link or combine any covered work with a work licensed
under version 3 of the GNU General Public License into a single combined work, and to convey the resulting work. The terms of this
License will continue to apply to the part which is the covered work, but the work with which it is combined will remain governed by
version 3 of the GNU General Public License.

"""
PART_WORDS = 40


def whole_texts() -> dict[str, str]:
    """The whole texts of long licences. The terms of the Affero licence are those of the GPL 3 under its own name, but for section 13."""
    folder = files(__package__) / "license_texts"
    texts = {f.name.removesuffix(".txt"): f.read_text("utf-8") for f in sorted(folder.iterdir(), key=lambda f: f.name) if f.name.endswith(".txt")}
    terms = texts["GPL-3.0"][texts["GPL-3.0"].index("TERMS AND CONDITIONS") : texts["GPL-3.0"].index("END OF TERMS AND CONDITIONS")]
    before, after = terms[: terms.index("  13. Use with")], terms[terms.index("  14. Revised Versions") :]
    own = lambda t: t.replace("GNU General Public License", "GNU Affero General Public License").replace("GNU\nGeneral Public License", "GNU Affero General Public License")
    return texts | {"AGPL-3.0": own(before) + _AFFERO_13 + own(after)}


def parts(text: str, least: int = PART_WORDS) -> list[str]:
    """Paragraphs of a text, with as many following ones as it takes to have ``least`` words; a short rest goes to the last part."""
    out: list[str] = []
    for paragraph in re.split(r"\n\s*\n", text):
        if out and len(normalised(out[-1])) < least:
            out[-1] += "\n\n" + paragraph
        else:
            out.append(paragraph)
    if len(out) > 1 and len(normalised(out[-1])) < least:
        last = out.pop()
        out[-1] += "\n\n" + last
    return out


def all_templates() -> dict[str, tuple[str, ...]]:
    """Notices, whole licences and their parts. What two licences have in common word for word stands for the first one only."""
    out, seen = {name: list(texts) for name, texts in TEMPLATES.items()}, set()
    for name, text in sorted(whole_texts().items(), key=lambda x: x[0] == "AGPL-3.0"):
        for part in (text, *parts(text)):
            words = " ".join(normalised(part))
            if words not in seen:
                seen.add(words)
                out.setdefault(name, []).append(part)
    return {name: tuple(texts) for name, texts in out.items()}


class Scanner:
    def __init__(self, templates: dict[str, tuple[str, ...]], dice: float = DICE):
        self.dice = dice
        words = sorted({w for texts in templates.values() for t in texts for w in normalised(t)})
        number = {w: k + 1 for k, w in enumerate(words)}
        self.known, self.size = _Known(number), len(words) + 1
        self.names: list[str] = []
        bags = []
        for name, texts in templates.items():
            for t in texts:
                ids = [number[w] for w in normalised(t)]
                bags.append(Counter(a * self.size + b for a, b in zip(ids, ids[1:])))
                self.names.append(name)
        self.codes = np.array(sorted({c for bag in bags for c in bag}), np.int64)
        self.bags = [(np.searchsorted(self.codes, np.array(sorted(bag), np.int64)), np.array([bag[c] for c in sorted(bag)], np.int64)) for bag in bags]
        self.totals = np.array([bag.total() for bag in bags], np.int64)
        # for each bigram the templates that have it, one after the other
        every = np.concatenate([own for own, _ in self.bags])
        order = np.argsort(every, kind="stable")
        self.owners = np.repeat(np.arange(len(bags)), [len(own) for own, _ in self.bags])[order]
        self.times = np.concatenate([n for _, n in self.bags])[order]
        self.ends = np.searchsorted(every[order], np.arange(len(self.codes) + 1))
        self.caps = np.zeros(len(self.codes), np.int64)

    def _reachable(self, known: np.ndarray) -> np.ndarray:
        """Numbers of the templates of which a text, given its known bigrams, has enough."""
        own, n = np.unique(known, return_counts=True)
        lengths = self.ends[own + 1] - self.ends[own]
        entries = np.repeat(self.ends[own] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        shared = np.bincount(self.owners[entries], np.minimum(np.repeat(n, lengths), self.times[entries]), len(self.totals))
        return np.flatnonzero(shared >= self.totals * self.dice / (2 - self.dice))

    def scan(self, text: str) -> list[tuple[str, float, int, int, int]]:
        """(licence, Dice, first word, one past the last, shared bigrams), without overlaps.

        The passage with the most shared bigrams comes first; of those that are mostly the same passage, to which near-equal
        templates lead, the one with the highest Dice stands for it.
        """
        words = normalised(text)
        ids = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        if len(ids) < 2:
            return []
        pairs = ids[:-1] * self.size + ids[1:]
        hits = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
        at = np.minimum(np.searchsorted(self.codes, pairs[hits]), len(self.codes) - 1)
        real = self.codes[at] == pairs[hits]
        hits, at = hits[real], at[real]
        if not len(hits):
            return []
        found = []
        for t in self._reachable(at).tolist():
            own, n = self.bags[t]
            self.caps[own] = n
            caps = self.caps[at]
            self.caps[own] = 0
            found += self._passages(t, hits[caps > 0], at[caps > 0], caps[caps > 0])
        found.sort(key=lambda x: (-x[4], -x[1], x[2]))
        by_start = sorted(found, key=lambda x: x[2])
        starts, longest = [x[2] for x in by_start], max((x[3] - x[2] for x in found), default=0)
        taken: list[tuple[int, int]] = []
        kept = []

        def free(x: tuple) -> bool:
            k = bisect_right(taken, (x[2], 1 << 60))
            return (k == 0 or taken[k - 1][1] <= x[2]) and (k == len(taken) or taken[k][0] >= x[3])

        for most in found:
            if free(most):
                near = by_start[bisect_left(starts, most[2] - longest) : bisect_right(starts, most[3])]
                same = [x for x in near if 2 * (min(x[3], most[3]) - max(x[2], most[2])) >= max(x[3] - x[2], most[3] - most[2]) and free(x)]
                best = max(same, key=lambda x: (x[1], x[4], -x[2]))
                insort(taken, (best[2], best[3]))
                kept.append(best)
        return sorted(kept, key=lambda x: (x[2], x[0]))

    def _passages(self, t: int, places: np.ndarray, codes: np.ndarray, caps: np.ndarray) -> Iterator[tuple[str, float, int, int, int]]:
        """The best passage from each hit on; a passage begins and ends with a hit, for other ends only lower the coefficient.

        A hit counts in a passage unless as many equal ones as the template has come before it there, that is, if the passage
        begins after the hit that lies so many equal ones back.
        """
        total = int(self.totals[t])
        least, most = math.ceil(total * self.dice / (2 - self.dice)), total * (2 - self.dice) / self.dice
        if len(places) < max(least, 1):
            return
        starts = np.flatnonzero(places[least - 1 :] - places[: len(places) - least + 1] < most)
        if not len(starts):
            return
        order = np.argsort(codes, kind="stable")
        group = np.searchsorted(codes[order], codes[order])
        back = np.arange(len(order)) - caps[order]
        earlier = np.empty(len(order), np.int64)
        earlier[order] = np.where(back >= group, order[np.maximum(back, 0)], -1)
        stops = np.searchsorted(places, places[starts] + most - 1, "right")
        for i, stop in zip(starts.tolist(), stops.tolist(), strict=True):
            both = np.cumsum(earlier[i:stop] < i)
            size = places[i:stop] - places[i] + 1
            dice = 2 * both / (total + size)
            k = int(dice.argmax())
            if dice[k] >= self.dice:
                yield self.names[t], float(dice[k]), int(places[i]), int(places[i + k]) + 2, int(both[k])


@lru_cache(maxsize=2)
def _scanner(templates: tuple, dice: float) -> Scanner:
    return Scanner(dict(templates), dice)


def find_licenses(docs: DataFrame, dice: float = DICE, templates: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """doc_id, n_matches, license, dice (of the best match) and spans of every row of ``docs``.

    spans is ``licence:start:end:dice`` in code points by start, comma-joined. The best match has the highest Dice, then
    the most bigrams, then comes first. Without a match, and for null and empty texts, n_matches is 0, license and dice
    are null and spans is empty. Very long texts are scanned whole. Repeated rows repeat; an empty table gives no rows. Other
    columns are ignored. A whole licence is one match; an excerpt is a match for each of its parts. ``templates`` (licence ->
    texts) stand in for ``all_templates()``, some 300 kB; the driver reads them and sends them with the tasks.
    """
    sent = tuple((all_templates() if templates is None else templates).items())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = _scanner(sent, dice)
        for pdf in batches:
            out = []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                found = scanner.scan(text)
                if not found:
                    out.append((doc_id, 0, None, None, ""))
                    continue
                places = [m.span() for m in _words.finditer(text.lower())] if len(text.lower()) == len(text) else _places(text)
                best = max(found, key=lambda x: (x[1], x[4], -x[2]))
                spans = ",".join(f"{x[0]}:{places[x[2]][0]}:{places[x[3] - 1][1]}:{x[1]:.4f}" for x in found)
                out.append((doc_id, len(found), best[0], best[1], spans))
            yield pd.DataFrame(out, columns=["doc_id", "n_matches", "license", "dice", "spans"])

    return only(docs, ["doc_id", "text"]).select("doc_id", text_or_empty().alias("text")).mapInPandas(run, "doc_id long, n_matches long, license string, dice double, spans string")


def _places(text: str) -> list[tuple[int, int]]:
    """Places of the words of ``text.lower()`` in ``text``, where lowering changes the number of code points."""
    back = [k for k, c in enumerate(text) for _ in c.lower()]
    return [(back[m.start()], back[m.end() - 1] + 1) for m in _words.finditer(text.lower())]


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_batches(spark)
    return find_licenses(table(spark, sf_dir, "documents"))
