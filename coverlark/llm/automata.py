"""Weighted acyclic automata over word sequences: built from sorted entries, united with summed weights, composed for look-ups."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator

#: Arcs of a state: (label, next state) by ascending label.
Arcs = tuple[tuple[int, int], ...]


class Automaton:
    """A minimal acyclic automaton. A sequence of words is a path from ``root``; its weight stands at the last state, 0 for none.

    Labels are places in ``words``, which is sorted, so that paths come in the order of the words' bytes.
    """

    def __init__(self, words: list[bytes]):
        self.words = words
        self.arcs: list[Arcs] = []
        self.weights: list[int] = []
        self.root = -1
        self._register: dict[tuple[int, Arcs], int] = {}

    def state(self, weight: int, arcs: Arcs) -> int:
        """The state with this weight and these arcs, of which there is never a second."""
        got = self._register.setdefault((weight, arcs), len(self.arcs))
        if got == len(self.arcs):
            self.arcs.append(arcs)
            self.weights.append(weight)
        return got

    @classmethod
    def of_sorted(cls, words: list[bytes], entries: Iterable[tuple[tuple[int, ...], int]]) -> Automaton:
        """Built entry by entry: where an entry leaves the path of the one before, the rest of that path is settled."""
        out = cls(words)
        last: tuple[int, ...] = ()
        path: list[list] = [[0, []]]  # weight and arcs of the states along ``last``

        def settle(down_to: int) -> None:
            while len(path) > down_to + 1:
                weight, arcs = path.pop()
                path[-1][1].append((last[len(path) - 1], out.state(weight, tuple(arcs))))

        for key, weight in entries:
            same = 0
            while same < min(len(key), len(last)) and key[same] == last[same]:
                same += 1
            settle(same)
            path += [[0, []] for _ in key[same:]]
            path[-1][0] += weight
            last = key
        settle(0)
        out.root = out.state(path[0][0], tuple(path[0][1]))
        return out

    def __len__(self) -> int:
        return len(self.arcs)

    def entries(self) -> Iterator[tuple[tuple[bytes, ...], int]]:
        """Accepted sequences and their weights, in order."""

        def walk(state: int, path: tuple[bytes, ...]) -> Iterator[tuple[tuple[bytes, ...], int]]:
            if self.weights[state]:
                yield path, self.weights[state]
            for label, after in self.arcs[state]:
                yield from walk(after, (*path, self.words[label]))

        yield from walk(self.root, ())

    def dumps(self) -> bytes:
        return pickle.dumps((self.words, self.arcs, self.weights, self.root), protocol=5)

    @classmethod
    def loads(cls, data: bytes) -> Automaton:
        out = cls([])
        out.words, out.arcs, out.weights, out.root = pickle.loads(data)
        return out


def union(parts: list[Automaton], keeps: Callable[[int, int], bool] = lambda depth, weight: weight > 0) -> Automaton:
    """Accepts what any part accepts, with the sum of the weights; sequences whose depth and sum ``keeps`` refuses get none."""
    words = sorted({w for p in parts for w in p.words})
    place = {w: k for k, w in enumerate(words)}
    labels = [[place[w] for w in p.words] for p in parts]
    out = Automaton(words)

    def merge(states: list[tuple[int, int]], depth: int) -> int:
        weight = sum(parts[p].weights[s] for p, s in states)
        after: dict[int, list[tuple[int, int]]] = {}
        for p, s in states:
            own = labels[p]
            for label, to in parts[p].arcs[s]:
                after.setdefault(own[label], []).append((p, to))
        arcs = [(label, merge(after[label], depth + 1)) for label in sorted(after)]
        return out.state(weight if keeps(depth, weight) else 0, tuple(a for a in arcs if out.weights[a[1]] or out.arcs[a[1]]))

    out.root = merge([(k, p.root) for k, p in enumerate(parts)], 0) if parts else out.state(0, ())
    return out


def compose(asked: Automaton, counts: Automaton) -> Iterator[tuple[tuple[bytes, ...], int]]:
    """What both accept, with the weight in ``counts``: paths are followed only as long as both have them."""

    def walk(a: int, c: int, path: tuple[bytes, ...]) -> Iterator[tuple[tuple[bytes, ...], int]]:
        if asked.weights[a] and counts.weights[c]:
            yield path, counts.weights[c]
        there = {counts.words[label]: to for label, to in counts.arcs[c]} if asked.arcs[a] else {}
        for label, to in asked.arcs[a]:
            word = asked.words[label]
            if word in there:
                yield from walk(to, there[word], (*path, word))

    yield from walk(asked.root, counts.root, ())
