"""A suffix automaton of several word sequences, with the least owner of each state."""

from __future__ import annotations

from collections.abc import Hashable, Sequence


class SuffixAutomaton:
    """All sub-sequences of the added sequences; each state knows the smallest
    owner in whose sequences its words occur."""

    def __init__(self):
        self.next: list[dict[Hashable, int]] = [{}]
        self.link, self.length, self.least = [-1], [0], [float("inf")]

    def _state(self, length: int, next_: dict, link: int, least) -> int:
        self.next.append(next_)
        self.link.append(link)
        self.length.append(length)
        self.least.append(least)
        return len(self.link) - 1

    def _split(self, p: int, word: Hashable, q: int) -> int:
        """The state for the words reached from ``p``, apart from the longer ones of ``q``."""
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q], float("inf"))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, words: Sequence[Hashable], owner) -> None:
        next_, link, length = self.next, self.link, self.length
        last = 0
        for word in words:
            q = next_[last].get(word)
            if q is not None:
                last = q if length[q] == length[last] + 1 else self._split(last, word, q)
            else:
                new = self._state(length[last] + 1, {}, 0, float("inf"))
                p = last
                while p >= 0 and word not in next_[p]:
                    next_[p][word] = new
                    p = link[p]
                if p >= 0:
                    q = next_[p][word]
                    link[new] = q if length[q] == length[p] + 1 else self._split(p, word, q)
                last = new
            if owner < self.least[last]:
                self.least[last] = owner

    def finish(self) -> None:
        """Owners of longer sequences own their suffixes too."""
        link, least = self.link, self.least
        for s in sorted(range(1, len(link)), key=self.length.__getitem__, reverse=True):
            if least[s] < least[link[s]]:
                least[link[s]] = least[s]

    def owners(self, words: Sequence[Hashable], size: int) -> list:
        """For each run of ``size`` words, by its last word: the least owner of
        a sequence that holds it (infinity: none). Matching statistics, cut at ``size``."""
        next_, link, length, least = self.next, self.link, self.length, self.least
        out, state, matched = [], 0, 0
        for at, word in enumerate(words):
            while state and word not in next_[state]:
                state = link[state]
                matched = length[state]
            if word in next_[state]:
                state = next_[state][word]
                matched += 1
            while length[link[state]] >= size and state:
                state = link[state]
                matched = length[state]
            if at >= size - 1:
                out.append(least[state] if matched >= size else float("inf"))
        return out
