"""Ternary search trees over sequences of numbers, and what their nodes add up to."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field


@dataclass
class TernaryTree:
    """Node 0 is the root, which has no symbol; ``down`` leads to the symbols that follow a node.

    Among the symbols that follow the same node, ``low`` and ``high`` lead to smaller and larger ones.
    """

    symbol: list[int] = field(default_factory=lambda: [0])
    low: list[int] = field(default_factory=lambda: [-1])
    down: list[int] = field(default_factory=lambda: [-1])
    high: list[int] = field(default_factory=lambda: [-1])
    #: the number of the sequence that ends at a node
    end: list[int] = field(default_factory=lambda: [-1])

    def _node(self, symbol: int) -> int:
        for column, value in ((self.symbol, symbol), (self.low, -1), (self.down, -1), (self.high, -1), (self.end, -1)):
            column.append(value)
        return len(self.symbol) - 1

    def insert(self, sequence: Sequence[int], number: int) -> None:
        symbol, low, down, high = self.symbol, self.low, self.down, self.high
        node = 0
        for s in sequence:
            at = down[node]
            if at < 0:
                down[node] = self._node(s)
                node = down[node]
                continue
            while s != symbol[at]:
                side = low if s < symbol[at] else high
                if side[at] < 0:
                    side[at] = self._node(s)
                at = side[at]
            node = at
        self.end[node] = number

    @classmethod
    def balanced(cls, sequences: Sequence[Sequence[int]]) -> TernaryTree:
        """The tree of sorted sequences, medians first, so that no side is deep."""
        tree, waiting = cls(), [(0, len(sequences))]
        while waiting:
            first, last = waiting.pop()
            if first < last:
                middle = (first + last) // 2
                tree.insert(sequences[middle], middle)
                waiting += [(middle + 1, last), (first, middle)]
        return tree

    def above(self) -> tuple[list[int], list[int], list[int]]:
        """All nodes but the root, each after the node it follows; that node of each; and every node's depth."""
        size = len(self.symbol)
        order, parent, depth = [], [-1] * size, [0] * size
        waiting = [(self.down[0], 0)]
        while waiting:
            at, up = waiting.pop()
            if at >= 0:
                order.append(at)
                parent[at], depth[at] = up, depth[up] + 1
                waiting += [(self.high[at], up), (self.low[at], up), (self.down[at], at)]
        return order, parent, depth

    def path(self, sequence: Sequence[int]) -> list[int]:
        """The nodes of a sequence that is in the tree, root first."""
        out = [0]
        for s in sequence:
            at = self.down[out[-1]]
            while self.symbol[at] != s:
                at = self.low[at] if s < self.symbol[at] else self.high[at]
            out.append(at)
        return out
