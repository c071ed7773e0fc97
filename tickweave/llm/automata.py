"""Probabilistic automata inferred from sample strings by merging compatible prefix-tree states."""

from __future__ import annotations

from collections import defaultdict
from math import inf, log, sqrt

#: The characters of credentials, by class. A class is one symbol of an automaton.
CLASSES = ("0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", *"+/_.=-")
SYMBOL = {ord(c): i for i, group in enumerate(CLASSES) for c in group}
WEIGHT = [log(len(group)) for group in CLASSES]
SYMBOLS = len(CLASSES)


class Automaton:
    """A deterministic automaton with counts: how often a state was entered, left by each symbol, and how
    often a string ended there."""

    def __init__(self, samples: list[bytes], alpha: float = 0.05):
        self.next: list[dict[int, int]] = [{}]
        self.taken: list[dict[int, int]] = [defaultdict(int)]
        self.visits, self.ends = [0], [0]
        for sample in samples:
            state = 0
            self.visits[0] += 1
            for char in sample:
                symbol = SYMBOL[char]
                self.taken[state][symbol] += 1
                if symbol not in self.next[state]:
                    self.next[state][symbol] = len(self.next)
                    self.next.append({})
                    self.taken.append(defaultdict(int))
                    self.visits.append(0)
                    self.ends.append(0)
                state = self.next[state][symbol]
                self.visits[state] += 1
            self.ends[state] += 1
        self.bound = sqrt(0.5 * log(2 / alpha))
        self._merge_all()
        self.tables = self._tables()

    def _differ(self, hits: int, n: int, other_hits: int, m: int) -> bool:
        """Hoeffding's bound: whether two relative frequencies differ for sure."""
        return abs(hits / n - other_hits / m) > self.bound * (1 / sqrt(n) + 1 / sqrt(m))

    def _compatible(self, one: int, other: int) -> bool:
        pairs = [(one, other)]
        while pairs:
            a, b = pairs.pop()
            n, m = self.visits[a], self.visits[b]
            if not n or not m or a == b:
                continue
            if self._differ(self.ends[a], n, self.ends[b], m):
                return False
            for symbol in self.taken[a].keys() | self.taken[b].keys():
                if self._differ(self.taken[a].get(symbol, 0), n, self.taken[b].get(symbol, 0), m):
                    return False
                if symbol in self.next[a] and symbol in self.next[b]:
                    pairs.append((self.next[a][symbol], self.next[b][symbol]))
        return True

    def _fold(self, red: int, blue: int) -> None:
        """Add the subtree at ``blue`` to ``red``."""
        pairs = [(red, blue)]
        while pairs:
            a, b = pairs.pop()
            self.visits[a] += self.visits[b]
            self.ends[a] += self.ends[b]
            for symbol, count in self.taken[b].items():
                self.taken[a][symbol] += count
                child = self.next[b][symbol]
                if symbol in self.next[a]:
                    pairs.append((self.next[a][symbol], child))
                else:
                    self.next[a][symbol] = child

    def _merge_all(self) -> None:
        red = [0]
        while True:
            members = set(red)
            blue = [
                (state, symbol, child)
                for state in red
                for symbol, child in self.next[state].items()
                if child not in members
            ]
            if not blue:
                break
            state, symbol, child = max(blue, key=lambda edge: self.visits[edge[2]])
            for target in red:
                if self._compatible(target, child):
                    self.next[state][symbol] = target
                    self._fold(target, child)
                    break
            else:
                red.append(child)
        self.states = red

    def _tables(self) -> tuple[list[list[int]], list[list[float]], list[float]]:
        """Per state: next states, log-probabilities of one character of each symbol, of the end."""
        index = {state: i for i, state in enumerate(self.states)}
        sink = len(index)
        steps, logs, ends = [], [], []
        for state in self.states:
            total = self.visits[state] + 0.5 * (SYMBOLS + 1)
            steps.append([index.get(self.next[state].get(s, -1), sink) for s in range(SYMBOLS)])
            logs.append([
                log((self.taken[state].get(s, 0) + 0.5) / total) - WEIGHT[s] for s in range(SYMBOLS)
            ])
            ends.append(log((self.ends[state] + 0.5) / total))
        steps.append([sink] * SYMBOLS)  # off every known path: all symbols alike
        logs.append([-log(SYMBOLS + 1) - WEIGHT[s] for s in range(SYMBOLS)])
        ends.append(-log(SYMBOLS + 1))
        return steps, logs, ends


def log_likelihood(tables: tuple, candidate: bytes, known_only: bool = False) -> float:
    """The natural log-probability of a string and its end. With ``known_only``, a string that takes a
    step which no sample took has none."""
    steps, logs, ends = tables
    state, total, sink = 0, 0.0, len(steps) - 1
    for char in candidate:
        symbol = SYMBOL[char]
        total += logs[state][symbol]
        state = steps[state][symbol]
        if known_only and state == sink:
            return -inf
    return total + ends[state]
