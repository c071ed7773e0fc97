"""A linear-chain conditional random field over words, with numpy.

A word's features are its affixes, its inner n-grams, itself, and the lexicons that have it; all but the
lexicons are hashed into a table of fixed size. Forward and backward passes run over many sequences at
once, the longest first, so the sequences still running are always a prefix.
"""

from __future__ import annotations

import numpy as np

from . import words as W

BUCKETS = 1 << 16
LETTERS = W.not_in((0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F))


def lowered(data: np.ndarray) -> np.ndarray:
    """Lower case for ASCII and Latin-1 letters in UTF-8."""
    data = W.LOWER[data]
    latin = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    data[1:][latin] += 0x20
    return data


def find_words(data: np.ndarray, offsets: np.ndarray) -> W.Words:
    """Runs of letters (ASCII, and all characters beyond it), in lower case."""
    return W.split(lowered(data), offsets, LETTERS, lower=False)


def hashed_features(words: W.Words, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature buckets of some words, one word after another, and where each word's begin."""
    start, end = words.start[index], words.end[index]
    size = end - start
    # the words, each between two marks
    framed = size + 2
    first = np.cumsum(framed) - framed
    text = np.full(int(framed.sum()), 0x20, dtype=np.uint64)
    place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    text[np.repeat(first + 1, size) + place] = words.data[np.repeat(start, size) + place]
    owner = np.repeat(np.arange(len(index)), framed)
    values, owners = [], []

    def add(kind: int, value: np.ndarray, whose: np.ndarray) -> None:
        values.append(W.mix(value * W.U64(64) + W.U64(kind)))
        owners.append(whose)

    for n in (2, 3):  # inner n-grams
        gram = np.zeros(max(len(text) - n + 1, 0), dtype=np.uint64)
        for step in range(n):
            gram = gram * W.U64(256) + text[step : step + len(gram)]
        whole = owner[: len(gram)] == owner[n - 1 :] if len(gram) else np.zeros(0, bool)
        add(n, gram[whole], owner[: len(gram)][whole])
    for n in (1, 2, 3, 4):  # affixes
        has = np.flatnonzero(size >= n)
        prefix = np.zeros(len(has), dtype=np.uint64)
        suffix = np.zeros(len(has), dtype=np.uint64)
        for step in range(n):
            prefix = prefix * W.U64(256) + text[first[has] + 1 + step]
            suffix = suffix * W.U64(256) + text[first[has] + 1 + size[has] - n + step]
        add(8 + n, prefix, has)
        add(16 + n, suffix, has)
    picked = W.Words(words.data, start, end, np.zeros(1, np.int64))
    add(32, _hashes(picked), np.arange(len(index)))
    owners_all = np.concatenate(owners)
    order = np.argsort(owners_all, kind="stable")
    buckets = (np.concatenate(values)[order] >> W.U64(48)).astype(np.int64)
    return buckets, np.searchsorted(owners_all[order], np.arange(len(index)))


def _hashes(words: W.Words) -> np.ndarray:
    """Hashes of words picked in any order."""
    order = np.argsort(words.start, kind="stable")
    out = np.empty(len(order), dtype=np.uint64)
    out[order] = W.Words(words.data, words.start[order], words.end[order], words.first).hashes()
    return out


def _softmax_parts(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    top = scores.max(axis=-1, keepdims=True)
    return np.exp(scores - top), top


def marginals(
    emissions: np.ndarray, starts: np.ndarray, sizes: np.ndarray, transitions: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of each label at each word, by forward-backward, and expected transition counts.

    ``emissions`` (words x labels) hold sequences that begin at ``starts`` with ``sizes`` words.
    """
    labels = emissions.shape[1]
    weights = np.exp(transitions - transitions.max())
    local, _ = _softmax_parts(emissions)
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    longest = int(sizes[0]) if len(sizes) else 0
    running = np.searchsorted(-sizes, -np.arange(longest), side="left")
    forward = np.empty_like(local)
    state = None
    for step in range(longest):
        at = starts[: running[step]] + step
        state = local[at] if step == 0 else (state[: len(at)] @ weights) * local[at]
        state = state / np.maximum(state.sum(axis=1, keepdims=True), 1e-300)
        forward[at] = state
    posterior = np.empty_like(local)
    moves = np.zeros((labels, labels))
    back = np.ones((len(starts), labels))
    for step in range(longest - 1, -1, -1):
        n = running[step]
        at = starts[:n] + step
        both = forward[at] * back[:n]
        posterior[at] = both / np.maximum(both.sum(axis=1, keepdims=True), 1e-300)
        if step:
            ahead = local[at] * back[:n]
            pair = forward[at - 1][:, :, None] * weights[None] * ahead[:, None, :]
            pair /= np.maximum(pair.sum(axis=(1, 2), keepdims=True), 1e-300)
            moves += pair.sum(axis=0)
            ahead = ahead @ weights.T
            back[:n] = ahead / np.maximum(ahead.sum(axis=1, keepdims=True), 1e-300)
    return posterior, moves


class Model:
    """Learned weights: hashed features, lexicons, and transitions between labels."""

    def __init__(self, labels: list[str], lexicons: list[np.ndarray]):
        self.labels = labels
        self.lexicons = lexicons  # ascending word hashes of each label
        self.weights = np.zeros((BUCKETS, len(labels)), dtype=np.float32)
        self.lexicon_weights = np.zeros((len(labels), len(labels)))
        self.transitions = np.zeros((len(labels), len(labels)))

    def listed(self, hashes: np.ndarray) -> np.ndarray:
        """Which lexicons have each word."""
        out = np.zeros((len(hashes), len(self.lexicons)))
        for label, lexicon in enumerate(self.lexicons):
            if len(lexicon):
                at = np.minimum(np.searchsorted(lexicon, hashes), len(lexicon) - 1)
                out[:, label] = lexicon[at] == hashes
        return out

    def emissions(self, buckets: np.ndarray, first: np.ndarray, listed: np.ndarray) -> np.ndarray:
        if not len(first):
            return np.zeros((0, len(self.labels)))
        sums = np.add.reduceat(self.weights[buckets], first, axis=0).astype(np.float64)
        return sums + listed @ self.lexicon_weights

    def fit(self, words: W.Words, sequence: np.ndarray, target: np.ndarray, turns: int = 60,
            rate: float = 0.15, penalty: float = 1e-4) -> None:
        """Maximise the likelihood of the labels by Adam over all sequences. ``sequence``: ascending, of
        each word; ``target``: the label of each word."""
        hashes = words.hashes()
        kinds, sample, which = np.unique(hashes, return_index=True, return_inverse=True)
        buckets, first = hashed_features(words, sample)
        owner = np.repeat(np.arange(len(kinds)), np.diff(np.append(first, len(buckets))))
        listed = self.listed(kinds)
        starts = np.flatnonzero(np.diff(sequence, prepend=-1))
        sizes = np.diff(np.append(starts, len(sequence)))
        labels, total = len(self.labels), len(target)
        inner = np.ones(total, dtype=bool)
        inner[starts] = False
        after = np.flatnonzero(inner)
        seen = np.bincount(target[after - 1] * labels + target[after], minlength=labels * labels)
        seen = seen.reshape(labels, labels)
        wanted = np.zeros((total, labels))
        wanted[np.arange(total), target] = 1
        values = [self.weights, self.lexicon_weights, self.transitions]
        means = [np.zeros(v.shape) for v in values]
        squares = [np.zeros(v.shape) for v in values]
        for turn in range(1, turns + 1):
            emissions = self.emissions(buckets, first, listed)[which]
            posterior, moves = marginals(emissions, starts, sizes, self.transitions)
            gap = wanted - posterior
            by_kind = np.stack([np.bincount(which, gap[:, j], len(kinds)) for j in range(labels)], axis=1)
            slope = np.stack(
                [np.bincount(buckets, by_kind[owner, j], BUCKETS) for j in range(labels)], axis=1
            )
            slopes = [slope, listed.T @ by_kind, seen - moves]
            for value, mean, square, change in zip(values, means, squares, slopes):
                change = change / total - penalty * value
                mean += 0.1 * (change - mean)
                square += 0.01 * (change * change - square)
                value += rate * (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-8)
