"""A compressed FM-index of one shard: Burrows-Wheeler transform in a wavelet matrix, searched in bulk.

Texts are sequences of word numbers of at most ``LONGEST`` words, each with a weight. Matching
statistics of many patterns run side by side: every step extends all patterns by one word to the left
(two rank queries per level of the wavelet matrix); a pattern that no longer occurs with total weight 2
or more gives up words on the right, to the parent interval of the LCP array, and tries again.
"""

from __future__ import annotations

import numpy as np

LONGEST = 64


class Bits:
    """A bit vector in 64-bit words with counts before each word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = (np.cumsum(counts) - counts).astype(np.int32)

    def ones(self, at: np.ndarray) -> np.ndarray:
        w = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)


class FMIndex:
    def __init__(self, words: np.ndarray, starts: np.ndarray, weights: np.ndarray):
        """``words``: numbers from 0; ``starts``: first word of each text; ``weights``: one per text."""
        texts = len(starts)
        lengths = np.diff(np.append(starts, len(words)))
        text = np.repeat(np.arange(texts), lengths)
        self.at = np.arange(len(words)) + text  # place of each word, a terminator after every text
        n = len(words) + texts
        rank = np.empty(n, np.int64)
        rank[self.at] = words + texts
        ends = starts + lengths + np.arange(texts)
        rank[ends] = np.arange(texts)  # terminators differ, so suffixes do within LONGEST + 1 words
        owner = np.repeat(np.arange(texts), lengths + 1)
        symbols = np.zeros(n, np.int64)
        symbols[self.at] = words + 1
        _, rank = np.unique(rank, return_inverse=True)
        levels, step = [rank.astype(np.int32)], 1
        while True:
            key = rank.astype(np.int64) * (n + 1)
            key[: n - step] += rank[step:] + 1
            order = np.argsort(key, kind="stable")
            sorted_key = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.append(False, sorted_key[1:] != sorted_key[:-1]))
            step *= 2
            if rank[order[-1]] == n - 1:
                break
            levels.append(rank.astype(np.int32))
        # common prefixes of neighbours, from the doubling ranks
        a, b = order[:-1].copy(), order[1:].copy()
        lcp = np.zeros(n - 1, np.int64)
        for k in range(len(levels) - 1, -1, -1):
            inside = (a < n) & (b < n)
            same = np.zeros(n - 1, bool)
            same[inside] = levels[k][a[inside]] == levels[k][b[inside]]
            lcp[same] += 1 << k
            a[same] += 1 << k
            b[same] += 1 << k
        self.lcp = np.concatenate([[-1], lcp, [-1]])
        self._neighbours()
        self.weight = np.concatenate([[0], np.cumsum(weights[owner[order]])])
        last = symbols[order - 1]  # place -1 is a terminator
        sigma = int(symbols.max()) + 1
        counts = np.bincount(symbols, minlength=sigma)
        self.first = np.cumsum(counts) - counts
        self.matrix: list[tuple[Bits, int]] = []
        self.start = np.zeros(sigma, np.int64)
        every = np.arange(sigma)
        self.depth = max(1, int(sigma - 1).bit_length())
        for level in range(self.depth - 1, -1, -1):
            bit = (last >> level & 1).astype(bool)
            bits, zeros = Bits(bit), int((~bit).sum())
            self.matrix.append((bits, zeros))
            ones = bits.ones(self.start)
            self.start = np.where(every >> level & 1, zeros + ones, self.start - ones)
            last = np.concatenate([last[~bit], last[bit]])
        self.n = n

    def _neighbours(self) -> None:
        """Nearest smaller LCP on either side of each place."""
        lcp, places = self.lcp, np.arange(len(self.lcp))
        self.left, self.right = np.zeros(len(lcp), np.int32), np.full(len(lcp), len(lcp) - 1, np.int32)
        for value in np.unique(lcp)[1:].tolist():
            mine = np.flatnonzero(lcp == value)
            less = np.flatnonzero(lcp < value)
            at = np.searchsorted(less, mine)
            self.left[mine], self.right[mine] = less[at - 1], less[at]

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before ``at`` in the transform."""
        for level, (bits, zeros) in zip(range(self.depth - 1, -1, -1), self.matrix):
            ones = bits.ones(at)
            at = np.where(symbol >> level & 1, zeros + ones, at - ones)
        return at - self.start[symbol]

    def repeated(self, words: np.ndarray, starts: np.ndarray, lengths: np.ndarray, window: int) -> np.ndarray:
        """For each pattern a bit mask: bit i is set if its ``window`` words from i on occur with total weight 2 or more."""
        n = len(starts)
        out = np.zeros(n, np.int64)
        at = lengths - 1
        lo, hi, size = np.zeros(n, np.int64), np.full(n, self.n, np.int64), np.zeros(n, np.int64)
        live = np.flatnonzero(at >= 0)
        while len(live):
            c = words[starts[live] + at[live]] + 1
            both = self.rank(np.concatenate([c, c]), np.concatenate([lo[live], hi[live]]))
            new_lo, new_hi = self.first[c] + both[: len(c)], self.first[c] + both[len(c):]
            ok = self.weight[new_hi] - self.weight[new_lo] >= 2
            go = live[ok]
            lo[go], hi[go] = new_lo[ok], new_hi[ok]
            size[go] += 1
            full = go[size[go] >= window]
            out[full] |= np.int64(1) << at[full]
            at[go] -= 1
            stop = live[~ok]
            none = stop[size[stop] == 0]
            at[none] -= 1
            up = stop[size[stop] > 0]
            edge = np.where(self.lcp[lo[up]] >= self.lcp[hi[up]], lo[up], hi[up])
            size[up] = np.maximum(self.lcp[edge], 0)
            root = size[up] == 0
            lo[up] = np.where(root, 0, self.left[edge])
            hi[up] = np.where(root, self.n, self.right[edge])
            # a pattern whose rest cannot hold another window is done
            live = live[(at[live] >= 0) & (size[live] + at[live] + 1 >= window)]
        return out
