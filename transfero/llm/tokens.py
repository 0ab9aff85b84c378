"""Byte-level BPE by pre-token: distinct pre-tokens are tokenised in bulk, then only looked up.

A pre-token here is the text between single spaces, with its leading space. Cutting there never changes
the result as long as no space touches other white space; texts where one does, and texts with the
special string, go to the library of the ``.json`` file whole. Pre-tokens not met before are joined and
encoded in one call over the rank file of the same vocabulary (several times faster than the ``.json``
library, equal ids; the tests hold both against each other), and the ids are cut where the tokens' byte
lengths reach the pre-tokens' ends.
"""

from __future__ import annotations

import base64
import functools
import re

import numpy as np

#: Fixed names: the tokenizer file, the same vocabulary as ranks, and the one special string.
BYTE_BPE, BYTE_RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
SPECIAL = "<|endoftext|>"
#: A space next to other white space: there the white-space rule looks across the cut.
_SPACES = re.compile(r" \s|\s ")


class PreTokens:
    """Ids of pre-tokens through a bounded table (``capacity`` entries, about 200 bytes each).

    The table only saves work: once full, pre-tokens it lacks are encoded again in each batch.
    """

    def __init__(self, path: str, ranks_path: str, pattern: str, capacity: int = 700_000):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.ranks = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.width = np.zeros(max(ranks.values()) + 1, np.int64)
        for piece, i in ranks.items():
            self.width[i] = len(piece)
        self.capacity = capacity
        self.known: dict[str, bytes] = {}

    def chunks(self, text: str) -> list[str] | None:
        """Pre-tokens without their leading space (the first has none), or None: leave it to the library."""
        if SPECIAL in text or text[:1] == " " or text[-1:] == " " or _SPACES.search(text):
            return None
        return text.split(" ")

    def whole(self, text: str) -> np.ndarray:
        return np.asarray(self.library.encode(text, add_special_tokens=False).ids, "<u4")

    def first(self, text: str) -> np.ndarray:
        return np.asarray(self.ranks.encode_ordinary(text), "<u4")

    def lookup(self, distinct: set[str]) -> dict[str, bytes]:
        """A table that holds the ids (little-endian, 4 bytes each) of every pre-token of ``distinct``."""
        new = list(distinct.difference(self.known))
        if not new:
            return self.known
        ids = self.ranks.encode_to_numpy(" " + " ".join(new)).astype("<u4")
        ends = np.cumsum([len(c.encode()) + 1 for c in new])
        cuts = (np.searchsorted(np.cumsum(self.width[ids]), ends, side="left") + 1) * 4
        raw = ids.tobytes()
        made = {c: raw[a:b] for c, a, b in zip(new, [0, *cuts[:-1].tolist()], cuts.tolist())}
        if len(self.known) + len(made) <= self.capacity:
            self.known.update(made)
            return self.known
        made.update((c, self.known[c]) for c in distinct if c in self.known)
        return made

    def ids(self, text: str | None) -> np.ndarray:
        """All ids of ``text`` as little-endian unsigned 32-bit numbers."""
        if not text:
            return np.empty(0, "<u4")
        return self.whole(text) if SPECIAL in text else self.first(text)


@functools.cache
def worker_tokens(path: str, ranks_path: str, pattern: str) -> PreTokens:
    """One table per Python worker, kept across its tasks."""
    return PreTokens(path, ranks_path, pattern)


def vocabulary() -> tuple[str, str, str]:
    """Default paths of the tokenizer and its ranks, and the public pattern that splits text before merges."""
    import public_tokenizers

    return public_tokenizers.path(BYTE_BPE), public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN
