"""Packing documents into fixed windows by non-negative least squares on the histogram of lengths.

Every document becomes ids plus one end id. Full windows of a long document are sequences of their own;
what is left (shorter than a window) goes into a histogram of lengths. Shallow combinations (two or
three lengths that fill the window exactly) are the columns of a non-negative least squares problem
whose right side is that histogram; its solution says how often each combination is used. Counts are
rounded to what the histogram still holds, and the residual lengths are packed greedily: the largest
that fits, and when none fits, the smallest is cut to fill the window. The last open window of a task
is cut into powers of two, which need no padding.

Each task packs blocks of ``block`` remainders of its own split: the problem has a fixed size, state is
bounded, nothing shuffles, and a lost task is repeated alone with the same result.

Defined results: a null or empty text is the end id alone; repeated rows are packed once each; a null
``doc_id`` stays null; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import map_arrow, pieces, table
from .tokens import vocabulary, worker_tokens

WINDOW, END_ID, BLOCK = 2048, 1, 8192
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def combinations(lengths: np.ndarray, window: int, max_triples: int = 60_000) -> np.ndarray:
    """Index triples (i <= j <= k, k = -1 for pairs) of the sorted ``lengths`` whose sum is ``window``.

    Triples are enumerated from the longest lengths down, at most ``max_triples``; this bounds the
    columns of the problem, never the rows packed (what no combination takes is packed greedily).
    """
    where = np.full(window + 1, -1)
    where[lengths] = np.arange(len(lengths))
    i = np.arange(len(lengths))
    j = where[window - lengths]
    pairs = np.stack([i, j, np.full_like(i, -1)], 1)[(j >= i)]
    found, n = [pairs], 0
    for a in range(len(lengths) - 1, -1, -1):
        rest = window - lengths[a] - lengths[: a + 1]
        ok = rest > 0
        k = np.where(ok, where[np.maximum(rest, 0)], -1)
        b = np.flatnonzero((k >= 0) & (k <= np.arange(a + 1)))
        if len(b):
            found.append(np.stack([k[b], b, np.full(len(b), a)], 1))
            n += len(b)
            if n >= max_triples:
                break
    return np.concatenate(found)


def solve(columns: np.ndarray, target: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Non-negative x that brings A x near ``target``; A counts how often a combination uses a length.

    Multiplicative updates x * (A'b / A'Ax): they keep x non-negative and never raise the squared error.
    """
    used = columns >= 0
    safe = np.where(used, columns, 0)
    up = (target[safe] * used).sum(1)
    x = up / max(1, len(columns))
    for _ in range(rounds):
        fit = np.zeros(len(target))
        for c in range(3):
            fit += np.bincount(safe[:, c], x * used[:, c], len(target))
        x = x * up / np.maximum((fit[safe] * used).sum(1), 1e-12)
    return x


class Packer:
    """Packs remainders (row, first id, ids) block by block and yields (row, start, ids, sequence, offset)."""

    def __init__(self, first_sequence: int, window: int = WINDOW):
        self.next, self.window = first_sequence, window
        self.held: list[tuple] = []

    def sequence(self) -> int:
        self.next += 1
        return self.next - 1

    def full(self, row, start: int, ids: np.ndarray):
        return row, start, ids, self.sequence(), 0

    def add(self, row, start: int, ids: np.ndarray) -> None:
        self.held.append((row, start, ids))

    def pack(self, last: bool) -> Iterator[tuple]:
        """Pack what is held; unless ``last``, the remainders of the last open window are held over."""
        if not self.held:
            return
        stacks: dict[int, list[tuple]] = {}
        for item in self.held:
            stacks.setdefault(len(item[2]), []).append(item)
        self.held = []
        lengths = np.array(sorted(stacks))
        columns = combinations(lengths, self.window)
        if len(columns):
            have = np.array([len(stacks[n]) for n in lengths.tolist()], float)
            x = solve(columns, have)
            order = np.argsort(-x, kind="stable")
            for c in order[x[order] >= 0.5].tolist():
                parts = [int(lengths[p]) for p in columns[c] if p >= 0]
                for _ in range(int(round(x[c]))):
                    if any(len(stacks[p]) < parts.count(p) for p in set(parts)):
                        break
                    yield from self._emit([stacks[p].pop() for p in sorted(parts, reverse=True)])
        yield from self._greedy(stacks, last)

    def _emit(self, items: list[tuple]) -> Iterator[tuple]:
        seq, at = self.sequence(), 0
        for row, start, ids in items:
            yield row, start, ids, seq, at
            at += len(ids)

    def _greedy(self, stacks: dict[int, list[tuple]], last: bool) -> Iterator[tuple]:
        left = sorted((n for n, s in stacks.items() for _ in s))
        total = sum(left)
        while total >= self.window:
            items, room = [], self.window
            while room:
                at = int(np.searchsorted(left, room, side="right")) - 1
                n = left.pop(max(at, 0))
                row, start, ids = stacks[n].pop()
                if n > room:  # none fits: the smallest is cut
                    rest = n - room
                    stacks.setdefault(rest, []).append((row, start + room, ids[room:]))
                    left.insert(int(np.searchsorted(left, rest)), rest)
                    ids = ids[:room]
                items.append((row, start, ids))
                room -= len(ids)
            total -= self.window
            yield from self._emit(items)
        rest = [stacks[n].pop() for n in left]
        if not last:
            self.held = rest
            return
        while total:
            size = 1 << (total.bit_length() - 1)
            items, room = [], size
            while room:
                row, start, ids = rest.pop()
                if len(ids) > room:
                    rest.append((row, start + room, ids[room:]))
                    ids = ids[:room]
                items.append((row, start, ids))
                room -= len(ids)
            total -= size
            yield from self._emit(items)


def pack(docs: DataFrame, files: tuple[str, str, str] | None = None, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """One row per piece of every document of ``docs`` (doc_id, text); sequences are unique per task."""
    files = files or vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokens = worker_tokens(*files)
        packer = Packer(TaskContext.get().partitionId() << 36, window)
        out: list[tuple] = []

        def row(doc, n, start, ids, seq, at):
            return doc, start, len(ids), zlib.crc32(ids.tobytes()), n, seq, at

        def flush(rows: list[tuple]) -> pa.RecordBatch:
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)

        for batch in pieces(batches):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.append(tokens.ids(text), np.uint32(END_ID)).astype("<u4")
                n, whole = len(ids), len(ids) // window * window
                for start in range(0, whole, window):
                    got = packer.full((doc, n), start, ids[start:start + window])
                    out.append(row(*got[0], *got[1:]))
                if whole < n:
                    packer.add((doc, n), whole, ids[whole:].copy())
                if len(packer.held) >= block:
                    out += [row(*r[0], *r[1:]) for r in packer.pack(last=False)]
            if out:
                yield flush(out)
                out = []
        out += [row(*r[0], *r[1:]) for r in packer.pack(last=True)]
        if out:
            yield flush(out)

    return map_arrow(docs.selectExpr("cast(doc_id as long) doc_id", "text"), run, SCHEMA)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
