"""Substring dedup: passages of ``WINDOW`` words that occur anywhere else are removed, by FM-indexes.

Every window of 35 words has an anchor: the smallest hash among its six-word grams (the leftmost, if
equal). Equal windows have equal anchors, and neighbouring windows mostly share one, so a text falls into
segments (runs of windows with one anchor, 64 words at most), and only segments of one anchor can repeat
each other's windows. Anchors send segments to shards: nothing is compared across shards, and no window
is lost.

1. Rows of equal text become one row with a weight (partial aggregation first), kept as a table bucketed
   by text, so that later joins to texts move only their small side.
2. Anchors that occur once are dropped; equal segments are counted. Where all segments of an anchor are
   equal, the count decides. A segment that occurs twice or more repeats as a whole.
3. For other anchors, one copy of each distinct segment goes to its shard: an FM-index over the shard's
   segments, whose backward search gives the matching statistics of every segment that occurs once.
   Windows matched at full length with total weight 2 or more repeat. Shards hold whole anchors and about
   ``SHARD`` words. The segments of an anchor with more than ``HOT`` occurrences never go to a shard: their
   windows are counted by a 128-bit hash (partial sums before the shuffle), and those with weight 2 or more
   are joined back to their segments, the most common ones by broadcast, so no task holds all texts that
   share a passage.
4. Repeated windows go back to their texts, which are cut and hashed.

Words are compared by 64-bit hashes, texts by 64-bit hashes of the whole text.

Defined results: null and empty texts have 0 words and the hash of the empty string; texts under 35 words
lose nothing; rows that repeat a text repeat all its windows; other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import map_arrow, pieces, store, table, whole_groups
from .fm_index import FMIndex
from .words import grams, split_words

WINDOW, GRAM = 35, 6
SHARD, HOT = 400_000, 4_000
#: Window hashes that occur more often than HOT and the ``1 / COMMON`` part of all are joined by broadcast, so COMMON is the most there can be.
COMMON = 50_000
_B = np.uint64(0xD1342543DE82EF95)
_B_INVERSE = np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))
_WINDOW_BASES = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)


def anchors(h: np.ndarray, row: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, ...]:
    """Segments of all rows: (first word, number of windows, anchor hash, segment hash), words counted over ``h``."""
    if len(h) < window:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    g = grams(h, GRAM)
    width = window - GRAM + 1  # grams in a window
    best, span = np.arange(len(g)), 1
    while span * 2 <= width:
        left, right = best[: len(best) - span], best[span:]
        best = np.where(g[left] <= g[right], left, right)
        span *= 2
    left, right = best[: len(h) - window + 1], best[width - span:][: len(h) - window + 1]
    best = np.where(g[left] <= g[right], left, right)
    whole = np.flatnonzero(row[: len(best)] == row[window - 1:])
    if not len(whole):
        return tuple(np.empty(0, np.int64) for _ in range(4))
    best = best[whole]
    new = np.append(True, (best[1:] != best[:-1]) | (whole[1:] != whole[:-1] + 1))
    first = whole[new]
    count = np.diff(np.append(np.flatnonzero(new), len(whole)))
    # hash of a segment's words: difference of prefix sums, shifted back to place 0
    power = np.cumprod(np.full(len(h), _B))
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * power)])
    back = np.cumprod(np.full(len(h), _B_INVERSE))
    segment = (prefix[first + count + window - 1] - prefix[first]) * back[first] + count.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return first, count, g[best[new]].view(np.int64), segment.view(np.int64)


def segments(texts: DataFrame) -> DataFrame:
    """``v, first, windows, anchor, segment, weight`` of every distinct text (v, weight, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            h, row, _, _ = split_words(batch.column(2))
            first, count, anchor, segment = anchors(h, row)
            if not len(first):
                continue
            starts = np.searchsorted(row, np.arange(batch.num_rows))
            rows = row[first]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), pa.array(first - starts[rows], pa.int64()), pa.array(count, pa.int32()),
                 pa.array(anchor, pa.int64()), pa.array(segment, pa.int64()), batch.column(1).take(pa.array(rows))],
                names=["v", "first", "windows", "anchor", "segment", "weight"])

    return map_arrow(texts.select("v", "weight", "text"), run, "v long, first long, windows int, anchor long, segment long, weight long")


def cut_segments(found: DataFrame) -> DataFrame:
    """Words of the wanted segments: rows (text, list of (first, windows, anchor, segment, weight)) to shard items."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            out: list[tuple] = []
            for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = text.encode().split()
                for s in wanted:
                    at, n = s["first"], s["windows"]
                    out.append((s["anchor"], s["segment"], s["weight"], n + WINDOW - 1, b" ".join(words[at:at + n + WINDOW - 1])))
            if out:
                c = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(x, pa.int64()) for x in c[:4]], pa.array([x.decode() for x in c[4]], pa.string())],
                    names=["anchor", "segment", "weight", "words", "body"])

    return map_arrow(found.select("text", "wanted"), run, "anchor long, segment long, weight long, words long, body string")


def window_hashes(h: np.ndarray, place: np.ndarray, base: int) -> np.ndarray:
    """Hash of the ``WINDOW`` words from each ``place`` on: difference of prefix sums, shifted back to place 0."""
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * np.cumprod(np.full(len(h), np.uint64(base))))])
    back = np.cumprod(np.full(len(h), np.uint64(pow(base, -1, 1 << 64))))
    return ((prefix[place + WINDOW] - prefix[place]) * back[place]).view(np.int64)


def cut_windows(found: DataFrame) -> DataFrame:
    """``anchor, segment, bit, weight, h0, h1`` of every window of the wanted segments: rows as for ``cut_segments``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 1_000_000):
            h, row, _, _ = split_words(batch.column(0))
            wanted = batch.column(1)
            owner = np.repeat(np.arange(batch.num_rows), pc.list_value_length(wanted).to_numpy(zero_copy_only=False))
            s = {c: pc.struct_field(wanted.flatten(), c).to_numpy(zero_copy_only=False) for c in ("first", "windows", "anchor", "segment", "weight")}
            which = np.repeat(np.arange(len(owner)), s["windows"])
            bit = np.arange(len(which)) - np.repeat(np.cumsum(s["windows"]) - s["windows"], s["windows"])
            place = (np.searchsorted(row, owner) + s["first"])[which] + bit
            yield pa.RecordBatch.from_arrays(
                [pa.array(s["anchor"][which], pa.int64()), pa.array(s["segment"][which], pa.int64()), pa.array(bit, pa.int32()),
                 pa.array(s["weight"][which], pa.int64()), *[pa.array(window_hashes(h, place, b), pa.int64()) for b in _WINDOW_BASES]],
                names=["anchor", "segment", "bit", "weight", "h0", "h1"])

    return map_arrow(found.select("text", "wanted"), run, "anchor long, segment long, bit int, weight long, h0 long, h1 long")


def counted(windows: DataFrame) -> DataFrame:
    """``anchor, segment, mask``: windows whose hash has total weight 2 or more.

    A hash of more than ``most`` rows is never dealt: there are at most ``COMMON`` of them, which are broadcast.
    """
    spark = windows.sparkSession
    windows = store(spark, windows, "hot-windows")
    most = max(HOT, windows.count() // COMMON)
    repeated = store(spark, windows.groupBy("h0", "h1").agg(F.sum("weight").alias("total"), F.count(F.lit(1)).alias("rows")).filter("total > 1"), "hot-repeats")
    common = F.broadcast(repeated.filter(F.col("rows") > most).select("h0", "h1"))
    others = windows.join(common, ["h0", "h1"], "left_anti").join(repeated.filter(F.col("rows") <= most).select("h0", "h1"), ["h0", "h1"], "left_semi")
    found = windows.join(common, ["h0", "h1"], "left_semi").unionByName(others)
    return found.groupBy("anchor", "segment").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask"))


def matched(items: DataFrame) -> DataFrame:
    """``anchor, segment, mask``: repeated windows of the items, by an FM-index per shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "anchor", "words", SHARD):
            h, row, _, _ = split_words(t.column("body").combine_chunks())
            _, words = np.unique(h, return_inverse=True)
            starts = np.searchsorted(row, np.arange(len(t)))
            lengths = np.diff(np.append(starts, len(words)))
            weight = t.column("weight").to_numpy()
            index = FMIndex(words, starts, weight)
            once = np.flatnonzero(weight == 1)  # heavier ones repeat as a whole and need no search
            mask = index.repeated(words, starts[once], lengths[once], WINDOW)
            hit = mask != 0
            rows = pa.array(once[hit])
            yield pa.RecordBatch.from_arrays(
                [t.column(c).take(rows).combine_chunks() for c in ("anchor", "segment")] + [pa.array(mask[hit], pa.int64())],
                names=["anchor", "segment", "mask"])

    dealt = items.repartition("anchor").sortWithinPartitions("anchor")
    return map_arrow(dealt, run, "anchor long, segment long, mask long")


def cut_texts(rows: DataFrame) -> DataFrame:
    """``v, n_words, n_removed, kept_sha256`` of rows (v, text, repeats: list of (first, mask))."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            n_words, n_removed, sha = [], [], []
            for text, repeats in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = text.encode().split()
                n_words.append(len(words))
                removed = 0
                if repeats:
                    change = np.zeros(len(words) + 1, np.int64)
                    for s in repeats:
                        bits, at = s["mask"] & ((1 << 64) - 1), s["first"]
                        while bits:
                            i = (bits & -bits).bit_length() - 1
                            change[at + i] += 1
                            change[at + i + WINDOW] -= 1
                            bits &= bits - 1
                    gone = np.cumsum(change[:-1]) > 0
                    removed = int(gone.sum())
                    words = [w for w, x in zip(words, gone.tolist()) if not x]
                n_removed.append(removed)
                sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(sha, pa.string())],
                                             names=["v", "n_words", "n_removed", "kept_sha256"])

    return map_arrow(rows.select("v", "text", "repeats"), run, "v long, n_words long, n_removed long, kept_sha256 string")


def substring_dedup(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("v"))
    name = f"llm_texts_{uuid.uuid4().hex}"
    buckets = min(100_000, int(spark.conf.get("spark.sql.shuffle.partitions")))
    (rows.groupBy("v").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("weight")).write.bucketBy(buckets, "v")
     .option("path", f"{ensure_checkpoint_dir(spark)}/{name}").option("compression", "zstd").format("parquet").saveAsTable(name))
    texts = spark.table(name)

    every = segments(texts)
    anchor = every.groupBy("anchor").agg(F.sum("weight").alias("n")).filter("n > 1")
    anchor = store(spark, anchor.select(F.col("anchor").alias("a"), "n"), "anchors")
    shared = store(spark, every.join(anchor, F.col("anchor") == F.col("a")).drop("a"), "segments")
    distinct = store(spark, shared.groupBy("anchor", "segment", "n", "windows").agg(F.sum("weight").alias("weight"), F.min(F.struct("v", "first")).alias("one")), "distinct-segments")
    asked = distinct.filter(F.col("weight") < F.col("n")).select(F.col("one.v").alias("v"), F.struct(
        F.col("one.first").alias("first"), "windows", "anchor", "segment", "weight").alias("s"), (F.col("n") > HOT).alias("hot"))
    wanted = lambda some: texts.select("v", "text").join(asked.filter(some).groupBy("v").agg(F.collect_list("s").alias("wanted")), "v")
    searched = matched(cut_segments(wanted("not hot")))
    if asked.filter("hot").limit(1).count():
        searched = searched.unionByName(counted(cut_windows(wanted("hot"))))
    all_windows = F.expr("shiftleft(1L, windows) - 1")
    masks = (distinct.filter("weight > 1").select("anchor", "segment", all_windows.alias("mask"))
             .unionByName(searched).groupBy("anchor", "segment").agg(F.bit_or("mask").alias("mask")))
    masks = store(spark, masks, "masks")
    hit = shared.select("v", "first", "anchor", "segment").join(masks, ["anchor", "segment"])
    repeats = hit.groupBy("v").agg(F.collect_list(F.struct("first", "mask")).alias("repeats"))
    cut = store(spark, cut_texts(texts.select("v", "text").join(repeats, "v", "left")), "cut-texts")
    spark.sql(f"DROP TABLE {name}")
    return rows.select("doc_id", "v").join(cut, "v").select("doc_id", "n_words", "n_removed", "kept_sha256")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))
