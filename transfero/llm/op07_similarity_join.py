"""N-gram Jaccard join: banded MinHash LSH, then exact verification.

A text is the set of its five-word shingles. There are ``TREES`` bands of MinHash
values, all of one depth: the longest, ``DEEPEST`` at most, at which two texts at the threshold are equal
in some band with probability ``RECALL``. A band's values are one label, and labels are grouped by equality.

1. Rows of equal text become one vertex (a 64-bit hash of the text) by partial aggregation.
2. Texts under one prefix are compared by 64 small MinHash values: pairs that agree on less than
   ``AGREE`` of them (five standard deviations below a pair at the threshold) are no candidates. A prefix
   with more than ``HOT`` texts needs no comparison: all its texts become candidates of each other.
3. Candidates are grouped by connected components, and every pair of a component is verified exactly, in
   blocks of ``BLOCK`` texts: a component of many blocks is all pairs of blocks, each its own group, so no
   task holds more than two blocks. Pairs are counted inside the task and never become rows.

Links are counted between documents: a text's links to other texts, weighted by their copies, plus its
own copies. ``class_id`` is the smallest id among the documents that links connect.

Defined results: a text without words is linked to nothing; a text of one to four words is one shingle
of all its words; rows that repeat id and text count as copies; null ids are never a class's smallest
id unless all are null; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, map_arrow, pieces, store, table, whole_groups
from .components import components
from .words import mix, shingles, split_words

SHINGLE, THRESHOLD = 5, 0.8
TREES, DEEPEST, RECALL = 24, 8, 0.9999
SKETCH, AGREE = 64, 0.55
HOT, BLOCK, BLOCK_BYTES = 1000, 512, 12_000_000


def prefix_depth(threshold: float, trees: int = TREES, deepest: int = DEEPEST, recall: float = RECALL) -> int:
    """The longest prefix at which a pair at ``threshold`` still meets in some tree with probability ``recall``."""
    for depth in range(deepest, 1, -1):
        if 1 - (1 - threshold ** depth) ** trees >= recall:
            return depth
    return 1


def signatures(rows: DataFrame, threshold: float) -> DataFrame:
    """``v, size, labels, sketch`` of every row of ``rows`` (v, text) that has a word."""
    depth = prefix_depth(threshold)
    rng = np.random.default_rng(17)
    n_hashes = max(TREES * depth, SKETCH)
    a = rng.integers(1, 1 << 63, n_hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(1, 1 << 63, n_hashes, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 1_000_000):
            h, row, _, _ = split_words(batch.column(1))
            h, row = shingles(h, row, SHINGLE)
            if not len(h):
                continue
            first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
            least = np.stack([np.minimum.reduceat(h * a[i] + b[i], first) for i in range(n_hashes)], 1)
            sketch = (least[:, :SKETCH] >> np.uint64(40)).astype("<u2")
            labels = np.zeros((len(first), TREES), np.uint64)
            for d in range(depth):
                labels = mix(labels * np.uint64(31) + least[:, d:TREES * depth:depth])
            some = batch.column(0).take(pa.array(row[first]))
            size = pc.binary_length(batch.column(1)).take(pa.array(row[first])).cast(pa.int64())
            flat = pa.array(labels.view(np.int64).ravel(), pa.int64())
            listed = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, TREES), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([some, size, listed, pa.array([s.tobytes() for s in sketch], pa.binary())],
                                             names=["v", "size", "labels", "sketch"])

    return map_arrow(rows.select("v", "text"), run, "v long, size long, labels array<long>, sketch binary")


def _smallest(agree: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest vertex reachable from each row of a symmetric boolean matrix."""
    low = v.copy()
    while True:
        new = np.minimum(low, np.where(agree, low[None, :], np.iinfo(np.int64).max).min(1, initial=np.iinfo(np.int64).max))
        if (new == low).all():
            return low
        low = new


def candidates(members: DataFrame) -> DataFrame:
    """Edges (a, b) between the texts of one prefix whose sketches agree; ``members``: bucket, v, sketch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "bucket", "one", 20_000):
            bucket, v = t.column("bucket").to_numpy(), t.column("v").to_numpy()
            sketch = np.frombuffer(b"".join(t.column("sketch").to_pylist()), "<u2").reshape(len(v), SKETCH)
            cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])).tolist() + [len(v)]
            a, b = [], []
            for lo, hi in zip(cuts, cuts[1:]):
                s = sketch[lo:hi]
                if hi - lo == 2:
                    low = v[lo:hi].min()
                    if (s[0] == s[1]).sum() >= AGREE * SKETCH:
                        a.append(v[lo:hi].max())
                        b.append(low)
                    continue
                agree = np.zeros((hi - lo, hi - lo), np.int16)
                for i in range(SKETCH):
                    agree += s[:, None, i] == s[None, :, i]
                low = _smallest(agree >= AGREE * SKETCH, v[lo:hi])
                for x, y in zip(v[lo:hi].tolist(), low.tolist()):
                    if x != y:
                        a.append(x)
                        b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    # enough partitions that rows of one prefix spread evenly; a prefix has HOT rows at most
    dealt = members.withColumn("one", F.lit(1).cast("long")).repartition("bucket").sortWithinPartitions("bucket", "v")
    return map_arrow(dealt, run, "a long, b long")


def verify(blocks: DataFrame, threshold: float) -> DataFrame:
    """Exact links inside every group of ``blocks`` (key, i, j, block, v, copies, size, text): ``v, low, texts, docs``."""
    def links(t: pa.Table) -> tuple[np.ndarray, ...]:
        v, copies, block = (t.column(c).to_numpy() for c in ("v", "copies", "block"))
        h, row, _, _ = split_words(t.column("text").combine_chunks())
        h, row = shingles(h, row, SHINGLE)
        order = np.lexsort((h, row))
        h, row = h[order], row[order]
        new = np.append(True, (h[1:] != h[:-1]) | (row[1:] != row[:-1]))
        h, row = h[new], row[new]
        size = np.bincount(row, minlength=len(v)).astype(np.float64)
        _, column, often = np.unique(h, return_inverse=True, return_counts=True)
        shared = often[column] > 1
        column, row = column[shared], row[shared]
        order = np.argsort(column, kind="stable")
        _, column = np.unique(column[order], return_inverse=True)
        row = row[order]
        both = np.zeros((len(v), len(v)), np.float32)
        n_columns = int(column[-1]) + 1 if len(column) else 0
        for lo in range(0, n_columns, 4096):
            x = np.zeros((len(v), min(4096, n_columns - lo)), np.float32)
            a, b = np.searchsorted(column, [lo, lo + 4096])
            x[row[a:b], column[a:b] - lo] = 1
            both += x @ x.T
        union = size[:, None] + size[None, :] - both
        linked = both >= threshold * union - 1e-9
        np.fill_diagonal(linked, False)
        if t.column("i")[0].as_py() != t.column("j")[0].as_py():
            linked &= block[:, None] != block[None, :]
        return v, _smallest(linked, v), linked.sum(1), (linked * copies[None, :]).sum(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "key", "size", 8_000_000):
            keys = np.stack([t.column(c).to_numpy() for c in ("key", "i", "j")], 1)
            cuts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(1))).tolist() + [len(keys)]
            for lo, hi in zip(cuts, cuts[1:]):
                v, low, texts, docs = links(t.slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (v, low, texts, docs)], names=["v", "low", "texts", "docs"])

    group = F.xxhash64("c", "i", "j")
    dealt = blocks.withColumn("key", group).repartition("key").sortWithinPartitions("key", "i", "j", "v")
    return map_arrow(dealt, run, "v long, low long, texts long, docs long")


def similarity_join(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, class_id, n_links, n_text_links, n_copies, text_hash`` of every row of ``docs`` (doc_id, text)."""
    return classes(docs, threshold).drop("component")


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """As ``similarity_join``, and ``component``: one value for each class, also where ids are null or used again."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("v"))
    has_word = F.rlike("text", F.lit(WORD))
    # texts of one vertex are equal, so any row's signature stands for all
    one = signatures(rows, threshold).groupBy("v").agg(*[F.first(c).alias(c) for c in ("size", "labels", "sketch")])
    signed = store(spark, one, "forest")
    labels = signed.select("v", F.posexplode("labels").alias("tree", "label")).select("v", F.xxhash64("tree", "label").alias("bucket"))
    shared = store(spark, labels.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("head")).filter("n > 1"), "forest-prefixes")
    members = store(spark, labels.join(shared, "bucket"), "forest-members")
    compared = members.filter(F.col("n") <= HOT).join(signed.select("v", "sketch"), "v").select("bucket", "v", "sketch")
    hot = members.filter((F.col("n") > HOT) & (F.col("v") != F.col("head"))).select(F.col("v").alias("a"), F.col("head").alias("b"))
    groups = components(candidates(compared).unionByName(hot), "candidates")

    sized = signed.select("v", "size").join(groups, "v")
    per = sized.groupBy("c").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("size") / BLOCK_BYTES)).cast("int").alias("nb"))
    placed = store(spark, sized.join(per, "c").select("v", "c", "nb", "size"), "candidate-blocks")
    counted = store(spark, rows.select("doc_id", F.when(has_word, F.col("v")).alias("v")).groupBy("v")
                    .agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least")).filter("v is not null"), "copies")
    # one text per vertex: partial aggregation leaves a row per task and vertex before the shuffle
    texts = rows.groupBy("v").agg(F.first("text").alias("text"))
    full = texts.join(placed, "v").join(counted.select("v", "copies"), "v")
    block = F.pmod(F.xxhash64(F.lit(1), "v"), "nb").cast("int")
    spread = full.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    spread = spread.select("c", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "v", "copies", "size", "text")
    found = store(spark, verify(spread, threshold), "links")
    sums = found.groupBy("v").agg(F.sum("texts").alias("texts"), F.sum("docs").alias("docs"))
    joined = components(found.filter("v <> low").select(F.col("v").alias("a"), F.col("low").alias("b")), "linked")
    info = (counted.join(sums, "v", "left").join(joined, "v", "left")
            .select("v", "copies", "least", F.coalesce("texts", F.lit(0)).alias("texts"), F.coalesce("docs", F.lit(0)).alias("docs"), F.coalesce("c", "v").alias("c")))
    info = store(spark, info, "link-counts")
    least = info.groupBy("c").agg(F.min("least").alias("class_id"))
    info = store(spark, info.join(least, "c").select(F.col("v").alias("u"), F.col("c").alias("component"), "copies", "texts", "docs", "class_id"), "classes")
    ids = rows.select("doc_id", F.when(has_word, F.col("v")).alias("v"))
    out = ids.join(info, F.col("v") == F.col("u"), "left")
    return out.select("doc_id", F.when(F.col("u").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                      F.coalesce(F.col("docs") + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("texts", F.lit(0)).cast("long").alias("n_text_links"),
                      F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"), F.col("v").alias("text_hash"), "component")


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs``, columns unchanged: one of each class, the first by (id, nulls last; hash of the text).

    Of rows that repeat id and text one stays; rows without words are in no class and stay.
    """
    spark = docs.sparkSession
    found = store(spark, classes(docs, threshold).filter("text_hash is not null").select("doc_id", "component", "text_hash"), "near-duplicates")
    first = (found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("one"))
             .select(F.col("one.doc_id").alias("_id"), F.col("one.text_hash").alias("_hash")))
    first = store(spark, first, "survivors")
    keyed = docs.withColumn("_v", F.xxhash64(F.coalesce("text", F.lit(""))))
    has_word = F.coalesce(F.rlike("text", F.lit(WORD)), F.lit(False))
    mine = lambda t: keyed["doc_id"].eqNullSafe(t["_id"]) & (keyed["_v"] == t["_hash"])
    again = found.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).count().filter("count > 1").drop("count")
    again = store(spark, again, "repeated-rows")
    kept = keyed.filter(has_word).join(first, mine(first), "left_semi")
    if again.limit(1).count():
        kept = kept.join(again, mine(again), "left_anti").unionByName(kept.join(again, mine(again), "left_semi").dropDuplicates(["doc_id", "_v"]))
    return kept.unionByName(keyed.filter(~has_word)).drop("_v")


def op7_similarity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_join(table(spark, sf_dir, "documents")).drop("text_hash")
