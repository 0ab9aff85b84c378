"""Mixing sources to target weights by hash-threshold histograms (DataFrame and SQL functions only).

Targets: source weights repeat 5, 2, 1 in code-point order (null last) and share the whole size; a
target stops at ``cap`` times its source's size and the excess is shared again by weight.

Selection: each row has a 64-bit hash of its id and text. A source is taken whole ``floor(target /
size)`` times, and once more below a hash threshold. The threshold is found without sorting rows: sizes
are summed by source and the hash's top bits, the bucket in which the running sum meets the budget is
refined by the next bits, and only rows of that one bucket are read again; the last step works on
(hash, id, size) groups. Rows of the group at the threshold share what is left of the budget, so a
source misses its target by less than one word per tied row.

The histograms are partial sums before their shuffle, so a source with a third of all rows costs one
row per bucket and task. Per-source tables have one row per source.

Defined results: null text has size 0 and is never taken; null is a source of its own; a source of size
0 has target 0; repeated rows tie and are treated alike; other columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, store, table

WEIGHTS, CAP = (5, 2, 1), 3
#: Bits of the hash that each histogram level looks at, from the top.
LEVELS = (12, 24, 36)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``source, source_size, target`` from one row per source (source, source_size).

    With level L a target is min(cap * size, L * weight). Sources are ordered by the level at which they
    reach their cap. Where the level that those not yet capped would share stays under the next cap, it
    only falls further on, so L is the highest such level.
    """
    everything = Window.orderBy("cap_level", F.col("source").asc_nulls_last())
    before = everything.rowsBetween(Window.unboundedPreceding, -1)
    place = Window.orderBy(F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    w = (sizes.withColumn("weight", F.get(F.array(*[F.lit(float(x)) for x in weights]),
                                         (F.row_number().over(place) - 1) % len(weights)))
         .withColumn("cap_level", cap * F.col("source_size") / F.col("weight"))
         .withColumn("level", (F.sum("source_size").over(whole) - F.coalesce(F.sum(cap * F.col("source_size")).over(before), F.lit(0)))
                     / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))))
    found = F.max(F.when(F.col("level") <= F.col("cap_level"), F.col("level"))).over(whole)
    return (w.withColumn("found", found)
            .select("source", "source_size",
                    F.least(cap * F.col("source_size").cast("double"),
                            F.coalesce(F.col("found"), F.lit(0.0)) * F.col("weight")).alias("target")))


def small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """``df`` (a stored table) marked for broadcast if it has at most ``rows`` rows: sources are few, rows many,
    and a join dealt by source would use no more tasks than there are sources."""
    return F.broadcast(df) if df.count() <= rows else df


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``doc_id, source, h, size, source_size, target, taken`` for every row of ``docs``."""
    spark = docs.sparkSession
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = store(spark, docs.select("doc_id", "source", size.alias("size"),
                                    F.xxhash64("doc_id", "text").alias("h")), "mix")
    top = lambda bits: F.shiftrightunsigned("h", 64 - bits)
    first = rows.groupBy("source", top(LEVELS[0]).alias("bucket")).agg(F.sum("size").alias("words"))
    sizes = first.groupBy("source").agg(F.sum("words").alias("source_size"))
    # budget: words of the last, partial pass over the source
    edge = (targets(sizes, weights, cap)
            .withColumn("words", F.round("target").cast("long"))
            .withColumn("passes", F.when(F.col("source_size") > 0, F.expr("words div source_size")).otherwise(F.lit(0).cast("long")))
            .withColumn("budget", F.col("words") - F.col("passes") * F.col("source_size")).drop("words"))
    edge = store(spark, edge, "mix-target")
    at = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    histogram, taken_below = first, edge.withColumn("bucket", F.lit(None).cast("long"))
    for level, bits in enumerate(LEVELS):
        if level:
            known = small(taken_below).select(F.col("source").alias("s"), F.col("bucket").alias("b"))
            near = rows.join(known, rows["source"].eqNullSafe(known["s"]) & (top(LEVELS[level - 1]) == F.col("b")), "left_semi")
            histogram = near.groupBy("source", top(bits).alias("bucket")).agg(F.sum("size").alias("words"))
        run = (histogram.withColumn("sum", F.sum("words").over(at))
               .select(F.col("source").alias("s"), F.col("bucket").alias("b"), (F.col("sum") - F.col("words")).alias("below"), "sum"))
        left = taken_below.drop("bucket")
        meets = (left.join(run, left["source"].eqNullSafe(run["s"]) & (F.col("below") <= F.col("budget")) & (F.col("budget") < F.col("sum")))
                 .select("source", "source_size", "target", "passes", (F.col("budget") - F.col("below")).alias("budget"), F.col("b").alias("bucket")))
        taken_below = store(spark, meets, f"mix-level{level}")
    # the last bucket: groups of equal (hash, id, size), of which the one at the threshold shares the rest
    known = small(taken_below).select(F.col("source").alias("s"), F.col("bucket").alias("b"), "budget")
    groups = (rows.join(known, rows["source"].eqNullSafe(known["s"]) & (top(LEVELS[-1]) == F.col("b")))
              .groupBy("source", "budget", "h", "doc_id", "size").agg(F.count(F.lit(1)).alias("n")))
    order = Window.partitionBy("source").orderBy("h", F.col("doc_id").asc_nulls_last(), "size").rowsBetween(Window.unboundedPreceding, 0)
    last = (groups.withColumn("sum", F.sum(F.col("size") * F.col("n")).over(order))
            .withColumn("below", F.col("sum") - F.col("size") * F.col("n"))
            .filter((F.col("below") <= F.col("budget")) & (F.col("budget") < F.col("sum")))
            .select(F.col("source").alias("s"), F.col("h").alias("edge_h"), F.col("doc_id").alias("edge_id"), F.col("size").alias("edge_size"),
                    F.floor((F.col("budget") - F.col("below")) / F.col("n")).alias("share")))
    per_source = edge.join(last, edge["source"].eqNullSafe(last["s"]), "left").drop("s")
    per_source = per_source.select(F.col("source").alias("s"), "source_size", "target", "passes", "budget", "edge_h", "edge_id", "edge_size", "share")
    per_source = small(store(spark, per_source, "mix-edges"))
    # unsigned order of the hash is the order of its buckets
    unsigned = lambda c: F.col(c).bitwiseXOR(F.lit(-(1 << 63)))
    here = F.struct(unsigned("h"), F.coalesce(F.col("doc_id"), F.lit((1 << 63) - 1)), F.col("size"))
    edge_at = F.struct(unsigned("edge_h"), F.coalesce(F.col("edge_id"), F.lit((1 << 63) - 1)), F.col("edge_size"))
    extra = (F.when(F.col("edge_h").isNull(), F.lit(0))
             .when(here < edge_at, F.col("size"))
             .when(here == edge_at, F.least(F.col("share"), F.col("size"))).otherwise(F.lit(0)))
    return (rows.join(per_source, rows["source"].eqNullSafe(per_source["s"]), "left")
            .select("doc_id", "source", "h", "size", "source_size", "target",
                    (F.col("passes") * F.col("size") + extra).cast("long").alias("taken")))


def mixture(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """The mix itself, with the columns of ``docs``: each row, always whole, as often as its words are taken.

    A row of which ``taken`` words are taken comes ``taken / size`` times, rounded; only rows at a source's threshold
    are taken in part, so a source misses its target by half a text, times the rows that tie there. Rows without
    words are not taken. Rows are found by id and text, so repeated rows are taken alike.
    """
    taken = mix(docs, weights, cap).filter("taken > 0")
    # equal (doc_id, size) rows of one source share their count; one row per key keeps the join from multiplying
    plan = taken.groupBy(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"), F.col("h").alias("_h")).agg(F.max("taken").alias("_taken"))
    plan = plan.withColumn("_copies", F.round(F.col("_taken") / F.col("_size")).cast("int")).filter("_copies > 0")
    keyed = docs.withColumn("_h0", F.xxhash64("doc_id", "text"))
    found = keyed.join(plan, keyed["doc_id"].eqNullSafe(plan["_id"]) & keyed["source"].eqNullSafe(plan["_source"]) & (keyed["_h0"] == plan["_h"]))
    copies = found.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return copies.select(*[F.col(f"`{c}`") for c in docs.columns])


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
