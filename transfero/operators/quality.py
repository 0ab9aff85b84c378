"""Split rows into accepted and rejected-with-reason instead of skipping or crashing."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Split(tuple):
    """(accepted, rejected) of one frame whose ``reason`` is NULL for accepted rows: stored once, it serves both."""

    def __new__(cls, tagged: DataFrame, *only_rejected: str):
        accepted = tagged.filter(F.col("reason").isNull()).drop("reason", *only_rejected)
        split = super().__new__(cls, (accepted, tagged.filter(F.col("reason").isNotNull())))
        split.tagged, split.only_rejected = tagged, only_rejected
        return split


def arithmetic(*columns: str) -> dict[str, Column]:
    """Rule: a NULL among the operands, which would make the result NULL."""
    return {"NULL arithmetic input": reduce(or_, [F.col(c).isNull() for c in columns])}


def quality_split(df: DataFrame, rules: dict[str, Column]) -> Split:
    """Apply ``rules`` (reason -> predicate that marks a bad row) in order.

    Returns (accepted, rejected); rejected keeps every input column plus ``reason`` (the first rule
    that matched). A predicate that evaluates to NULL counts as not matched. Accepted + rejected
    always equals the input: nothing is silently dropped.
    """
    reason = F.lit(None).cast("string")
    for name, pred in reversed(list(rules.items())):
        reason = F.when(F.coalesce(pred, F.lit(False)), F.lit(name)).otherwise(reason)
    return Split(df.withColumn("reason", reason))


def key_split(df: DataFrame, key: list[str], order: list[str]) -> Split:
    """The target's key constraint: the first row of every key by ``order`` is accepted, the others are rejected.

    A NULL in the key is rejected as well. ``order`` need not tell all rows apart: the remaining columns settle
    ties, and of rows equal in every column one is accepted; rejected rows come once, with their number as ``n_rows``. Equal rows are counted, and every key is
    reduced to its number of rows and its first row, both by partial aggregates; only keys with several rows are
    joined back. A key with most of the rows is therefore never sorted or gathered in one task.
    """
    rest = [c for c in df.columns if c not in key and c not in order]
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    rank = F.struct(*[F.col(c) for c in [*order, *rest]])
    clashes = (df.filter(reduce(and_, [F.col(c).isNotNull() for c in key])).groupBy(*key)
               .agg(F.count(F.lit(1)).alias("_n"), F.min(rank).alias("_first")).filter("_n > 1").drop("_n"))
    clashes = clashes.withColumnsRenamed({c: f"_key_{c}" for c in key})
    found = counted.join(clashes, [counted[c] == clashes[f"_key_{c}"] for c in key], "left")
    first = F.col("_first").isNull() | (rank == F.col("_first"))
    no_key = reduce(or_, [F.col(c).isNull() for c in key])
    duplicate = F.lit("duplicate key")
    one, copies = F.lit(1).cast("long"), F.col("_copies")
    tag = lambda reason, n: F.struct(F.lit(reason).cast("string").alias("reason"), n.alias("n_rows"))
    tags = (F.when(no_key, F.array(tag("NULL in key", copies))).when(~first, F.array(tag("duplicate key", copies)))
            .otherwise(F.array(tag(None, one), tag("duplicate key", copies - 1))))
    found = found.withColumn("_tag", F.explode(tags)).select(*df.columns, "_tag.reason", "_tag.n_rows").filter("n_rows > 0")
    return Split(found, "n_rows")
