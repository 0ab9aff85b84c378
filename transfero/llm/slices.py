"""Running values within a key, over range slices of the rows: a key with most of the rows is still dealt over many tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.numbering import pin

_SUMS = {"sum": F.sum, "xor": F.bit_xor}


def running(df: DataFrame, key: list[str], order: list[str], **values: tuple[str, Column]) -> DataFrame:
    """Add each ``name=(kind, column)``: the sum (or xor) of ``column`` over the rows of the same key that come earlier.

    Rows are sorted by key and order into contiguous slices, written once. A window over (slice, key) gives the
    part within a slice. Only the last key of a slice can go on into the next one, so what earlier slices hold of
    a key is a table of one row per slice, which is broadcast. Nulls sort first and are one key; ``column`` may
    not be null. Ties beyond ``order`` are put in some order, the same for every reader.
    """
    named = df.withColumns({f"_of_{n}": c for n, (_, c) in values.items()})
    tagged = pin(named, [F.col(c).asc_nulls_first() for c in [*key, *order]])
    before = Window.partitionBy("_pin_part", *key).orderBy("_pin_pos").rowsBetween(Window.unboundedPreceding, -1)
    within = tagged.withColumns({n: F.coalesce(_SUMS[kind](f"_of_{n}").over(before), F.lit(0)) for n, (kind, _) in values.items()})

    keys = {c: f"_key_{i}" for i, c in enumerate(key)}
    same = lambda left, right: [F.col("_pin_part") == F.col("_part"), *[left[c].eqNullSafe(right[k]) for c, k in keys.items()]]
    last = tagged.groupBy(F.col("_pin_part").alias("_part")).agg(
        F.max_by(F.struct(*[F.col(c).alias(k) for c, k in keys.items()]), "_pin_pos").alias("_last"))
    last = last.select("_part", *[F.col(f"_last.{k}").alias(k) for k in keys.values()])
    ends = (tagged.join(F.broadcast(last), same(tagged, last)).groupBy("_part", *keys.values())
            .agg(*[_SUMS[kind](f"_of_{n}").alias(f"_end_{n}") for n, (kind, _) in values.items()]))
    so_far = Window.partitionBy(*keys.values()).orderBy("_part")
    carry = ends.select(F.lead("_part").over(Window.orderBy("_part")).alias("_part"), *keys.values(),
                        *[_SUMS[kind](f"_end_{n}").over(so_far).alias(f"_end_{n}") for n, (kind, _) in values.items()])
    joined = within.join(F.broadcast(carry), same(within, carry), "left")
    out = {n: (F.col(n).bitwiseXOR(c) if kind == "xor" else F.col(n) + c).cast("long")
           for n, (kind, _) in values.items() for c in [F.coalesce(F.col(f"_end_{n}"), F.lit(0))]}
    return joined.select(*[F.col(c) for c in df.columns if c not in out], *[c.alias(n) for n, c in out.items()])
