"""Ordered per-key operator: chained fill over range slices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .numbering import pin


def fill_within(df: DataFrame, key: Sequence[str], cut: str, order: Sequence[str], value: str, fillable: Column, empty: Column,
                out: str) -> DataFrame:
    """First half of ``chained_fill`` for rows that lie by range of ``key`` and ``cut``: ``out`` = value of the last
    non-fillable row before each row in its (key, cut), NULL if none. Rows are not moved, so it can run in the task that
    writes them; ``cut`` is NULL for keys that are not cut."""
    anchor = F.when(~F.coalesce(fillable, F.lit(False)), F.coalesce(F.col(value), empty))
    before = Window.partitionBy(*key, cut).orderBy(*[F.col(c).asc_nulls_first() for c in order]) \
        .rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(out, F.last(anchor, ignorenulls=True).over(before))


def _carry_over_cuts(df: DataFrame, key: Sequence[str], cut: str, order: str, value: str, fill: Column, empty: Column) -> DataFrame:
    """Last non-fillable value before each cut of a cut key: one row per key that is cut and cut of it."""
    own = F.coalesce(F.col(value), empty)
    last = df.filter(F.col(cut).isNotNull()).groupBy(*key, cut).agg(
        F.max_by(F.when(~fill, own), F.when(~fill, F.col(order))).alias("_cf_last"))
    before = Window.partitionBy(*key).orderBy(cut).rowsBetween(Window.unboundedPreceding, -1)
    return last.select(*[F.col(k).alias(f"_cf_k{i}") for i, k in enumerate(key)], F.col(cut).alias("_cf_cut"),
                       F.last("_cf_last", ignorenulls=True).over(before).alias("_cf_carry"))


def chained_fill(df: DataFrame, key: Sequence[str], order: str, value: str, fillable: Column, empty: Column | None = None,
                 within: str | None = None, cut: str | None = None) -> DataFrame:
    """Give each ``fillable`` row the value of the row before it in the same key, chaining through
    rows filled the same way; a non-fillable predecessor contributes ``coalesce(value, 0)`` and a
    fillable run at the start of a key gets 0.

    That is the value of the last non-fillable row before it in its key (0 if none). Computed as a
    scan over range slices so a key with very many rows is still split over many tasks:
    within a slice, a window over (slice, key) carries the last non-fillable value; across slices,
    a table with one row per slice carries the last non-fillable (key, value) into the next slice.

    Rows that ``fill_within`` has seen (``within``: its column, ``cut``: as there) are not moved again: only keys cut
    into several ranges need a value carried over, and that table has one row per cut of such a key. ``empty`` stands
    for 0 where ``value`` is not a number.
    """
    if within:
        zero = F.lit(0) if empty is None else empty
        fill = F.coalesce(fillable, F.lit(False))
        carries = _carry_over_cuts(df, key, cut, order, value, fill, zero)
        same = [*[F.col(k).eqNullSafe(F.col(f"_cf_k{i}")) for i, k in enumerate(key)], F.col(cut) == F.col("_cf_cut")]
        filled = F.when(fill, F.coalesce(F.col(within), F.col("_cf_carry"), zero)).otherwise(F.col(value))
        joined = df.join(F.broadcast(carries), same, "left")
        return joined.select(*[filled.alias(c) if c == value else F.col(c) for c in df.columns])
    order_cols = [*[F.col(k).asc_nulls_first() for k in key], F.col(order).asc_nulls_first()]
    base = df.withColumn("_cf_fill", F.coalesce(fillable, F.lit(False)))
    tagged = pin(base, order_cols).withColumnRenamed("_pin_part", "_cf_part").drop("_pin_pos")
    anchor = F.when(~F.col("_cf_fill"), F.coalesce(F.col(value), F.lit(0)))
    w_local = (Window.partitionBy("_cf_part", *key).orderBy(F.col(order).asc_nulls_first())
               .rowsBetween(Window.unboundedPreceding, -1))
    tagged = tagged.withColumn("_cf_local", F.last(anchor, ignorenulls=True).over(w_local))

    # Last anchor of every slice (one row per slice), then the latest one strictly before each slice.
    last_in_part = (tagged.filter(~F.col("_cf_fill"))
                    .groupBy("_cf_part")
                    .agg(F.max_by(F.struct(*[F.col(k) for k in key], F.coalesce(F.col(value), F.lit(0)).alias("_v")),
                                  F.struct(*[F.col(k) for k in key], F.col(order))).alias("_cf_last")))
    parts = tagged.select("_cf_part").distinct()
    w_carry = Window.orderBy("_cf_part").rowsBetween(Window.unboundedPreceding, -1)
    carries = (parts.join(last_in_part, "_cf_part", "left")
               .select("_cf_part", F.last("_cf_last", ignorenulls=True).over(w_carry).alias("_cf_carry")))
    joined = tagged.join(F.broadcast(carries), "_cf_part", "left")
    same_key = F.lit(True)
    for k in key:
        same_key = same_key & F.col("_cf_carry")[k].eqNullSafe(F.col(k))
    carried = F.when(same_key, F.col("_cf_carry")["_v"])
    filled = F.coalesce(F.col("_cf_local"), carried, F.lit(0))
    out = joined.withColumn(value, F.when(F.col("_cf_fill"), filled).otherwise(F.col(value)).cast(df.schema[value].dataType))
    return out.select(*df.columns)

