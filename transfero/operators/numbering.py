"""Deterministic numbering without single-task windows.

``row_number() OVER (ORDER BY ...)`` with no PARTITION BY moves every row to one task, and
``row_number() OVER (PARTITION BY g ...)`` puts a whole group in one task, which fails when one group
holds a large share of the data. The operators here number rows with range partitioning instead:

1. ``repartitionByRange`` on the full (total) order, so even a very large group is split over many
   contiguous slices, and ``sortWithinPartitions`` on the same order;
2. each slice is written once to the shared checkpoint folder with every row's (slice, position in
   slice), taken from ``monotonically_increasing_id`` in the writing task, so counting and numbering
   read identical data on every executor and after any retry;
3. a running sum over the per-slice counts gives each slice's offset. That table has one row per
   slice, so its size is bounded by the partition count, never by the data, and it is broadcast.

Group-relative numbers (a counter that restarts per group) are taken within (slice, group) and go on from the rows
that the group has in earlier slices: only the last group of a slice can go on, so that table has one row per slice too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import zfill
from ..session import is_planning, scratch_path, shuffle_files_removed

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row position in its lower 33 bits


def _as_order(cols: Sequence[Column | str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in cols]


def pin(df: DataFrame, order: Sequence[Column] | None = None, lying: bool = False) -> DataFrame:
    """Write ``df`` as a table in the session's checkpoint folder and read it back (lineage cut).

    With ``order``, rows are range-partitioned and sorted on it, and each row is written with its
    slice (``_pin_part``) and its position in the slice (``_pin_pos``), both taken in the task that
    writes the slice. The assignment is therefore frozen in shared storage: later stages and retried
    tasks read the same numbers. The input is cached first so that range sampling and the write do not
    run the plan above twice; a frame the caller has cached is used as it is and stays cached. With ``lying`` the caller has range-partitioned
    the rows already, by columns that sort as ``order`` does, and they are only sorted. The table is plain parquet, so readers get column pruning and pushdown.
    """
    if is_planning():  # only the shape of the plan is asked for
        return df.withColumn("_pin_part", F.lit(0).cast("long")).withColumn("_pin_pos", F.lit(0).cast("long"))
    spark = df.sparkSession
    path = scratch_path(spark, "pinned")
    own_cache = bool(order) and not lying and df.storageLevel == StorageLevel.NONE
    cached = df.persist(StorageLevel.MEMORY_AND_DISK) if own_cache else df
    try:
        ranged = cached if lying or not order else cached.repartitionByRange(*order)
        ranged = ranged.sortWithinPartitions(*order) if order else ranged
        with shuffle_files_removed(spark):
            ranged.withColumn("_pin_mid", F.monotonically_increasing_id()).write.parquet(path)
    finally:
        if own_cache:
            cached.unpersist()
    back = spark.read.parquet(path)
    return (back.withColumn("_pin_part", F.shiftright(F.col("_pin_mid"), _LOCAL_BITS))
            .withColumn("_pin_pos", F.col("_pin_mid").bitwiseAND((1 << _LOCAL_BITS) - 1))
            .drop("_pin_mid"))


def global_number(df: DataFrame, order: Sequence[Column | str], out: str,
                  start: Column | int = 0, lying: bool = False) -> DataFrame:
    """Add ``out`` = 1-based position of each row in ``order`` plus ``start`` (``lying``: see ``pin``).

    ``order`` must be a total order (end it with a unique key); columns given as strings sort
    ascending with NULLs first, like SQL Server. ``start`` may be a literal or a Column (e.g. a
    ``max`` taken from an existing table and joined in as a one-row frame).
    """
    order_cols = _as_order(order)
    tagged = pin(df, order_cols, lying)
    counts = tagged.groupBy("_pin_part").agg(F.count(F.lit(1)).alias("_gn_n"))
    # One row per slice: the window below is over the slice table, not over the data.
    offsets = counts.select(
        "_pin_part",
        F.coalesce(F.sum("_gn_n").over(Window.orderBy("_pin_part").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_gn_off"))
    start_col = start if isinstance(start, Column) else F.lit(start)
    numbered = tagged.join(F.broadcast(offsets), "_pin_part")
    return (numbered.withColumn(out, (F.col("_gn_off") + F.col("_pin_pos") + 1 + start_col).cast("long"))
            .drop("_pin_part", "_pin_pos", "_gn_off"))


def _carried(tagged: DataFrame, key: Sequence[str], out: str) -> DataFrame:
    """Rows of a slice's first key in earlier slices: one row per slice that goes on with the key before (``_c_part``,
    the key under numbered names, ``out``). Only the last key of a slice can go on, so each slice contributes one."""
    names = {c: f"_c_{i}" for i, c in enumerate(key)}
    last = tagged.groupBy(F.col("_pin_part").alias("_c_part")).agg(
        F.max_by(F.struct(*[F.col(c).alias(n) for c, n in names.items()]), "_pin_pos").alias("_c_last"))
    last = last.select("_c_part", *[F.col(f"_c_last.{n}").alias(n) for n in names.values()])
    same = [tagged["_pin_part"] == last["_c_part"], *[tagged[c].eqNullSafe(last[n]) for c, n in names.items()]]
    ends = tagged.join(F.broadcast(last), same).groupBy("_c_part", *names.values()).agg(F.count(F.lit(1)).alias("_c_n"))
    # windows over the table of slices, not over the data
    return ends.select(F.lead("_c_part").over(Window.orderBy("_c_part")).alias("_c_part"), *names.values(),
                       F.sum("_c_n").over(Window.partitionBy(*names.values()).orderBy("_c_part")).alias(out))


def group_number(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], out: str,
                 start: Column | int = 0, lying: bool = False) -> DataFrame:
    """Counter restarting at 1 (+ ``start``) in each group, in ``order`` (total within the group).

    A row's number is its place among the rows of its group in its slice plus the group's rows in earlier slices,
    so a group with most of the rows is numbered slice by slice. With ``lying`` the rows lie by some of ``group`` already
    and no group is large: each is sorted where it lies, and nothing is moved or written.
    """
    if lying:
        place = F.row_number().over(Window.partitionBy(*group).orderBy(*_as_order(order)))
        return df.withColumn(out, (place + (start if isinstance(start, Column) else F.lit(start))).cast("long"))
    tagged = pin(df, [*_as_order(group), *_as_order(order)])
    here = F.row_number().over(Window.partitionBy("_pin_part", *group).orderBy("_pin_pos"))
    carried = _carried(tagged, group, "_c_rows")
    same = [F.col("_pin_part") == F.col("_c_part"), *[tagged[c].eqNullSafe(carried[f"_c_{i}"]) for i, c in enumerate(group)]]
    start_col = start if isinstance(start, Column) else F.lit(start)
    joined = tagged.withColumn("_c_here", here).join(F.broadcast(carried), same, "left")
    number = (F.col("_c_here") + F.coalesce("_c_rows", F.lit(0)) + start_col).cast("long").alias(out)
    return joined.select(*[tagged[c] for c in df.columns if c != out], number)


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column | str],
                  take: Sequence[str] | None = None, last: bool = False) -> DataFrame:
    """One row per ``key``: the first (or last) by ``order``, keeping ``take`` columns.

    A partially-aggregated ``min``/``max`` of a struct whose leading fields are the order, so a hot
    key is combined map-side instead of being sorted in one task. Order columns must be ascending
    expressions or names; NULLs sort first as in SQL Server (struct comparison puts NULL first).
    A column that is both taken and an order is moved once.
    """
    take = [c for c in (take or df.columns) if c not in key]
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    place = {c: f"_o{i}" for i, c in enumerate(order) if isinstance(c, str)}
    fields = [o.alias(f"_o{i}") for i, o in enumerate(order_cols)] + [F.col(c).alias(c) for c in take if c not in place]
    agg = F.max if last else F.min
    picked = df.groupBy(*key).agg(agg(F.struct(*fields)).alias("_pick"))
    return picked.select(*key, *[F.col("_pick")[place.get(c, c)].alias(c) for c in take])


def _slice_offsets(tagged: DataFrame, part: str, out: str) -> DataFrame:
    """Rows before each slice: a running sum over the per-slice counts (one row per slice)."""
    counts = tagged.groupBy(part).agg(F.count(F.lit(1)).alias("_so_n"))
    return counts.select(part, F.coalesce(F.sum("_so_n").over(
        Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(out))


def control_break(df: DataFrame, key: Sequence[str], order: Sequence[Column | str],
                  header_id: str, item_no: str, start: int = 0) -> DataFrame:
    """Number headers (one per distinct ``key``, in key order) and items within each header.

    Replaces "sort, then open a new header when the key changes". One pin: rows are numbered over
    (key, order); an item's number is its distance from the header's first row, and a header's id is
    the count of headers whose first row lies in earlier slices plus its rank among the first rows of
    its own slice (at most one slice of rows). Returns the rows with ``header_id`` and ``item_no``.
    """
    order_cols = [*_as_order(key), *_as_order(order)]
    tagged = pin(df, order_cols)
    numbered = tagged.join(F.broadcast(_slice_offsets(tagged, "_pin_part", "_cb_off")), "_pin_part") \
        .withColumn("_cb_n", F.col("_cb_off") + F.col("_pin_pos") + 1).drop("_cb_off", "_pin_pos")
    hk = [f"_cb_k{i}" for i in range(len(key))]
    firsts = (numbered.groupBy(*key).agg(F.min(F.struct("_cb_n", "_pin_part")).alias("_cb_f"))
              .select(*[F.col(k).alias(h) for k, h in zip(key, hk)],
                      F.col("_cb_f._cb_n").alias("_cb_first"), F.col("_cb_f._pin_part").alias("_cb_part")))
    rank = F.row_number().over(Window.partitionBy("_cb_part").orderBy("_cb_first"))
    firsts = (firsts.join(F.broadcast(_slice_offsets(firsts, "_cb_part", "_cb_hoff")), "_cb_part")
              .withColumn(header_id, (F.col("_cb_hoff") + rank + F.lit(start)).cast("long"))
              .drop("_cb_part", "_cb_hoff"))
    joined = numbered.join(firsts, [numbered[k].eqNullSafe(firsts[h]) for k, h in zip(key, hk)])
    return (joined.withColumn(item_no, (F.col("_cb_n") - F.col("_cb_first") + 1).cast("long"))
            .drop(*hk, "_cb_n", "_cb_first", "_pin_part"))


def hierarchical_code(df: DataFrame, group: Sequence[str], order: Sequence[Column | str],
                      width: int = 3) -> DataFrame:
    """Counter per group split into (subgroup, code): up to 999 -> ('000', nnn); above that the
    thousands become the subgroup and the last three digits the code (1000 -> '001', '000'). ``width``
    is the least width of a subgroup: the millionth row of a group has subgroup '1000', so codes stay distinct."""
    numbered = group_number(df, group, order, "_hc_n")
    n = F.col("_hc_n")
    size = F.lit(10 ** width).cast("long")
    sub = zfill(((n - n % size) / size).cast("long"), width)  # a multiple of size, so the quotient is whole
    code = zfill(n % size, width)
    return numbered.withColumn("subgrupo", sub).withColumn("codigo", code).withColumnRenamed("_hc_n", "seq")
