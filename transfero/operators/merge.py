"""Target-table DML expressed as DataFrame -> DataFrame (parquet targets have no MERGE/UPDATE)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numbering import first_per_key


def merge_update(target: DataFrame, source: DataFrame, on: Sequence[str] | Mapping[str, str],
                 assign: Mapping[str, str], pick: Sequence[Column | str] | None = None,
                 last: bool = True) -> DataFrame:
    """``MERGE INTO target USING source ON key WHEN MATCHED THEN UPDATE SET ...``.

    ``on`` lists key names shared by both sides, or maps target key -> source key. ``assign`` maps a
    target column to the source column that replaces it. When several source rows match one target
    row the one picked is the last (or first) by ``pick``; without ``pick`` the source must already
    be unique per key. Unmatched target rows keep their values; NULL keys never match.
    """
    keys = dict(on) if isinstance(on, Mapping) else {k: k for k in on}
    src = source.select(*[F.col(s).alias(f"_mk_{t}") for t, s in keys.items()],
                        *[F.col(v).alias(f"_mv_{k}") for k, v in assign.items()],
                        *[(F.col(p) if isinstance(p, str) else p).alias(f"_mp_{i}") for i, p in enumerate(pick or [])])
    if pick:
        src = first_per_key(src, [f"_mk_{t}" for t in keys], [f"_mp_{i}" for i in range(len(pick))],
                            take=[f"_mv_{k}" for k in assign], last=last)
    src = src.select(*[f"_mk_{t}" for t in keys], *[f"_mv_{k}" for k in assign], F.lit(True).alias("_m_hit"))
    cond = [target[t] == src[f"_mk_{t}"] for t in keys]
    joined = target.join(src, cond, "left")
    hit = F.col("_m_hit").isNotNull()
    out = [F.when(hit, F.col(f"_mv_{c}")).otherwise(target[c]).alias(c) if c in assign else target[c]
           for c in target.columns]
    return joined.select(*out)


def update_where(df: DataFrame, assign: Mapping[str, Column], where: Column) -> DataFrame:
    """``UPDATE t SET c = expr WHERE cond`` (a NULL condition leaves the row unchanged)."""
    cond = F.coalesce(where, F.lit(False))
    out = df
    # All new values are computed from the old row, as in SQL.
    exprs = {c: F.when(cond, e).otherwise(F.col(c)) for c, e in assign.items()}
    return out.select(*[exprs[c].alias(c) if c in exprs else F.col(c) for c in df.columns])


def rows_absent(target: DataFrame, new: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key no target row has. As in SQL a NULL equals nothing, so a row with a NULL in its key
    is always absent. Only key columns of the target are moved, each key once."""
    keys = target.select(*on).dropna().distinct()
    return new.join(keys, list(on), "left_anti").select(*new.columns)


def insert_absent(target: DataFrame, new: DataFrame, on: Sequence[str]) -> DataFrame:
    """``INSERT ... SELECT ... WHERE NOT EXISTS (same key in target)``: anti-join, then append."""
    return target.unionByName(rows_absent(target, new, on), allowMissingColumns=True)


def delete_where(target: DataFrame, predicate: Column) -> DataFrame:
    """``DELETE FROM t WHERE p``; a row for which ``p`` is NULL stays."""
    return target.filter(~F.coalesce(predicate, F.lit(False)))


def delete_in(target: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """``DELETE FROM t WHERE key IN (SELECT key FROM keys)``; a row without a key stays."""
    return target.join(keys.select(on).distinct(), on, "left_anti").select(*target.columns)
