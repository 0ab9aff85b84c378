"""Entity resolution against a supplier dimension: by document, by name, by legacy id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numbering import first_per_key


def supplier_keys(master: DataFrame) -> dict[str, DataFrame]:
    """One row per key for each way of resolving (``master``: codif, nome, codant, documento).

    document: the supplier loaded last (highest id) wins, as in a cache keyed by document;
    name (first 50 characters) and legacy id: the first supplier (lowest id) wins.
    Each table has one row per distinct key, so a hot key costs one row, and the joins below are
    plain equi-joins (broadcast by AQE when the dimension is small).
    """
    by_doc = first_per_key(master.filter(F.col("documento").isNotNull()), ["documento"], ["codif"],
                           take=["codif"], last=True)
    by_name = first_per_key(master.filter(F.col("nome").isNotNull()).withColumn("_n50", F.substring("nome", 1, 50)),
                            ["_n50"], ["codif"], take=["codif"])
    by_id = first_per_key(master.filter(F.col("codant").isNotNull()).withColumn("_id", F.col("codant").cast("long")),
                          ["_id"], ["codif"], take=["codif"])
    return {"document": by_doc, "name": by_name, "legacy_id": by_id}


def resolve_supplier(df: DataFrame, master: DataFrame, by: Sequence[tuple[str, Column]], out: str = "codif",
                     matched_by: str | None = None) -> DataFrame:
    """Add ``out`` = supplier id found by the first rule in ``by`` that matches.

    ``by`` is a list of (rule, value) with rule in 'document', 'name', 'legacy_id'.
    """
    keys = supplier_keys(master)
    tmp = []
    for i, (rule, value) in enumerate(by):
        k = f"_rs_k{i}"
        v = f"_rs_v{i}"
        table = keys[rule]
        key_col = {"document": "documento", "name": "_n50", "legacy_id": "_id"}[rule]
        probe = value if rule != "name" else F.substring(value, 1, 50)
        if rule == "legacy_id":
            probe = probe.cast("long")
        df = df.withColumn(k, probe)
        df = df.join(table.select(F.col(key_col).alias(f"{k}_r"), F.col("codif").alias(v)),
                     F.col(k) == F.col(f"{k}_r"), "left").drop(f"{k}_r", k)
        tmp.append((rule, v))
    df = df.withColumn(out, F.coalesce(*[F.col(v) for _, v in tmp]))
    if matched_by:
        expr = F.lit(None).cast("string")
        for rule, v in reversed(tmp):
            expr = F.when(F.col(v).isNotNull(), F.lit(rule)).otherwise(expr)
        df = df.withColumn(matched_by, expr)
    return df.drop(*[v for _, v in tmp])
