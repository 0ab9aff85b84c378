"""The requisition tables after all loads that write them: opening balance, movements, fuel."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import MigrationContext
from ..sources.catalog import Legacy, oracle
from . import fleet, suppliers, warehouse

_TIMES = ("dtlan", "datae", "dtpag")


def _alike(df: DataFrame) -> DataFrame:
    """Dates as timestamps and ids as long, so that the parts of a table have the same types."""
    times = {c: F.col(c).cast("timestamp_ntz") for c in _TIMES if c in df.columns}
    longs = {c: F.col(c).cast("long") for c in ("codccusto", "codif", "docum", "id_requi") if c in df.columns}
    return df.withColumns({**times, **longs})


def _parts(src: Legacy, output: str, kept: DataFrame, loaded: dict[str, DataFrame]) -> dict[str, DataFrame | None]:
    """Segments of a target table. What other modules own was cleared of this module's rows by the run before, if it
    is a segment of its own, and then stays as it is."""
    same = src.previous is not None and "foreign" in src.previous.tables.get(output, {})
    return {"foreign": None if same else _alike(kept), **{k: _alike(v) for k, v in loaded.items()}}


def _headers(src: Legacy, ctx: MigrationContext) -> dict[str, DataFrame]:
    return {"opening": warehouse.stock_opening_header(src, ctx), "movement": warehouse.stock_requisitions(src, ctx),
            "fuel": fleet.fuel_requisitions(src, ctx)}


def _items(src: Legacy, ctx: MigrationContext) -> dict[str, DataFrame]:
    return {"opening": warehouse.stock_opening_balance(src, ctx).drop("dtlan"), "movement": warehouse.stock_movements(src, ctx),
            "fuel": fleet.fuel_items(src, ctx)}


def _header_segments(src: Legacy, ctx: MigrationContext) -> dict[str, DataFrame | None]:
    return _parts(src, "requisitions_target", warehouse.kept_requisitions(src, ctx)[0], _headers(src, ctx))


def _item_segments(src: Legacy, ctx: MigrationContext) -> dict[str, DataFrame | None]:
    return _parts(src, "requisition_items_target", warehouse.kept_requisitions(src, ctx)[1], _items(src, ctx))


def _whole(parts: dict[str, DataFrame | None], kept: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                  [_alike(kept) if df is None else df for df in parts.values()])


def requisitions_target(src: Legacy, ctx: MigrationContext) -> DataFrame:
    """All requisition headers: those that stay, the opening balance, the year's movements, fuel."""
    return _whole(_header_segments(src, ctx), warehouse.kept_requisitions(src, ctx)[0])


def requisition_items_target(src: Legacy, ctx: MigrationContext) -> DataFrame:
    return _whole(_item_segments(src, ctx), warehouse.kept_requisitions(src, ctx)[1])


def _oracle(ctx: MigrationContext) -> dict[str, str]:
    whole = fleet.oracle_bodies(ctx)
    tables, ctes = whole["tables"], whole["ctes"]
    sup_tables, _ = suppliers.oracle_lookup_ctes(ctx)
    heads = " union all by name ".join(["(select * from rkept)", *(f"({b})" for b in (warehouse.opening_header_sql(ctx), "from wreq", whole["fuel_requisitions"]))])
    items = " union all by name ".join(["(select * from ikept)", "(select * exclude (dtlan) from opening)", f"({warehouse.movements_sql(ctx)})", f"({whole['fuel_items']})"])
    big = "select * replace (codccusto::bigint as codccusto, id_requi::bigint as id_requi) from ({})"
    return {"requisitions_target": oracle(f"select * replace (codif::bigint as codif, docum::bigint as docum, id_requi::bigint as id_requi) from ({heads})",
                                          sorted(set(tables + sup_tables)), ctes),
            "requisition_items_target": oracle(big.format(items), sorted(set(tables + sup_tables)), ctes)}


QUERIES = {"requisitions_target": requisitions_target, "requisition_items_target": requisition_items_target}
SEGMENTS = {"requisitions_target": _header_segments, "requisition_items_target": _item_segments}
ORACLE = _oracle(MigrationContext())
