"""Rows the load could not accept, with the reason (quality split of quotation items and tender bids)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import MigrationContext
from ..sources.catalog import Legacy, oracle
from . import quotation, suppliers, tender


def rejected_bids(src: Legacy, ctx: MigrationContext) -> DataFrame:
    """Quotation items and tender bids whose product has no code in the target."""
    _, q_bad = quotation._items(src)
    _, t_bad = tender._bid_rows(src, ctx)
    q = q_bad.select(F.lit("quotation_item").alias("source"), F.col("codant").alias("chave"),
                     F.col("cdmaterial").cast("long").alias("cdmaterial"), "reason")
    t = t_bad.select(F.lit("tender_bid").alias("source"), tender._codant().alias("chave"),
                     F.col("cdmat").cast("long").alias("cdmaterial"), "reason")
    return q.unionByName(t)


def _oracle(ctx: MigrationContext) -> dict[str, str]:
    tables = sorted(set(quotation._Q_TABLES + suppliers._SUPPLIER_TABLES + [
        "produto", "classificacao", "classificacao_bens", "classificacao_obras", "unidademedida",
        "processolicitatorio", "itemobjeto", "tender_proposta", "classificacaoproposta", "tabela_preco_item", *tender.BUDGET_TABLES]))
    ctes = quotation._oracle_ctes(ctx) + tender._oracle_ctes(ctx)
    body = ("select 'quotation_item' source, q.codant chave, cast(q.cdmaterial as bigint) cdmaterial, "
            "'product code not found' reason from qitems q left join codes c on c.codreduz = q.cdmaterial "
            "where c.cadpro is null union all select 'tender_bid', codant, cast(cdmat as bigint), "
            "'product code not found' from tbids_all where cadpro is null")
    return {"rejected_bids": oracle(body, tables, ctes)}


QUERIES = {"rejected_bids": rejected_bids}
ORACLE = _oracle(MigrationContext())
