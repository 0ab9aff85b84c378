"""Price quotations: headers and items, bidders, bids with the winning price, totals."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..context import MigrationContext
from ..functions import sqltext as Q
from ..functions.text import (capitalize, cut, decimal14_text, doc_pad_b, keep_right, lot_item_number, title_case,
                              year_chars_3_4, year_mod_2000)
from ..operators.numbering import first_per_key, group_number
from ..operators.quality import Split, quality_split
from ..operators.resolve import resolve_supplier
from ..session import is_planning
from ..sources.catalog import Legacy, derived, oracle, stored, stored_by, view
from . import master, suppliers, warehouse

# Fixed values of the target system.
STATUS_OPEN = "EC"
BID_CLASS = "GL"
PRICE_KIND = "M"


def _txt(c: Column | str) -> Column:
    """Piece of a T-SQL CONCAT: NULL counts as ''."""
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))


def _id_text(nr: str = "nrpesquisa", year: str = "dtanopesquisa") -> Column:
    return F.concat(_txt(nr), _txt(year_chars_3_4(year)))


def _numorc(nr: str = "nrpesquisa", year: str = "dtanopesquisa") -> Column:
    return F.concat(keep_right(nr, 5), F.lit("/"), year_mod_2000(year))


def _money(c: Column) -> Column:
    return c.cast("decimal(18,5)").cast("double")


# --- P7 headers and items ----------------------------------------------------------------------

def quotation_headers(src: Legacy, ctx: MigrationContext) -> DataFrame:
    p = src["processopesquisa"]
    f = src["condicaopagamento"].select("cdcondicaopagamento", "dscondicaopagamento")
    z = src["localentrega"].select("cdlocalentrega", F.concat("dslocalentrega", F.lit(" - Compl.: "), "dscomplemento").alias("_place"))
    rows = p.join(f, "cdcondicaopagamento", "left").join(z, "cdlocalentrega", "left")
    nrproc = F.coalesce(F.col("nrprocesso"), F.lit(0))
    has_process = nrproc != 0
    proclic = F.concat(keep_right(nrproc, 6), F.lit("/"), (F.coalesce(F.col("dtanoprocesso"), F.lit(0)) % 2000).cast("string"))
    numlic = F.concat(nrproc.cast("string"), _txt(F.col("dtanoprocesso") % 2000))
    just = F.col("justificativa_contratacao")
    return rows.select(
        _numorc().alias("numorc"),
        keep_right("nrpesquisa", 5).alias("num"),
        F.col("dtanopesquisa").cast("int").alias("ano"),
        F.col("dtexpedicao").alias("dtorc"),
        title_case("dspesquisa").alias("descr"),
        F.when(F.coalesce(just, F.lit("")) != "", capitalize(just)).alias("obs"),
        F.lit(0).alias("codccusto"),
        F.lit(STATUS_OPEN).alias("status"),
        F.lit("S").alias("liberado"),
        _id_text().alias("id_cadorc"),
        F.lit(ctx.company).alias("empresa"),
        F.when(has_process, proclic).alias("proclic"),
        F.when(has_process, numlic).alias("numlic"),
        F.lit("N").alias("registropreco"),
        cut("dscondicaopagamento", 30).alias("condpgto"),
        F.coalesce("_place", F.lit("")).alias("local_entrega"),
    )


#: A quotation with so many items or more is numbered slice by slice.
CROWDED_ROWS = 1_000_000


def _bid_codant(item: str) -> Column:
    return F.concat(F.col("id_cadorc"), F.lit("-"), _txt(item), F.lit("-"), _txt("lote"), F.lit("-"), _txt("cdorgaoreduzido"))


@stored_by("id_cadorc")
def _item_rows(src: Legacy) -> DataFrame:
    """Items of quotations. They and the bids lie by the quotation's id, so that they meet without being moved again."""
    i = src["itempesquisa"]
    o = src["orgaopesquisa"]
    lots = i.groupBy("nrpesquisa", "dtanopesquisa").agg(F.max("lote").alias("qtdlote"))
    rows = (src["processopesquisa"].select("nrpesquisa", "dtanopesquisa")
            .join(i, ["nrpesquisa", "dtanopesquisa"])
            .join(o, ["nrpesquisa", "dtanopesquisa"], "left")
            .join(lots, ["nrpesquisa", "dtanopesquisa"], "left")
            .filter(F.col("cdmaterial") != 0))
    return rows.withColumn("id_cadorc", _id_text())


def _crowded(src: Legacy) -> list[str]:
    """Quotations with ``CROWDED_ROWS`` items or more (so at most one for every so many rows)."""
    if is_planning():
        return []
    often = _item_rows(src).groupBy("id_cadorc").count().filter(F.col("count") >= CROWDED_ROWS)
    return sorted(r["id_cadorc"] for r in often.select("id_cadorc").collect())


@derived
def _item_split(src: Legacy) -> Split:
    rows, group, order = _item_rows(src), ["id_cadorc"], ["nritem", "lote", "cdmaterial", "cdorgaoreduzido"]
    # products come to where the items lie; only pairs of quotation and product are moved to them and back
    codes = rows.select("id_cadorc", "cdmaterial").distinct().join(warehouse._products(src), "cdmaterial")
    if crowded := _crowded(src):
        large = F.col("id_cadorc").isin(crowded)
        rows = group_number(rows.filter(~large), group, order, "rn", lying=True).unionByName(group_number(rows.filter(large), group, order, "rn"))
    else:
        rows = group_number(rows, group, order, "rn", lying=True)
    rows = rows.join(codes, ["id_cadorc", "cdmaterial"], "left").withColumn("codant", _bid_codant("nritem"))
    return quality_split(rows, {"product code not found": F.col("cadpro").isNull()})


@view
def _items(src: Legacy) -> tuple[DataFrame, DataFrame]:
    ok, bad = _item_split(src)
    item = lot_item_number("lote", "rn", "qtdlote")
    items = ok.select(
        _numorc().alias("numorc"), item.alias("item"), item.alias("itemorc"), F.lit(0.0).alias("valor"),
        F.col("cdorgaoreduzido").alias("codccusto"), "cadpro",
        F.col("qtitempesquisa").cast("double").alias("qtd"), "id_cadorc", "codant")
    return items, bad


def quotation_items(src: Legacy, ctx: MigrationContext) -> DataFrame:
    return _items(src)[0]


# --- P8 bidders --------------------------------------------------------------------------------

def _supplier_master(src: Legacy, ctx: MigrationContext) -> DataFrame:
    return suppliers.supplier_master(src, ctx)


@derived
def quotation_bidders(src: Legacy, ctx: MigrationContext) -> DataFrame:
    # Only the keys of a bid tell bidders of a quotation apart; what a supplier adds is found once per supplier, so that
    # no text is sorted or hashed per bid.
    p = src["propostapesquisa"].filter(F.col("nrpesquisa") > 0).select("nrpesquisa", "dtanopesquisa", "cdfornecedor").distinct()
    f = src["fornecedor"].select("cdfornecedor", "nmfornecedor", doc_pad_b(decimal14_text("nrcgccpf")).alias("insmf")).distinct()
    f = resolve_supplier(f, _supplier_master(src, ctx), [("document", F.col("insmf")), ("name", F.col("nmfornecedor"))])
    rows = p.join(f, "cdfornecedor").withColumns({"numorc": _numorc(), "id_cadorc": _id_text()})
    return rows.select("numorc", "codif", title_case(cut("nmfornecedor", 70)).alias("nome"),
                       F.lit(0.0).alias("valorc"), "id_cadorc", F.col("insmf").alias("insmf_ant"))


# --- P9 bids, totals, item prices ----------------------------------------------------------------

@stored
def _bid_suppliers(src: Legacy, ctx: MigrationContext) -> DataFrame:
    """Suppliers resolved once each, not once per bid."""
    f = src["fornecedor"].select("cdfornecedor", "nmfornecedor", doc_pad_b(decimal14_text("nrcgccpf")).alias("insmf"))
    return resolve_supplier(f, _supplier_master(src, ctx), [("document", F.col("insmf")), ("name", F.col("nmfornecedor"))]).select("cdfornecedor", "codif")


@stored_by("id_cadorc")
def _bid_rows(src: Legacy, ctx: MigrationContext) -> DataFrame:
    """Bids with their supplier and the winner of their item, lying by the quotation's id."""
    key = ["nrpesquisa", "dtanopesquisa", "lote", "nritemproposta"]
    # Cheapest positive bid of each item (ties: lowest supplier id), found where the bids lie; a NULL in the key has none.
    best = F.min(F.when(F.col("vlcotacaoproposta") > 0, F.struct("vlcotacaoproposta", "cdfornecedor"))).over(Window.partitionBy(*key))
    keyed = reduce(and_, [F.col(k).isNotNull() for k in key])
    p = src["propostapesquisa"].filter(F.col("nrpesquisa") > 0).withColumn("_w", F.when(keyed, best))
    p = p.withColumns({"ganhador": F.col("_w.cdfornecedor"), "valorvencedor": F.col("_w.vlcotacaoproposta")}).drop("_w")
    rows = p.join(_bid_suppliers(src, ctx), "cdfornecedor").join(src["orgaopesquisa"], ["nrpesquisa", "dtanopesquisa"])
    return rows.withColumn("id_cadorc", _id_text()).drop("cdfornecedor")


@stored
def _winner_ids(src: Legacy, ctx: MigrationContext) -> DataFrame:
    """Winners resolved once each, not once per bid."""
    winners = _bid_rows(src, ctx).select("ganhador").filter(F.col("ganhador").isNotNull()).distinct()
    return resolve_supplier(winners, _supplier_master(src, ctx), [("legacy_id", F.col("ganhador"))], out="ganhou")


@derived
def quotation_bids(src: Legacy, ctx: MigrationContext) -> DataFrame:
    rows = _bid_rows(src, ctx).withColumn("codant", _bid_codant("nritemproposta")).join(_winner_ids(src, ctx), "ganhador", "left")
    items = _items(src)[0].select(F.col("id_cadorc").alias("_quotation"), F.col("codant").alias("_codant"), F.col("item").alias("_item"))
    items = first_per_key(items, ["_quotation", "_codant"], ["_item"], take=["_item"], last=True)
    rows = rows.join(items, (rows.id_cadorc == items._quotation) & (rows.codant == items._codant), "left")
    return rows.select(
        _numorc().alias("numorc"), "codif", F.col("vlcotacaoproposta").cast("double").alias("vlruni"),
        _money(F.col("vlcotacaoproposta") * F.col("qtitemproposta")).alias("vlrtot"),
        F.coalesce(F.col("_item"), F.lit(0)).cast("long").alias("item"), "id_cadorc", F.lit(BID_CLASS).alias("classe"),
        "ganhou", F.col("valorvencedor").cast("double").alias("vlrganhou"))


def quotation_bidder_totals(src: Legacy, ctx: MigrationContext) -> DataFrame:
    """Bidders with ``valorc`` = sum of their bid totals in the quotation (NULL without bids)."""
    bidders = quotation_bidders(src, ctx)
    bids = quotation_bids(src, ctx)
    sums = bids.groupBy("codif", "id_cadorc").agg(_money(F.sum(F.col("vlrtot").cast("decimal(18,5)"))).alias("_sum"))
    out = bidders.join(sums, ["codif", "id_cadorc"], "left")
    return out.select("numorc", "codif", "nome", F.col("_sum").alias("valorc"), "id_cadorc", "insmf_ant")


def quotation_item_prices(src: Legacy, ctx: MigrationContext) -> DataFrame:
    """Per quotation item: winner (lowest winning supplier id among its bids) and the mean of the
    positive bid prices over the bids that have a supplier; 0 when there is none. Grouped by the whole
    quotation key: ``numorc`` keeps five digits of the number, so two quotations can share it."""
    items = _items(src)[0].select("numorc", "item", "id_cadorc", "qtd")
    bids = quotation_bids(src, ctx)
    winner = bids.groupBy("id_cadorc", "item").agg(F.min("ganhou").alias("_codif"))
    pos = bids.filter(F.col("vlruni") > 0).groupBy("id_cadorc", "item").agg(
        F.sum(F.col("vlruni").cast("decimal(18,5)")).alias("_sum"), F.count("codif").alias("_n"))
    out = items.join(winner, ["id_cadorc", "item"], "left").join(pos, ["id_cadorc", "item"], "left")
    valunt = F.when(F.col("_n") > 0, F.col("_sum").cast("double") / F.col("_n").cast("double"))
    valunt = F.coalesce(valunt, F.lit(0.0))
    return out.select("numorc", "item", "id_cadorc", "qtd", F.col("_codif").alias("codif"), valunt.alias("valunt"),
                      (valunt * F.col("qtd")).alias("valtot"), F.lit(PRICE_KIND).alias("tipo"),
                      F.lit("S").alias("flg_aceito"))


# --- oracles ---------------------------------------------------------------------------------------

_Q_TABLES = ["localentrega", "processopesquisa", "itempesquisa", "orgaopesquisa", "condicaopagamento", "propostapesquisa", "fornecedor"]


def _o_txt(e: str) -> str:
    return f"coalesce(cast({e} as varchar), '')"


def _o_id(nr: str = "nrpesquisa", year: str = "dtanopesquisa") -> str:
    return f"({_o_txt(nr)} || substring(cast({year} as varchar), 3, 2))"


def _o_numorc(nr: str = "nrpesquisa", year: str = "dtanopesquisa") -> str:
    return f"({Q.keep_right(nr, 5)} || '/' || cast({year} % 2000 as varchar))"


def _oracle_ctes(ctx: MigrationContext) -> list[tuple[str, str]]:
    heads = (
        f"select {_o_numorc()} numorc, {Q.keep_right('nrpesquisa', 5)} num, cast(dtanopesquisa as integer) ano, dtexpedicao dtorc, "
        f"{Q.title('dspesquisa')} descr, case when coalesce(justificativa_contratacao, '') <> '' then "
        f"{Q.capitalize('justificativa_contratacao')} end obs, 0 codccusto, '{STATUS_OPEN}' status, 'S' liberado, "
        f"{_o_id()} id_cadorc, {ctx.company} empresa, "
        "case when coalesce(nrprocesso, 0) <> 0 then " + Q.keep_right("coalesce(nrprocesso, 0)", 6)
        + " || '/' || cast(coalesce(dtanoprocesso, 0) % 2000 as varchar) end proclic, "
        "case when coalesce(nrprocesso, 0) <> 0 then cast(coalesce(nrprocesso, 0) as varchar) || "
        + _o_txt("dtanoprocesso % 2000") + " end numlic, 'N' registropreco, substring(dscondicaopagamento, 1, 30) condpgto, "
        "coalesce(dslocalentrega || ' - Compl.: ' || dscomplemento, '') local_entrega from processopesquisa p "
        "left join condicaopagamento f using (cdcondicaopagamento) left join localentrega using (cdlocalentrega)")
    qr = ("select p.nrpesquisa, p.dtanopesquisa, i.lote, i.nritem, i.cdmaterial, i.qtitempesquisa, o.cdorgaoreduzido, "
          "(select max(c.lote) from itempesquisa c where c.dtanopesquisa = p.dtanopesquisa and c.nrpesquisa = "
          "p.nrpesquisa) qtdlote from processopesquisa p left join itempesquisa i on i.dtanopesquisa = p.dtanopesquisa "
          "and i.nrpesquisa = p.nrpesquisa left join orgaopesquisa o on o.dtanopesquisa = p.dtanopesquisa and "
          "o.nrpesquisa = p.nrpesquisa")
    qitems = (
        f"select {_o_numorc()} numorc, row_number() over (partition by {_o_id()} order by nritem nulls first, lote nulls first, "
        f"cdmaterial nulls first, cdorgaoreduzido nulls first) rn, qtdlote, lote, qtitempesquisa, cdmaterial, cdorgaoreduzido, {_o_id()} id_cadorc, "
        f"{_o_id()} || '-' || {_o_txt('nritem')} || '-' || {_o_txt('lote')} || '-' || {_o_txt('cdorgaoreduzido')} codant "
        "from qr where cdmaterial <> 0")
    item = Q.lot_item_number("lote", "rn", "qtdlote")
    items = (f"select numorc, {item} item, {item} itemorc, cast(0 as double) valor, cdorgaoreduzido codccusto, c.cadpro, "
             "cast(qtitempesquisa as double) qtd, id_cadorc, codant from qitems q join codes c on c.codreduz = q.cdmaterial")
    doc = Q.doc_pad_b(Q.decimal14_text("f.nrcgccpf"))

    def by_doc_then_name(doc_e: str, name_e: str) -> str:
        return (f"coalesce((select max(s.codif) from smaster s where s.documento = {doc_e}), "
                f"(select min(s.codif) from smaster s where substring(s.nome, 1, 50) = substring({name_e}, 1, 50)))")

    bidders = (
        "select numorc, " + by_doc_then_name("insmf", "nmfornecedor") + " codif, "
        f"{Q.title('substring(nmfornecedor, 1, 70)')} nome, cast(0 as double) valorc, id_cadorc, insmf insmf_ant from "
        f"(select distinct {_o_numorc('p.nrpesquisa', 'p.dtanopesquisa')} numorc, {_o_id('p.nrpesquisa', 'p.dtanopesquisa')} "
        f"id_cadorc, p.dtanopesquisa, p.cdfornecedor, f.nmfornecedor, {doc} insmf from propostapesquisa p join fornecedor f "
        "on f.cdfornecedor = p.cdfornecedor where p.nrpesquisa > 0) b")
    win = ("(select g.{col} from propostapesquisa g where g.nrpesquisa = p.nrpesquisa and g.dtanopesquisa = "
           "p.dtanopesquisa and g.lote = p.lote and g.nritemproposta = p.nritemproposta and g.vlcotacaoproposta > 0 "
           "order by g.vlcotacaoproposta, g.cdfornecedor limit 1)")
    bids = (
        f"select {_o_numorc('p.nrpesquisa', 'p.dtanopesquisa')} numorc, "
        + by_doc_then_name(doc, "f.nmfornecedor") + " codif, cast(p.vlcotacaoproposta as double) vlruni, "
        "cast(cast(p.vlcotacaoproposta * p.qtitemproposta as decimal(18,5)) as double) vlrtot, "
        f"cast(coalesce((select max(i.item) from qitems_final i where i.codant = {_o_id('p.nrpesquisa', 'p.dtanopesquisa')} "
        f"|| '-' || {_o_txt('p.nritemproposta')} || '-' || {_o_txt('p.lote')} || '-' || {_o_txt('o.cdorgaoreduzido')}), 0) "
        f"as bigint) item, {_o_id('p.nrpesquisa', 'p.dtanopesquisa')} id_cadorc, '{BID_CLASS}' classe, "
        f"(select min(s.codif) from smaster s where cast(s.codant as bigint) = {win.format(col='cdfornecedor')}) ganhou, "
        f"cast({win.format(col='vlcotacaoproposta')} as double) vlrganhou "
        "from propostapesquisa p join fornecedor f on f.cdfornecedor = p.cdfornecedor join orgaopesquisa o "
        "on o.nrpesquisa = p.nrpesquisa and o.dtanopesquisa = p.dtanopesquisa where p.nrpesquisa > 0")
    totals = ("select b.numorc, b.codif, b.nome, (select cast(cast(sum(cast(v.vlrtot as decimal(18,5))) as decimal(18,5)) "
              "as double) from qbids v where v.codif = b.codif and v.id_cadorc = b.id_cadorc) valorc, b.id_cadorc, "
              "b.insmf_ant from qbidders b")
    prices = (
        "select c.numorc, c.item, c.id_cadorc, c.qtd, (select min(v.ganhou) from qbids v where v.id_cadorc = c.id_cadorc "
        "and v.item = c.item) codif, coalesce(m.valunt, 0) valunt, coalesce(m.valunt, 0) * c.qtd valtot, "
        f"'{PRICE_KIND}' tipo, 'S' flg_aceito from qitems_final c left join (select id_cadorc, item, case when count(codif) > 0 "
        "then cast(sum(cast(vlruni as decimal(18,5))) as double) / cast(count(codif) as double) end valunt from qbids "
        "where vlruni > 0 group by id_cadorc, item) m on m.id_cadorc = c.id_cadorc and m.item = c.item")
    codes = master._oracle_codes_ctes() + [("codes", master._CODES_BODY)]
    sup = suppliers._oracle_supplier_ctes(ctx)
    return codes + sup + [("qheads", heads), ("qr", qr), ("qitems", qitems), ("qitems_final", items),
                          ("qbidders", bidders), ("qbids", bids), ("qtotals", totals), ("qprices", prices)]


def _oracle(ctx: MigrationContext) -> dict[str, str]:
    tables = sorted(set(_Q_TABLES + suppliers._SUPPLIER_TABLES + ["produto", "classificacao", "classificacao_bens",
                                                                   "classificacao_obras", "unidademedida"]))
    ctes = _oracle_ctes(ctx)
    return {name: oracle(f"select * from {cte}", tables, ctes) for name, cte in [
        ("quotation_headers", "qheads"), ("quotation_items", "qitems_final"), ("quotation_bidders", "qbidders"),
        ("quotation_bids", "qbids"), ("quotation_bidder_totals", "qtotals"), ("quotation_item_prices", "qprices")]}


QUERIES = {
    "quotation_headers": quotation_headers,
    "quotation_items": quotation_items,
    "quotation_bidders": quotation_bidders,
    "quotation_bids": quotation_bids,
    "quotation_bidder_totals": quotation_bidder_totals,
    "quotation_item_prices": quotation_item_prices,
}
ORACLE = _oracle(MigrationContext())
