"""Cost centres, warehouses and suppliers (P4-P6), and the supplier lookup used by later jobs.

Supplier load = entity resolution against the suppliers already in the target: match by document,
then by name cut at 50; matched rows get the legacy id, unmatched suppliers are inserted once with
ids after the current maximum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..context import MigrationContext
from ..functions import sqltext as Q
from ..functions.text import cut, decimal14_text, doc_mask, doc_pad_a, doc_type, title_case, zfill
from ..operators.merge import delete_where, merge_update
from ..operators.numbering import first_per_key, global_number
from ..sources.catalog import Legacy, derived, oracle

# Fixed values of the target system.
CONVERSION_NAME = "Conversão"      # default cost centre / warehouse added by the migration
DEFAULT_WAREHOUSE = "000000001"
DEFAULT_COST_CENTRE = "001"
MODULE = "COMPRAS"


# --- P4 cost centres ---------------------------------------------------------------------------

@derived
def cost_centers(src: Legacy, ctx: MigrationContext) -> DataFrame:
    org = src["orgao"]
    first = first_per_key(org.withColumn("nmorgao", F.lit(None).cast("string")), ["cdorgaoreduzido"],
                          ["dtano", "naorgao"], take=["naorgao", "nmorgao"])
    guard = org.limit(1).select(F.lit(0).cast("long").alias("cdorgaoreduzido"), F.lit(CONVERSION_NAME).alias("naorgao"),
                                F.lit("").alias("nmorgao"))
    rows = first.select(F.col("cdorgaoreduzido").cast("long").alias("cdorgaoreduzido"), "naorgao", "nmorgao") \
        .unionByName(guard).distinct()
    # the company's first unit: one row, NULL when it has none
    unit = src["desorc"].filter(F.col("empresa") == ctx.company).agg(F.min(F.struct("poder", "orgao", "unidade")).alias("_unit"))
    return rows.crossJoin(F.broadcast(unit)).select(
        "_unit.poder", "_unit.orgao", "_unit.unidade", F.lit(DEFAULT_WAREHOUSE).alias("destino"), F.lit(DEFAULT_COST_CENTRE).alias("ccusto"),
        title_case("naorgao").alias("descr"), F.col("cdorgaoreduzido").alias("codccusto"),
        F.lit(ctx.company).alias("empresa"), F.lit("N").alias("ocultar"))


def _oracle_cost_centers(ctx: MigrationContext) -> str:
    return (
        f"select unit.poder, unit.orgao, unit.unidade, '{DEFAULT_WAREHOUSE}' destino, '{DEFAULT_COST_CENTRE}' ccusto, {Q.title('naorgao')} descr, "
        f"cdorgaoreduzido codccusto, {ctx.company} empresa, 'N' ocultar from ("
        "select cast(cdorgaoreduzido as bigint) cdorgaoreduzido, naorgao, cast(null as varchar) nmorgao from "
        "(select *, row_number() over (partition by cdorgaoreduzido order by dtano nulls first, naorgao nulls first) rn "
        "from orgao) o where rn = 1 "
        f"union select * from (select cast(0 as bigint), '{CONVERSION_NAME}', '' from orgao limit 1) g) u left join "
        f"(select poder, orgao, unidade from desorc where empresa = {ctx.company} order by all limit 1) unit on true")


# --- P5 warehouses -------------------------------------------------------------------------------

def warehouses(src: Legacy, ctx: MigrationContext) -> DataFrame:
    a = src["almoxarifado"]
    guard = a.limit(1).select(F.lit(0).cast("long").alias("cdalmoxarifado"), F.lit(CONVERSION_NAME).alias("dsalmoxarifado"))
    rows = a.select(F.col("cdalmoxarifado").cast("long").alias("cdalmoxarifado"), "dsalmoxarifado") \
        .unionByName(guard).distinct()
    return rows.select(zfill("cdalmoxarifado", 9).alias("cod"), title_case("dsalmoxarifado").alias("desti"),
                       F.lit(ctx.company).alias("empresa"))


def _oracle_warehouses(ctx: MigrationContext) -> str:
    return (f"select {Q.zfill('cdalmoxarifado', 9)} cod, {Q.title('dsalmoxarifado')} desti, {ctx.company} empresa "
            "from (select cast(cdalmoxarifado as bigint) cdalmoxarifado, dsalmoxarifado from almoxarifado union "
            f"select * from (select cast(0 as bigint), '{CONVERSION_NAME}' from almoxarifado limit 1) g) u")


# --- P6 suppliers --------------------------------------------------------------------------------

def _supplier_rows(src: Legacy) -> DataFrame:
    """Supplier with address, city, state and bank account (left joins), distinct."""
    f = src["fornecedor"]
    e = src["enderecofornecedor"]
    m = src["municipio"].select("cdpais", "cduf", "cdmunicipio", "nmmunicipio")
    u = src["unidadefederacao"].select("cdpais", "cduf", "sguf")
    c = src["contacorrentefornecedor"].select("cdfornecedor", "cdbanco", "cdagencia", "cdcontacorrente")
    street = ["cdpais", "cduf", "cdmunicipio", "cdlogradouro"]
    g = src["logradouro"].select(*street, "nmlogradouro")
    rows = (f.join(e, "cdfornecedor", "left")
            .join(m, ["cdpais", "cduf", "cdmunicipio"], "left")
            .join(u, ["cdpais", "cduf"], "left")
            .join(g, street, "left")
            .join(c, "cdfornecedor", "left"))
    return rows.select("sguf", "nmmunicipio", "nmfantasia", "nmfornecedor", "cdfornecedor",
                       "inpessoafisicajuridica", "nrcgccpf", "dsendereco", "nrinscricaoestadual", "nrinscricaomunicipal", "nmlogradouro", "cdcep",
                       F.coalesce(F.col("dscomplementologradouro"), F.lit("")).alias("dscomplementologradouro"),
                       "cdbanco", "cdagencia", "cdcontacorrente").distinct()


def _existing(src: Legacy) -> DataFrame:
    """Suppliers that stay in the target: those that an earlier load of this module left are replaced."""
    return delete_where(src.existing("suppliers_target", "desfor_existing"), F.col("modulo") == MODULE)


@derived
def _resolved(src: Legacy) -> DataFrame:
    """Each supplier row with its padded document and the existing supplier it matches (if any):
    first by document, then by name cut at 50; the first existing supplier (lowest id) wins. Suppliers without a
    document of their own are never matched."""
    rows = _supplier_rows(src).withColumn("cnpj", doc_pad_a(decimal14_text("nrcgccpf")))
    ex = _existing(src).filter(F.col("insmf").isNotNull())
    by_doc = first_per_key(ex.filter(F.col("audesp_numero").isNotNull()), ["audesp_numero"], ["codif"], take=["codif"]) \
        .select(F.col("audesp_numero").alias("cnpj"), F.col("codif").alias("_by_doc"))
    by_name = first_per_key(ex.filter(F.col("nome").isNotNull()), ["nome"], ["codif"], take=["codif"]) \
        .select(F.col("nome").alias("_name50"), F.col("codif").alias("_by_name"))
    rows = rows.join(by_doc, "cnpj", "left").withColumn("_name50", cut("nmfornecedor", 50)) \
        .join(by_name, "_name50", "left")
    return rows.withColumn("match", F.coalesce("_by_doc", "_by_name")).drop("_by_doc", "_by_name", "_name50")


@derived
def supplier_inserts(src: Legacy, ctx: MigrationContext) -> DataFrame:
    """One new supplier per unmatched legacy supplier (its first row by address, descending), with
    ids after the current maximum in legacy-id order."""
    rows = _resolved(src).filter(F.col("match").isNull())
    # DESC with NULLs last, as SQL Server orders it: the first row has the greatest address.
    first = first_per_key(rows.withColumn("_has", F.col("dsendereco").isNotNull()), ["cdfornecedor"],
                          ["_has", "dsendereco", "cdbanco", "cdagencia", "cdcontacorrente", "sguf", "nmmunicipio", "cdcep", "nmlogradouro"],
                          last=True)
    top = _existing(src).agg(F.coalesce(F.max("codif"), F.lit(0)).cast("long").alias("_max"))
    numbered = global_number(first.crossJoin(F.broadcast(top)), ["cdfornecedor"], "codif", start=F.col("_max"))
    return numbered.select(
        "codif", cut("nmfornecedor", 50).alias("nome"), cut("nmfantasia", 50).alias("nom_fant"),
        F.col("dsendereco").alias("ender"), cut("dscomplementologradouro", 20).alias("compl"),
        F.col("nmmunicipio").alias("cepci"), F.col("sguf").alias("uf"),
        F.col("cdfornecedor").cast("string").alias("codant"),
        F.col("cdcep").alias("cep"), doc_type("cnpj").alias("codtip"), doc_mask("cnpj").alias("insmf"),
        F.col("nrinscricaomunicipal").alias("inscim"), F.col("nrinscricaoestadual").alias("inest"),
        F.col("cdbanco").alias("banco"), F.col("cdagencia").alias("agenc"), F.col("cdcontacorrente").alias("conta"),
        F.lit(MODULE).alias("modulo"))


@derived
def supplier_matches(src: Legacy, ctx: MigrationContext) -> DataFrame:
    """Existing suppliers after the load: codant = legacy id of the last supplier matched to them."""
    ex = _existing(src).select("codif", "audesp_numero", "nome").withColumn("codant", F.lit(None).cast("string"))
    hits = _resolved(src).filter(F.col("match").isNotNull()) \
        .select("match", F.col("cdfornecedor").cast("string").alias("_codant"), "cdfornecedor")
    return merge_update(ex, hits, {"codif": "match"}, {"codant": "_codant"}, pick=["cdfornecedor"])


def suppliers_target(src: Legacy, ctx: MigrationContext) -> DataFrame:
    """The supplier table after the load: rows of other modules with the legacy id they were matched to, and this
    module's rows in place of those an earlier load left."""
    kept = _existing(src).drop("codant").join(supplier_matches(src, ctx).select("codif", "codant"), "codif")
    new = supplier_inserts(src, ctx)
    out = [*new.columns, "audesp_numero"]
    have = {c: F.col(c) if c in kept.columns else F.lit(None).cast(new.schema[c].dataType).alias(c) for c in out}
    return kept.select(*have.values()).unionByName(new.withColumn("audesp_numero", F.lit(None).cast("string")))


@derived
def supplier_master(src: Legacy, ctx: MigrationContext) -> DataFrame:
    """Target supplier table: existing suppliers (with codant) and the inserted ones."""
    existing = supplier_matches(src, ctx).select("codif", "nome", "codant", F.col("audesp_numero").alias("documento"))
    new = supplier_inserts(src, ctx).select("codif", "nome", "codant", F.translate("insmf", "./-", "").alias("documento"))
    return existing.unionByName(new)


@derived
def supplier_lookup(src: Legacy, ctx: MigrationContext) -> DataFrame:
    """One row per legacy id for the lookups of later jobs: the supplier with the lowest id."""
    m = supplier_master(src, ctx).filter(F.col("codant").isNotNull())
    return first_per_key(m.withColumn("codant", F.col("codant").cast("long")), ["codant"], ["codif"], take=["codif"])


# --- oracles ---------------------------------------------------------------------------------------

_SUPPLIER_TABLES = ["fornecedor", "enderecofornecedor", "municipio", "unidadefederacao", "contacorrentefornecedor",
                    "logradouro", "desfor_existing"]


def _oracle_supplier_ctes(ctx: MigrationContext) -> list[tuple[str, str]]:
    rows = ("select distinct u.sguf, m.nmmunicipio, f.nmfantasia, f.nmfornecedor, f.cdfornecedor, "
            "f.inpessoafisicajuridica, f.nrcgccpf, f.nrinscricaoestadual, f.nrinscricaomunicipal, e.cdcep, g.nmlogradouro, e.dsendereco, coalesce(e.dscomplementologradouro, '') "
            "dscomplementologradouro, c.cdbanco, c.cdagencia, c.cdcontacorrente from fornecedor f "
            "left join enderecofornecedor e on e.cdfornecedor = f.cdfornecedor "
            "left join municipio m on e.cdpais = m.cdpais and e.cduf = m.cduf and e.cdmunicipio = m.cdmunicipio "
            "left join unidadefederacao u on e.cdpais = u.cdpais and e.cduf = u.cduf "
            "left join logradouro g on e.cdpais = g.cdpais and e.cduf = g.cduf and e.cdmunicipio = g.cdmunicipio and e.cdlogradouro = g.cdlogradouro "
            "left join contacorrentefornecedor c on f.cdfornecedor = c.cdfornecedor")
    kept = f"select * from desfor_existing where modulo is distinct from '{MODULE}'"
    res = ("select r.*, coalesce((select min(x.codif) from skept x where x.audesp_numero = r.cnpj and x.insmf is not null), "
           "(select min(x.codif) from skept x where x.insmf is not null and x.nome = substring(r.nmfornecedor, 1, 50))) match "
           f"from (select *, {Q.doc_pad_a(Q.decimal14_text('nrcgccpf'))} cnpj from srows) r")
    first = ("select * from (select *, row_number() over (partition by cdfornecedor order by dsendereco desc nulls last, "
             "cdbanco desc nulls last, cdagencia desc nulls last, cdcontacorrente desc nulls last, sguf desc nulls last, "
             "nmmunicipio desc nulls last, cdcep desc nulls last, nmlogradouro desc nulls last) rn from sres where match is null) x where rn = 1")
    ins = (
        "select cast((select coalesce(max(codif), 0) from skept) + row_number() over (order by cdfornecedor) "
        "as bigint) codif, substring(nmfornecedor, 1, 50) nome, substring(nmfantasia, 1, 50) nom_fant, dsendereco ender, "
        "substring(dscomplementologradouro, 1, 20) compl, nmmunicipio cepci, sguf uf, cast(cdfornecedor as varchar) codant, "
        f"cdcep cep, {Q.doc_type('cnpj')} codtip, {Q.doc_mask('cnpj')} insmf, nrinscricaomunicipal inscim, nrinscricaoestadual inest, cdbanco banco, cdagencia agenc, cdcontacorrente conta, "
        f"'{MODULE}' modulo from sfirst")
    matches = ("select cast(x.codif as bigint) codif, x.audesp_numero, x.nome, (select cast(max(r.cdfornecedor) as varchar) from sres r "
               "where r.match = x.codif) codant from skept x")
    master = ("select codif, nome, codant, audesp_numero documento from smatches union all "
              "select codif, nome, codant, replace(replace(replace(insmf, '.', ''), '/', ''), '-', '') from sinserts")
    lookup = ("select cast(codant as bigint) codant, min(codif) codif from smaster where codant is not null "
              "group by cast(codant as bigint)")
    return [("srows", rows), ("skept", kept), ("sres", res), ("sfirst", first), ("sinserts", ins), ("smatches", matches),
            ("smaster", master), ("supplier_lookup", lookup)]


def oracle_lookup_ctes(ctx: MigrationContext) -> tuple[list[str], list[tuple[str, str]]]:
    return _SUPPLIER_TABLES, _oracle_supplier_ctes(ctx)


def _oracle(ctx: MigrationContext) -> dict[str, str]:
    ctes = _oracle_supplier_ctes(ctx)
    return {
        "cost_centers": oracle(_oracle_cost_centers(ctx), ["orgao", "desorc"]),
        "warehouses": oracle(_oracle_warehouses(ctx), ["almoxarifado"]),
        "supplier_inserts": oracle("select * from sinserts", _SUPPLIER_TABLES, ctes),
        "supplier_matches": oracle("select * from smatches", _SUPPLIER_TABLES, ctes),
        "suppliers_target": oracle("select k.codif, k.nome, m.codant, k.insmf, k.modulo, k.audesp_numero from skept k join smatches m using (codif) "
                                   "union all by name select * from sinserts", _SUPPLIER_TABLES, ctes),
        "supplier_master": oracle("select * from smaster", _SUPPLIER_TABLES, ctes),
    }


QUERIES = {
    "cost_centers": cost_centers,
    "warehouses": warehouses,
    "supplier_inserts": supplier_inserts,
    "supplier_matches": supplier_matches,
    "supplier_master": supplier_master,
    "suppliers_target": suppliers_target,
}
ORACLE = _oracle(MigrationContext())
