"""Master data: units, product groups and codes, cost centres, warehouses, suppliers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import MigrationContext
from ..functions import sqltext as Q
from ..functions.text import cut, title_case, zfill
from ..operators.numbering import global_number, hierarchical_code
from ..operators.quality import Split, quality_split
from ..sources.catalog import Legacy, derived, oracle, view


# --- P1 units of measure -------------------------------------------------------------------------

def units_of_measure(src: Legacy, ctx: MigrationContext) -> DataFrame:
    u = src["unidademedida"]
    return u.select(F.col("sgunidademedida").alias("sigla"), F.col("dsunidademedida").alias("descricao"))


ORACLE_UNITS = oracle("select sgunidademedida sigla, dsunidademedida descricao from unidademedida",
                      ["unidademedida"])


# --- P2 product groups ---------------------------------------------------------------------------

def _group_sources(src: Legacy, classes: str = "classificacao", goods: str | None = "classificacao_bens",
                   works: str | None = "classificacao_obras", products: str = "produto") -> DataFrame:
    """Class rows tagged with their product type; type-3 classes with no works class get a
    placeholder. UNION ALL of the three branches then UNION with the fourth: the last UNION
    removes duplicates from the whole result."""
    def branch(name: str, tipo: str) -> DataFrame:
        return src[name].select("cdclassereduzido", F.lit(tipo).alias("tipo"), "dsclassificacao")

    parts = [branch(classes, "1")]
    if goods:
        parts.append(branch(goods, "2"))
    if works:
        parts.append(branch(works, "3"))
    prod = src[products].filter(F.col("tpmaterial") == 3)
    if works:
        prod = prod.join(src[works].select("cdclassereduzido"), "cdclassereduzido", "left_anti")
    parts.append(prod.select("cdclassereduzido", F.lit("3").alias("tipo"), F.lit("NAO CADASTRADO").alias("dsclassificacao")))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows.distinct()


@derived
def _groups(src: Legacy, **kw) -> DataFrame:
    rows = _group_sources(src, **kw)
    numbered = global_number(rows, ["tipo", "cdclassereduzido", "dsclassificacao"], "_n")
    return numbered.select(
        zfill("_n", 3).alias("grupo"),
        cut(title_case("dsclassificacao"), 45).alias("nome"),
        F.lit("N").alias("ocultar"),
        F.col("cdclassereduzido").cast("string").alias("conv_id"),
        F.col("tipo").alias("conv_tipo"),
    )


def product_groups(src: Legacy, ctx: MigrationContext) -> DataFrame:
    return _groups(src)


def product_subgroups(src: Legacy, ctx: MigrationContext) -> DataFrame:
    g = _groups(src)
    return g.select("grupo", F.lit("000").alias("subgrupo"), "nome", "ocultar")


def _oracle_groups_cte(classes="classificacao", goods="classificacao_bens", works="classificacao_obras",
                       products="produto") -> str:
    branches = [f"select cdclassereduzido, '1' tipo, dsclassificacao from {classes}"]
    if goods:
        branches.append(f"select cdclassereduzido, '2' tipo, dsclassificacao from {goods}")
    if works:
        branches.append(f"select cdclassereduzido, '3' tipo, dsclassificacao from {works}")
        nc = (f"select cdclassereduzido, '3' tipo, 'NAO CADASTRADO' dsclassificacao from {products} p "
              f"where not exists (select 1 from {works} o where o.cdclassereduzido = p.cdclassereduzido) "
              f"and tpmaterial = 3")
    else:
        nc = (f"select cdclassereduzido, '3' tipo, 'NAO CADASTRADO' dsclassificacao from {products} p "
              f"where tpmaterial = 3")
    union_all = " union all ".join(branches)
    return (f"select {Q.zfill('n', 3)} grupo, substring({Q.title('dsclassificacao')}, 1, 45) nome, 'N' ocultar, "
            f"cast(cdclassereduzido as varchar) conv_id, tipo conv_tipo from ("
            f"select u.*, row_number() over (order by tipo nulls first, cdclassereduzido nulls first, "
            f"dsclassificacao nulls first) n from (select distinct * from ({union_all} union all {nc}) a) u) g")


ORACLE_GROUPS = oracle("select * from grupos",
                       ["classificacao", "classificacao_bens", "classificacao_obras", "produto"],
                       [("grupos", _oracle_groups_cte())])
ORACLE_SUBGROUPS = oracle("select grupo, '000' subgrupo, nome, ocultar from grupos",
                          ["classificacao", "classificacao_bens", "classificacao_obras", "produto"],
                          [("grupos", _oracle_groups_cte())])


# --- P3 product codes ----------------------------------------------------------------------------

@derived
def _product_split(src: Legacy, products: str = "produto", **group_kw) -> Split:
    """Products with the group of their class, accepted and rejected."""
    groups = _groups(src, products=products, **group_kw)
    p = src[products]
    u = src["unidademedida"].select("cdunidademedida", F.col("sgunidademedida").alias("unid1"))
    rows = p.join(u, "cdunidademedida", "left")
    g = groups.select("grupo", F.col("nome").alias("nome_grupo"),
                      F.col("conv_id").cast("int").alias("_gid"), F.col("conv_tipo").cast("int").alias("_gtipo"))
    tagged = rows.join(g, (rows.cdclassereduzido == g._gid) & (rows.tpmaterial == g._gtipo), "left")
    return quality_split(tagged, {"group not found": F.col("grupo").isNull()})


@derived
def _coded(src: Legacy, **kw) -> DataFrame:
    return hierarchical_code(_product_split(src, **kw)[0], ["tpmaterial", "cdclassereduzido"], ["cdmaterial"])


@view
def _product_codes(src: Legacy, **kw):
    """Returns (codes, overflow_subgroups, rejected)."""
    coded, rejected = _coded(src, **kw), _product_split(src, **kw)[1]
    codes = coded.select(
        F.concat_ws(".", "grupo", "subgrupo", "codigo").alias("cadpro"),
        "grupo", "subgrupo",
        F.col("cdmaterial").alias("codreduz"),
        "codigo",
        title_case("dsmaterial").alias("disc1"),
        title_case("dsmaterial").alias("discr1"),
        F.when(F.col("tpmaterial") == 3, "S").otherwise("P").alias("tipopro"),
        F.when(F.col("tpmaterial") == 2, "P").otherwise("C").alias("usopro"),
        "unid1",
    )
    overflow = (coded.filter(F.col("subgrupo") != "000")
                .select("grupo", "subgrupo", F.col("nome_grupo").alias("nome"), F.lit("N").alias("ocultar"))
                .distinct())
    return codes, overflow, rejected.select(F.col("cdmaterial").alias("codreduz"), "reason")


def product_codes(src: Legacy, ctx: MigrationContext) -> DataFrame:
    return _product_codes(src)[0]


def product_subgroup_overflow(src: Legacy, ctx: MigrationContext) -> DataFrame:
    """Subgroups that groups of more than 999 products need beyond '000'."""
    return _product_codes(src)[1]


def product_rejects(src: Legacy, ctx: MigrationContext) -> DataFrame:
    """Products whose class has no group, with the reason."""
    return _product_codes(src)[2]


def product_subgroup_overflow_wide(src: Legacy, ctx: MigrationContext) -> DataFrame:
    """Overflow subgroups of the wide product stand-in, whose groups hold thousands of products."""
    return _product_codes(src, products="produto_wide", classes="classificacao_wide", goods=None, works=None)[1]


def product_codes_wide(src: Legacy, ctx: MigrationContext) -> DataFrame:
    return _product_codes(src, products="produto_wide", classes="classificacao_wide", goods=None, works=None)[0]


def _oracle_codes_ctes(products="produto", **kw) -> list[tuple[str, str]]:
    coded = (
        "select p.*, u.sgunidademedida unid1, g.grupo, g.nome nome_grupo, "
        "row_number() over (partition by p.tpmaterial, p.cdclassereduzido order by p.cdmaterial nulls first) r "
        f"from {products} p left join unidademedida u on u.cdunidademedida = p.cdunidademedida "
        "join grupos g on cast(g.conv_id as int) = p.cdclassereduzido and cast(g.conv_tipo as int) = p.tpmaterial")
    split = ("select *, case when r > 999 then " + Q.zfill("r // 1000", 3) + " else '000' end subgrupo, "
             "case when r > 999 then right(cast(r as varchar), 3) else " + Q.zfill("r", 3) + " end codigo from coded")
    return [("grupos", _oracle_groups_cte(products=products, **kw)), ("coded", coded), ("split", split)]


_CODES_BODY = (
    "select grupo || '.' || subgrupo || '.' || codigo cadpro, grupo, subgrupo, cdmaterial codreduz, codigo, "
    f"{Q.title('dsmaterial')} disc1, {Q.title('dsmaterial')} discr1, "
    "case when tpmaterial = 3 then 'S' else 'P' end tipopro, case when tpmaterial = 2 then 'P' else 'C' end usopro, "
    "unid1 from split")
_OVERFLOW_BODY = "select distinct grupo, subgrupo, nome_grupo nome, 'N' ocultar from split where subgrupo <> '000'"
_WIDE = dict(products="produto_wide", classes="classificacao_wide", goods=None, works=None)

ORACLE_CODES = oracle(_CODES_BODY, ["classificacao", "classificacao_bens", "classificacao_obras", "produto",
                                    "unidademedida"], _oracle_codes_ctes())
ORACLE_CODES_WIDE = oracle(_CODES_BODY, ["classificacao_wide", "produto_wide", "unidademedida"],
                           _oracle_codes_ctes(**_WIDE))
_PRODUCT_TABLES = ["classificacao", "classificacao_bens", "classificacao_obras", "produto", "unidademedida"]
ORACLE_OVERFLOW = oracle(_OVERFLOW_BODY, _PRODUCT_TABLES, _oracle_codes_ctes())
ORACLE_OVERFLOW_WIDE = oracle(_OVERFLOW_BODY, ["classificacao_wide", "produto_wide", "unidademedida"],
                              _oracle_codes_ctes(**_WIDE))
ORACLE_REJECTS = oracle(
    "select cdmaterial codreduz, 'group not found' reason from produto where not exists (select 1 from grupos "
    "where conv_tipo = cast(tpmaterial as varchar) and conv_id = cast(cdclassereduzido as varchar))",
    _PRODUCT_TABLES, [("grupos", _oracle_groups_cte())])


QUERIES = {
    "units_of_measure": units_of_measure,
    "product_groups": product_groups,
    "product_subgroups": product_subgroups,
    "product_codes": product_codes,
    "product_codes_wide": product_codes_wide,
    "product_subgroup_overflow": product_subgroup_overflow,
    "product_subgroup_overflow_wide": product_subgroup_overflow_wide,
    "product_rejects": product_rejects,
}
ORACLE = {
    "units_of_measure": ORACLE_UNITS,
    "product_groups": ORACLE_GROUPS,
    "product_subgroups": ORACLE_SUBGROUPS,
    "product_codes": ORACLE_CODES,
    "product_codes_wide": ORACLE_CODES_WIDE,
    "product_subgroup_overflow": ORACLE_OVERFLOW,
    "product_subgroup_overflow_wide": ORACLE_OVERFLOW_WIDE,
    "product_rejects": ORACLE_REJECTS,
}
