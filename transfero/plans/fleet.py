"""Fleet: drivers, vehicles with their cost centres, fuel consumption as requisitions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import MigrationContext
from ..functions import sqltext as Q
from ..functions.text import cut, zfill
from ..operators.joins import containment_join
from ..operators.merge import merge_update
from ..operators.numbering import control_break, first_per_key, global_number
from ..operators.quality import Split, arithmetic, quality_split
from ..sources.catalog import Legacy, derived, oracle
from . import suppliers, warehouse

# Fixed values of the target system.
ODOMETER = "Hodômetro"
AVERAGE_UNIT = "Km/L"
DISTANCE_TCE = "01 - Quilômetros"
NEW_CENTRE = {"poder": "02", "orgao": "01", "unidade": "01", "destino": "000000001", "ccusto": "001"}
NO_LOT = "000000000"


def drivers(src: Legacy, ctx: MigrationContext) -> DataFrame:
    m = src["motorista"]
    return m.select(
        F.col("cdfuncionario").cast("long").alias("cod"),
        F.col("nmfuncionario").alias("nome"),
        F.col("nrcarteirahabilitacao").cast("decimal(20,0)").cast("string").alias("cnh"),
        F.col("dslogradouro").alias("secretaria"),
        cut("nrfonemotorista", 15).alias("telefone_celular"),
        F.col("dtvalidadehabilitacao").alias("dtvenccnh"), F.col("cdcategoriahabilitacao").alias("categcnh"))


def _plate(col: str) -> F.Column:
    return F.replace(F.replace(F.col(col), F.lit("-"), F.lit("")), F.lit(" "), F.lit(""))


@derived
def _vehicles(src: Legacy) -> DataFrame:
    v = src["frotas_veiculo"].filter(F.col("nrplacaveiculo") != "")
    p = src["produto"].select(F.col("cdmaterial").alias("cdcombustivel"), "descricao_unica")
    t = src["tipoveiculo"].select("cdtpveiculo", F.col("dstpveiculo").alias("tipo"))
    return v.join(t, "cdtpveiculo", "left").join(p, "cdcombustivel", "left").withColumn("placa", _plate("nrplacaveiculo")) \
        .filter(F.col("placa") != "")  # a plate of dashes or blanks would match every text


def vehicles(src: Legacy, ctx: MigrationContext) -> DataFrame:
    """The model is the model year, as in the source job; ``tipo`` is the vehicle type it reads but does not write."""
    v = _vehicles(src)
    return v.select(
        F.col("cdveiculo").alias("sequencia"), "placa", F.col("dtanofabricacao").alias("ano"),
        F.col("dtanomodelo").alias("modelo"), F.col("dtanomodelo").alias("anomod"), F.col("nrrenavan").alias("renavam"),
        F.col("nrchassi").alias("chassi"), F.col("nrmarcadorinicial").alias("kminicial"),
        F.col("nrmarcadoratual").alias("kmatual"), "tipo",
        cut("descricao_unica", 1).alias("combustivel"), F.lit(ODOMETER).alias("tipo_marcador"),
        F.lit(AVERAGE_UNIT).alias("tipo_media"), F.lit(DISTANCE_TCE).alias("deslocamento_tce"))


@derived
def _centres_before(src: Legacy, ctx: MigrationContext) -> DataFrame:
    """Cost centres present before the vehicle load: the migrated ones and the plate centres."""
    cc = suppliers.cost_centers(src, ctx).select("codccusto", "descr", "destino", "ccusto", "empresa", "ocultar", "poder", "orgao", "unidade")
    plates = src["centrocusto_placa"].select(F.col("codccusto").cast("long").alias("codccusto"), "descr")
    return cc.unionByName(plates, allowMissingColumns=True).withColumn("placa", F.lit(None).cast("string"))


@derived
def vehicle_cost_centers(src: Legacy, ctx: MigrationContext) -> DataFrame:
    """Each vehicle is matched to the first cost centre (lowest id) whose description, upper-cased and
    without blanks, contains its plate; the centre gets the plate (the last vehicle in load order,
    newest first, wins). Vehicles without a centre get a new one numbered after the maximum."""
    centres = _centres_before(src, ctx)
    v = _vehicles(src).select("cdveiculo", "placa", "dtanofabricacao")
    searchable = centres.filter(F.lower(F.col("descr")).contains("placa")) \
        .select("codccusto", F.upper(F.replace(F.col("descr"), F.lit(" "), F.lit(""))).alias("_text"))
    pairs = containment_join(v, "placa", searchable, "_text")
    first = first_per_key(pairs, ["cdveiculo"], ["codccusto"], take=["codccusto"])
    v = v.join(first, "cdveiculo", "left")
    # Load order: newest vehicle first, then vehicle id; the last matching vehicle sets the plate.
    matched = v.filter(F.col("codccusto").isNotNull())
    updated = merge_update(centres, matched, ["codccusto"], {"placa": "placa"},
                           pick=[F.col("dtanofabricacao").isNull(), -F.col("dtanofabricacao"), F.col("cdveiculo")])
    top = centres.agg(F.coalesce(F.max("codccusto"), F.lit(0)).cast("long").alias("_max"))
    new = global_number(v.filter(F.col("codccusto").isNull()).drop("codccusto").crossJoin(F.broadcast(top)),
                        [F.col("dtanofabricacao").desc_nulls_last(), F.col("cdveiculo").asc()], "codccusto",
                        start=F.col("_max"))
    new = new.select(F.col("codccusto"), F.col("placa").alias("descr"), F.lit(NEW_CENTRE["destino"]).alias("destino"),
                     F.lit(NEW_CENTRE["ccusto"]).alias("ccusto"), F.lit(ctx.company).alias("empresa"),
                     F.lit("N").alias("ocultar"), "placa",
                     *[F.lit(NEW_CENTRE[k]).alias(k) for k in ("poder", "orgao", "unidade")])
    return updated.unionByName(new, allowMissingColumns=True)


@derived
def _fuel(src: Legacy, ctx: MigrationContext) -> Split:
    y = ctx.fleet_year
    m = src["movtoveiculo"].filter((F.col("dtmovimento") >= F.lit(f"{y}-01-01").cast("date"))
                                   & (F.col("dtmovimento") < F.lit(f"{y + 1}-01-01").cast("date"))
                                   & (F.col("cditemmaterial") > 0))
    v = src["frotas_veiculo"].filter(F.col("nrplacaveiculo") != "") \
        .select("cdveiculo", _plate("nrplacaveiculo").alias("placa"))
    rows = m.join(v, "cdveiculo")
    prod = warehouse._products(src).withColumnRenamed("cdmaterial", "cditemmaterial")
    rows = rows.join(prod, "cditemmaterial", "left")
    return quality_split(rows, {"product code not found": F.col("cadpro").isNull(),
                                   "zero quantity": F.col("qtmovimentada") == 0, **arithmetic("vlvalor", "qtmovimentada")})


@derived
def _fuel_numbered(src: Legacy, ctx: MigrationContext) -> DataFrame:
    ok, _ = _fuel(src, ctx)
    rows = ok.crossJoin(F.broadcast(warehouse.requisition_high_water(src, ctx)))
    return control_break(rows, ["dtmovimento"], ["nrsequencia"], "_hdr", "item")


def fuel_items(src: Legacy, ctx: MigrationContext) -> DataFrame:
    rows = _fuel_numbered(src, ctx)
    centres = vehicle_cost_centers(src, ctx).filter(F.col("placa").isNotNull()) \
        .groupBy("placa").agg(F.min("codccusto").alias("codccusto"))
    rows = rows.join(centres, "placa", "left")
    num = zfill(F.col("_hdr") + F.col("_num0"), 6)
    unit = F.col("vlvalor").cast("double") / F.col("qtmovimentada").cast("double")
    return rows.select(
        F.concat(num, F.lit("/" + ctx.fleet_yy)).alias("requi"),
        "item", "cadpro",
        F.col("qtmovimentada").cast("double").alias("quan1"), F.col("qtmovimentada").cast("double").alias("quan2"),
        unit.alias("vaun1"), unit.alias("vaun2"), F.lit(NO_LOT).alias("lote"),
        F.col("vlvalor").cast("double").alias("vato1"), F.col("vlvalor").cast("double").alias("vato2"),
        "placa", F.col("nrmarcador").alias("km"), F.col("nrnfdepartamento").alias("documento"), "codccusto",
        (F.col("_hdr") + F.col("_id0")).cast("long").alias("id_requi"), F.lit(ctx.company).alias("empresa"))


def fuel_requisitions(src: Legacy, ctx: MigrationContext) -> DataFrame:
    rows = _fuel_numbered(src, ctx)
    heads = first_per_key(rows, ["_hdr"], ["item"], take=["dtmovimento", "cdfornecedormotorista", "nrnfdepartamento", "_id0", "_num0"])
    look = suppliers.supplier_lookup(src, ctx)
    heads = heads.join(look, heads.cdfornecedormotorista == look.codant, "left")
    num = zfill(F.col("_hdr") + F.col("_num0"), 6)
    return heads.select(
        F.concat(num, F.lit("/" + ctx.fleet_yy)).alias("requi"), num.alias("num"), F.lit(ctx.fleet_year).alias("ano"),
        F.col("dtmovimento").alias("dtlan"), F.col("dtmovimento").alias("datae"), F.col("dtmovimento").alias("dtpag"),
        "codif", F.col("nrnfdepartamento").alias("docum"), F.lit("S").alias("entr"), F.lit("S").alias("said"), F.lit("P").alias("comp"),
        F.lit("R").alias("tiposaida"), F.lit("S").alias("entr_said"),
        (F.col("_hdr") + F.col("_id0")).cast("long").alias("id_requi"), F.lit(ctx.company).alias("empresa"))


def fuel_rejected(src: Legacy, ctx: MigrationContext) -> DataFrame:
    _, bad = _fuel(src, ctx)
    return bad.select("nrsequencia", "cdveiculo", "dtmovimento", "cditemmaterial", "reason")


# --- oracles ---------------------------------------------------------------------------------------

_FLEET_TABLES = ["frotas_veiculo", "produto", "centrocusto_placa", "orgao", "desorc"]


def _oracle_fleet_ctes(ctx: MigrationContext) -> list[tuple[str, str]]:
    plate = "replace(replace(nrplacaveiculo, '-', ''), ' ', '')"
    veh = (f"select v.*, {plate} placa, p.descricao_unica from frotas_veiculo v left join produto p "
           "on p.cdmaterial = v.cdcombustivel where v.nrplacaveiculo <> ''")
    cc = (f"select codccusto, descr, destino, ccusto, empresa, ocultar, cast(null as varchar) placa, "
          "poder, orgao, unidade from ccmig "
          "union all select cast(codccusto as bigint), descr, null, null, null, null, null, null, null, null "
          "from centrocusto_placa")
    match = ("select v.cdveiculo, v.placa, v.dtanofabricacao, (select min(c.codccusto) from cc0 c where "
             "lower(c.descr) like '%placa%' and contains(upper(replace(c.descr, ' ', '')), v.placa)) codccusto from veh v")
    upd = ("select c.* replace (coalesce((select m.placa from vmatch m where m.codccusto = c.codccusto "
           "order by m.dtanofabricacao asc nulls first, m.cdveiculo desc limit 1), c.placa) as placa) from cc0 c")
    new = ("select cast((select coalesce(max(codccusto), 0) from cc0) + row_number() over (order by dtanofabricacao "
           f"desc nulls last, cdveiculo) as bigint) codccusto, placa descr, '{NEW_CENTRE['destino']}' destino, "
           f"'{NEW_CENTRE['ccusto']}' ccusto, {ctx.company} empresa, 'N' ocultar, placa, '{NEW_CENTRE['poder']}' poder, "
           f"'{NEW_CENTRE['orgao']}' orgao, '{NEW_CENTRE['unidade']}' unidade from vmatch where codccusto is null")
    from . import suppliers as S
    return [("ccmig", S._oracle_cost_centers(ctx)), ("veh", veh), ("cc0", cc), ("vmatch", match), ("ccupd", upd),
            ("ccnew", new), ("vcc", "select * from ccupd union all select * from ccnew")]


def _oracle_fuel_ctes(ctx: MigrationContext) -> list[tuple[str, str]]:
    y = ctx.fleet_year
    rows = ("select m.*, replace(replace(v.nrplacaveiculo, '-', ''), ' ', '') placa, c.cadpro from movtoveiculo m "
            f"join frotas_veiculo v on v.cdveiculo = m.cdveiculo left join codes c on c.codreduz = m.cditemmaterial "
            f"where year(m.dtmovimento) = {y} and m.cditemmaterial > 0 and v.nrplacaveiculo <> ''")
    ok = "select * from frows where cadpro is not null and qtmovimentada <> 0 and vlvalor is not null"
    hw = ("select (select coalesce(max(id_requi), 0) from (select id_requi from wreq union all select id_requi "
          "from opening union all select id_requi from rkept)) id0, (select coalesce(max(cast(num as bigint)), 0) from "
          "(select num from wreq union all select num from rkept)) num0")
    heads = "select dtmovimento, row_number() over (order by dtmovimento) n from (select distinct dtmovimento from fok) d"
    items = ("select f.*, h.n, row_number() over (partition by h.n order by f.nrsequencia) item from fok f "
             "join fheads h using (dtmovimento)")
    return [("frows", rows), ("fok", ok), ("hw", hw), ("fheads", heads), ("fitems", items)]


def oracle_bodies(ctx: MigrationContext) -> dict:
    """Tables, CTEs and bodies of the fuel oracles."""
    yy = ctx.fleet_yy
    wh_ctes = warehouse._oracle_movement_ctes(ctx)
    sup_tables, sup_ctes = suppliers.oracle_lookup_ctes(ctx)
    wreq = ("wreq", warehouse._requisitions_sql(ctx))
    fleet = _oracle_fleet_ctes(ctx)
    fuel = _oracle_fuel_ctes(ctx)
    all_tables = sorted(set(_FLEET_TABLES + warehouse._WAREHOUSE_TABLES + sup_tables + ["movtoveiculo"]))
    num = Q.zfill("(n + num0)", 6)
    items = (f"select {num} || '/{yy}' requi, cast(item as bigint) item, cadpro, cast(qtmovimentada as double) quan1, "
             "cast(qtmovimentada as double) quan2, cast(vlvalor as double) / cast(qtmovimentada as double) vaun1, "
             "cast(vlvalor as double) / cast(qtmovimentada as double) vaun2, "
             f"'{NO_LOT}' lote, cast(vlvalor as double) vato1, cast(vlvalor as double) vato2, i.placa, nrmarcador km, nrnfdepartamento documento, "
             "(select min(c.codccusto) from vcc c where c.placa = i.placa) codccusto, cast(n + id0 as bigint) id_requi, "
             f"{ctx.company} empresa from fitems i, hw")
    heads = (f"select {num} || '/{yy}' requi, {num} num, {ctx.fleet_year} ano, dtmovimento dtlan, dtmovimento datae, "
             "dtmovimento dtpag, (select s.codif from supplier_lookup s where s.codant = i.cdfornecedormotorista) codif, nrnfdepartamento docum, "
             "'S' entr, 'S' said, 'P' comp, 'R' tiposaida, 'S' entr_said, cast(n + id0 as bigint) id_requi, "
             f"{ctx.company} empresa from fitems i, hw where item = 1")
    return {"tables": all_tables, "ctes": wh_ctes + sup_ctes + [wreq] + fleet + fuel, "fuel_items": items, "fuel_requisitions": heads}


def _oracle(ctx: MigrationContext) -> dict[str, str]:
    bodies = oracle_bodies(ctx)
    all_tables, full, items, heads = (bodies[k] for k in ("tables", "ctes", "fuel_items", "fuel_requisitions"))
    fleet, fuel = _oracle_fleet_ctes(ctx), _oracle_fuel_ctes(ctx)
    rejected = ("select nrsequencia, cdveiculo, dtmovimento, cditemmaterial, case when cadpro is null then "
                "'product code not found' when qtmovimentada = 0 then 'zero quantity' else 'NULL arithmetic input' end reason from frows where cadpro is null or "
                "qtmovimentada = 0 or qtmovimentada is null or vlvalor is null")
    drivers_sql = ("select cast(cdfuncionario as bigint) cod, nmfuncionario nome, cast(cast(nrcarteirahabilitacao as "
                   "decimal(20,0)) as varchar) cnh, dslogradouro secretaria, substring(nrfonemotorista, 1, 15) "
                   "telefone_celular, dtvalidadehabilitacao dtvenccnh, cdcategoriahabilitacao categcnh from motorista")
    veh_sql = (f"select cdveiculo sequencia, placa, dtanofabricacao ano, substring(descricao_unica, 1, 1) combustivel, "
               f"'{ODOMETER}' tipo_marcador, '{AVERAGE_UNIT}' tipo_media, '{DISTANCE_TCE}' deslocamento_tce, "
               "dtanomodelo modelo, dtanomodelo anomod, nrrenavan renavam, nrchassi chassi, nrmarcadorinicial kminicial, "
               "nrmarcadoratual kmatual, (select min(dstpveiculo) from tipoveiculo t where t.cdtpveiculo = veh.cdtpveiculo) tipo from veh")
    codes_and_fuel = [x for x in warehouse._oracle_opening_ctes(ctx) if x[0] in ("grupos", "coded", "split", "codes")] + fuel[:2]
    return {
        "drivers": oracle(drivers_sql, ["motorista"]),
        "vehicles": oracle(veh_sql, ["frotas_veiculo", "produto", "tipoveiculo"], [fleet[1]]),
        "vehicle_cost_centers": oracle("select * from vcc", _FLEET_TABLES, fleet),
        "fuel_items": oracle(items, all_tables, full),
        "fuel_requisitions": oracle(heads, all_tables, full),
        "fuel_rejected": oracle(rejected, ["movtoveiculo", "frotas_veiculo"] + warehouse._WAREHOUSE_TABLES[3:],
                                codes_and_fuel),
    }


QUERIES = {
    "drivers": drivers,
    "vehicles": vehicles,
    "vehicle_cost_centers": vehicle_cost_centers,
    "fuel_items": fuel_items,
    "fuel_requisitions": fuel_requisitions,
    "fuel_rejected": fuel_rejected,
}
ORACLE = _oracle(MigrationContext())
