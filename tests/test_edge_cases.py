"""Job rules on hand-made legacy rows: cases the test tables do not reach (FIXTURES §5)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from transfero.context import MigrationContext
from transfero.plans import assets, quotation, suppliers
from transfero.sources.catalog import Catalog


class FakeLegacy(Catalog):
    """Catalog over hand-made DataFrames."""

    def __init__(self, tables):
        super().__init__(None)
        self.tables = tables

    def read(self, name):
        return self.tables[name]


CTX = MigrationContext()
T = dt.datetime


def test_identical_depreciation_rows_collapse(spark):
    # Two identical depreciation rows become one ledger row (the final UNION removes duplicates).
    mov = spark.createDataFrame([], "cditem bigint, dtmovimento timestamp_ntz, intipomovimento string, "
                                    "vlareavaliar decimal(18,5), vlanterior decimal(18,5), cdlocalanterior int, "
                                    "cdlocalatual int, inestorno int, cdtpbaixa int, chmovimento bigint, cdmotivo int, dsobservacao string, dsfundamento string")
    dep = spark.createDataFrame(
        [(1, T(2000, 1, 1), Decimal("5"), 0, None), (1, T(2000, 1, 1), Decimal("5"), 0, None),
         (2, T(2000, 1, 1), Decimal("7"), 0, None), (2, T(2000, 2, 1), Decimal("7"), -1, T(2000, 1, 1))],
        "cditem bigint, dtmovimento timestamp_ntz, vldepreciacao decimal(18,5), inestorno int, dtestorno timestamp_ntz")
    comp = spark.createDataFrame([], "cditem bigint, dtmovimento timestamp_ntz, vlcomplementar decimal(18,5), inestorno int")
    item = spark.createDataFrame([(1,), (2,)], "cditem bigint")
    src = FakeLegacy({"patri_movimento": mov, "movimentodepreciacao": dep, "movimentovlcomplementar": comp,
                      "patri_item": item, "motivo": spark.createDataFrame([], "cdmotivo int, dsmotivo string")})
    rows = assets._ledger_source(src).collect()
    # item 1: duplicates collapse; item 2: cancelled by its reversal (same item, date and value).
    assert [(r["cditem"], r["valor"]) for r in rows] == [(1, Decimal("-5.00000"))]


def test_shared_existing_supplier_takes_last_legacy_id(spark):
    # Two legacy suppliers match the same existing supplier by name: the larger legacy id wins.
    forn = spark.createDataFrame([(10, "ACME", "A", Decimal("123"), "J", None, None), (11, "ACME", "B", Decimal("456"), "J", None, None)],
                                 "cdfornecedor bigint, nmfornecedor string, nmfantasia string, nrcgccpf decimal(14,0), "
                                 "inpessoafisicajuridica string, nrinscricaoestadual string, nrinscricaomunicipal string")
    empty_end = spark.createDataFrame([], "cdfornecedor bigint, cdpais int, cduf int, cdmunicipio int, "
                                          "dsendereco string, dscomplementologradouro string, cdcep string, cdlogradouro int")
    src = FakeLegacy({
        "fornecedor": forn, "enderecofornecedor": empty_end,
        "municipio": spark.createDataFrame([], "cdpais int, cduf int, cdmunicipio int, nmmunicipio string"),
        "unidadefederacao": spark.createDataFrame([], "cdpais int, cduf int, sguf string"),
        "contacorrentefornecedor": spark.createDataFrame([], "cdfornecedor bigint, cdbanco bigint, cdagencia bigint, "
                                                             "cdcontacorrente bigint"),
        "logradouro": spark.createDataFrame([], "cdpais int, cduf int, cdmunicipio int, cdlogradouro int, nmlogradouro string"),
        # an earlier load's row of the module is replaced, and one without a document is not matched
        "desfor_existing": spark.createDataFrame([(500, None, "ACME", "DOC", None), (400, None, "ACME", "DOC", "COMPRAS"), (300, None, "ACME", None, "X")],
                                                 "codif bigint, audesp_numero string, nome string, insmf string, modulo string"),
    })
    m = suppliers.supplier_matches(src, CTX).collect()
    assert sorted((r["codif"], r["codant"]) for r in m) == [(300, None), (500, "11")]
    assert suppliers.supplier_inserts(src, CTX).count() == 0


def test_price_mean_ignores_bids_without_supplier(spark, monkeypatch):
    # valunt = sum of positive prices / number of bids that have a supplier (a NULL supplier still adds its price).
    bids = spark.createDataFrame(
        [("00001/98", 1, "198", Decimal("10"), 7), ("00001/98", 1, "198", Decimal("20"), None),
         ("00001/98", 1, "198", Decimal("0"), 8)],
        "numorc string, item bigint, id_cadorc string, vlruni decimal(18,5), codif bigint") \
        .withColumn("vlruni", F.col("vlruni").cast("double")).withColumn("ganhou", F.lit(7).cast("bigint"))
    items = spark.createDataFrame([("00001/98", 1, "198", 2.0)], "numorc string, item bigint, id_cadorc string, qtd double")
    monkeypatch.setattr(quotation, "quotation_bids", lambda src, ctx: bids)
    monkeypatch.setattr(quotation, "_items", lambda src: (items, None))
    r = quotation.quotation_item_prices(FakeLegacy({}), CTX).first()
    assert r["valunt"] == 30.0 and r["valtot"] == 60.0 and r["codif"] == 7


def test_texts_are_cut_at_their_limits(spark):
    from transfero.functions.text import cut, title_case
    long = "a" * 300
    r = spark.createDataFrame([(long,)], "v string").select(
        cut("v", 255).alias("c255"), cut(title_case("v"), 45).alias("t45"), cut("v", 1024).alias("c1024")).first()
    assert len(r["c255"]) == 255 and len(r["t45"]) == 45 and r["t45"].startswith("Aaa") and len(r["c1024"]) == 300
