"""Ledger rows that differ only in a text stay apart; equal ones become one."""

import datetime as dt
from decimal import Decimal

from transfero.plans import assets

from .test_edge_cases import FakeLegacy


def test_texts_take_part_in_the_union(spark):
    long = "artigo " * 500
    row = lambda note, reason, basis: (1, dt.datetime(2000, 1, 1), "R", Decimal(5), Decimal(3), None, 2, 0, None, 7, reason, note, basis)
    mov = spark.createDataFrame([row("n", 1, long + "1"), row("n", 1, long + "2"), row("n", 1, long + "2"), row("n", 2, long + "2"), row("m", 2, None),
                                 row("m", 9, None), row("x" * 30 + "a", 1, None), row("x" * 30 + "b", 1, None)],
                                "cditem bigint, dtmovimento timestamp_ntz, intipomovimento string, vlareavaliar decimal(18,5), vlanterior decimal(18,5), "
                                "cdlocalanterior int, cdlocalatual int, inestorno int, cdtpbaixa int, chmovimento bigint, cdmotivo int, dsobservacao string, dsfundamento string")
    none = {"movimentodepreciacao": "cditem bigint, dtmovimento timestamp_ntz, vldepreciacao decimal(18,5), inestorno int, dtestorno timestamp_ntz",
            "movimentovlcomplementar": "cditem bigint, dtmovimento timestamp_ntz, vlcomplementar decimal(18,5), inestorno int", "patri_item": "cditem bigint"}
    src = FakeLegacy({"patri_movimento": mov, "motivo": spark.createDataFrame([(1, "A"), (2, "B")], "cdmotivo int, dsmotivo string"),
                      **{k: spark.createDataFrame([], v) for k, v in none.items()}})
    got = sorted(((r["obs"], r["dsmotivo"], r["dsfundamento"]) for r in assets._ledger_source(src).collect()), key=str)
    assert got == sorted([("n", "A", long + "1"), ("n", "A", long + "2"), ("n", "B", long + "2"), ("m", "B", None), ("m", None, None), ("x" * 30, "A", None)], key=str)
