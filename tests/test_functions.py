"""Text rules against hand-made values (cases the test tables do not reach)."""

from pyspark.sql import functions as F

from transfero.functions import text as T


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_title_case_matches_python(spark):
    for s in ["O'NEIL 3M PRE-MOLDADO", "ação de graças", "x", "", "a1b2 c3", "MÁQUINA  DE CAFÉ"]:
        assert one(spark, T.title_case("v"), s) == s.title()


def test_capitalize_matches_python(spark):
    for s in ["hELLO World", "a", "ÉCOLE"]:
        assert one(spark, T.capitalize("v"), s) == s.capitalize()


def test_keep_right_vs_zfill(spark):
    assert one(spark, T.keep_right("v", 5), "123456") == "23456"
    assert one(spark, T.keep_right("v", 5), "12") == "00012"
    assert one(spark, T.zfill("v", 5), "123456") == "123456"
    assert one(spark, T.zfill("v", 5), "12") == "00012"


def test_year_formats(spark):
    for y, mod, fmt, chars in [(2005, "5", "05", "05"), (1999, "1999", "1999", "99"), (2012, "12", "12", "12")]:
        assert one(spark, T.year_mod_2000("v"), y, "v int") == mod
        assert one(spark, T.year_2digits_fmt("v"), y, "v int") == fmt
        assert one(spark, T.year_chars_3_4("v"), y, "v int") == chars


def test_documents(spark):
    assert one(spark, T.doc_mask("v"), "12345678901") == "123.456.789-01"
    assert one(spark, T.doc_mask("v"), "12345678000190") == "12.345.678/0001-90"
    assert one(spark, T.doc_mask("v"), "123") == "123"
    assert one(spark, T.doc_type("v"), "12345678901") == "02"
    assert one(spark, T.doc_type("v"), "12345678000190") == "01"
    assert one(spark, T.doc_pad_a("v"), "123456789012") == "00123456789012"
    assert one(spark, T.doc_pad_a("v"), "1234567890") == "01234567890"
    assert one(spark, T.doc_pad_b("v"), "1234567890123") == "01234567890123"
    assert one(spark, T.doc_pad_b("v"), "123") == "00000000123"
    assert one(spark, T.doc_unmask("v"), "12.345.678/0001-90") == "12345678000190"


def test_lot_item_number(spark):
    df = spark.createDataFrame([(1, 5, 1), (2, 5, 2), (12, 5, 12), (1, 120, 2)], "lot int, item int, lots int")
    got = [r["n"] for r in df.select(T.lot_item_number("lot", "item", "lots").alias("n")).collect()]
    assert got == [5, 25, 1205, 10120]


def test_year_plus_one_clamps(spark):
    r = spark.sql("select add_months(date'2024-02-29', 12) d").first()["d"]
    assert str(r) == "2025-02-28"
