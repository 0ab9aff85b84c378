"""Operators on small hand-made frames, compared with the obvious single-task formulation."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from transfero.operators.joins import containment_join
from transfero.operators.ledger import chained_fill
from transfero.operators.merge import delete_in, delete_where, insert_absent, merge_update, rows_absent, update_where
from transfero.operators.numbering import control_break, first_per_key, global_number, group_number, hierarchical_code
from transfero.operators.quality import arithmetic, key_split, quality_split


def test_global_number_equals_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") % 37).alias("g"), (F.col("id") * 7919 % 5000).alias("k"))
    df = df.repartition(11)
    got = global_number(df, ["g", "k"], "n", start=10)
    ref = df.withColumn("n", F.row_number().over(Window.orderBy("g", "k")) + 10)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ref.select("g", "k", "n").collect()))
    assert got.agg(F.min("n"), F.max("n"), F.countDistinct("n")).first() == (11, 5010, 5000)


def test_global_number_descending_and_nulls(spark):
    df = spark.createDataFrame([(None,), (3,), (1,), (2,)], "x int")
    got = {r["x"]: r["n"] for r in global_number(df, [F.col("x").desc_nulls_last()], "n").collect()}
    assert got == {3: 1, 2: 2, 1: 3, None: 4}


def test_group_number_with_one_hot_group(spark):
    # One group holds most rows: numbering must still restart per group and stay dense.
    df = spark.range(0, 3000).select(F.when(F.col("id") < 2000, 0).otherwise(F.col("id") % 5 + 1).alias("g"),
                                     F.col("id").alias("k"))
    got = group_number(df, ["g"], ["k"], "n")
    ref = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("k")))
    assert sorted(map(tuple, got.select("g", "k", "n").collect())) == sorted(map(tuple, ref.collect()))


def test_hierarchical_code_overflow(spark):
    df = spark.range(1, 2101).select(F.lit(1).alias("g"), F.col("id").alias("k"))
    got = {r["k"]: (r["subgrupo"], r["codigo"]) for r in hierarchical_code(df, ["g"], ["k"]).collect()}
    assert got[999] == ("000", "999") and got[1000] == ("001", "000") and got[2000] == ("002", "000")
    assert got[2100] == ("002", "100")


def test_control_break(spark):
    df = spark.createDataFrame([("b", 2), ("a", 1), ("b", 1), ("a", 3), ("c", 1)], "h string, o int")
    got = sorted(map(tuple, control_break(df, ["h"], ["o"], "hid", "item", start=100).select("h", "o", "hid", "item").collect()))
    assert got == [("a", 1, 101, 1), ("a", 3, 101, 2), ("b", 1, 102, 1), ("b", 2, 102, 2), ("c", 1, 103, 1)]


def test_first_per_key(spark):
    df = spark.createDataFrame([(1, 5, "x"), (1, 3, "y"), (2, None, "z"), (2, 1, "w")], "k int, o int, v string")
    first = {r["k"]: r["v"] for r in first_per_key(df, ["k"], ["o"], take=["v"]).collect()}
    last = {r["k"]: r["v"] for r in first_per_key(df, ["k"], ["o"], take=["v"], last=True).collect()}
    assert first == {1: "y", 2: "z"}   # NULL sorts first
    assert last == {1: "x", 2: "w"}


def test_chained_fill(spark):
    # asset 1: 5, fill, fill, NULL(non-fillable), fill ; asset 2 starts with a fillable row
    rows = [(1, 1, 5, False), (1, 2, None, True), (1, 3, 0, True), (1, 4, None, False), (1, 5, None, True),
            (2, 6, None, True), (2, 7, 9, False), (2, 8, None, True)]
    df = spark.createDataFrame(rows, "a int, id int, v int, f boolean").repartition(3)
    got = {r["id"]: r["v"] for r in chained_fill(df, ["a"], "id", "v", F.col("f")).collect()}
    assert got == {1: 5, 2: 5, 3: 5, 4: None, 5: 0, 6: 0, 7: 9, 8: 9}


def test_merge_update_picks_last(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    s = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (3, None, 1)], "k int, v string, o int")
    got = dict(map(tuple, merge_update(t, s, ["k"], {"v": "v"}, pick=["o"]).collect()))
    assert got == {1: "y", 2: "b", 3: None}


def test_update_insert_replace(spark):
    t = spark.createDataFrame([(1, 10), (2, None)], "k int, v int")
    u = dict(map(tuple, update_where(t, {"v": F.lit(0)}, F.col("v") > 5).collect()))
    assert u == {1: 0, 2: None}
    new = spark.createDataFrame([(2, 7), (3, 8)], "k int, v int")
    assert sorted(map(tuple, insert_absent(t, new, ["k"]).collect()), key=str) == sorted([(1, 10), (2, None), (3, 8)], key=str)
    assert sorted(map(tuple, delete_where(t, F.col("v") > 5).collect()), key=str) == [(2, None)]
    assert sorted(map(tuple, delete_where(t, F.col("v") != 10).collect()), key=str) == sorted([(1, 10), (2, None)], key=str)
    with_none = t.unionByName(spark.createDataFrame([(None, 4)], "k int, v int"))
    gone = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert sorted(map(tuple, delete_in(with_none, gone, "k").collect()), key=str) == sorted([(2, None), (None, 4)], key=str)


def test_rows_absent_on_a_composite_key(spark):
    have = spark.createDataFrame([(1, 1, "x"), (1, None, "x"), (2, 2, None), (1, 1, "x")], "a int, b int, c string")
    new = spark.createDataFrame([(1, 1, "x", 5), (1, None, "x", 6), (2, 2, None, 7), (1, 1, "y", 8), (1, 1, "x", 9)], "a int, b int, c string, v int")
    got = rows_absent(have, new, ["a", "b", "c"]).collect()
    # a NULL equals nothing, not even a NULL: such rows are inserted again
    assert sorted(r["v"] for r in got) == [6, 7, 8] and got[0].asDict().keys() == {"a", "b", "c", "v"}
    assert insert_absent(have, new, ["a", "b", "c"]).count() == 4 + 3
    assert rows_absent(have.limit(0), new, ["a", "b", "c"]).count() == 5


def test_key_split(spark):
    import random
    r = random.Random(3)
    rows = [(r.choice([None, 1, 2, 3, 500]) if i > 900 else 500, r.choice([0, 0, 1, None]), r.choice([None, "a", "b"]), r.randrange(3)) for i in range(1500)]
    ok, bad = key_split(spark.createDataFrame(rows, "k int, k2 int, o string, v int"), ["k", "k2"], ["o"])
    first, refused = {}, 0
    for k, k2, o, v in sorted(rows, key=lambda x: (x[2] is not None, x[2] or "", x[3])):
        if k is None or k2 is None:
            refused += 1
        elif (k, k2) in first:
            refused += 1
        else:
            first[k, k2] = (k, k2, o, v)
    assert sorted(map(tuple, ok.collect()), key=str) == sorted(first.values(), key=str)
    found = bad.collect()
    assert sum(x["n_rows"] for x in found) == refused and {x["reason"] for x in found} == {"duplicate key", "NULL in key"}
    assert len(rows) == refused + len(first)
    empty = key_split(spark.createDataFrame([], "k int, v int"), ["k"], ["v"])
    assert empty[0].count() == empty[1].count() == 0


def test_arithmetic_rule(spark):
    df = spark.createDataFrame([(1, 2), (None, 2), (1, None)], "a int, b int")
    ok, bad = quality_split(df, arithmetic("a", "b"))
    assert ok.count() == 1 and [x["reason"] for x in bad.collect()] == ["NULL arithmetic input"] * 2


def test_containment_join(spark):
    plates = spark.createDataFrame([(1, "ABC1234"), (2, "XYZ9"), (3, "NOPE")], "id int, p string")
    texts = spark.createDataFrame([(10, "CARROABC1234"), (11, "XYZ9XYZ9"), (12, "ABC1234")], "c int, t string")
    got = sorted(map(tuple, containment_join(plates, "p", texts, "t").select("id", "c").collect()))
    brute = sorted(map(tuple, plates.crossJoin(texts).filter(F.col("t").contains(F.col("p"))).select("id", "c").collect()))
    assert got == brute


def test_quality_split_is_total(spark):
    df = spark.range(0, 100).select("id", F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id")).alias("v"))
    ok, bad = quality_split(df, {"null value": F.col("v").isNull(), "big": F.col("v") > 90})
    assert ok.count() + bad.count() == 100
    assert {r["reason"] for r in bad.collect()} == {"null value", "big"}


def test_control_break_many_slices_and_hot_header(spark):
    # 40% of the rows share one header; headers must be dense in key order, items dense per header.
    df = spark.range(0, 4000).select(
        F.when(F.col("id") % 10 < 4, F.lit(500)).otherwise(F.col("id") % 97).alias("h"),
        F.when(F.col("id") % 13 == 0, None).otherwise(F.col("id") % 7).alias("h2"),
        F.col("id").alias("o")).repartition(9)
    got = control_break(df, ["h", "h2"], ["o"], "hid", "item", start=5).select("h", "h2", "o", "hid", "item")
    ref = df.select("h", "h2", "o",
                    (F.dense_rank().over(Window.orderBy("h", "h2")) + 5).alias("hid"),
                    F.row_number().over(Window.partitionBy("h", "h2").orderBy("o")).alias("item"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, ref.collect()), key=str)


def test_hierarchical_code_beyond_a_million(spark):
    df = spark.range(1, 1_002_001).select(F.lit(1).alias("g"), F.col("id").alias("k"))
    coded = hierarchical_code(df, ["g"], ["k"])
    assert coded.select("subgrupo", "codigo").distinct().count() == 1_002_000
    got = {r["k"]: (r["subgrupo"], r["codigo"]) for r in coded.filter("k in (100000, 999999, 1000000, 1000001)").collect()}
    assert got == {100000: ("100", "000"), 999999: ("999", "999"), 1000000: ("1000", "000"), 1000001: ("1000", "001")}


def test_numbering_leaves_the_callers_cache_alone(spark):
    df = spark.range(100).select("id").cache()
    assert global_number(df, ["id"], "n").count() == 100
    assert df.is_cached and df.storageLevel.useMemory
    df.unpersist()
