"""Order lines, contract items, tender items and quotation bids meet where they lie instead of being moved for each join."""

import time

import pytest
from pyspark.sql import functions as F

from transfero.context import DEFAULT_CONTEXT
from transfero.plans import JOBS, orders, quotation
from transfero.sources.catalog import Legacy

SF = "/root/testdata/sf0.001"
LIMIT = "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture(scope="module")
def src(spark):
    """Tables of which none is broadcast; steps are shared by the tests here."""
    spark.conf.set(LIMIT, "-1")
    found = Legacy(spark, SF)
    spark.conf.unset(LIMIT)
    return found


def _moves(df):
    """Exchanges of the physical plan that move rows between tasks, without broadcasts."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return plan.count(" Exchange ")


def _rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("name, most", [
    ("purchase_order_lines", 0), ("rejected_order_items", 0), ("purchase_orders", 6), ("delivery_authorizations", 1),
    ("delivery_authorization_items", 12), ("rejected_sub_orders", 12), ("quotation_item_prices", 26), ("tender_budget_lines", 32)])
def test_rows_of_a_query_are_moved_seldom(src, name, most):
    assert _moves(JOBS[name](src, DEFAULT_CONTEXT)) <= most


def test_lines_are_moved_once_to_their_orders(src):
    # the lines themselves, and the products of pairs without a bid
    assert _moves(orders._order_lines.__wrapped__(src, DEFAULT_CONTEXT).tagged) <= 12


def test_contract_items_need_no_order_lines(spark):
    src = Legacy(spark, SF)
    JOBS["rejected_sub_orders"](src, DEFAULT_CONTEXT)
    assert not {"_order_lines", "_order_items", "_orders_final"} & {k[2] for k in src._memo}


def _shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ")
    return {b for b in blocks.split() if b.startswith("shuffle_")}


def test_a_written_step_leaves_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    src = Legacy(spark, SF)
    rows = src.spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    for by in ((), ("k",)):
        assert src.memo(("step", "a", str(by)), lambda: rows, True, by).count() == 7
    for _ in range(50):  # they are removed by the time the driver has told the executors
        left = [b for b in _shuffle_files(spark) - before if b.endswith(".data") or b.count("_") == 3]
        if len(left) <= 2:  # of the two counts above
            break
        time.sleep(0.2)
    assert len({b.split("_")[1] for b in left}) <= 2


def test_a_supplier_with_two_names_has_a_line_for_each(spark):
    src = Legacy(spark, SF)
    whole = {(r[0], r[1]): r[2] for r in orders._commitment_lines(src, DEFAULT_CONTEXT).groupBy("cdfornecedor", "nrempenho").agg(F.sum("qtdeitem")).collect()}
    n = {r[0]: r[1] for r in orders._commitment_lines(src, DEFAULT_CONTEXT).groupBy("cdfornecedor").count().collect()}
    src = Legacy(spark, SF)
    f = src["fornecedor"]
    src._cache["fornecedor"] = f.unionByName(f.filter("cdfornecedor = 1")).unionByName(
        f.filter("cdfornecedor = 2").withColumn("nmfornecedor", F.lit(None).cast("string")))
    lines = orders._commitment_lines(src, DEFAULT_CONTEXT)
    assert {r[0]: r[1] for r in lines.groupBy("cdfornecedor").count().collect()} == {**n, 2: 2 * n[2]}
    twice = {(r[0], r[1]): r[2] for r in lines.groupBy("cdfornecedor", "nrempenho").agg(F.sum("qtdeitem")).collect()}
    assert twice == {k: v * (2 if k[0] in (1, 2) else 1) for k, v in whole.items()}
    # a missing name sorts first
    assert [r[0] for r in lines.filter("cdfornecedor = 2").select("_variant").distinct().sort("_variant").collect()] == [1, 2]


def test_contracts_without_a_tender_find_their_products(spark):
    src = Legacy(spark, SF)
    c = src["instrumentocontratual"]
    src._cache["instrumentocontratual"] = c.withColumn("nrprocesso", F.when(F.col("nrinstrumentocontratual") % 3 != 1, F.col("nrprocesso")))
    codes = {r["cdmaterial"]: r["cadpro"] for r in orders.warehouse._products(src).collect()}
    ok, bad = orders._authorization_items(src, DEFAULT_CONTEXT)
    alone = [r for part in (ok, bad) for r in part.filter("nrinstrumentocontratual % 3 = 1").collect()]
    assert len(alone) == orders._authorized(src, DEFAULT_CONTEXT)[0].filter("nrinstrumentocontratual % 3 = 1").count() > 100
    assert all(r["id_processolicitatorio"] is None and r["_tcodant"] is None and r["cadpro"] == codes.get(r["cdmaterial"]) for r in alone)


def test_items_of_crowded_quotations_are_numbered_by_slices(spark, monkeypatch):
    whole = {name: _rows(JOBS[name](Legacy(spark, SF), DEFAULT_CONTEXT)) for name in ("quotation_items", "quotation_bids")}
    monkeypatch.setattr(quotation, "CROWDED_ROWS", 4)
    src = Legacy(spark, SF)
    assert 0 < len(quotation._crowded(src)) < src["processopesquisa"].count()
    assert {name: _rows(JOBS[name](src, DEFAULT_CONTEXT)) for name in whole} == whole
