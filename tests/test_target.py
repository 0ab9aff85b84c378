"""Whole runs: steps stored once, scratch removed, versions published as a whole, a second run equal to the first."""

import os
from collections import Counter

import pytest

from transfero.context import MigrationContext
from transfero.plans import JOBS
from transfero.plans.graph import trace
from transfero.plans.runner import migrate
from transfero.session import ensure_checkpoint_dir
from transfero.sources import files
from transfero.sources.catalog import Legacy
from transfero.sources.jdbc import LEGACY_TABLES
from transfero.sources.target import Target

SF = "/root/testdata/sf0.001"
NAMES = ["supplier_master", "suppliers_target", "product_codes", "tender_items", "tender_bids", "tender_bid_finals", "tender_rejected_bids",
         "price_registry_target", "price_registry_docs_target", "requisitions_target", "requisition_items_target"]


def rows(df):
    cols = sorted(df.columns)
    return Counter(map(tuple, df.select(cols).collect()))


@pytest.fixture(scope="module")
def two_runs(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("target"))
    before = set(os.listdir(ensure_checkpoint_dir(spark).removeprefix("file:")))
    first = Legacy(spark, SF)
    one = migrate(spark, first, folder, names=NAMES)
    left = set(os.listdir(ensure_checkpoint_dir(spark).removeprefix("file:"))) - before
    return folder, first, left, one, migrate(spark, Legacy(spark, SF), folder, names=NAMES)


def test_shared_steps_are_stored_once_and_removed(two_runs):
    _, catalog, left, _, _ = two_runs
    written = Counter(k[2] for k in catalog.written)
    assert set(written.values()) == {1}
    assert {"_bid_rows", "_items", "_classified", "supplier_master", "_products", "_movements"} <= set(written)
    assert left == set()


def test_outputs_are_those_of_the_queries(spark, two_runs):
    from transfero.plans import run
    for name in ("tender_bid_finals", "requisition_items_target", "suppliers_target"):
        assert rows(two_runs[3].table(name)) == rows(run(name, spark, SF))


def test_a_second_run_gives_the_same_tables(two_runs):
    _, _, _, one, two = two_runs
    assert (one.number, two.number) == (1, 2) and set(one.tables) == set(two.tables) == set(NAMES)
    for name in NAMES:
        assert rows(one.table(name)) == rows(two.table(name)), name
    # rows of other modules stay in their folder, those of this one are new
    a, b = (s.tables["requisitions_target"] for s in (one, two))
    assert a["foreign"] == b["foreign"] and a["movement"] != b["movement"]


def test_a_run_that_breaks_off_changes_nothing(spark, two_runs):
    folder = two_runs[0]
    before = Target(spark, folder).current()

    def fail(name):
        if name == "tender_bids":
            raise RuntimeError("lost")

    catalog = Legacy(spark, SF)
    with pytest.raises(RuntimeError):
        migrate(spark, catalog, folder, names=["tender_items", "tender_bids"], before_write=fail)
    after = Target(spark, folder).current()
    assert after == before and rows(after.table("tender_items")) == rows(two_runs[4].table("tender_items"))
    assert catalog._scratch == {} and catalog.shared == set()
    # neither does a pointer that was cut short
    files.write_text(spark, Target(spark, folder).pointer(before.number + 1), '{"tables": {')
    assert Target(spark, folder).current() == before


def test_only_stale_outputs_are_built(spark, tmp_path):
    names = ["units_of_measure", "warehouses", "suppliers_target"]
    built = []
    one = migrate(spark, SF, str(tmp_path), names=names, before_write=built.append)
    two = migrate(spark, SF, str(tmp_path), names=names, only_stale=True, before_write=built.append)
    # the supplier table depends on the target, so it is never taken over
    assert built == [*names, "suppliers_target"]
    assert one.tables["warehouses"] == two.tables["warehouses"] and one.tables["suppliers_target"] != two.tables["suppliers_target"]
    migrate(spark, SF, str(tmp_path), MigrationContext(company=2), names=["warehouses"], only_stale=True, before_write=built.append)
    assert built[-1] == "warehouses"


@pytest.fixture(scope="module")
def graph(spark):
    return trace(Legacy(spark, SF), JOBS, MigrationContext())


def test_load_order_follows_from_the_graph(graph):
    order = graph.order()
    assert sorted(order) == sorted(JOBS) and graph.clearing() == order[::-1]
    for earlier, later in [("supplier_master", "tender_bids"), ("tender_bids", "price_registry"), ("stock_requisitions", "requisitions_target"),
                           ("vehicle_cost_centers", "fuel_items"), ("asset_register", "asset_ledger"), ("supplier_inserts", "supplier_master")]:
        assert order.index(earlier) < order.index(later)


def test_every_legacy_table_has_a_source(graph):
    used = {n[1] for n in graph.reads if n[0] == "table"}
    made_up = {"produto_wide", "classificacao_wide"}  # a second product table that only exists among the test tables
    in_target = {"despes", "conpla_tce", "centrocusto_placa", "desorc", "icadorc_fic"}
    assert used - set(LEGACY_TABLES) == made_up | in_target | {u for u in used if u.endswith("_existing")}
