"""Steps that move less: what a query does not return is neither computed nor written, and results stay the same."""

import pytest
from pyspark.sql import functions as F

from transfero.context import DEFAULT_CONTEXT
from transfero.operators.numbering import first_per_key
from transfero.operators.quality import key_split
from transfero.plans import JOBS
from transfero.sources.catalog import Legacy

SF = "/root/testdata/sf0.001"


def _steps(spark, name):
    """Steps that building ``name`` asks for, and the result."""
    src = Legacy(spark, SF)
    out = JOBS[name](src, DEFAULT_CONTEXT)
    return [k[2] for k in src._memo], out


@pytest.mark.parametrize("name", ["order_registry_flag", "order_commitment_link"])
def test_flags_of_orders_need_no_lines_and_bids(spark, name):
    steps, out = _steps(spark, name)
    assert not {"_order_lines", "_order_items", "_classified", "_items"} & set(steps)
    assert out.count() > 0


def test_rejected_bids_need_no_item_numbers(spark):
    src = Legacy(spark, SF)
    JOBS["rejected_bids"](src, DEFAULT_CONTEXT)
    assert not [k for k in src._memo if k[1:3] == ("transfero.plans.tender", "_items")]


def test_order_lines_and_item_map_are_written_once(spark):
    src = Legacy(spark, SF)
    JOBS["purchase_orders"](src, DEFAULT_CONTEXT)
    written = [k[2] for k in src.written]
    assert written.count("_order_lines") == written.count("_tender_item_map") == 1


def test_item_map_names_the_best_bid_of_every_item(spark):
    from transfero.plans import orders, tender
    src = Legacy(spark, SF)
    got = {r["_tcodant"]: (r["_tcc"], r["_titem"], r["_tcadpro"]) for r in orders._tender_item_map(src, DEFAULT_CONTEXT).collect()}
    items = {(r["pkid"], r["item"]): r["codant"] for r in tender._items(src)[0].collect()}
    best = {}
    order = lambda v: (v is not None, v if v is not None else 0)
    for b in tender._bids(src, DEFAULT_CONTEXT).collect():
        if (key := items.get((b["numlic"], b["item"]))) is not None:
            rank = (order(b["subem"]), order(b["codif"]), b["cadpro"], b["codccusto"], b["item"])
            if key not in best or rank < best[key][0]:
                best[key] = (rank, (b["codccusto"], b["item"], b["cadpro"]))
    assert got == {k: v for k, (_, v) in best.items()} and got


def test_first_per_key_moves_a_taken_order_column_once(spark):
    df = spark.createDataFrame([(1, 5, "x"), (1, 3, "y"), (2, None, "z")], "k int, o int, v string")
    out = first_per_key(df, ["k"], ["o"], take=["v", "o"])
    assert out.columns == ["k", "v", "o"]
    assert sorted(map(tuple, out.collect())) == [(1, "y", 3), (2, "z", None)]
    packed = out._jdf.queryExecution().optimizedPlan().toString().split("min(struct(")[1].split("))")[0]
    assert packed.count("o#") == 1


def test_key_split_finds_clashes_in_one_aggregate(spark):
    df = spark.createDataFrame([("a", 1, 2), ("a", 1, 2), ("a", 2, 1), ("b", 1, 1), (None, 1, 1)], "k string, o int, v int")
    ok, bad = key_split(df, ["k"], ["o"])
    assert sorted(map(tuple, ok.select("k", "o", "v").collect())) == [("a", 1, 2), ("b", 1, 1)]
    assert sorted((r["k"] or "", r["o"], r["reason"], r["n_rows"]) for r in bad.collect()) == [
        ("", 1, "NULL in key", 1), ("a", 1, "duplicate key", 1), ("a", 2, "duplicate key", 1)]
    plan = ok._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sum(_copies") == 0


def _moves(df):
    """Exchanges of the physical plan that move rows between tasks, without broadcasts."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return plan.count(" Exchange ")


@pytest.fixture()
def nothing_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bids_and_objects_of_a_tender_meet_where_they_lie(spark, nothing_broadcast):
    from transfero.plans import tender
    classified = tender._classified.__wrapped__(Legacy(spark, SF))
    # lineitems twice, orders twice (the second join reuses one), tenders, price tables and the bids that look there
    assert _moves(classified) <= 8
    assert classified.sparkSession.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "false"
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_settings_of_the_caller_go_on(spark, nothing_broadcast):
    src = Legacy(spark, SF)
    for key in ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions", "spark.sql.session.timeZone"]:
        assert src.spark.conf.get(key) == spark.conf.get(key)


def test_amendments_are_the_latest_of_the_same_bid(spark):
    from transfero.plans import tender
    src = Legacy(spark, SF)
    bids = spark.createDataFrame(
        [(1, 7, 2020, 4, 1, 1, 5, 9, 10, "C", 1), (1, 7, 2020, 4, 1, 1, 5, 9, 12, "R", 2), (1, 7, 2020, 4, 1, 1, 5, 9, 11, "R", 3),
         (1, 7, 2020, 4, 1, 1, 5, 8, 20, "C", 9), (1, 7, 2020, 4, None, 1, 5, 9, 13, "R", 4), (None, 7, 2020, 4, 1, 2, 5, 9, 14, "R", 5)],
        "fk_processo_licitatorio long, nrprocesso long, dtanoprocesso int, cdtipoprocesso int, lote int, nritem int, cdmaterial long, "
        "cdfornecedor long, vlcotacaoproposta int, tpregistro string, ordem int")
    src._cache["classificacaoproposta"] = bids.withColumns({"nrclassificacao": F.lit(1), "fk_tabela_preco_processo": F.lit(None).cast("long")})
    src._cache["processolicitatorio"] = spark.createDataFrame([(7, 2020, 4, 1)], "nrprocesso long, dtanoprocesso int, cdtipoprocesso int, pkid long")
    src._cache["itemobjeto"] = spark.createDataFrame([(1, 1, 5, 1, 3), (1, 2, 5, 1, 4)], "id_processolicitatorio long, nritem int, cdmaterial long, lote int, qtitemobjeto int")
    got = {(r["ordem"], r["_amended"], r["qtitemobjeto"]) for r in tender._classified(src).collect()}
    # without a lot no amendment is found; without its tender a bid finds no object
    assert got == {(1, 11, 3), (2, 11, 3), (3, 11, 3), (9, None, 3), (4, None, None), (5, 14, None)}


def test_ledger_rows_are_moved_once(spark, nothing_broadcast):
    from transfero.plans import assets
    src = Legacy(spark, SF)
    # movements by reason, depreciation and its reversals (twice), complementary values by asset, and all rows by range
    assert _moves(assets._ledger_source(src)) <= 9
    plan = assets._ledger_source(src)._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    above = plan[:plan.index("rangepartitioning")]
    assert above.count("Exchange") == 1 and "SortAggregate" in above


def _rows(df):
    return sorted(map(str, df.collect()))


def test_crowded_assets_are_cut_by_day(spark, monkeypatch):
    from transfero.plans import assets
    whole = _rows(assets.asset_ledger(Legacy(spark, SF), DEFAULT_CONTEXT))
    register = _rows(assets.asset_register_final(Legacy(spark, SF), DEFAULT_CONTEXT))
    monkeypatch.setattr(assets, "_crowded", lambda src: list(range(0, 200, 3)))
    src = Legacy(spark, SF)
    assert assets._ledger_source(src).filter("_day is not null").count() > 1000
    assert _rows(assets.asset_ledger(src, DEFAULT_CONTEXT)) == whole
    assert _rows(assets.asset_register_final(src, DEFAULT_CONTEXT)) == register


def test_crowded_assets_are_found(spark, monkeypatch):
    from transfero.plans import assets
    src = Legacy(spark, SF)
    monkeypatch.setattr(assets, "CROWDED_ROWS", 200)
    monkeypatch.setattr(assets, "CROWDED_SAMPLE", 1.0)
    ids = spark.createDataFrame([(1,)] * 250 + [(2,)] * 150 + [(None,)] * 300, "cditem long")
    for t in ("patri_movimento", "movimentodepreciacao", "movimentovlcomplementar"):
        src._cache[t] = ids if t == "patri_movimento" else ids.limit(0)
    assert assets._crowded(src) == [1]


def test_an_asset_registered_twice_has_its_ledger_rows_twice(spark):
    from transfero.plans import assets
    src = Legacy(spark, SF)
    once = assets.asset_ledger(src, DEFAULT_CONTEXT).groupBy("codigo_pat_mov").count().collect()
    src = Legacy(spark, SF)
    item = src["patri_item"]
    src._cache["patri_item"] = item.unionByName(item.filter("cditem = 5").withColumn("dsreduzida", F.lit("again")))
    twice = {r[0]: r[1] for r in assets.asset_ledger(src, DEFAULT_CONTEXT).groupBy("codigo_pat_mov").count().collect()}
    assert twice.pop(5) == 2 * {r[0]: r[1] for r in once}[5]
    assert twice == {r[0]: r[1] for r in once if r[0] != 5}


def test_a_fill_goes_on_over_the_cuts_of_a_key(spark):
    from transfero.operators.ledger import chained_fill, fill_within
    rows = [(1, 1, 1, 5, False), (1, 2, 2, None, True), (1, 4, 3, 0, True), (1, 4, 4, None, False), (1, 5, 5, None, True),
            (2, None, 6, None, True), (2, None, 7, 9, False), (2, None, 8, None, True), (None, 1, 9, 3, False), (None, 2, 10, None, True)]
    df = spark.createDataFrame(rows, "a int, c int, id int, v int, f boolean").repartitionByRange(4, "a", "c")
    seen = fill_within(df, ["a"], "c", ["id"], "v", F.col("f"), F.lit(0), "w")
    got = {r["id"]: r["v"] for r in chained_fill(seen, ["a"], "id", "v", F.col("f"), within="w", cut="c").collect()}
    assert got == {1: 5, 2: 5, 3: 5, 4: None, 5: 0, 6: 0, 7: 9, 8: 9, 9: 3, 10: 3}


def test_bidders_are_told_apart_by_keys(spark, nothing_broadcast):
    from transfero.plans import quotation
    src = Legacy(spark, SF)
    bids = spark.createDataFrame([(7, 1998, 1, 1), (7, 1998, 1, 2), (7, 1998, 2, 1), (8, None, 1, 1), (0, 1998, 1, 1)],
                                 "nrpesquisa long, dtanopesquisa int, cdfornecedor long, nritemproposta int")
    src._cache["propostapesquisa"] = bids
    f = src["fornecedor"].filter("cdfornecedor in (1, 2)")
    src._cache["fornecedor"] = f.unionByName(f).unionByName(f.filter("cdfornecedor = 2").withColumn("nmfornecedor", F.lit("OTHER")))
    out = quotation.quotation_bidders(src, DEFAULT_CONTEXT)
    assert sorted((r["id_cadorc"], r["nome"]) for r in out.collect()) == [
        ("798", "Other"), ("798", "Supplier#000000000"), ("798", "Supplier#000000001"), ("8", "Supplier#000000000")]
    texts = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate [" in line and "nrpesquisa" in line]
    assert texts and not any("nmfornecedor" in line or "numorc" in line for line in texts)


def test_tasks_of_a_shuffle_grow_in_number_with_the_input(spark, monkeypatch):
    from transfero.sources import catalog
    monkeypatch.setattr(catalog, "SHUFFLE_BYTES", 1 << 10)
    src = Legacy(spark, SF)
    src["propostapesquisa"]
    assert int(src.spark.conf.get("spark.sql.shuffle.partitions")) > 100 > int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_task_size_is_the_callers_where_set(spark):
    from transfero.session import TASK_BYTES, process_session
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    assert process_session(spark).conf.get(key) == TASK_BYTES
    spark.conf.set(key, "32m")
    try:
        assert process_session(spark).conf.get(key) == "32m"
    finally:
        spark.conf.unset(key)


@pytest.fixture()
def sliced(monkeypatch):
    """Columns of all rows that are numbered by slices."""
    from transfero.operators import numbering
    seen, pin = [], numbering.pin
    monkeypatch.setattr(numbering, "pin", lambda df, *args: seen.append(df.columns) or pin(df, *args))
    return seen


def test_bids_items_and_products_of_a_tender_meet_where_they_lie(spark, sliced):
    from transfero.plans import tender
    src = Legacy(spark, SF)
    tender.tender_bids(src, DEFAULT_CONTEXT)
    assert sliced and not [columns for columns in sliced if "nritem" in columns]  # items are numbered where they lie
    src.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = tender._classified(src)
    assert _moves(rows.select("_tender", "cdmat").distinct()) == 0
    assert _moves(rows.join(rows.groupBy("_tender", "pkid", "nritem").count(), ["_tender", "nritem"])) == 0
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("step_")]


def test_small_tables_of_tenders_are_written_first(spark):
    src = Legacy(spark, SF)
    JOBS["tender_bids"](src, DEFAULT_CONTEXT)
    assert {"_price_tables", "_expenses", "_bidder_ids", "_classified"} <= {k[2] for k in src.written}


def test_items_of_crowded_tenders_are_numbered_by_slices(spark, monkeypatch, sliced):
    from transfero.plans import tender
    whole = {name: _rows(JOBS[name](Legacy(spark, SF), DEFAULT_CONTEXT)) for name in ("tender_items", "tender_bids")}
    monkeypatch.setattr(tender, "CROWDED_ROWS", 5)
    src = Legacy(spark, SF)
    n = src["processolicitatorio"].count()
    assert 0 < len(tender._crowded(src)) < n
    assert {name: _rows(JOBS[name](src, DEFAULT_CONTEXT)) for name in whole} == whole
    assert [columns for columns in sliced if "nritem" in columns]


def test_tenders_that_share_an_id_share_their_item_numbers(spark):
    from transfero.plans import tender
    src = Legacy(spark, SF)
    mat = sorted(r[0] for r in tender.warehouse._products(src).select("cdmaterial").limit(2).collect())
    bids = [(p, 2020, 4, lot, n, m, 9, 10) for p, lot, n, m in
            [(7, 1, 1, mat[0]), (7, 1, 3, mat[0]), (8, 1, 1, mat[0]), (8, 1, 2, mat[1]), (8, 1, 4, -5), (9, 1, 1, mat[0]), (6, 2, 1, mat[1]), (5, 1, 1, mat[0])]]
    src._cache["classificacaoproposta"] = spark.createDataFrame(
        bids, "nrprocesso long, dtanoprocesso int, cdtipoprocesso int, lote int, nritem int, cdmaterial long, cdfornecedor long, vlcotacaoproposta int") \
        .withColumns({"fk_processo_licitatorio": F.col("nrprocesso"), "nrclassificacao": F.lit(1), "tpregistro": F.lit("C"), "ordem": F.lit(1),
                      "fk_tabela_preco_processo": F.lit(None).cast("long")})
    # 7 and 8 have one id, 6 and 9 have none
    src._cache["processolicitatorio"] = spark.createDataFrame(
        [(7, 2020, 4, 1), (8, 2020, 4, 1), (9, 2020, 4, None), (6, 2020, 4, None), (5, 2020, 4, 5)], "nrprocesso long, dtanoprocesso int, cdtipoprocesso int, pkid long")
    got = sorted((r["pkid"] or 0, r["nrprocesso"], r["nritem"], r["item"]) for r in tender._items(src)[0].collect())
    first = [g[3] for g in got if g[0] == 1 and g[2] == 1]
    assert sorted(first) == [1, 2]
    assert [g for g in got if g[2] != 1] == [(1, 7, 3, 4), (1, 8, 2, 3)]
    assert [g for g in got if g[0] != 1] == [(0, 6, 1, 2), (0, 9, 1, 1), (5, 5, 1, 1)]
    placed = sorted((r["pkid"] or 0, r["nrprocesso"], r["nritem"], r["_item"]) for r in tender._placed_bids(src, DEFAULT_CONTEXT).collect())
    assert placed == [(0, 6, 1, 2), (0, 9, 1, 1), (1, 7, 1, 2), (1, 7, 3, 4), (1, 8, 1, 2), (1, 8, 2, 3), (5, 5, 1, 1)]
