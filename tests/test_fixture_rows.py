"""Adapters keep every row of the test table they are derived from."""

import pytest

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name, base, key", [
    ("movimentodepreciacao", "lineitem", None), ("movimentovlcomplementar", "lineitem", None), ("instrumentocontratual", "orders", None),
    ("iteminstrumentocontratual", "lineitem", ["l_orderkey", "l_linenumber"])])
def test_adapter_reads_all_rows(spark, name, base, key):
    from transfero.sources.catalog import Legacy
    legacy = Legacy(spark, SF)
    rows = legacy.table(name)
    if name == "movimentodepreciacao":
        rows = rows.filter("inestorno = 0")
    all_rows = legacy.base(base)
    assert rows.count() == (all_rows.select(*key).distinct() if key else all_rows).count()
