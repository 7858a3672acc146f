from shelfsense.plans import base, catalog

SF = "/root/testdata/sf0.01"


def test_explorer_selects_all_stores(spark):
    """The 200 most recent rows of the panel's categories and regions, whatever store they are of."""
    panel = (base.panel(spark, SF).filter("category IN ('SIZED', 'PROMO') AND region IN ('AMERICA', 'ASIA', 'EUROPE')")
             .select("dt", "store_id", "product_id").collect())
    panel.sort(key=lambda r: (-r.dt.toordinal(), r.store_id, r.product_id))
    got = catalog.explorer_top200(spark, SF).collect()
    assert [(r.dt, r.store_id, r.product_id) for r in got] == [tuple(r) for r in panel[:200]]
    assert {r.store_id for r in got} - {f"S{i}" for i in range(1, 26)}
