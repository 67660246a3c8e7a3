"""The registered store queries over every pgtraj of the store."""

from inputs import TINY

from trajspark.suite import fixtures as fx
from trajspark.suite.queries import QUERIES


def test_every_event_takes_part(spark):
    n = fx.fixes(spark, TINY).count()
    for name in ("store_export_import_all", "store_transfer_all", "store_import_type1_all"):
        assert QUERIES[name](spark, TINY).count() == n
    names = {r[0] for r in QUERIES["store_page_all"](spark, TINY).select("pgtraj_name").collect()}
    assert names == {"p0", "p1", "p2", "p3"}
