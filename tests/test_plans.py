"""Physical-plan checks: what the planner does with the registered queries."""
import re
from pathlib import Path

import pytest

from panelcast.plans import backtest as bt
from panelcast.plans.queries import SQL_CHECKED
from panelcast.sources import business as biz
from panelcast.sources.tables import Tables

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(SQL_CHECKED))
def test_no_pairwise_joins_or_python_in_relational_queries(spark, name):
    p = plan(SQL_CHECKED[name](spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, p
    assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p
    assert "FlatMapGroupsInPandas" not in p


def scans(p: str, table: str) -> int:
    return p.count(f"{table}.parquet")


def test_source_plans(spark):
    """Lines are exchanged once, orders twice, each table is scanned once per pass."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        t = Tables(spark, SF)
        fact, cells = plan(biz.sales_fact(t)), plan(biz.order_cells(t))
        pruned = plan(biz.weighted_monthly(biz.sales_fact(t, biz.WEIGHTED_FROM)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert [scans(fact, x) for x in ("lineitem", "orders", "customer")] == [1, 1, 1]
    assert [scans(cells, x) for x in ("lineitem", "orders", "customer")] == [0, 1, 1]
    by_key = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", fact)
    assert sum("orderkey" in k for k in by_key) == 2  # lines and placed orders, once each
    assert sum("order_month" in k for k in by_key) == 1  # the small cells
    assert sum(re.match(r"custkey", k) is not None for k in by_key) == 2  # orders and customers
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate", pruned)
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", fact)
    line = next(s for s in schemas if "l_orderkey" in s)
    assert {c.split(":")[0] for c in line.split(",")} == {"l_orderkey", "l_extendedprice", "l_discount", "l_shipdate"}


def test_panel_build_scans_lineitem_once(spark):
    inp = bt.PanelInputs(Tables(spark, SF), checkpoint=True)
    keyed = inp.keyed   # fact materialised once, weighted and actuals read it
    assert "lineitem.parquet" not in plan(keyed)
    assert "orders.parquet" not in plan(inp.oil) + plan(inp.rig)


def test_a_run_leaves_no_intermediate(spark):
    from panelcast.session import cut_lineage, scratch_run
    with scratch_run(spark) as path:
        kept = cut_lineage(spark.range(5))
        assert kept.count() == 5 and list(Path(path.removeprefix("file:")).iterdir())
    assert not Path(path.removeprefix("file:")).exists()


def test_intermediates_lie_in_the_folder_of_the_application(spark):
    from panelcast import session
    kept = session.cut_lineage(spark.range(3))
    assert spark.sparkContext.applicationId in kept.inputFiles()[0]
    path = session.scratch_dir(spark) + "/some"
    spark.range(1).write.parquet(path)
    session._delete_quietly(spark, path)
    assert not Path(path.removeprefix("file:")).exists()
    session._delete_quietly(None, path)  # a stopped session is no error


def test_changed_files_get_a_new_panel(spark, scratch):
    import shutil
    from panelcast.plans import queries as Q
    root = Path(scratch) / "t"
    shutil.copytree(SF, root, copy_function=shutil.copyfile)
    root.chmod(0o755)  # the given folder is read-only, and its mode is copied
    first = Q._inputs(spark, str(root))
    assert Q._inputs(spark, str(root)) is first
    (root / "orders.parquet").unlink()
    shutil.copyfile(f"{SF}/orders.parquet", root / "orders.parquet")
    assert Q._inputs(spark, str(root)) is not first


def test_bucketed_lines_are_not_exchanged(spark):
    from panelcast.sources.bucketed import bucketed, suggested_buckets
    tables = Tables(spark, SF)
    assert suggested_buckets(tables) == 8
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with bucketed(tables, 4) as t:
            fact = biz.sales_fact(t)
            text, rows = plan(fact), sorted(fact.collect())
            pairs = plan(t.lineitem.join(t.orders, t.lineitem.l_orderkey == t.orders.o_orderkey))
        plain = biz.sales_fact(tables)
        assert rows == sorted(plain.collect())
        by_key = lambda p: re.findall(r"hashpartitioning\(([a-z_]*orderkey)", p)
        assert len(by_key(plan(biz.sales_fact(tables)))) == 2  # lines and orders
        assert len(by_key(text)) == 1 and "Bucketed: true" in text  # only the placed orders
        assert by_key(pairs) == [] and "Exchange" not in pairs
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("panelcast_")]
