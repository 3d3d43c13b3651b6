"""How often the registered queries shuffle the items, where no side is small enough to be broadcast."""

import datetime as dt

import pytest

from cartwheel.plans import queries


@pytest.fixture()
def tables(spark, scratch):
    day = lambda i: dt.datetime(1998 + i % 2, 3, 1 + i)
    write = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(f"{scratch}/{name}.parquet")
    write("orders", [(i, i % 3, "O", day(i)) for i in range(8)] + [(None, 1, "O", day(1))], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp")
    items = [(i, i % 4, n, 10.0 + i, 0.05) for i in range(8) for n in (1, 2)]
    write("lineitem", items + [(3, 3, 1, 13.0, 0.05), (None, 1, 1, 1.0, 0.0)], "l_orderkey long, l_partkey long, l_linenumber int, l_extendedprice double, l_tax double")
    write("customer", [(i, f"Customer#{i}", 1, "M") for i in range(3)], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string")
    write("nation", [(1, "FRANCE", 1)], "n_nationkey int, n_name string, n_regionkey int")
    write("part", [(i, "TYPE", "Brand", 5) for i in range(4)], "p_partkey long, p_type string, p_brand string, p_size int")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield scratch
    for k, v in before.items():
        spark.conf.set(k, v)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_items_joined_with_orders_are_not_shuffled_again_for_the_facts_orders(spark, tables):
    joined = queries.fact_order_item_joins(spark, tables)
    # items thrice (by order, product and customer), orders twice, products, customers and their nations;
    # before: items once more, by order_id
    assert _plan(joined).count("- Exchange hashpartitioning") == 9
    rows = joined.select("order_id", "order_item_id", "product_id", "customer_id", "price").collect()
    expected = [(str(i), str(n), str(i % 4), str(i % 3), 10.0 + i) for i in range(8) for n in (1, 2)] + [("3", "1", "3", "0", 13.0)]
    assert sorted(map(tuple, rows)) == sorted(expected)


def test_a_merge_shuffles_its_source_once_for_updates_and_inserts(spark, tables):
    merged = queries.merge_order_item(spark, tables)
    plan = _plan(merged)
    # of the five scans two are of rows with null keys, one of the target, one of its keys; before: six
    assert plan.count("FileScan parquet [l_orderkey") == 5
    # the join of items and orders lies by order_id for the newest row of each key
    assert plan.count("- Exchange hashpartitioning") == 15
    rows = {(r.order_id, r.order_item_id, r.product_id): r for r in merged.collect() if r.order_id is not None}
    assert rows[("2", "1", "2")].freight_value == 0.05 and rows[("3", "1", "3")].price == 13.0
