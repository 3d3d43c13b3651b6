"""Orders and items in buckets by order_id: the same tables and facts, joined without a shuffle."""

import datetime as dt
import random
import time

import pytest

from test_load_versions import drop
from test_plans import _plan, no_broadcast  # noqa: F401

from cartwheel import schemas
from cartwheel.operators.merge import merge_entity
from cartwheel.plans import loads
from cartwheel.session import BUCKET_CONF
from cartwheel.sources import tables
from cartwheel.sources.tables import Buckets, dealt_to_buckets, lineage, publish, read_table, vacuum

N = 8


@pytest.fixture()
def bucket_conf(spark):
    for k, v in BUCKET_CONF.items():
        spark.conf.set(k, v)
    yield
    for k in BUCKET_CONF:
        spark.conf.unset(k)


def item_lines(rng, n):
    keys = {(f"o{rng.randrange(40)}" if rng.random() < 0.6 else "hot", rng.randrange(90), f"p{rng.randrange(6)}") for _ in range(n)}
    return [f"{o},{i},2017-0{rng.randint(1, 9)}-02 03:04:05,2017-01-02 03:04:05,c{rng.randrange(5)},{p},{rng.random() * 9:.3f},{rng.random():.3f},ok" for o, i, p in sorted(keys)] + ["short,line"]


def order_lines(rng, ids):
    stamp = lambda: f"2017-0{rng.randint(1, 9)}-02 03:04:05"
    return [",".join([o, f"c{rng.randrange(5)}", "done", *(stamp() for _ in range(5))]) for o in ids]


def load_all(spark, folder, wh):
    rng = random.Random(5)
    loads.load_dimension(spark, "d_product", drop(folder, "p", [f"p{k},toys,s" for k in range(5)]), wh)
    loads.load_dimension(spark, "d_customer", drop(folder, "c", [f'"c{k}","u{k}","1","x","SP"' for k in range(5)]), wh)
    loads.load_calendar(spark, drop(folder, "h", []), wh, lo="2017-01-01", hi="2017-12-31")
    for turn in range(3):
        loads.load_dimension(spark, "d_order", drop(folder, f"o{turn}", order_lines(rng, ["hot", *(f"o{k}" for k in range(turn * 10, turn * 10 + 20))])), wh)
        loads.load_dimension(spark, "d_order_item", drop(folder, f"i{turn}", item_lines(rng, 150)), wh)
        if turn:
            loads.refresh_fact_changes(spark, wh)
        else:
            loads.refresh_fact(spark, wh)


def rows(df):
    return sorted(map(repr, df.collect()))


def contents(spark, wh):
    names = ("d_order", "d_order_item", "d_product", "d_customer")
    return [rows(read_table(spark, wh.dimension(n), schemas.ENTITIES[n].schema)) for n in names] + [rows(loads.read_fact(spark, wh))]


@pytest.fixture(scope="module")
def bucketed(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("buckets"))
    wh = loads.Warehouse(folder + "/wh", order_buckets=N)
    load_all(spark, folder, wh)
    return wh


def test_loads_and_refreshes_give_the_same_tables(spark, scratch, bucketed):
    plain = loads.Warehouse(scratch + "/plain")
    load_all(spark, scratch, plain)
    want = contents(spark, plain)
    assert all(want) and contents(spark, bucketed) == want
    for name in ("d_order", "d_order_item"):
        path = tables.current_version_path(spark, bucketed.dimension(name))
        assert lineage(spark, path)["buckets"] == {"by": "order_id", "count": N, "partition_by": []}
        staged = tables.current_version_path(spark, bucketed.staging(name))
        assert loads.staged_counts(spark, staged) == loads.staged_counts(spark, tables.current_version_path(spark, plain.staging(name)))
    # a session that hasn't written the tables finds their buckets by the lineage
    for t in spark.catalog.listTables():
        if t.name.startswith("cartwheel_"):
            spark.sql(f"DROP TABLE {t.name}")
    assert contents(spark, bucketed) == want
    assert rows(loads.staged_rejects(spark, "d_order_item", bucketed)) == rows(loads.staged_rejects(spark, "d_order_item", plain))


def shuffled_under_joins(plan):
    """For each sort-merge join of a plan: whether a shuffle feeds one of its sides, other joins' output not counted."""
    found, lines = [], plan.splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    for n, line in enumerate(lines):
        if "SortMergeJoin" in line:
            below = []
            for later in lines[n + 1 :]:
                if depth(later) <= depth(line):
                    break
                below.append(later)
            found.append((line.strip(" :+-"), any("Exchange" in x for x in below)))
    return found


def test_the_order_join_of_the_fact_shuffles_neither_side(spark, bucketed, no_broadcast):  # noqa: F811
    frames = loads._fact_frames(spark, bucketed, loads._fact_inputs(spark, bucketed))
    joins = dict(shuffled_under_joins(_plan(loads._build(frames, orders_first=True))))
    assert [shuffled for join, shuffled in joins.items() if "[order_id" in join] == [False]


def test_the_fact_needs_no_shuffle_of_items_with_small_products_and_customers(spark, bucketed):
    frames = loads._fact_frames(spark, bucketed, loads._fact_inputs(spark, bucketed))
    plan = _plan(loads._build(frames, orders_first=True))
    assert "Exchange hashpartitioning(order_id" not in plan and "Exchange hashpartitioning(product_id" not in plan
    assert "Exchange hashpartitioning(order_purchase_date" not in plan


@pytest.mark.parametrize("name", ["d_order", "d_order_item"])
def test_merges_shuffle_neither_side(spark, bucketed, no_broadcast, bucket_conf, name):  # noqa: F811
    entity = schemas.ENTITIES[name]
    target = read_table(spark, bucketed.dimension(name), entity.schema)
    merged = merge_entity(target, loads.staged_clean(spark, name, bucketed), entity)
    joins = shuffled_under_joins(_plan(merged))
    assert len(joins) == 3 and not any(shuffled for _, shuffled in joins)
    assert "Exchange" not in _plan(merged)


def test_odd_keys_and_empty_tables(spark, scratch):
    schema = schemas.D_ORDER
    null = [None] * (len(schema.fields) - 1)
    data = [(None, *null)] * 20 + [("", *null), ("a`'b", *null)] + [("hot", *null)] * 50
    buckets = Buckets("order_id", N)
    for n, found in enumerate((data, [])):
        table = f"{scratch}/it's odd {n}"
        path = publish(dealt_to_buckets(spark.createDataFrame(found, schema), buckets), table, schema, base=None, buckets=buckets)
        for _ in range(2):
            assert rows(read_table(spark, table, schema)) == sorted(map(repr, spark.createDataFrame(found, schema).collect()))
            spark.sql(f"DROP TABLE IF EXISTS {tables._table_name(spark, path)}")


def test_vacuum_and_failures_forget_the_catalog_entry(spark, scratch):
    schema, buckets, table = schemas.D_PRODUCT, Buckets("product_id", 4), scratch + "/t"
    first = publish(spark.createDataFrame([("p", "c", "s")], schema), table, schema, buckets=buckets)
    publish(spark.createDataFrame([("q", "c", "s")], schema), table, schema, buckets=buckets)
    assert spark.catalog.tableExists(tables._table_name(spark, first))
    time.sleep(1.1)
    assert vacuum(spark, table, dt.datetime.now()) != []
    assert not spark.catalog.tableExists(tables._table_name(spark, first))
    bad = spark.createDataFrame([("p", "c", "s")], schema).selectExpr("product_id", "raise_error('no') product_category", "segment")
    with pytest.raises(Exception):
        publish(bad, table, schema, buckets=buckets)
    assert [r.product_id for r in read_table(spark, table, schema).collect()] == ["q"]
    publish(spark.createDataFrame([("r", "c", "s")], schema), table, schema, buckets=buckets)
    assert [r.product_id for r in read_table(spark, table, schema).collect()] == ["r"]
