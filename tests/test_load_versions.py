"""Loads that overlap, and fact refreshes that recompute changed orders only."""

import os
import random

import pytest

from cartwheel import schemas
from cartwheel.plans import loads
from cartwheel.sources.tables import ConcurrentWriteError, current_version_path, publish, read_table

HEADER = {"d_product": "id,category,segment"}


def drop(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name}.csv"
    with open(path, "w") as f:
        f.write("header\n" + "".join(v + "\n" for v in lines))
    return path


def products(spark, wh):
    return sorted(r.product_id for r in read_table(spark, wh.dimension("d_product"), schemas.D_PRODUCT).collect())


def test_interleaved_loads_end_with_the_rows_of_both(spark, scratch):
    wh = loads.Warehouse(scratch + "/wh")
    a = loads.stage(spark, "d_product", drop(scratch, "a", ["p1,x,s"]), wh)
    b = loads.stage(spark, "d_product", drop(scratch, "b", ["p2,x,s"]), wh)
    loads.merge_staged(spark, "d_product", wh, a)
    loads.merge_staged(spark, "d_product", wh, b)
    assert products(spark, wh) == ["p1", "p2"]


def test_a_merge_overtaken_by_another_raises_and_can_be_repeated(spark, scratch, monkeypatch):
    wh = loads.Warehouse(scratch + "/wh")
    loads.load_dimension(spark, "d_product", drop(scratch, "first", ["p0,x,s"]), wh)
    a = loads.stage(spark, "d_product", drop(scratch, "a", ["p1,x,s"]), wh)
    b = loads.stage(spark, "d_product", drop(scratch, "b", ["p2,x,s"]), wh)
    merge = loads.merge_entity

    def overtaken(target, rows, entity):
        monkeypatch.setattr(loads, "merge_entity", merge)
        loads.merge_staged(spark, "d_product", wh, b)  # between the read and the write of a's merge
        return merge(target, rows, entity)

    monkeypatch.setattr(loads, "merge_entity", overtaken)
    with pytest.raises(ConcurrentWriteError):
        loads.merge_staged(spark, "d_product", wh, a)
    assert products(spark, wh) == ["p0", "p2"]
    loads.merge_staged(spark, "d_product", wh, a)
    assert products(spark, wh) == ["p0", "p1", "p2"]


def test_rejects_are_counted_by_reason_in_the_staging_pass(spark, scratch):
    wh = loads.Warehouse(scratch + "/wh")
    good = "o1,1,2017-01-02 03:04:05,2017-01-02 03:04:05,c1,p1,1.5,2.5,ok"
    lines = [good, good, good.replace("o1,1", "o1,x"), good.replace("o1,1", "o2,y"), good.replace(",1.5,", ",?,"), "too,short", ""]
    staged = loads.stage(spark, "d_order_item", drop(scratch, "i", lines), wh)
    counts = loads.staged_counts(spark, staged)
    assert counts == {"clean": 1, "bad_order_item_id": 2, "bad_price": 1, "too_few_fields": 2}
    rejects = loads.staged_rejects(spark, "d_order_item", wh, staged).groupBy("reason").count().collect()
    assert {r.reason: r["count"] for r in rejects} == {k: n for k, n in counts.items() if k != "clean"}


def rows_of(df):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


def test_incremental_refresh_equals_a_rebuild_after_random_merges(spark, scratch):
    rng = random.Random(9)
    wh = loads.Warehouse(scratch + "/wh")
    stamp = lambda: f"2017-0{rng.randint(1, 3)}-{rng.randint(1, 28):02d} 10:00:00"
    orders, items = [f"o{k}" for k in range(40)], {}

    def line(entity, k):
        if entity == "d_customer":
            return f"c{k},u{rng.randint(0, 9)},1,city,{rng.choice('AB')}"
        if entity == "d_product":
            return f"p{k},{rng.choice(['toys', 'art'])},{rng.choice('ST')}"
        if entity == "d_order":
            return f"{orders[k]},c{rng.randint(0, 9)},{rng.choice(['sent', 'paid'])},{stamp()},{stamp()},{stamp()},{stamp()},{stamp()}"
        item = items.setdefault(k, (orders[k % 40], f"c{rng.randint(0, 9)}", f"p{rng.randint(0, 9)}", stamp()))
        return f"{item[0]},{k},{item[3]},{stamp()},{item[1]},{item[2]},{rng.randint(1, 99)}.5,{rng.randint(1, 9)}.25,{rng.choice(['sent', 'paid'])}"

    sizes = {"d_customer": 10, "d_product": 10, "d_order": 40, "d_order_item": 120}

    def load(entity, share, n):
        keys = [k for k in range(sizes[entity]) if rng.random() < share]
        if keys:
            loads.load_dimension(spark, entity, drop(scratch, f"{entity}-{n}", [line(entity, k) for k in keys]), wh)

    def holidays(n, *days):
        loads.load_calendar(spark, drop(scratch, f"h-{n}", days), wh, lo="2017-01-01", hi="2017-03-31")

    for entity in sizes:
        load(entity, 0.6, 0)
    holidays(0, "1/1/2017,New Year")
    first = loads.refresh_fact_changes(spark, wh)  # there is none yet
    assert rows_of(loads.read_fact(spark, wh)) == rows_of(loads._build(loads._fact_frames(spark, wh, loads._fact_inputs(spark, wh))))
    assert loads.refresh_fact_changes(spark, wh) != first and spark.read.parquet(current_version_path(spark, wh.changed_orders)).count() == 0
    for n in range(1, 6):
        for entity in rng.sample(list(sizes), rng.randint(1, 3)):
            load(entity, 0.15, n)
        if n % 2:
            holidays(n, f"{n}/2/2017,Day {n}")
        loads.refresh_fact_changes(spark, wh)
        whole = rows_of(loads._build(loads._fact_frames(spark, wh, loads._fact_inputs(spark, wh))))
        assert rows_of(loads.read_fact(spark, wh)) == whole
        changed = spark.read.parquet(current_version_path(spark, wh.changed_orders))
        assert 0 < changed.count() <= 40


def test_without_lineage_everything_is_rebuilt(spark, scratch):
    wh = loads.Warehouse(scratch + "/wh")
    for entity, text in {"d_customer": "c1,u1,1,x,A", "d_product": "p1,toys,S", "d_order": "o1,c1,paid" + ",2017-01-02 03:04:05" * 5}.items():
        loads.load_dimension(spark, entity, drop(scratch, entity, [text]), wh)
    loads.load_dimension(spark, "d_order_item", drop(scratch, "i", ["o1,1,2017-01-02 03:04:05,2017-01-02 03:04:05,c1,p1,1.5,2.5,ok"]), wh)
    loads.load_calendar(spark, drop(scratch, "h", ["1/1/2017,New Year"]), wh, lo="2017-01-01", hi="2017-03-31")
    loads.refresh_fact(spark, wh)
    publish(spark.createDataFrame([("p1", "art", "T")], schemas.D_PRODUCT), wh.dimension("d_product"), schemas.D_PRODUCT)  # no merge
    loads.refresh_fact_changes(spark, wh)
    assert [r.product_segment for r in loads.read_fact(spark, wh).collect()] == ["T"]
