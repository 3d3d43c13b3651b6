"""End to end: CSV drops -> staging -> dimensions -> calendar -> fact, twice."""

import datetime as dt
import os

import pytest

from cartwheel import schemas
from cartwheel.operators.calendar import date_spine
from cartwheel.plans import loads, queries, tpch_roles as roles
from cartwheel.sources.tables import read_table

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver data missing")

HEADERS = {
    "d_customer": "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state",
    "d_product": "product_id,product_category,segment",
    "d_order": "order_id,customer_id,order_status,purchase,approved,carrier,delivered,estimated",
    "d_order_item": "order_id,order_item_id,purchase,approved,customer_id,product_id,price,freight_value,order_status",
    "d_holiday": "date,name",
}


def _drop(folder, entity, df):
    """Write the lines as two CSV files, each with its own header line."""
    lines = [r.value for r in df.collect()]
    os.makedirs(folder, exist_ok=True)
    half = len(lines) // 2
    for i, chunk in enumerate((lines[:half], lines[half:])):
        with open(os.path.join(folder, f"{entity}_{i}.csv"), "w") as f:
            f.write(HEADERS[entity] + "\n" + "".join(v + "\n" for v in chunk))
    return folder + "/*.csv"


def _snapshot(spark, wh, entity):
    e = schemas.ENTITIES[entity]
    return sorted((tuple(r) for r in read_table(spark, wh.dimension(entity), e.schema).collect()), key=str)


def test_csv_to_fact_twice(spark, scratch):
    wh = loads.Warehouse(scratch + "/wh")
    sources = {
        "d_customer": roles.customer_lines(spark, SF),
        "d_product": roles.product_lines(spark, SF),
        "d_order": roles.order_lines(spark, SF),
        "d_order_item": roles.order_item_lines(spark, SF),
    }
    paths = {e: _drop(f"{scratch}/in/{e}", e, df) for e, df in sources.items()}
    hol = roles.holiday_lines_for_spine(date_spine(spark, "1995-01-01", "2001-12-31"))
    hol_path = _drop(f"{scratch}/in/d_holiday", "d_holiday", hol)

    def run_all():
        for e, p in paths.items():
            loads.load_dimension(spark, e, p, wh)
        loads.load_calendar(spark, hol_path, wh, lo="1995-01-01", hi="2001-12-31")
        loads.refresh_fact(spark, wh)

    run_all()
    first = {e: _snapshot(spark, wh, e) for e in list(paths) + ["d_holiday"]}
    fact1 = sorted((tuple(r) for r in loads.read_fact(spark, wh).collect()), key=str)

    # staged rows equal the cleaner's output; rejects carry reasons
    assert len(first["d_order_item"]) == queries.cln.clean_order_item(sources["d_order_item"]).count()
    rej = loads.staged_rejects(spark, "d_order_item", wh)
    assert rej.count() > 0 and rej.filter("reason is null").count() == 0

    # calendar: month partitions, the fact matches the in-memory build
    d_date_dirs = os.listdir([os.path.join(wh.d_date, d) for d in os.listdir(wh.d_date) if d.startswith("v=")][0])
    assert sum(d.startswith("first_day_of_the_month=") for d in d_date_dirs) == 84
    assert len(fact1) > 0

    # Second run of the same drops. Customer, product and order keys are
    # unique, so those merges change nothing. The order-item drop repeats one
    # merge key with two prices: the first load inserted both rows, and now
    # both source rows match them, which MERGE refuses (MRG6); the failed
    # merge publishes nothing. Holidays: all dates valid, nothing re-inserted.
    for e in ("d_customer", "d_product", "d_order"):
        loads.load_dimension(spark, e, paths[e], wh)
    with pytest.raises(Exception, match="cardinality"):
        loads.load_dimension(spark, "d_order_item", paths["d_order_item"], wh)
    loads.load_calendar(spark, hol_path, wh, lo="1995-01-01", hi="2001-12-31")
    loads.refresh_fact(spark, wh)
    second = {e: _snapshot(spark, wh, e) for e in first}
    assert second == first
    fact2 = sorted((tuple(r) for r in loads.read_fact(spark, wh).collect()), key=str)
    assert fact2 == fact1


def test_second_load_with_duplicate_matched_keys_fails(spark, scratch):
    wh = loads.Warehouse(scratch + "/wh")
    folder = f"{scratch}/in"
    os.makedirs(folder)
    with open(folder + "/p.csv", "w") as f:
        f.write("h\np1,a,s\np1,b,s\n")
    loads.load_dimension(spark, "d_product", folder, wh)  # both inserted
    assert len(_snapshot(spark, wh, "d_product")) == 2
    with pytest.raises(Exception, match="cardinality"):
        loads.load_dimension(spark, "d_product", folder, wh)
    # the failed merge published nothing: the table is unchanged
    assert len(_snapshot(spark, wh, "d_product")) == 2


def test_calendar_load_with_quoted_names(spark, scratch):
    wh = loads.Warehouse(scratch + "/wh")
    folder = f"{scratch}/hol"
    os.makedirs(folder)
    with open(folder + "/h.csv", "w") as f:
        f.write('date,name\n19/1/2009,"Martin Luther King, Jr. Day"\n1/1/2009,New Year\n')
    loads.load_calendar(spark, folder, wh, quoted_names=True, lo="2009-01-01", hi="2009-01-31")
    names = sorted(r.name for r in read_table(spark, wh.dimension("d_holiday"), schemas.D_HOLIDAY).collect())
    assert names == ["Martin Luther King, Jr. Day", "New Year"]
    hol = [r for r in loads.read_d_date(spark, wh).collect() if r.is_holiday]
    assert sorted(r.day for r in hol) == [1, 19]


def test_missing_inputs_raise_and_publish_nothing(spark, scratch):
    wh = loads.Warehouse(scratch + "/nowhere")
    for step in (loads.refresh_fact, loads.build_calendar, lambda s, w: loads.merge_staged(s, "d_product", w)):
        with pytest.raises(FileNotFoundError):
            step(spark, wh)
    assert not os.path.exists(wh.fact) and not os.path.exists(wh.d_date)


def test_calendar_bounds_each_on_its_own(spark, scratch):
    wh = loads.Warehouse(scratch + "/wh")
    os.makedirs(f"{scratch}/hol")
    with open(f"{scratch}/hol/h.csv", "w") as f:
        f.write("date,name\n1/1/2020,New Year\n")

    def span(**bounds):
        loads.load_calendar(spark, f"{scratch}/hol", wh, **bounds)
        row = loads.read_d_date(spark, wh).selectExpr("min(Date) lo", "max(Date) hi").first()
        return str(row.lo), str(row.hi)

    assert span(lo="2020-01-01") == ("2020-01-01", "2025-12-31")
    assert span(hi="2017-01-31") == ("2016-09-01", "2017-01-31")
    assert span(end_year=2018) == ("2016-09-01", "2018-12-31")
    assert span(with_day_of_week=False, run_date=dt.date(2019, 5, 5)) == ("2016-01-01", "2020-12-31")
    with pytest.raises(ValueError):
        loads.build_calendar(spark, wh, hi="2017-01-31", end_year=2018)


def test_independent_drops_load_side_by_side(spark, scratch, monkeypatch):
    """The four drops' loads wait for each other; one after the other none would ever meet the next."""
    import threading

    meet, loaded = threading.Barrier(4, timeout=60), {}

    def load(spark, name, drop, wh, header, latest_by):
        meet.wait()
        loaded[name] = (spark.read.text(drop).collect()[0].value, header, latest_by)

    for name in ("customer", "product", "order", "order_item"):
        monkeypatch.setattr(roles, f"{name}_lines", lambda spark, sf_dir, name=name: spark.createDataFrame([(f"a {name}",)], "value string"))
    monkeypatch.setattr(loads, "load_dimension", load)
    queries._load_drops(spark, SF, loads.Warehouse(scratch))
    assert loaded == {
        "d_customer": ("a customer", False, None),
        "d_product": ("a product", False, None),
        "d_order": ("a order", False, None),
        "d_order_item": ("a order_item", False, ["price", "freight_value"]),
    }


def test_a_failed_load_is_raised_after_the_others_ended(spark):
    ended = []

    def fails():
        raise ValueError("no such drop")

    with pytest.raises(ValueError, match="no such drop"):
        queries._side_by_side(spark, [fails, lambda: ended.append(spark.range(3).count())])
    assert ended == [3]
