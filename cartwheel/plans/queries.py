"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads whole driver tables (mapped into the reference's roles by
``tpch_roles``) and runs the library operators on them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel import schemas
from cartwheel.operators import calendar as cal_ops
from cartwheel.operators import merge as mrg
from cartwheel.operators import clean as cln
from cartwheel.operators.fact import build_fact, fact_rows
from cartwheel.plans import loads
from cartwheel.plans import tpch_roles as roles
from cartwheel.sources.tables import dealt_to_buckets, publish, read_table, shared_folder, shuffles_dropped, vacuum

Query = Callable[[SparkSession, str], DataFrame]

DROP_LINES = 1_000_000


# --------------------------------------------------------------------------
# Calendar
# --------------------------------------------------------------------------


def _spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cal_ops.date_spine_from_bounds(roles.calendar_bounds(spark, sf_dir))


def calendar_holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holidays of the calendar fixture, through the holiday cleaner."""
    return cln.clean_holiday(roles.holiday_lines_for_spine(_spine(spark, sf_dir)))


def _dim_date(spark: SparkSession, sf_dir: str, with_dow: bool, dedupe: bool) -> DataFrame:
    return cal_ops.dim_date(_spine(spark, sf_dir), calendar_holidays(spark, sf_dir), with_dow, dedupe)


def _small_calendar(spark: SparkSession, sf_dir: str, dedupe: bool) -> DataFrame:
    # One row per day of the orders' years, two on the rules' double holiday: a
    # few thousand rows a decade, whatever the number of orders.
    return F.broadcast(_dim_date(spark, sf_dir, True, dedupe))


def dim_date_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CAL1-11, file variant (with day_of_week)."""
    return _dim_date(spark, sf_dir, True, False)


def dim_date_scheduled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CAL1-11, scheduled variant (no day_of_week), up to the end of the year
    after the run year (CAL2), the run date being the last order date."""
    spine = cal_ops.date_spine_from_bounds(roles.scheduled_calendar_bounds(spark, sf_dir))
    holidays = cln.clean_holiday(roles.holiday_lines_for_spine(spine))
    return cal_ops.dim_date(spine, holidays, False, False)


def dim_date_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 option: one row per day even on double-holiday dates."""
    return _dim_date(spark, sf_dir, True, True)


# --------------------------------------------------------------------------
# Fact
# --------------------------------------------------------------------------


def _fact_inputs(spark: SparkSession, sf_dir: str, dedupe_holidays: bool):
    return (
        roles.order_items(spark, sf_dir),
        roles.orders(spark, sf_dir),
        roles.products(spark, sf_dir),
        roles.customers(spark, sf_dir),
        _small_calendar(spark, sf_dir, dedupe_holidays),
    )


def fact_transaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FCT1-11: the flagship query."""
    return build_fact(*_fact_inputs(spark, sf_dir, False), orders_first=True)


def fact_transaction_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FCT1-11 over the de-duplicated calendar (Q3 option)."""
    return build_fact(*_fact_inputs(spark, sf_dir, True), orders_first=True)


def fact_transaction_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FCT1-11 from items and orders published in buckets by order_id, whose join then needs no shuffle (FCT2)."""
    wh = loads.Warehouse(shared_folder(spark, "warehouse"), order_buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    items, orders, *others = _fact_inputs(spark, sf_dir, False)
    found = []
    for entity, rows in ((schemas.ORDER_ITEM, items), (schemas.ORDER, orders)):
        buckets = wh.buckets(entity.name)
        path = publish(dealt_to_buckets(rows, buckets), wh.dimension(entity.name), entity.schema, base=None, buckets=buckets)
        found.append(read_table(spark, wh.dimension(entity.name), entity.schema, version=path))
    return build_fact(*found, *others, orders_first=True)


def fact_order_item_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FCT1-5: the joined rows, before the group-by."""
    rows = fact_rows(*_fact_inputs(spark, sf_dir, False), orders_first=True)
    return rows.select(
        "order_purchase_date", "is_weekday", "is_holiday", "order_id", "product_id", "order_item_id",
        "order_approved_at", "order_status", "product_segment", "product_category", "customer_id",
        "customer_unique_id", "customer_state", "freight_value", "price",
    )


# --------------------------------------------------------------------------
# Cleaners
# --------------------------------------------------------------------------


def clean_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cln.clean_customer(roles.customer_lines(spark, sf_dir))


def clean_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cln.clean_product(roles.product_lines(spark, sf_dir))


def clean_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cln.clean_order(roles.order_lines(spark, sf_dir))


def clean_order_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cln.clean_order_item(roles.order_item_lines(spark, sf_dir))


def clean_holiday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cln.clean_holiday(roles.holiday_lines_from_orders(spark, sf_dir))


def clean_holiday_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 option: quoted holiday names read whole."""
    return cln.clean_holiday(roles.holiday_lines_from_orders(spark, sf_dir), quoted_names=True)


def rejects_order_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cln.rejects(roles.order_item_lines(spark, sf_dir), "d_order_item")


def rejects_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cln.rejects(roles.order_lines(spark, sf_dir), "d_order")


def rejects_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cln.rejects(roles.customer_lines(spark, sf_dir), "d_customer")


def rejects_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6: bad product rows go to rejects (the reference sends None on)."""
    return cln.rejects(roles.product_lines(spark, sf_dir), "d_product")


def rejects_holiday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cln.rejects(roles.holiday_lines_from_orders(spark, sf_dir), "d_holiday")


def distinct_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DED1 on the order-item export (every line twice, plus true copies)."""
    return cln.dedupe_lines(roles.order_item_lines(spark, sf_dir))


def category_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CLN5 alone, on every part's category (raw and the dirty variants)."""
    from cartwheel.functions.categories import normalize_category
    from cartwheel.functions.text import strip

    p = roles.table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    raw = (
        F.when(k % 4 == 0, F.lit("home_appliances_2"))
        .when(k % 4 == 1, F.lit(" home_comfort_2 "))
        .when(k % 4 == 2, F.lit("#N/A"))
        .otherwise(F.col("p_type"))
    )
    return p.select(
        k.cast("string").alias("product_id"),
        raw.alias("raw_category"),
        normalize_category(strip(raw)).alias("product_category"),
    )


# --------------------------------------------------------------------------
# Merges
# --------------------------------------------------------------------------


def merge_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRG1."""
    return mrg.merge_entity(*roles.customer_merge_sides(spark, sf_dir), schemas.CUSTOMER)


def merge_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRG4."""
    return mrg.merge_entity(*roles.product_merge_sides(spark, sf_dir), schemas.PRODUCT)


def merge_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRG2."""
    return mrg.merge_entity(*roles.order_merge_sides(spark, sf_dir), schemas.ORDER)


def merge_order_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRG3."""
    return mrg.merge_entity(*roles.order_item_merge_sides(spark, sf_dir), schemas.ORDER_ITEM)


def merge_holiday(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRG5: both sides through the holiday cleaner (NULL dates included)."""
    old_lines, new_lines = roles.holiday_merge_lines(spark, sf_dir)
    return mrg.merge_entity(cln.clean_holiday(old_lines), cln.clean_holiday(new_lines), schemas.HOLIDAY)


def merge_conflicts_order_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRG6: keys of loaded items that the raw export matches more than once."""
    return mrg.merge_conflicts(*roles.order_item_conflict_sides(spark, sf_dir), schemas.ORDER_ITEM.keys)


# --------------------------------------------------------------------------
# The whole chain
# --------------------------------------------------------------------------


def _side_by_side(spark: SparkSession, jobs: Sequence[Callable[[], object]]) -> None:
    """Run jobs that don't depend on each other at the same time, so that none's last tasks
    leave cores idle; earlier ones come first at free cores. Raises, when all have ended,
    what the first to fail raised."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        for job in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]:
            job.result()


def _older_load(spark: SparkSession, sf_dir: str) -> loads.Warehouse:
    """A warehouse of its own, with the dimensions of the older load and the calendar."""
    wh = loads.Warehouse(shared_folder(spark, "warehouse"), own_drops=True)
    sides = {
        schemas.ORDER_ITEM: roles.order_item_merge_sides,
        schemas.ORDER: roles.order_merge_sides,
        schemas.PRODUCT: roles.product_merge_sides,
        schemas.CUSTOMER: roles.customer_merge_sides,
    }

    def dimension(entity: schemas.Entity) -> None:
        publish(sides[entity](spark, sf_dir)[0], wh.dimension(entity.name), entity.schema, base=None)

    def calendar() -> None:
        publish(_dim_date(spark, sf_dir, True, False), wh.d_date, loads.D_DATE_SCHEMA, ["first_day_of_the_month"], base=None)

    _side_by_side(spark, [*(partial(dimension, entity) for entity in sides), calendar])
    return wh


def _load_drops(spark: SparkSession, sf_dir: str, wh: loads.Warehouse) -> None:
    """PIP1 for each entity: its dirty lines written as files, staged, counted and merged.

    What was merged into goes then, as nobody else reads this warehouse.
    """
    drops = {
        schemas.ORDER_ITEM: roles.order_item_lines,
        schemas.ORDER: roles.order_lines,
        schemas.PRODUCT: roles.product_lines,
        schemas.CUSTOMER: roles.customer_lines,
    }

    def load(entity: schemas.Entity) -> None:
        drop = wh.drop(entity.name)
        # a compressed file is read by one task, so it is bounded
        drops[entity](spark, sf_dir).select("value").write.option("maxRecordsPerFile", DROP_LINES).text(drop, compression="gzip", lineSep="\n")
        # the raw export has a few item keys twice, which a merge would refuse
        latest_by = ["price", "freight_value"] if entity is schemas.ORDER_ITEM else None
        loads.load_dimension(spark, entity.name, drop, wh, header=False, latest_by=latest_by)
        vacuum(spark, wh.dimension(entity.name), dt.datetime.now(dt.timezone.utc))

    _side_by_side(spark, [partial(load, entity) for entity in drops])


def pipeline_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIP1-PIP3 by ``loads``: dirty lines -> staged -> merged into the older load -> fact.

    Each step reads the table that the one before has written, so every cleaner and
    every merge is planned and run once.
    """
    with shuffles_dropped(spark):
        wh = _older_load(spark, sf_dir)
        _load_drops(spark, sf_dir, wh)
        loads.refresh_fact(spark, wh)
    return loads.read_fact(spark, wh)


def pipeline_fact_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIP3 by changes: the fact of the older load, brought up to date after the merges by the orders they touch."""
    with shuffles_dropped(spark):
        wh = _older_load(spark, sf_dir)
        loads.refresh_fact(spark, wh)
        _load_drops(spark, sf_dir, wh)
        loads.refresh_fact_changes(spark, wh)
    return loads.read_fact(spark, wh)


def fixtures() -> dict[str, Callable[[SparkSession, str], tuple[DataFrame, ...]]]:
    """What a query prepares from the driver tables before its operators run, for
    timing the two apart. The other queries read the tables as they are."""
    lines = {
        "customer": roles.customer_lines,
        "product": roles.product_lines,
        "order": roles.order_lines,
        "order_item": roles.order_item_lines,
        "holiday": roles.holiday_lines_from_orders,
    }
    found = {f"{job}_{name}": (lambda spark, sf_dir, make=make: (make(spark, sf_dir),)) for name, make in lines.items() for job in ("clean", "rejects")}
    found["clean_holiday_quoted"] = found["clean_holiday"]
    found["distinct_lines"] = found["clean_order_item"]
    found |= {
        "merge_customer": roles.customer_merge_sides,
        "merge_product": roles.product_merge_sides,
        "merge_order": roles.order_merge_sides,
        "merge_order_item": roles.order_item_merge_sides,
        "merge_holiday": roles.holiday_merge_lines,
        "merge_conflicts_order_item": roles.order_item_conflict_sides,
    }
    return found


def registry() -> dict[str, Query]:
    return {
        "fact_transaction": fact_transaction,
        "fact_transaction_dedup": fact_transaction_dedup,
        "fact_transaction_bucketed": fact_transaction_bucketed,
        "fact_order_item_joins": fact_order_item_joins,
        "dim_date_file": dim_date_file,
        "dim_date_scheduled": dim_date_scheduled,
        "dim_date_dedup": dim_date_dedup,
        "clean_customer": clean_customer,
        "clean_product": clean_product,
        "clean_order": clean_order,
        "clean_order_item": clean_order_item,
        "clean_holiday": clean_holiday,
        "clean_holiday_quoted": clean_holiday_quoted,
        "rejects_order_item": rejects_order_item,
        "rejects_order": rejects_order,
        "rejects_customer": rejects_customer,
        "rejects_product": rejects_product,
        "rejects_holiday": rejects_holiday,
        "distinct_lines": distinct_lines,
        "category_normalize": category_normalize,
        "merge_customer": merge_customer,
        "merge_product": merge_product,
        "merge_order": merge_order,
        "merge_order_item": merge_order_item,
        "merge_holiday": merge_holiday,
        "merge_conflicts_order_item": merge_conflicts_order_item,
        "pipeline_fact": pipeline_fact,
        "pipeline_fact_changes": pipeline_fact_changes,
    }
