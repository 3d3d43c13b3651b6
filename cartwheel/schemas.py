"""Fixed table schemas and merge keys (declared, never inferred).

Column order is the staging / dimension column order. Raw CSV columns are
bound by position, so the position lists below are part of the contract.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

S = T.StringType()
TS = T.TimestampType()
D = T.DateType()
F64 = T.DoubleType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


D_CUSTOMER = _schema(
    ("customer_id", S),
    ("customer_unique_id", S),
    ("customer_zip_code_prefix", S),
    ("customer_city", S),
    ("customer_state", S),
)

D_PRODUCT = _schema(
    ("product_id", S),
    ("product_category", S),
    ("segment", S),
)

D_ORDER = _schema(
    ("order_id", S),
    ("customer_id", S),
    ("order_status", S),
    ("order_purchase_timestamp", TS),
    ("order_approved_at", TS),
    ("order_delivered_carrier_date", TS),
    ("order_delivered_customer_date", TS),
    ("order_estimated_delivery_date", TS),
)

D_ORDER_ITEM = _schema(
    ("order_id", S),
    ("order_item_id", S),
    ("order_purchase_timestamp", TS),
    ("order_approved_at", TS),
    ("customer_id", S),
    ("product_id", S),
    ("price", F64),
    ("freight_value", F64),
    ("order_status", S),
)

D_HOLIDAY = _schema(
    ("date", D),
    ("name", S),
)


@dataclass(frozen=True)
class Entity:
    """One loadable table: schema, merge keys and merge mode."""

    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    # Columns a matched target row takes from the source (None = insert only).
    update_cols: tuple[str, ...] | None

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]


# Merge keys and updated columns of each dimension (fixed by the upserts).
CUSTOMER = Entity(
    "d_customer",
    D_CUSTOMER,
    ("customer_id", "customer_unique_id"),
    (
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    ),
)
ORDER = Entity(
    "d_order",
    D_ORDER,
    ("order_id",),
    (
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ),
)
ORDER_ITEM = Entity(
    "d_order_item",
    D_ORDER_ITEM,
    ("order_id", "order_item_id", "product_id"),
    tuple(f.name for f in D_ORDER_ITEM.fields),
)
PRODUCT = Entity(
    "d_product",
    D_PRODUCT,
    ("product_id",),
    ("product_category", "segment"),
)
HOLIDAY = Entity("d_holiday", D_HOLIDAY, ("date", "name"), None)

ENTITIES = {e.name: e for e in (CUSTOMER, ORDER, ORDER_ITEM, PRODUCT, HOLIDAY)}


FACT = _schema(
    ("order_purchase_date", D),
    ("is_weekday", T.BooleanType()),
    ("is_holiday", T.BooleanType()),
    ("order_id", S),
    ("product_id", S),
    ("order_item_id", S),
    ("order_approved_at", TS),
    ("order_status", S),
    ("product_segment", S),
    ("product_category", S),
    ("customer_id", S),
    ("customer_unique_id", S),
    ("customer_state", S),
    ("freight_value", F64),
    ("avg_price", F64),
    ("product_quantity", T.LongType()),
)

FACT_COLUMNS = [f.name for f in FACT.fields]
