"""The driver tables in the reference's roles, and dirty CSV lines from them.

The reference loads five retail CSV files. The driver ships TPC-H-like
tables instead, so every registered query first maps those tables into the
reference's roles (all columns, whole tables; nothing is sampled):

* customer  <- customer ⋈ nation: id c_custkey, unique id c_name,
  zip lpad(c_nationkey, 5, '0'), city c_mktsegment, state n_name
* product   <- part: id p_partkey, category p_type, segment p_brand
* order     <- orders: id o_orderkey, customer o_custkey, status
  o_orderstatus, timestamps from o_orderdate (+0, +1, +2, +5, +10 days)
* order item<- lineitem ⋈ orders: id l_orderkey, item l_linenumber,
  customer o_custkey, product l_partkey, price l_extendedprice,
  freight l_tax, status o_orderstatus
* calendar  <- whole years spanning min..max(o_orderdate), holidays by rule

and, for the cleaners, renders each table as the dirty CSV lines the
reference's jobs read (padding, quotes, every timestamp layout, blank and
malformed fields, short rows, every line exported twice).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.operators.calendar import scheduled_bounds


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string")


def _ts(c: str | Column, days: int = 0) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.timestamp_add("DAY", F.lit(days), c.cast("timestamp"))


# --------------------------------------------------------------------------
# Dimensions in the reference's schema
# --------------------------------------------------------------------------


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey, "inner").select(
        _s("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        F.lpad(_s("c_nationkey"), 5, "0").alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        F.col("n_name").alias("customer_state"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        _s("p_partkey").alias("product_id"),
        F.col("p_type").alias("product_category"),
        F.col("p_brand").alias("segment"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        _s("o_orderkey").alias("order_id"),
        _s("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        _ts("o_orderdate").alias("order_purchase_timestamp"),
        _ts("o_orderdate", 1).alias("order_approved_at"),
        _ts("o_orderdate", 2).alias("order_delivered_carrier_date"),
        _ts("o_orderdate", 5).alias("order_delivered_customer_date"),
        _ts("o_orderdate", 10).alias("order_estimated_delivery_date"),
    )


def _items_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner")


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Joined on the id's text, so that the rows lie by order_id for what joins or groups by it next.
    li = table(spark, sf_dir, "lineitem").withColumn("order_id", _s("l_orderkey"))
    o = table(spark, sf_dir, "orders").withColumn("order_id", _s("o_orderkey"))
    return li.join(o, "order_id", "inner").select(
        "order_id",
        _s("l_linenumber").alias("order_item_id"),
        _ts("o_orderdate").alias("order_purchase_timestamp"),
        _ts("o_orderdate", 1).alias("order_approved_at"),
        _s("o_custkey").alias("customer_id"),
        _s("l_partkey").alias("product_id"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_tax").alias("freight_value"),
        F.col("o_orderstatus").alias("order_status"),
    )


def scheduled_calendar_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row (lo, hi) as the yearly job has them if it runs on the last order
    date: from Jan 1 of the first order year to Dec 31 of next year."""
    o = table(spark, sf_dir, "orders")
    return scheduled_bounds(o, "o_orderdate", F.make_date(F.year(F.min("o_orderdate")), F.lit(1), F.lit(1)))


def calendar_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row (lo, hi): Jan 1 of the first and Dec 31 of the last order year."""
    o = table(spark, sf_dir, "orders")
    return o.agg(
        F.make_date(F.year(F.min("o_orderdate")), F.lit(1), F.lit(1)).alias("lo"),
        F.make_date(F.year(F.max("o_orderdate")), F.lit(12), F.lit(31)).alias("hi"),
    )


# Holiday rules of the calendar fixture (month, rule, name).
# The two October names share a date, as in the reference's holiday file,
# and one name carries a comma, which the naive split cuts (Q1).
HOLIDAY_RULES = [
    (1, "day 1", "New Year's Day"),
    (1, "third Monday", "Martin Luther King, Jr. Day"),
    (7, "day 4", "Independence Day"),
    (10, "second Monday", "Columbus Day"),
    (10, "second Monday", "Indigenous Peoples' Day"),
    (12, "day 25", "Christmas Day"),
]


def _rule_matches(d: Column, month: int, rule: str) -> Column:
    m = F.month(d) == month
    if rule.startswith("day "):
        return m & (F.dayofmonth(d) == int(rule.split()[1]))
    nth = {"second": 2, "third": 3}[rule.split()[0]]
    # n-th Monday: a Monday (dayofweek 2) on day 7n-6 .. 7n
    return m & (F.dayofweek(d) == 2) & F.dayofmonth(d).between(7 * nth - 6, 7 * nth)


def holiday_lines_for_spine(spine: DataFrame) -> DataFrame:
    """Holiday CSV lines (``D/M/YYYY,name``; names with a comma are quoted)
    for every rule date of the spine's days."""
    d = F.col("Date")
    names = F.array(*[F.when(_rule_matches(d, m, r), F.lit(n)) for m, r, n in HOLIDAY_RULES])
    hits = spine.select(d, F.explode(F.filter(names, lambda x: x.isNotNull())).alias("name"))
    csv_name = F.when(F.col("name").contains(","), F.concat(F.lit('"'), F.col("name"), F.lit('"'))).otherwise(
        F.col("name")
    )
    return hits.select(
        F.concat_ws(",", F.concat_ws("/", F.dayofmonth(d), F.month(d), F.year(d)), csv_name).alias("value")
    )


# --------------------------------------------------------------------------
# Dirty CSV lines (every table row becomes a line; each line exported twice)
# --------------------------------------------------------------------------


def _stamp(d: Column, k: Column) -> Column:
    """A timestamp text of ``d`` in one of four layouts chosen by ``k``:
    three year-first layouts the cleaner accepts and one day-first it must
    NULL."""
    y, m, dd = F.year(d).cast("string"), F.month(d).cast("string"), F.dayofmonth(d).cast("string")
    r = k % 4
    return (
        F.when(r == 0, F.concat(y, F.lit("-"), m, F.lit("-"), dd, F.lit(" 1:2:3")))
        .when(r == 1, F.concat(y, F.lit("/"), m, F.lit("/"), dd, F.lit(" 10:20:30")))
        .when(r == 2, F.concat(y, F.lit("."), m, F.lit("."), dd, F.lit(" 00:00:00")))
        .otherwise(F.concat(dd, F.lit("-"), m, F.lit("-"), y, F.lit(" 00:00:00")))
    )


def _twice(lines: DataFrame) -> DataFrame:
    """Every line exported twice (two overlapping drops), for DED1; the
    line is built once and emitted twice."""
    return lines.select(F.explode(F.array(F.col("value"), F.col("value"))).alias("value"))


def customer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    j = c.join(n, c.c_nationkey == n.n_nationkey, "inner")
    k = F.col("c_custkey")
    line = F.when(k % 50 == 7, F.concat(_s(k), F.lit(",short"))).otherwise(
        F.concat(
            _s(k), F.lit(',"'), F.col("c_name"), F.lit('",  '),
            F.lpad(_s("c_nationkey"), 5, "0"), F.lit(" ,"), F.col("c_mktsegment"),
            F.lit(","), F.col("n_name"),
        )
    )
    return _twice(j.select(line.alias("value")))


def product_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    cat = (
        F.when(k % 4 == 0, F.lit("home_appliances_2"))
        .when(k % 4 == 1, F.lit(" home_comfort_2 "))
        .when(k % 4 == 2, F.lit("#N/A"))
        .otherwise(F.lower("p_type"))
    )
    line = F.when(k % 50 == 7, F.concat(_s(k), F.lit(",short"))).otherwise(
        F.concat(_s(k), F.lit(","), cat, F.lit(","), F.col("p_brand"))
    )
    return _twice(p.select(line.alias("value")))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    approved = F.when(k % 5 == 0, F.lit("")).otherwise(_stamp(d, k + 1))
    line = F.when(k % 50 == 7, F.concat(_s(k), F.lit(",short"))).otherwise(
        F.concat(
            _s(k), F.lit(", "), _s("o_custkey"), F.lit(" ,"), F.col("o_orderstatus"), F.lit(","),
            _stamp(d, k), F.lit(","), approved, F.lit(","), _stamp(d, k + 2), F.lit(","),
            _stamp(d, k), F.lit(","), _stamp(d, k), F.lit(",extra"),
        )
    )
    return _twice(o.select(line.alias("value")))


def order_item_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _items_joined(spark, sf_dir)
    k, p, d = F.col("l_orderkey"), F.col("l_partkey"), F.col("o_orderdate")
    item = F.when(p % 40 == 3, F.lit("x")).otherwise(F.concat(F.lit("0"), _s("l_linenumber")))
    # every eighth price and freight ends in a third decimal 5, a tie in text
    third = F.when(p % 8 == 1, F.lit("5")).otherwise(F.lit(""))
    price = F.when(p % 40 == 5, F.lit("n/a")).otherwise(F.concat(_s(F.col("l_extendedprice").cast("decimal(12,2)")), third))
    freight = F.when(p % 40 == 9, F.lit("free")).otherwise(F.concat(_s(F.col("l_tax").cast("decimal(12,2)")), third))
    line = F.when(k % 50 == 7, F.concat(_s(k), F.lit(",1,a,b,c"))).otherwise(
        F.concat(
            _s(k), F.lit(","), item, F.lit(","), _stamp(d, k), F.lit(",,"), _s("o_custkey"), F.lit(","),
            _s(p), F.lit(","), price, F.lit(","), freight,
            F.lit(","), F.col("o_orderstatus"),
        )
    )
    return _twice(j.select(line.alias("value")))


def holiday_lines(orders_df: DataFrame) -> DataFrame:
    """One holiday line per order row: the order date in one of four layouts
    (three day-first ones the cleaner accepts, one year-first it must NULL),
    a name from the order priority (quoted with a comma for some), short
    lines for some."""
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    y, m, dd = F.year(d).cast("string"), F.month(d).cast("string"), F.dayofmonth(d).cast("string")
    r = k % 4
    date_txt = (
        F.when(r == 0, F.concat(dd, F.lit("-"), m, F.lit("-"), y))
        .when(r == 1, F.concat(dd, F.lit("/"), m, F.lit("/"), y))
        .when(r == 2, F.concat(F.lpad(dd, 2, "0"), F.lit("."), F.lpad(m, 2, "0"), F.lit("."), y))
        .otherwise(F.concat(y, F.lit("-"), F.lpad(m, 2, "0"), F.lit("-"), F.lpad(dd, 2, "0")))
    )
    name = F.when(k % 7 == 0, F.concat(F.lit('"'), F.col("o_orderpriority"), F.lit(', observed"'))).otherwise(
        F.concat(F.lit(" "), F.col("o_orderpriority"))
    )
    line = F.when(k % 50 == 7, date_txt).otherwise(F.concat(date_txt, F.lit(","), name))
    return _twice(orders_df.select(line.alias("value")))


def holiday_lines_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return holiday_lines(table(spark, sf_dir, "orders"))


# --------------------------------------------------------------------------
# Merge fixtures: an older load (target) and this week's extract (source)
# --------------------------------------------------------------------------

# The load windows. The target holds what earlier loads wrote;
# the source is the newest extract, overlapping the target by one year (or,
# for customers and parts, by one region / a band of sizes). Together they
# cover every row of the table.
TARGET_BEFORE = "1999-01-01"
SOURCE_FROM = "1998-01-01"
TARGET_REGIONS = ("AFRICA", "AMERICA", "ASIA")
SOURCE_REGIONS = ("ASIA", "EUROPE", "MIDDLE EAST")
TARGET_MAX_SIZE = 30
SOURCE_MIN_SIZE = 20


def _ts_lit(s: str) -> Column:
    return F.lit(s).cast("timestamp")


def _customers_in(spark: SparkSession, sf_dir: str, regions) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region").filter(F.col("r_name").isin(*regions))
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return j.select(
        _s("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        F.lpad(_s("c_nationkey"), 5, "0").alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        F.col("n_name").alias("customer_state"),
    )


def _spoilt(df: DataFrame, key: str, blank: str | None, new: Column | None) -> DataFrame:
    """The cases a MERGE must get right, by the number in the ``key`` column
    (its digits): a NULL key for every 40th row, a NULL in ``blank`` for every 7th,
    and every 5th row twice where ``new`` says that no target row has its key."""
    n = F.regexp_extract(key, r"[0-9]+", 0).cast("bigint")
    if new is not None:
        copies = F.when(new & (n % 5 == 0), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        df = df.withColumn("_copy", F.explode(copies)).drop("_copy")
    if blank is not None:
        df = df.withColumn(blank, F.when(n % 7 != 0, F.col(blank)))
    return df.withColumn(key, F.when(n % 40 != 0, F.col(key)))


def customer_merge_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Target: earlier load (city spelt in lower case); source: newest, with
    blank cities, repeated new customers, and NULL keys on both sides."""
    target = _customers_in(spark, sf_dir, TARGET_REGIONS).withColumn("customer_city", F.lower("customer_city"))
    source = _customers_in(spark, sf_dir, SOURCE_REGIONS)
    asia = _customers_in(spark, sf_dir, ("ASIA",)).select(F.col("customer_state").alias("_asia")).distinct()
    source = source.join(asia, F.col("customer_state") == F.col("_asia"), "left")
    source = _spoilt(source, "customer_id", "customer_city", F.col("_asia").isNull()).drop("_asia")
    return _spoilt(target, "customer_id", None, None), source


def product_merge_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Target: earlier load (category in lower case); source: newest, with
    blank segments, repeated new parts, and NULL keys on both sides."""
    p = table(spark, sf_dir, "part")

    def side(df: DataFrame) -> DataFrame:
        return df.select(
            _s("p_partkey").alias("product_id"),
            F.col("p_type").alias("product_category"),
            F.col("p_brand").alias("segment"),
        )

    target = side(p.filter(F.col("p_size") <= TARGET_MAX_SIZE)).withColumn(
        "product_category", F.lower("product_category")
    )
    late = side(p.filter(F.col("p_size") > TARGET_MAX_SIZE)).withColumn("_new", F.lit(True))
    early = side(p.filter(F.col("p_size").between(SOURCE_MIN_SIZE, TARGET_MAX_SIZE))).withColumn("_new", F.lit(False))
    source = _spoilt(early.unionByName(late), "product_id", "segment", F.col("_new")).drop("_new")
    return _spoilt(target, "product_id", None, None), source


def order_merge_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Target: orders loaded before, still open and unapproved then. Source: the
    newest extract, with blank statuses, repeated new orders, and NULL keys on
    both sides."""
    o = orders(spark, sf_dir)
    target = (
        o.filter(F.col("order_purchase_timestamp") < _ts_lit(TARGET_BEFORE))
        .withColumn("order_status", F.lit("O"))
        .withColumn("order_approved_at", F.lit(None).cast("timestamp"))
    )
    source = o.filter(F.col("order_purchase_timestamp") >= _ts_lit(SOURCE_FROM))
    source = _spoilt(source, "order_id", "order_status", F.col("order_purchase_timestamp") >= _ts_lit(TARGET_BEFORE))
    return _spoilt(target, "order_id", None, None), source


def latest_per_key(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """Staging hygiene for a fixture: one row per key, the one with the
    largest ``order_cols`` (then all other columns, so ties are settled
    deterministically). A grouped max, so partial aggregation bounds a hot
    key's cost."""
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    best = F.max(F.struct(*[F.col(c) for c in order_cols + rest])).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in order_cols + rest]).select(
        *df.columns
    )


def order_item_merge_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Target: items loaded before, freight not yet known then. Source: the
    newest extract, one row per merge key (latest by price, freight), with
    blank prices, repeated new items, and NULL keys on both sides."""
    it = order_items(spark, sf_dir)
    target = it.filter(F.col("order_purchase_timestamp") < _ts_lit(TARGET_BEFORE)).withColumn(
        "freight_value", F.lit(None).cast("double")
    )
    source = latest_per_key(
        it.filter(F.col("order_purchase_timestamp") >= _ts_lit(SOURCE_FROM)),
        ["order_id", "order_item_id", "product_id"],
        ["price", "freight_value"],
    )
    source = _spoilt(source, "order_id", "price", F.col("order_purchase_timestamp") >= _ts_lit(TARGET_BEFORE))
    return _spoilt(target, "order_id", None, None), source


def order_item_conflict_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Target: the items loaded before, one row per key. Source: the raw export of
    all items, some keys of which come twice."""
    it = order_items(spark, sf_dir)
    keys = ["order_id", "order_item_id", "product_id"]
    return latest_per_key(it.filter(F.col("order_purchase_timestamp") < _ts_lit(TARGET_BEFORE)), keys, ["price", "freight_value"]), it


def holiday_merge_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Holiday lines of the earlier load and of the newest extract."""
    o = table(spark, sf_dir, "orders")
    d = F.col("o_orderdate").cast("timestamp")
    return (
        holiday_lines(o.filter(d < _ts_lit(TARGET_BEFORE))),
        holiday_lines(o.filter(d >= _ts_lit(SOURCE_FROM))),
    )
