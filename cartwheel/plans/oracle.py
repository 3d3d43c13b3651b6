"""Independent DuckDB SQL for each registered query (the correctness gate).

Written from the reference's SQL and the cleaners' documented behaviour, not
from the Spark code: DuckDB's own ``string_split``, ``trim``,
``try_strptime``, ``try_cast``, ``strftime('%U')`` and joins. The tables
``customer nation part orders lineitem`` are DuckDB views on the same
Parquet files. Column names and types match the Spark results.
"""

from __future__ import annotations

# ---------------------------------------------------------------- roles
ROLES = """
cust AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_unique_id,
         lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
         c_mktsegment AS customer_city, n_name AS customer_state
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
prod AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_type AS product_category, p_brand AS segment
  FROM part),
ord AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
         o_orderstatus AS order_status,
         CAST(o_orderdate AS TIMESTAMP) AS order_purchase_timestamp,
         CAST(o_orderdate AS TIMESTAMP) + INTERVAL 1 DAY AS order_approved_at,
         CAST(o_orderdate AS TIMESTAMP) + INTERVAL 2 DAY AS order_delivered_carrier_date,
         CAST(o_orderdate AS TIMESTAMP) + INTERVAL 5 DAY AS order_delivered_customer_date,
         CAST(o_orderdate AS TIMESTAMP) + INTERVAL 10 DAY AS order_estimated_delivery_date
  FROM orders),
item AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS order_item_id,
         CAST(o_orderdate AS TIMESTAMP) AS order_purchase_timestamp,
         CAST(o_orderdate AS TIMESTAMP) + INTERVAL 1 DAY AS order_approved_at,
         CAST(o_custkey AS VARCHAR) AS customer_id, CAST(l_partkey AS VARCHAR) AS product_id,
         l_extendedprice AS price, l_tax AS freight_value, o_orderstatus AS order_status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

# ---------------------------------------------------------------- calendar
# Holiday dates by rule (DuckDB dayofweek: 0 = Sunday, 1 = Monday), one row
# per holiday name, so the October pair gives two rows for one date.
CALENDAR = """
bounds AS (
  SELECT make_date(CAST(year(min(o_orderdate)) AS INTEGER), 1, 1) AS lo,
         make_date(CAST(year(max(o_orderdate)) AS INTEGER), 12, 31) AS hi
  FROM orders),
spine AS (
  SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS "Date"
  FROM bounds),
hol AS (
  SELECT "Date" AS hdate FROM spine WHERE month("Date") = 1 AND day("Date") = 1
  UNION ALL SELECT "Date" FROM spine WHERE month("Date") = 1 AND dayofweek("Date") = 1 AND day("Date") BETWEEN 15 AND 21
  UNION ALL SELECT "Date" FROM spine WHERE month("Date") = 7 AND day("Date") = 4
  UNION ALL SELECT "Date" FROM spine WHERE month("Date") = 10 AND dayofweek("Date") = 1 AND day("Date") BETWEEN 8 AND 14
  UNION ALL SELECT "Date" FROM spine WHERE month("Date") = 10 AND dayofweek("Date") = 1 AND day("Date") BETWEEN 8 AND 14
  UNION ALL SELECT "Date" FROM spine WHERE month("Date") = 12 AND day("Date") = 25),
{hol_src},
dd AS (
  SELECT s."Date",
         CAST(date_trunc('month', s."Date") AS DATE) AS first_day_of_the_month,
         CAST(year(s."Date") AS INTEGER) AS year,
         CAST(strftime(s."Date", '%U') AS INTEGER) AS week,
         CAST(day(s."Date") AS INTEGER) AS day,
         CAST(quarter(s."Date") AS VARCHAR) AS quarter,
         CAST(month(s."Date") AS INTEGER) AS month,
         CAST(dayofweek(s."Date") + 1 AS INTEGER) AS day_of_week,
         dayofweek(s."Date") NOT IN (0, 6) AS is_weekday,
         h.hdate IS NOT NULL AS is_holiday
  FROM spine s LEFT JOIN hsrc h ON s."Date" = h.hdate)"""

HOL_ALL = "hsrc AS (SELECT hdate FROM hol)"
HOL_DEDUP = "hsrc AS (SELECT DISTINCT hdate FROM hol)"


def _calendar(dedupe: bool) -> str:
    return CALENDAR.format(hol_src=HOL_DEDUP if dedupe else HOL_ALL)


def _dim_date(with_dow: bool, dedupe: bool, years_ahead: int = 0) -> str:
    cols = '"Date", first_day_of_the_month, year, week, day, quarter, month, '
    cols += "day_of_week, " if with_dow else ""
    cols += "is_weekday, is_holiday"
    calendar = _calendar(dedupe).replace("year(max(o_orderdate))", f"year(max(o_orderdate)) + {years_ahead}")
    return f"WITH {calendar}\nSELECT {cols} FROM dd"


# ---------------------------------------------------------------- fact
FACT_JOIN = """
FROM item i
JOIN ord o ON i.order_id = o.order_id
JOIN prod p ON i.product_id = p.product_id
JOIN cust c ON i.customer_id = c.customer_id
LEFT JOIN dd ON CAST(i.order_purchase_timestamp AS DATE) = dd."Date"
"""


def _fact(dedupe: bool) -> str:
    return f"""WITH {ROLES}, {_calendar(dedupe)}
SELECT CAST(i.order_purchase_timestamp AS DATE) AS order_purchase_date,
       dd.is_weekday, dd.is_holiday, i.order_id, i.product_id, i.order_item_id,
       o.order_approved_at, i.order_status, p.segment AS product_segment, p.product_category,
       i.customer_id, c.customer_unique_id, c.customer_state,
       SUM(i.freight_value) AS freight_value, AVG(i.price) AS avg_price,
       COUNT(i.product_id) AS product_quantity
{FACT_JOIN}
GROUP BY CAST(i.order_purchase_timestamp AS DATE), dd.is_weekday, dd.is_holiday, i.order_id,
         i.order_status, o.order_approved_at, i.order_item_id, i.product_id, p.segment,
         p.product_category, i.customer_id, c.customer_unique_id, c.customer_state"""


FACT_JOINS_ONLY = f"""WITH {ROLES}, {_calendar(False)}
SELECT CAST(i.order_purchase_timestamp AS DATE) AS order_purchase_date,
       dd.is_weekday, dd.is_holiday, i.order_id, i.product_id, i.order_item_id,
       o.order_approved_at, i.order_status, p.segment AS product_segment, p.product_category,
       i.customer_id, c.customer_unique_id, c.customer_state, i.freight_value, i.price
{FACT_JOIN}"""

# ---------------------------------------------------------------- dirty lines
# STAMP(d, k): a timestamp text in one of four layouts picked by k % 4.
def _stamp(d: str, k: str) -> str:
    y, m, dd = (f"CAST({f}({d}) AS VARCHAR)" for f in ("year", "month", "day"))
    return (
        f"(CASE ({k}) % 4 WHEN 0 THEN {y} || '-' || {m} || '-' || {dd} || ' 1:2:3' "
        f"WHEN 1 THEN {y} || '/' || {m} || '/' || {dd} || ' 10:20:30' "
        f"WHEN 2 THEN {y} || '.' || {m} || '.' || {dd} || ' 00:00:00' "
        f"ELSE {dd} || '-' || {m} || '-' || {y} || ' 00:00:00' END)"
    )


CUSTOMER_LINES = """
L AS (
  SELECT CASE WHEN c_custkey % 50 = 7 THEN CAST(c_custkey AS VARCHAR) || ',short'
         ELSE CAST(c_custkey AS VARCHAR) || ',"' || c_name || '",  ' || lpad(CAST(c_nationkey AS VARCHAR), 5, '0')
              || ' ,' || c_mktsegment || ',' || n_name END AS value
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
LL AS (SELECT value FROM L UNION ALL SELECT value FROM L)"""

PRODUCT_LINES = """
L AS (
  SELECT CASE WHEN p_partkey % 50 = 7 THEN CAST(p_partkey AS VARCHAR) || ',short'
         ELSE CAST(p_partkey AS VARCHAR) || ',' ||
              CASE p_partkey % 4 WHEN 0 THEN 'home_appliances_2' WHEN 1 THEN ' home_comfort_2 '
                                 WHEN 2 THEN '#N/A' ELSE lower(p_type) END || ',' || p_brand END AS value
  FROM part),
LL AS (SELECT value FROM L UNION ALL SELECT value FROM L)"""

ORDER_LINES = f"""
L AS (
  SELECT CASE WHEN o_orderkey % 50 = 7 THEN CAST(o_orderkey AS VARCHAR) || ',short'
         ELSE CAST(o_orderkey AS VARCHAR) || ', ' || CAST(o_custkey AS VARCHAR) || ' ,' || o_orderstatus || ','
              || {_stamp('o_orderdate', 'o_orderkey')} || ','
              || CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE {_stamp('o_orderdate', 'o_orderkey + 1')} END || ','
              || {_stamp('o_orderdate', 'o_orderkey + 2')} || ','
              || {_stamp('o_orderdate', 'o_orderkey')} || ','
              || {_stamp('o_orderdate', 'o_orderkey')} || ',extra' END AS value
  FROM orders),
LL AS (SELECT value FROM L UNION ALL SELECT value FROM L)"""

ORDER_ITEM_LINES = f"""
L AS (
  SELECT CASE WHEN l_orderkey % 50 = 7 THEN CAST(l_orderkey AS VARCHAR) || ',1,a,b,c'
         ELSE CAST(l_orderkey AS VARCHAR) || ','
              || CASE WHEN l_partkey % 40 = 3 THEN 'x' ELSE '0' || CAST(l_linenumber AS VARCHAR) END || ','
              || {_stamp('o_orderdate', 'l_orderkey')} || ',,' || CAST(o_custkey AS VARCHAR) || ','
              || CAST(l_partkey AS VARCHAR) || ','
              || CASE WHEN l_partkey % 40 = 5 THEN 'n/a' ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) || third END
              || ',' || CASE WHEN l_partkey % 40 = 9 THEN 'free' ELSE CAST(CAST(l_tax AS DECIMAL(12,2)) AS VARCHAR) || third END
              || ',' || o_orderstatus END AS value
  FROM (SELECT *, CASE WHEN l_partkey % 8 = 1 THEN '5' ELSE '' END AS third FROM lineitem) JOIN orders ON l_orderkey = o_orderkey),
LL AS (SELECT value FROM L UNION ALL SELECT value FROM L)"""

HOLIDAY_LINES = """
L AS (
  SELECT CASE WHEN o_orderkey % 50 = 7 THEN dtxt ELSE dtxt || ',' || name END AS value
  FROM (
    SELECT o_orderkey,
      CASE o_orderkey % 4
        WHEN 0 THEN CAST(day(o_orderdate) AS VARCHAR) || '-' || CAST(month(o_orderdate) AS VARCHAR) || '-' || CAST(year(o_orderdate) AS VARCHAR)
        WHEN 1 THEN CAST(day(o_orderdate) AS VARCHAR) || '/' || CAST(month(o_orderdate) AS VARCHAR) || '/' || CAST(year(o_orderdate) AS VARCHAR)
        WHEN 2 THEN lpad(CAST(day(o_orderdate) AS VARCHAR), 2, '0') || '.' || lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') || '.' || CAST(year(o_orderdate) AS VARCHAR)
        ELSE CAST(year(o_orderdate) AS VARCHAR) || '-' || lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') || '-' || lpad(CAST(day(o_orderdate) AS VARCHAR), 2, '0')
      END AS dtxt,
      CASE WHEN o_orderkey % 7 = 0 THEN '"' || o_orderpriority || ', observed"' ELSE ' ' || o_orderpriority END AS name
    FROM orders)),
LL AS (SELECT value FROM L UNION ALL SELECT value FROM L)"""

# Split after the dedupe; f[i] is 1-based.
SPLIT = "P AS (SELECT value, string_split(value, ',') AS f FROM (SELECT DISTINCT value FROM LL))"

TS3 = (
    "COALESCE(try_strptime({x}, '%Y-%m-%d %H:%M:%S'), try_strptime({x}, '%Y/%m/%d %H:%M:%S'), "
    "try_strptime({x}, '%Y.%m.%d %H:%M:%S'))"
)
DATE3 = (
    "CAST(COALESCE(try_strptime({x}, '%d-%m-%Y'), try_strptime({x}, '%d/%m/%Y'), "
    "try_strptime({x}, '%d.%m.%Y')) AS DATE)"
)


def _ts(i: int) -> str:
    return TS3.format(x=f"trim(f[{i}])")


CLEAN_CUSTOMER = f"""WITH {CUSTOMER_LINES}, {SPLIT}
SELECT replace(trim(f[1]), '"', '') AS customer_id, replace(trim(f[2]), '"', '') AS customer_unique_id,
       replace(trim(f[3]), '"', '') AS customer_zip_code_prefix, replace(trim(f[4]), '"', '') AS customer_city,
       replace(trim(f[5]), '"', '') AS customer_state
FROM P WHERE len(f) >= 5"""

CLEAN_PRODUCT = f"""WITH {PRODUCT_LINES}, {SPLIT}
SELECT f[1] AS product_id,
       CASE trim(f[2]) WHEN 'home_appliances_2' THEN 'home_appliances' WHEN 'home_comfort_2' THEN 'home_comfort'
                       WHEN '#N/A' THEN 'Others' ELSE trim(f[2]) END AS product_category,
       trim(f[3]) AS segment
FROM P WHERE len(f) >= 3"""

CLEAN_ORDER = f"""WITH {ORDER_LINES}, {SPLIT}
SELECT trim(f[1]) AS order_id, trim(f[2]) AS customer_id, trim(f[3]) AS order_status,
       {_ts(4)} AS order_purchase_timestamp, {_ts(5)} AS order_approved_at,
       {_ts(6)} AS order_delivered_carrier_date, {_ts(7)} AS order_delivered_customer_date,
       {_ts(8)} AS order_estimated_delivery_date
FROM P WHERE len(f) >= 8"""

_ITEM_REASON = """CASE WHEN len(f) < 9 THEN 'too_few_fields'
            WHEN TRY_CAST(trim(f[2]) AS BIGINT) IS NULL THEN 'bad_order_item_id'
            WHEN TRY_CAST(trim(f[7]) AS DOUBLE) IS NULL THEN 'bad_price'
            WHEN TRY_CAST(trim(f[8]) AS DOUBLE) IS NULL THEN 'bad_freight_value' END"""

# round(x, 2) of a double >= 2^-8 or 0 on its exact binary value, in whole
# numbers: x * 2^60 is a whole number there; half to even.
def _exact2(text: str) -> str:
    scaled = f"(CAST(CAST({text} AS DOUBLE) * 1152921504606846976.0 AS HUGEINT) * 100)"
    whole, rest = f"({scaled} // 1152921504606846976)", f"({scaled} % 1152921504606846976)"
    up = f"({rest} > 576460752303423488 OR ({rest} = 576460752303423488 AND {whole} % 2 = 1))"
    return f"CAST({whole} + CASE WHEN {up} THEN 1 ELSE 0 END AS DOUBLE) / 100.0"


CLEAN_ORDER_ITEM = f"""WITH {ORDER_ITEM_LINES}, {SPLIT},
R AS (SELECT *, {_ITEM_REASON} AS reason FROM P)
SELECT trim(f[1]) AS order_id, CAST(TRY_CAST(trim(f[2]) AS BIGINT) AS VARCHAR) AS order_item_id,
       {_ts(3)} AS order_purchase_timestamp, {_ts(4)} AS order_approved_at,
       trim(f[5]) AS customer_id, trim(f[6]) AS product_id,
       {_exact2("trim(f[7])")} AS price, {_exact2("trim(f[8])")} AS freight_value,
       trim(f[9]) AS order_status
FROM R WHERE reason IS NULL"""

REJECTS_ORDER_ITEM = f"""WITH {ORDER_ITEM_LINES}, {SPLIT},
R AS (SELECT *, {_ITEM_REASON} AS reason FROM P)
SELECT value, reason FROM R WHERE reason IS NOT NULL"""

REJECTS_ORDER = f"""WITH {ORDER_LINES}, {SPLIT}
SELECT value, 'too_few_fields' AS reason FROM P WHERE len(f) < 8"""

REJECTS_CUSTOMER = f"""WITH {CUSTOMER_LINES}, {SPLIT}
SELECT value, 'too_few_fields' AS reason FROM P WHERE len(f) < 5"""

REJECTS_PRODUCT = f"""WITH {PRODUCT_LINES}, {SPLIT}
SELECT value, 'too_few_fields' AS reason FROM P WHERE len(f) < 3"""

REJECTS_HOLIDAY = f"""WITH {HOLIDAY_LINES}, {SPLIT}
SELECT value, 'too_few_fields' AS reason FROM P WHERE len(f) < 2"""

CLEAN_HOLIDAY = f"""WITH {HOLIDAY_LINES}, {SPLIT}
SELECT {DATE3.format(x="trim(f[1])")} AS date, trim(f[2]) AS name
FROM P WHERE len(f) >= 2"""

CLEAN_HOLIDAY_QUOTED = f"""WITH {HOLIDAY_LINES}, {SPLIT}
SELECT {DATE3.format(x="trim(f[1])")} AS date,
       CASE WHEN regexp_matches(value, '^[^,]*,\\s*"((?:[^"]|"")*)"')
            THEN trim(replace(regexp_extract(value, '^[^,]*,\\s*"((?:[^"]|"")*)"', 1), '""', '"'))
            ELSE trim(f[2]) END AS name
FROM P WHERE len(f) >= 2"""

DISTINCT_LINES = f"""WITH {ORDER_ITEM_LINES}
SELECT DISTINCT value FROM LL"""

CATEGORY_NORMALIZE = """
SELECT CAST(p_partkey AS VARCHAR) AS product_id, raw AS raw_category,
       CASE trim(raw) WHEN 'home_appliances_2' THEN 'home_appliances' WHEN 'home_comfort_2' THEN 'home_comfort'
                      WHEN '#N/A' THEN 'Others' ELSE trim(raw) END AS product_category
FROM (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'home_appliances_2' WHEN 1 THEN ' home_comfort_2 '
                                           WHEN 2 THEN '#N/A' ELSE p_type END AS raw FROM part)"""


# ---------------------------------------------------------------- merges
# Upsert as a full outer join with presence markers: a matched row takes the
# source's values, an unmatched row keeps its own side's. NULL keys never
# compare equal, so such rows come through unmatched.
def _upsert(ctes: str, keys: list[str], cols: list[str]) -> str:
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    sel = ", ".join(f"CASE WHEN s._in_s IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in cols)
    return f"""WITH {ctes},
TT AS (SELECT *, 1 AS _in_t FROM T), SS AS (SELECT *, 1 AS _in_s FROM S)
SELECT {sel}
FROM TT t FULL OUTER JOIN SS s ON {on}"""


# The rows a MERGE must get right, by the number n in the key: NULL keys (n % 40 =
# 0), blanks in one column of the source (n % 7 = 0), and source rows that come
# twice where no target row has their key (n % 5 = 0).
def _spoilt(rows: str, key: str, blank: str | None = None, new: str | None = None) -> str:
    n = f"CAST({key} AS BIGINT)"
    replaced = f"CASE WHEN {n} % 40 <> 0 THEN {key} END AS {key}"
    if blank:
        replaced += f", CASE WHEN {n} % 7 <> 0 THEN {blank} END AS {blank}"
    once = f"SELECT * REPLACE ({replaced}) FROM ({rows})"
    if not new:
        return once
    return f"{once} UNION ALL SELECT * REPLACE ({replaced}) FROM ({rows}) WHERE ({new}) AND {n} % 5 = 0"


_CUSTOMER_COLS = ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"]
_CUST_REGION = """
cr AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_unique_id,
         lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
         c_mktsegment AS customer_city, n_name AS customer_state, r_name
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
T AS ({t}),
S AS (SELECT * EXCLUDE (r_name) FROM ({s}))""".format(
    t=_spoilt("SELECT * EXCLUDE (r_name) REPLACE (lower(customer_city) AS customer_city) FROM cr WHERE r_name IN ('AFRICA', 'AMERICA', 'ASIA')", "customer_id"),
    s=_spoilt("SELECT * FROM cr WHERE r_name IN ('ASIA', 'EUROPE', 'MIDDLE EAST')", "customer_id", "customer_city", "r_name <> 'ASIA'"),
)
MERGE_CUSTOMER = _upsert(_CUST_REGION, ["customer_id", "customer_unique_id"], _CUSTOMER_COLS)

_PRODUCT_SIDES = """
pr AS (SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_type AS product_category, p_brand AS segment, p_size FROM part),
T AS ({t}),
S AS (SELECT * EXCLUDE (p_size) FROM ({s}))""".format(
    t=_spoilt("SELECT * EXCLUDE (p_size) REPLACE (lower(product_category) AS product_category) FROM pr WHERE p_size <= 30", "product_id"),
    s=_spoilt("SELECT * FROM pr WHERE p_size >= 20", "product_id", "segment", "p_size > 30"),
)
MERGE_PRODUCT = _upsert(_PRODUCT_SIDES, ["product_id"], ["product_id", "product_category", "segment"])

_ORDER_COLS = [
    "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
    "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date",
]
_ORDER_SIDES = f"""{ROLES},
T AS ({_spoilt("SELECT * REPLACE ('O' AS order_status, CAST(NULL AS TIMESTAMP) AS order_approved_at) FROM ord WHERE order_purchase_timestamp < TIMESTAMP '1999-01-01'", "order_id")}),
S AS ({_spoilt("SELECT * FROM ord WHERE order_purchase_timestamp >= TIMESTAMP '1998-01-01'", "order_id", "order_status", "order_purchase_timestamp >= TIMESTAMP '1999-01-01'")})"""
MERGE_ORDER = _upsert(_ORDER_SIDES, ["order_id"], _ORDER_COLS)

_ITEM_COLS = [
    "order_id", "order_item_id", "order_purchase_timestamp", "order_approved_at", "customer_id",
    "product_id", "price", "freight_value", "order_status",
]
_ITEM_SIDES = f"""{ROLES},
latest AS (SELECT * EXCLUDE (rn)
      FROM (SELECT *, row_number() OVER (PARTITION BY order_id, order_item_id, product_id
                                         ORDER BY price DESC, freight_value DESC) AS rn
            FROM item WHERE order_purchase_timestamp >= TIMESTAMP '1998-01-01') WHERE rn = 1),
T AS ({_spoilt("SELECT * REPLACE (CAST(NULL AS DOUBLE) AS freight_value) FROM item WHERE order_purchase_timestamp < TIMESTAMP '1999-01-01'", "order_id")}),
S AS ({_spoilt("SELECT * FROM latest", "order_id", "price", "order_purchase_timestamp >= TIMESTAMP '1999-01-01'")})"""
MERGE_ORDER_ITEM = _upsert(_ITEM_SIDES, ["order_id", "order_item_id", "product_id"], _ITEM_COLS)


def _holiday_clean(name: str, where: str) -> str:
    lines = HOLIDAY_LINES.replace("FROM orders))", f"FROM orders WHERE {where}))")
    lines = lines.replace("L AS (", f"L_{name} AS (", 1).replace("LL AS (SELECT value FROM L UNION ALL SELECT value FROM L)",
                                                             f"LL_{name} AS (SELECT value FROM L_{name} UNION ALL SELECT value FROM L_{name})")
    return f"""{lines},
{name} AS (
  SELECT {DATE3.format(x="trim(f[1])")} AS date, trim(f[2]) AS name
  FROM (SELECT string_split(value, ',') AS f FROM (SELECT DISTINCT value FROM LL_{name}))
  WHERE len(f) >= 2)"""


MERGE_HOLIDAY = f"""WITH {_holiday_clean("T", "o_orderdate < TIMESTAMP '1999-01-01'")},
{_holiday_clean("S", "o_orderdate >= TIMESTAMP '1998-01-01'")}
SELECT date, name FROM T
UNION ALL
SELECT s.date, s.name FROM S s WHERE NOT EXISTS (SELECT 1 FROM T t WHERE t.date = s.date AND t.name = s.name)"""


MERGE_CONFLICTS = f"""WITH {ROLES},
several AS (SELECT order_id, order_item_id, product_id, count(*) AS source_rows FROM item
            GROUP BY order_id, order_item_id, product_id HAVING count(*) > 1)
SELECT DISTINCT order_id, order_item_id, product_id, source_rows
FROM several JOIN item USING (order_id, order_item_id, product_id)
WHERE order_purchase_timestamp < TIMESTAMP '1999-01-01'"""


# ---------------------------------------------------------------- the chain
def _chained(sides: str, clean: str, keys: list[str], cols: list[str]) -> str:
    """The merge of a cleaner's rows into the older load (the T of ``sides``)."""
    t = f"WITH {sides} SELECT * FROM T"
    return f"({_upsert(f'T AS ({t}), S AS ({clean})', keys, cols)})"


_ITEM_KEYS = ["order_id", "order_item_id", "product_id"]
_LATEST_ITEMS = f"""SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id, order_item_id, product_id
                               ORDER BY price DESC, freight_value DESC) AS rn FROM ({CLEAN_ORDER_ITEM})) WHERE rn = 1"""

PIPELINE_FACT = _fact(False).replace(
    ROLES,
    f"""
cust AS {_chained(_CUST_REGION, CLEAN_CUSTOMER, ["customer_id", "customer_unique_id"], _CUSTOMER_COLS)},
prod AS {_chained(_PRODUCT_SIDES, CLEAN_PRODUCT, ["product_id"], ["product_id", "product_category", "segment"])},
ord AS {_chained(_ORDER_SIDES, CLEAN_ORDER, ["order_id"], _ORDER_COLS)},
item AS {_chained(_ITEM_SIDES, _LATEST_ITEMS, _ITEM_KEYS, _ITEM_COLS)}""",
)


def registry() -> dict[str, str]:
    return {
        "fact_transaction": _fact(False),
        "fact_transaction_dedup": _fact(True),
        "fact_transaction_bucketed": _fact(False),
        "fact_order_item_joins": FACT_JOINS_ONLY,
        "dim_date_file": _dim_date(True, False),
        "dim_date_scheduled": _dim_date(False, False, years_ahead=1),
        "dim_date_dedup": _dim_date(True, True),
        "clean_customer": CLEAN_CUSTOMER,
        "clean_product": CLEAN_PRODUCT,
        "clean_order": CLEAN_ORDER,
        "clean_order_item": CLEAN_ORDER_ITEM,
        "clean_holiday": CLEAN_HOLIDAY,
        "clean_holiday_quoted": CLEAN_HOLIDAY_QUOTED,
        "rejects_order_item": REJECTS_ORDER_ITEM,
        "rejects_order": REJECTS_ORDER,
        "rejects_customer": REJECTS_CUSTOMER,
        "rejects_product": REJECTS_PRODUCT,
        "rejects_holiday": REJECTS_HOLIDAY,
        "distinct_lines": DISTINCT_LINES,
        "category_normalize": CATEGORY_NORMALIZE,
        "merge_customer": MERGE_CUSTOMER,
        "merge_product": MERGE_PRODUCT,
        "merge_order": MERGE_ORDER,
        "merge_order_item": MERGE_ORDER_ITEM,
        "merge_holiday": MERGE_HOLIDAY,
        "merge_conflicts_order_item": MERGE_CONFLICTS,
        "pipeline_fact": PIPELINE_FACT,
        "pipeline_fact_changes": PIPELINE_FACT,
    }
