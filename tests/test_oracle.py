"""Every registered query against its DuckDB oracle (as the driver does)."""

import os
import re
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from cartwheel.plans import oracle as sql  # noqa: E402
from cartwheel.plans import queries as plans  # noqa: E402
from check_oracle import TABLES, _digest, _family  # noqa: E402

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver data missing")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_warehouse_query_has_an_oracle():
    assert set(plans.registry()) == set(sql.registry())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", ["merge_customer", "merge_product", "merge_order", "merge_order_item"])
def test_merge_data_tells_an_update_from_a_coalesce(duck, name):
    right = sql.registry()[name]
    wrong = re.sub(r"CASE WHEN s\._in_s IS NOT NULL THEN s\.(\w+) ELSE t\.\w+ END", r"coalesce(s.\1, t.\1)", right)
    assert wrong != right
    assert _digest(duck.sql(right).df()) != _digest(duck.sql(wrong).df())


@pytest.mark.parametrize("name", sorted(sql.registry()))
def test_query_matches_oracle(spark, duck, name):
    sdf = queries()[name](spark, SF)
    s_schema = {f.name: _family(f.dataType.simpleString()) for f in sdf.schema.fields}
    spdf = sdf.toPandas()
    rel = duck.sql(oracle_sql()[name])
    d_schema = {c: _family(str(t)) for c, t in zip(rel.columns, rel.types)}
    dpdf = rel.df()
    assert s_schema == d_schema
    assert len(spdf) == len(dpdf)
    assert _digest(spdf) == _digest(dpdf)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns[0] == "order_purchase_date"
    assert df.count() > 0
