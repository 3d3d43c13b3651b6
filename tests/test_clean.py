"""Golden lines for each cleaner (cases from FIXTURES.md §5)."""

import datetime as dt
import re

from line_frames import lines_df

from cartwheel.operators import clean as cln


def _rows(df):
    return [tuple(r) for r in df.collect()]


def test_customer_golden(spark):
    lines = ["1,2,3,4", '"a","b c", 01001 ,"x, y",SP', ",,,,", ""]
    got = _rows(cln.clean_customer(lines_df(spark, lines)))
    assert sorted(got) == sorted([("a", "b c", "01001", "x", "y"), ("", "", "", "", "")])


def test_customer_rejects_short_and_blank(spark):
    rej = _rows(cln.rejects(lines_df(spark, ["1,2,3,4", ""]), "d_customer"))
    assert sorted(rej) == [("", "too_few_fields"), ("1,2,3,4", "too_few_fields")]


def test_holiday_golden(spark):
    lines = [
        '19/1/2009,"Martin Luther King, Jr. Day"',
        "31/2/2009,X",
        "1-1-2009,A",
        "1.1.2009,B",
        "2009-01-01,C",
        "onlyone",
    ]
    got = sorted(_rows(cln.clean_holiday(lines_df(spark, lines))), key=str)
    assert got == sorted(
        [
            (dt.date(2009, 1, 19), '"Martin Luther King'),
            (None, "X"),
            (dt.date(2009, 1, 1), "A"),
            (dt.date(2009, 1, 1), "B"),
            (None, "C"),
        ],
        key=str,
    )


def test_product_golden(spark):
    lines = [" p1 ,#N/A,s", "p2, home_comfort_2 ,t", "p3,home_appliances_2,u", "p4,Home_comfort_2,v", "p5,x"]
    got = sorted(_rows(cln.clean_product(lines_df(spark, lines))))
    assert got == [
        (" p1 ", "Others", "s"),
        ("p2", "home_comfort", "t"),
        ("p3", "home_appliances", "u"),
        ("p4", "Home_comfort_2", "v"),
    ]
    rej = _rows(cln.rejects(lines_df(spark, lines), "d_product"))
    assert rej == [("p5,x", "too_few_fields")]


def test_product_custom_map(spark):
    got = _rows(cln.clean_product(lines_df(spark, ["p,a,b"]), category_map={"a": "A"}))
    assert got == [("p", "A", "b")]


def test_order_golden(spark):
    line = "o,c,s,2017-1-2 3:4:5,,2017/01/02 03:04:05,2017.01.02 03:04:05,2017-01-02 03:04:05.5"
    (row,) = _rows(cln.clean_order(lines_df(spark, [line, "o2,c,s,a,b,c,d"])))
    t = dt.datetime(2017, 1, 2, 3, 4, 5)
    assert row == ("o", "c", "s", t, None, t, t, None)


def test_order_item_golden(spark):
    lines = [
        "o,01,2017-01-02 03:04:05,,c,p,58.90,13.29,delivered",
        "o,x,2017-01-02 03:04:05,,c,p,58.90,13.29,delivered",
        "o,1,2017-01-02 03:04:05,,c,p,,13.29,delivered",
        "o,1,2017-01-02 03:04:05,,c,p,1.5,n/a,delivered",
        "o,1,t,a,c",
        "o,2,t,a,c,p,1,2",
    ]
    got = _rows(cln.clean_order_item(lines_df(spark, lines)))
    assert got == [("o", "1", dt.datetime(2017, 1, 2, 3, 4, 5), None, "c", "p", 58.9, 13.29, "delivered")]
    rej = dict(_rows(cln.rejects(lines_df(spark, lines), "d_order_item")))
    assert rej == {
        lines[1]: "bad_order_item_id",
        lines[2]: "bad_price",
        lines[3]: "bad_freight_value",
        lines[4]: "too_few_fields",
        lines[5]: "too_few_fields",
    }


def test_dedupe_is_on_raw_lines(spark):
    lines = ["a,b,c,d,e", "a,b,c,d,e", " a,b,c,d,e", '"a",b,c,d,e']
    got = _rows(cln.clean_customer(lines_df(spark, lines)))
    # the three distinct raw lines survive, though they clean to one row
    assert got == [("a", "b", "c", "d", "e")] * 3
    assert cln.dedupe_lines(lines_df(spark, lines)).count() == 3


def test_staging_records_one_pass(spark):
    spec = cln.SPECS["d_order_item"]
    lines = ["o,01,2017-01-02 03:04:05,,c,p,58.90,13.29,delivered", "o,x"]
    recs = cln.staging_records(cln.parse_lines(lines_df(spark, lines), spec), spec)
    by_status = {r.status: r for r in recs.collect()}
    assert by_status["clean"].value is None and by_status["clean"].order_item_id == "1"
    assert by_status["rejected"].value == "o,x" and by_status["rejected"].order_id is None


def test_parse_runs_once_after_the_dedupe(spark):
    """The clean-row filter must not inline the parse (see clean._keep)."""
    lines = lines_df(spark, ["o,01,2017-01-02 03:04:05,,c,p,58.90,13.29,delivered"] * 3)
    plan = cln.clean_order_item(lines)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
    # one guard per parsed field, plus the integer's sign check
    assert plan.count("RLIKE(") == 6
    # nothing is parsed below the dedupe (on raw copies)
    below = plan.split("Aggregate [value", 1)[1].split("\n", 1)[1]
    assert "split(" not in below and "RLIKE(" not in below


def test_holiday_quoted_names_option(spark):
    lines = ['19/1/2009,"Martin Luther King, Jr. Day"', '1/1/2009, "Say ""hi"", all" ,x', "4/7/2009,Plain"]
    got = sorted(_rows(cln.clean_holiday(lines_df(spark, lines), quoted_names=True)), key=str)
    assert got == sorted(
        [
            (dt.date(2009, 1, 19), "Martin Luther King, Jr. Day"),
            (dt.date(2009, 1, 1), 'Say "hi", all'),
            (dt.date(2009, 7, 4), "Plain"),
        ],
        key=str,
    )


def test_generated_code_of_the_cleaners_is_small_enough_to_be_compiled(spark):
    """Beyond 8,000 bytes the JVM interprets a method; Spark then has to run the operators by themselves."""
    from cartwheel.session import COMPILED_CONF

    assert all(spark.conf.get(k) == v for k, v in COMPILED_CONF.items())
    lines = spark.createDataFrame([("1,01,2020-01-01 1:2:3,,c,p,1.005,2,X",)], "value string").repartition(2)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        clean = cln.clean_rows(cln.parse_lines(lines, cln.ORDER_ITEM), cln.ORDER_ITEM)
        code = clean._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # before: 38,228
    assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", code))) < 16_000


def test_strip_and_timestamps_off_the_plain_path(spark):
    lines = [
        "\x1f1\xa0, 01\t, 2020/2/ 3 \t4:5:6 ,　2020.12.31 1:02:03, c , p, 1.5,2\x1c, X ",
        "2,1,2020-02-30 1:2:3,2020-02/03 1:2:3,c,p,1,2,X",
        "3,1,٢020-02-03 1:2:3,2020-02-03  1:2:3,c,p,1,2,X",
    ]
    got = cln.clean_order_item(spark.createDataFrame([(v,) for v in lines], "value string")).orderBy("order_id").collect()
    stamp = lambda *a: dt.datetime(*a)
    assert [(r.order_id, r.order_item_id, r.order_purchase_timestamp, r.order_approved_at, r.customer_id, r.product_id, r.price, r.freight_value, r.order_status) for r in got] == [
        ("1", "1", stamp(2020, 2, 3, 4, 5, 6), stamp(2020, 12, 31, 1, 2, 3), "c", "p", 1.5, 2.0, "X"),
        ("2", "1", None, None, "c", "p", 1.0, 2.0, "X"),
        ("3", "1", stamp(2020, 2, 3, 1, 2, 3), stamp(2020, 2, 3, 1, 2, 3), "c", "p", 1.0, 2.0, "X"),
    ]
