"""Hand-written lines with the row, or the reason of the reject, that they must give."""

import datetime as dt

import pytest

from line_frames import lines_df

from cartwheel.operators import clean as cln

T1 = dt.datetime(2017, 1, 2, 3, 4, 5)
NAN = "NaN"

# (line, expected row or None for a reject)
CUSTOMER = [
    ("c1,u1,01234,City,SP", ("c1", "u1", "01234", "City", "SP")),
    ('\t"a" , b\u3000,c,d,e', ("a", "b", "c", "d", "e")),
    (' "q" ,"w, e",r,t,y', ("q", "w", "e", "r", "t")),
    ('" in ",x,y,z,w', (" in ", "x", "y", "z", "w")),
    (",,,,", ("", "", "", "", "")),
    ("a,b,c,d,e,f,g", ("a", "b", "c", "d", "e")),
    ("x,y", None),
    ("nothing", None),
]
PRODUCT = [
    (" p , #N/A ,s", (" p ", "Others", "s")),
    ("p,home_comfort_2\x1f,s", ("p", "home_comfort", "s")),
    ("p,home_appliances_2, t ", ("p", "home_appliances", "t")),
    ("p,Home_comfort_2,s", ("p", "Home_comfort_2", "s")),
    ("p,,", ("p", "", "")),
    ("p", None),
]
ORDER = [
    (
        "o,c,s,2017-1-2 3:4:5,,2017/01/02\t03:04:05,2017.01.02 03:04:05,2017-01-02 03:04:05.5",
        ("o", "c", "s", T1, None, T1, T1, None),
    ),
    (
        "o2,c,s,2017-02-30 01:01:01,2016-02-29 23:59:59,0000-01-01 00:00:00,2017-01- 2 03:04:05,x",
        ("o2", "c", "s", None, dt.datetime(2016, 2, 29, 23, 59, 59), None, T1, None),
    ),
    ('"o3",c,s,,,,,,more', ('"o3"', "c", "s", None, None, None, None, None)),
    ("o3,c,s,a,b,c,d", None),
]
ORDER_ITEM = [
    ("o,+01,2017-01-02 03:04:05,,c,p,1_000.5,0.125,s", ("o", "1", T1, None, "c", "p", 1000.5, 0.12, "s")),
    ("o,-0,2017-01-02 03:04:05,,c,p,.5,5.,s", ("o", "0", T1, None, "c", "p", 0.5, 5.0, "s")),
    ("o,1_0,2017-01-02 03:04:05,,c,p,nan,-Inf,s", ("o", "10", T1, None, "c", "p", NAN, float("-inf"), "s")),
    ("o,2,x,,c,p,2.675,58.905,s", ("o", "2", None, None, "c", "p", 2.67, 58.91, "s")),
    ("o,3,x,,c,p,1.115,8.345,s", ("o", "3", None, None, "c", "p", 1.11, 8.35, "s")),
    ("o,1.0,2017-01-02 03:04:05,,c,p,1,1,s", None),
    ("o,1,2017-01-02 03:04:05,,c,p,1d,1,s", None),
    ("o,1,2017-01-02 03:04:05,,c,p,1,0x10,s", None),
    ("o,1,2,3,4,5,6,7", None),
]
HOLIDAY = [
    ('19/1/2009,"Martin Luther King, Jr. Day"', (dt.date(2009, 1, 19), '"Martin Luther King')),
    ("31/2/2009,X", (None, "X")),
    ("1.1.2009 , Y ", (dt.date(2009, 1, 1), "Y")),
    ("2009-01-01,C", (None, "C")),
    ("z", None),
]
CASES = {
    "d_customer": (CUSTOMER, cln.clean_customer),
    "d_product": (PRODUCT, cln.clean_product),
    "d_order": (ORDER, cln.clean_order),
    "d_order_item": (ORDER_ITEM, cln.clean_order_item),
    "d_holiday": (HOLIDAY, cln.clean_holiday),
}


def _plain(row):
    return tuple(NAN if isinstance(v, float) and v != v else v for v in row)


@pytest.mark.parametrize("entity", CASES)
def test_golden_lines(spark, entity):
    cases, clean = CASES[entity]
    lines = lines_df(spark, [line for line, _ in cases])
    got = sorted((_plain(r) for r in clean(lines).collect()), key=repr)
    assert got == sorted((row for _, row in cases if row is not None), key=repr)
    rejected = sorted(r.value for r in cln.rejects(lines, entity).collect())
    assert rejected == sorted(line for line, row in cases if row is None)
