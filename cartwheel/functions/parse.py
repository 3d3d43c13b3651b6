"""CLN6-CLN9: typed parses that follow Python's parsing rules, JVM-side.

Each parse is a guard regex (the exact text shape Python accepts) plus a
built-in conversion. Nothing throws: a text Python would reject gives NULL,
and the caller decides whether NULL nulls the field (dates, timestamps) or
rejects the row (integers, floats).

Python's numbers and its ``\\d`` take the decimal digits of every script. The
guards of dates have them wherever Python does; what is converted is the text with
its digits replaced by ASCII ones.
"""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# The field patterns of Python's strptime directives
# (%Y four digits, %m, %d, %H, %M, %S), a format blank matching any run of
# whitespace, and the separators of the accepted layouts.
_WS_RUN = r"[\s\x{1c}-\x{1f}]+"
_SEP = r"([-/.])"  # one separator, repeated by backreference \2

# The zero of each script's ten decimal digits, as Python knows them.
_ZEROS = [c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.decimal(c, None) == 0]
_WIDE_DIGITS = "".join(chr(ord(z) + n) for z in _ZEROS if not z.isascii() for n in range(10))
# ASCII first: that is what nearly every text has.
_ANY_DIGIT = "(?:[0-9]|[" + "".join(f"\\x{{{ord(z):x}}}-\\x{{{ord(z) + 9:x}}}" for z in _ZEROS if not z.isascii()) + "])"
_ANY_ZERO = "(?:0|[" + "".join(f"\\x{{{ord(z):x}}}" for z in _ZEROS if not z.isascii()) + "])"


def _layouts(digit: str, zero: str) -> tuple[str, str]:
    """CLN7 and CLN6 with ``digit`` in the place of \\d. The digits that the directives name are ASCII."""
    y = rf"((?!{zero}{{4}}){digit}{{4}})"  # year 0 is outside datetime's range
    m = r"(1[0-2]|0[1-9]|[1-9])"
    d = rf"(3[01]|[12]{digit}|0[1-9]|[1-9]| [1-9])"
    h = rf"(2[0-3]|[01]{digit}|{digit})"
    minute = rf"([0-5]{digit}|{digit})"
    s = rf"(6[01]|[0-5]{digit}|{digit})"
    return rf"(?U)^{y}{_SEP}{m}\2{d}{_WS_RUN}{h}:{minute}:{s}$", rf"^{d}{_SEP}{m}\2{y}$"


# CLN7: '%Y-%m-%d %H:%M:%S', '%Y/%m/%d %H:%M:%S', '%Y.%m.%d %H:%M:%S'
# CLN6: '%d-%m-%Y', '%d/%m/%Y', '%d.%m.%Y'
TIMESTAMP_PATTERN, DATE_PATTERN = _layouts("[0-9]", "0")
# What nearly every timestamp looks like: one space, ASCII digits, no blank for the tens of a day.
_PLAIN_TIMESTAMP_PATTERN = TIMESTAMP_PATTERN.replace(_WS_RUN, " ").replace("| [1-9])", ")").replace("(?U)", "")
_WIDE_TIMESTAMP_PATTERN, _WIDE_DATE_PATTERN = _layouts(_ANY_DIGIT, _ANY_ZERO)

# Below this, x * 1000 in doubles is less than a half off the thousandth x stands
# for; from here on, a double's fraction has at most ten bits.
TIE_LIMIT = float(2**42)
# From here on doubles are whole numbers.
WHOLE_LIMIT = float(2**53)

INT_PATTERN = r"^[+-]?[0-9]+(?:_[0-9]+)*$"
_DIGITS = r"[0-9](?:_?[0-9])*"
FLOAT_PATTERN = (
    rf"^[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
    r"|(?i:inf|infinity|nan))$"
)


def ascii_digits(c: Column) -> Column:
    """Text with the decimal digits of all scripts replaced by ASCII ones."""
    return F.when(F.octet_length(c) != F.char_length(c), F.translate(c, _WIDE_DIGITS, "0123456789" * (len(_WIDE_DIGITS) // 10))).otherwise(c)


def parse_timestamp_year_first(c: Column) -> Column:
    """CLN7: stripped text -> TIMESTAMP (UTC) or NULL (blank / no layout fits /
    impossible calendar value such as 31 February or second 60).

    ``c`` should be a column reference (it is read often). The accepted text
    is rewritten to ``Y-M-D h:m:s`` and converted with Spark's own string
    cast, which validates the calendar value.
    """
    return text_timestamp(timestamp_text(c))


def timestamp_text(c: Column) -> Column:
    """The text that Spark's cast reads of a timestamp in an accepted layout, else NULL."""
    canon = F.replace(F.regexp_replace(ascii_digits(c), TIMESTAMP_PATTERN, "$1-$3-$4 $5:$6:$7"), F.lit("- "), F.lit("-"))
    plain = F.replace(F.replace(c, F.lit("/"), F.lit("-")), F.lit("."), F.lit("-"))
    return F.when(F.regexp_instr(c, F.lit(_PLAIN_TIMESTAMP_PATTERN)) > 0, plain).when(c.rlike(_WIDE_TIMESTAMP_PATTERN), canon)


def text_timestamp(c: Column) -> Column:
    return c.try_cast("timestamp")


def parse_date_day_first(c: Column) -> Column:
    """CLN6: stripped text -> DATE or NULL, day-first layouts only."""
    canon = F.replace(F.regexp_replace(ascii_digits(c), DATE_PATTERN, "$4-$3-$1"), F.lit(" "), F.lit(""))
    return F.when(c.rlike(_WIDE_DATE_PATTERN), canon.try_cast("date"))


def parse_int_text(c: Column) -> Column:
    """CLN8 + SNK2: text of ``int(x)``, i.e. canonical integer text, or NULL."""
    return int_text(ascii_digits(c))


def int_text(c: Column) -> Column:
    """The same of a text whose digits are ASCII (a column reference: it is read often).

    ``'01'`` -> ``'1'``, ``'+5'`` -> ``'5'``, ``'-0'`` -> ``'0'``,
    ``'1_000'`` -> ``'1000'``; any length (no overflow, it stays text).
    """
    digits = F.regexp_replace(F.regexp_replace(c, r"[_+-]", ""), r"^0+(?=[0-9])", "")
    negative = c.startswith("-") & c.rlike("[1-9]")
    text = F.concat(F.when(negative, F.lit("-")).otherwise(F.lit("")), digits)
    return F.when(c.rlike(INT_PATTERN), text)


def round2(x: Column) -> Column:
    """``round(x, 2)`` of a double, decided on its exact binary value.

    ``bround`` decides on the decimal text, which differs only where that text
    is a tie, i.e. where x is the double next to k/1000 with k ending in 5. There
    x * 200 is compared with the odd integer of the tie: x is split into halves
    of 26 bits (Veltkamp), whose products with 200 are exact. That holds for |x|
    below 2^42 (4.4e12). From there to 2^53 the whole part and the fraction are
    split: the fraction is a multiple of 1/1024, so its hundredths are exact and
    ``rint`` decides on them; larger doubles are whole numbers already.
    """
    a = F.abs(x)
    k = F.rint(a * 1000)
    is_tie = (a < TIE_LIMIT) & (k % 10 == 5) & (k / 1000 == a)
    big = a * 134217729.0  # 2^27 + 1
    high = big - (big - a)
    # the odd integer of the tie is k / 5, the hundredths below it are (k - 5) / 10
    over = (high * 200 - k / 5) + (a - high) * 200
    up = F.when(over == 0, k % 20 == 15).otherwise(over > 0)
    tie = (k + F.when(up, 5.0).otherwise(-5.0)) / 10 / 100
    large = (a - a % 1) + F.rint(a % 1 * 100) / 100
    exact = F.when(is_tie, tie).when((a >= TIE_LIMIT) & (a < WHOLE_LIMIT), large)
    signed = exact * F.when(x < 0, -1.0).otherwise(1.0)
    return F.when(a >= WHOLE_LIMIT, x).otherwise(F.coalesce(signed, F.bround(x, 2)))


def parse_float_round2(c: Column) -> Column:
    """CLN9: ``round(float(x), 2)`` as DOUBLE, or NULL when float() would fail."""
    return float_round2(ascii_digits(c))


def float_round2(c: Column) -> Column:
    """The same of a text whose digits are ASCII (a column reference: it is read often)."""
    return round2(text_float(c))


def text_float(c: Column) -> Column:
    """``float(x)`` of a text whose digits are ASCII (a column reference: it is read often), or NULL.

    nan / inf / infinity (any case, signed) pass through: the
    guard admits exactly Python's float syntax, and Spark's cast reads the
    special words (a signed ``nan`` is mapped here, the cast does not take
    it).
    """
    # Past the guard, only nan ends in n/N ("inf"/"infinity" end in f/y).
    is_nan = c.endswith("n") | c.endswith("N")
    plain = F.when(c.contains("_"), F.replace(c, F.lit("_"), F.lit(""))).otherwise(c)
    return F.when(c.rlike(FLOAT_PATTERN), F.when(is_nan, F.lit(float("nan"))).otherwise(plain.try_cast("double")))
