"""CLN1, CLN3, CLN4: split, trim and unquote as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters Python's str.strip() removes (str.isspace):
# U+0009-000D, U+001C-001F, U+0020, U+0085, U+00A0, U+1680, U+2000-200A,
# U+2028, U+2029, U+202F, U+205F, U+3000.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)

_ODD_ASCII = r"[\x09-\x0d\x1c-\x1f]"


def split_fields(line: Column | str, sep: str = ",") -> Column:
    """CLN1: naive split on the delimiter; quotes are not honoured, empty
    trailing fields are kept (``'a,,'`` gives three fields)."""
    line = F.col(line) if isinstance(line, str) else line
    return F.split(line, _regex_escape(sep), -1)


def field(fields: Column, i: int) -> Column:
    """Field ``i`` (0-based) or NULL past the end (never throws under ANSI)."""
    return F.get(fields, F.lit(i))


def strip(c: Column) -> Column:
    """CLN3: remove leading and trailing whitespace (all kinds, like str.strip).

    A character-set trim, not a regex: Spark's TRIM(BOTH chars FROM c)."""
    return F.trim(c, F.lit(PY_WHITESPACE))


def has_odd_whitespace(c: Column) -> Column:
    """May a text hold whitespace other than spaces? (All that isn't ASCII may.)"""
    return (F.octet_length(c) != F.char_length(c)) | (F.regexp_instr(c, F.lit(_ODD_ASCII)) > 0)


def strip_of(c: Column, odd: Column) -> Column:
    """``strip`` of a part of a text of which ``odd`` says whether it may have odd whitespace.

    Without any, the trim of spaces does, which looks no character up in a set."""
    return F.when(odd, strip(c)).otherwise(F.trim(c))


def unquote(c: Column) -> Column:
    """CLN4: drop every double quote (after strip, so inner spaces survive)."""
    return F.replace(c, F.lit('"'), F.lit(""))


def _regex_escape(s: str) -> str:
    return "".join("\\" + ch if ch in r"\^$.|?*+()[]{}" else ch for ch in s)
