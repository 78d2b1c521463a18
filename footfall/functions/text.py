"""Column functions for text: ids, escapes, money, JSON."""

from pyspark.sql import Column, functions as F

from footfall.schema import MONEY


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash16(*parts) -> Column:
    """First 16 hex characters of the MD5 of the concatenated parts."""
    return F.substring(F.md5(F.concat(*[_col(p) for p in parts])), 1, 16)


def blank_to_null(c) -> Column:
    c = _col(c)
    return F.when(F.length(F.trim(c)) > 0, c)


def escape_value(c) -> Column:
    """Escape `?` and `&` only; `%` and `=` stay, so text that already holds
    an escape cannot be told apart afterwards."""
    return F.replace(F.replace(_col(c), F.lit("?"), F.lit("%3F")), F.lit("&"), F.lit("%26"))


def unescape_value(c) -> Column:
    return F.replace(F.replace(_col(c), F.lit("%3F"), F.lit("?")), F.lit("%26"), F.lit("&"))


def money(c) -> Column:
    return _col(c).cast(MONEY)


def money_text(c) -> Column:
    """Two-decimal text; from decimals, so that no binary rounding creeps in."""
    return money(c).cast("string")


def json_object(c) -> Column:
    """The text when it is a JSON object, else NULL."""
    c = _col(c)
    # the first sign tells what a readable text is; only texts that can be objects are parsed
    opens = F.ltrim(c, F.lit(" \t\n\r")).startswith("{")
    return F.when(opens & F.try_parse_json(c).isNotNull(), c)
