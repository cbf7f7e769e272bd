"""Money amounts in text.

Amounts are kept as canonical digit strings (no leading zeros) and ordered by
``(length, digits)``, which is numeric order for integers of any length, so
no amount overflows a fixed-width number type.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocab
from ._util import as_col, regex_escape


def digits_only(c) -> Column:
    """All characters except ASCII digits removed."""
    return F.regexp_replace(as_col(c), "[^0-9]", "")


def canonical_digits(d) -> Column:
    """Digit string without leading zeros ('' stays '', '000' -> '0')."""
    d = as_col(d)
    stripped = F.regexp_replace(d, "^0+", "")
    return F.when((stripped == "") & (d != ""), F.lit("0")).otherwise(stripped)


def group_thousands(d, sep: str = vocab.THOUSANDS_SEP) -> Column:
    """'1234567' -> '1.234.567' for a canonical digit string of any length."""
    rev = F.reverse(as_col(d))
    grouped = F.reverse(F.regexp_replace(rev, "([0-9]{3})", "$1" + sep.replace("$", r"\$")))
    # a length divisible by three leaves one separator in front
    return F.regexp_replace(grouped, "^" + regex_escape(sep), "")


def money_format(text, prefix: str = vocab.MONEY_PREFIX,
                 sep: str = vocab.THOUSANDS_SEP) -> Column:
    """The digits of the text as one amount, grouped by thousands and
    prefixed; a text without digits is returned unchanged."""
    d = digits_only(text)
    formatted = F.concat(F.lit(prefix), group_thousands(canonical_digits(d), sep))
    return F.when(d == "", as_col(text)).otherwise(formatted)


def _amount_digits(text, pattern: str, min_digits: int, drop_fraction: bool) -> Column:
    """Canonical digit strings of all matches that are long enough, in text order."""
    found = F.regexp_extract_all(F.coalesce(as_col(text), F.lit("")), F.lit(pattern), 0)
    if drop_fraction:
        found = F.transform(found, lambda m: F.regexp_replace(m, ",[0-9]+$", ""))
    digits = F.transform(found, digits_only)
    kept = F.filter(digits, lambda d: F.length(d) >= min_digits)
    return F.transform(kept, canonical_digits)


def _by_size(digits: Column) -> Column:
    """Structs that order as the numbers do: shorter first, then by digits."""
    return F.transform(digits, lambda d: F.struct(F.length(d).alias("n"), d.alias("d")))


def amounts(text, pattern: str = vocab.SALARY_PATTERN,
            min_digits: int = vocab.SALARY_MIN_DIGITS, drop_fraction: bool = False) -> Column:
    """Distinct amounts of all ``pattern`` matches, ascending by value, as
    canonical digit strings; matches with fewer than ``min_digits`` digits are
    dropped.  By default the digits after a decimal comma count too (as in the
    original rule); ``drop_fraction`` removes a trailing ``,<digits>`` first."""
    sized = _by_size(_amount_digits(text, pattern, min_digits, drop_fraction))
    return F.transform(F.sort_array(F.array_distinct(sized)), lambda x: x["d"])


def amount_range(text, pattern: str = vocab.SALARY_PATTERN,
                 min_digits: int = vocab.SALARY_MIN_DIGITS,
                 sentinel: str = vocab.NOT_STATED, prefix: str = vocab.MONEY_PREFIX,
                 sep: str = vocab.THOUSANDS_SEP, range_sep: str = vocab.AMOUNT_RANGE_SEP,
                 drop_fraction: bool = False) -> Column:
    """E9: 'min - max' of the amounts in the text (one amount alone, the
    sentinel when there is none)."""
    sized = _by_size(_amount_digits(text, pattern, min_digits, drop_fraction))
    low, high = F.array_min(sized)["d"], F.array_max(sized)["d"]
    lo = F.concat(F.lit(prefix), group_thousands(low, sep))
    hi = F.concat(F.lit(prefix), group_thousands(high, sep))
    return (F.when(low.isNull(), F.lit(sentinel))
            .when(low == high, lo)
            .otherwise(F.concat(lo, F.lit(range_sep), hi)))
