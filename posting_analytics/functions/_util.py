from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_REGEX_SPECIAL = set(r".^$|?*+()[]{}\/")


def as_col(c) -> Column:
    """A column name or a Column -> Column."""
    return c if isinstance(c, Column) else F.col(c)


def regex_escape(text: str) -> str:
    """Escape a literal for both the JVM regex engine and RE2."""
    return "".join("\\" + ch if ch in _REGEX_SPECIAL else ch for ch in text)


def require_columns(df, cols) -> list[str]:
    """The column names, all of which the frame must have."""
    unknown = [c for c in cols if c not in df.columns]
    if unknown:
        raise ValueError(f"no such columns: {unknown}; the frame has {df.columns}")
    return list(cols)


def let(value: Column, f) -> Column:
    """``f(value)`` with ``value`` worked out once, however often ``f`` names it."""
    return F.transform(F.array(value), f)[0]
