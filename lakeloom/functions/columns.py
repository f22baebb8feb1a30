"""Column expressions for the rule-driven derived columns.

All of these are built-in Catalyst expressions (no Python per row), so they
stay inside whole-stage codegen. ``strict=True`` keeps ANSI errors for bad
input; ``strict=False`` turns them into NULL (the lenient reading that feeds
the reject table).
"""

from __future__ import annotations

import re
from typing import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_map(mapping: Mapping[str, str]) -> Column:
    """A map literal; its size is the size of the rule table, not of the data."""
    items: list[Column] = []
    for k, v in mapping.items():
        items += [F.lit(str(k)), F.lit(v)]
    return F.create_map(*items)


def value_map(c: str | Column, mapping: Mapping[str, str], default: str | None) -> Column:
    """Look the value up as text; NULL or unmapped gives the default."""
    default_col = F.lit(default).cast("string")
    if not mapping:
        return default_col
    return F.coalesce(F.try_element_at(literal_map(mapping), _col(c).cast("string")), default_col)


def prefix_map(c: str | Column, mapping: Mapping[str, str], sep: str = "_") -> Column:
    """P5: the label of the text before the first ``sep``, case-sensitive; without a
    separator or a rule it is NULL."""
    if not mapping:
        return F.lit(None).cast("string")
    parts = F.split(_col(c), re.escape(sep), 2)
    return F.when(F.size(parts) == 2, F.try_element_at(literal_map(mapping), parts[0]))


def trailing_int(c: str | Column, strict: bool = False) -> Column:
    """Digits after the last ``_`` at the end of the id, as int; no match gives NULL.
    So does a number beyond an int, unless ``strict``; ``int_overflow`` tells it apart."""
    digits = F.nullif(F.regexp_extract(_col(c), r"_(\d+)$", 1), F.lit(""))
    return digits.cast("int") if strict else digits.try_cast("int")


def int_overflow(c: str | Column) -> Column:
    """Whether the id ends in a number that P6 has no room for."""
    digits = F.nullif(F.regexp_extract(_col(c), r"_(\d+)$", 1), F.lit(""))
    return digits.isNotNull() & digits.try_cast("int").isNull()


def to_decimal(c: str | Column, precision: int = 16, scale: int = 5, strict: bool = True) -> Column:
    """Text amount to a fixed-point decimal."""
    t = f"decimal({precision},{scale})"
    return _col(c).cast(t) if strict else _col(c).try_cast(t)


def parse_date(c: str | Column, pattern: str, strict: bool = True) -> Column:
    """Date by pattern."""
    return F.to_date(_col(c), pattern) if strict else F.try_to_date(_col(c), pattern)


def parse_timestamp(c: str | Column, pattern: str, strict: bool = True) -> Column:
    """Timestamp by pattern."""
    if strict:
        return F.to_timestamp(_col(c), pattern)
    return F.try_to_timestamp(_col(c), F.lit(pattern))


def sign_category(c: str | Column, negative: str = "REFUND", positive: str = "CHARGE") -> Column:
    """P10: below zero is the negative label; zero and NULL are the positive one."""
    return F.when(_col(c) < 0, F.lit(negative)).otherwise(F.lit(positive))


def coerce_numeric(c: str | Column, to: str = "double") -> Column:
    """P20: non-numeric text becomes NULL (and NaN becomes NULL)."""
    v = _col(c).try_cast(to)
    if to in ("double", "float"):
        v = F.when(F.isnan(v), F.lit(None)).otherwise(v)
    return v


def year_of_period(c: str | Column) -> Column:
    """``2023-Q1`` → 2023, ``2023`` → 2023, anything else → NULL."""
    s = _col(c).cast("string")
    head = F.when(s.contains("-Q"), F.split(s, "-").getItem(0)).otherwise(s)
    return head.try_cast("int")


def slug(text: str) -> str:
    """P25 for a text known to the driver, such as a column name."""
    return "_".join(re.findall("[0-9a-zA-Z]+", text))


def slugify(c: str | Column) -> Column:
    """P25: runs of non-alphanumerics become ``_``; leading/trailing ``_`` removed."""
    return F.regexp_replace(F.regexp_replace(_col(c), r"[^0-9a-zA-Z]+", "_"), r"^_+|_+$", "")


def code_or_prefix(c: str | Column, lookup: Column) -> Column:
    """P21 fallback: the looked-up code, else upper first three letters when the
    trimmed name has at least three characters, else the trimmed name."""
    name = F.trim(_col(c))
    fallback = F.when(F.length(name) >= 3, F.upper(F.substring(name, 1, 3))).otherwise(name)
    return F.coalesce(lookup, fallback)


def sex_code(c: str | Column) -> Column:
    """TOT/T → T, MAS/M → M, anything else → F."""
    g = F.trim(_col(c).cast("string"))
    return (F.when(g.isin("TOT", "T"), F.lit("T"))
            .when(g.isin("MAS", "M"), F.lit("M"))
            .otherwise(F.lit("F")))
