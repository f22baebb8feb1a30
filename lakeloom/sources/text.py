"""Text-line sources: positional records (S4, S5) and character streams.

``spark.read.text`` splits files into input splits like any line format; the
parse is ``split`` + positional ``get`` + cast, all JVM-side.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom import rules as R


def read_lines(spark: SparkSession, path: str, line_sep: str | None = None) -> DataFrame:
    """One row per line (``value``)."""
    reader = spark.read
    if line_sep:
        reader = reader.option("lineSep", line_sep)
    return reader.text(path)


def parse_positional(lines: DataFrame, names: Sequence[str] = tuple(R.MIGRATION_FILE_COLUMNS),
                     casts: dict[str, str] | None = None, strict: bool = False,
                     text_col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Split on every ``,`` (no quoting) and take fields by position.

    ``casts`` maps field → type (default: last field ``Value`` as long). Strict
    casting fails the job on a bad value, as the reference does; lenient
    (default) gives NULL and a ``_bad_fields`` count for the reject table.
    """
    casts = {names[-1]: "long"} if casts is None else casts
    parts = F.split(F.col(text_col), ",")
    cols: list[Column] = []
    bad: list[Column] = []
    for i, name in enumerate(names):
        raw = F.get(parts, i)
        if name in casts:
            typed = raw.cast(casts[name]) if strict else raw.try_cast(casts[name])
            bad.append((raw.isNotNull() & typed.isNull()).cast("int"))
            cols.append(typed.alias(name))
        else:
            cols.append(raw.alias(name))
    out = lines.select(*keep, *cols, (sum(bad) if bad else F.lit(0)).alias("_bad_fields"))
    return out


def characters(text: Column) -> Column:
    """Iterate a string → one element per character (code point)."""
    return F.explode(F.split(text, ""))
