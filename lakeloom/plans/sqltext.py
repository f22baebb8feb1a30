"""Small helpers that spell rule tables as SQL text for the DuckDB oracle."""

from __future__ import annotations

from typing import Mapping, Sequence


def q(s: str) -> str:
    return "'" + str(s).replace("'", "''") + "'"


def case_map(expr: str, mapping: Mapping[str, str], default: str | None = None) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items())
    inner = f"CASE CAST({expr} AS VARCHAR) {whens} END"
    return f"COALESCE({inner}, {q(default)})" if default is not None else inner


def case_prefix(expr: str, mapping: Mapping[str, str], sep: str = "_") -> str:
    whens = " ".join(f"WHEN starts_with({expr}, {q(k + sep)}) THEN {q(v)}" for k, v in mapping.items())
    return f"CASE {whens} ELSE CAST(NULL AS VARCHAR) END"


def in_list(values: Sequence[str]) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def values_table(rows: Sequence[Sequence], columns: Sequence[str], alias: str = "t") -> str:
    """``(VALUES ...) AS t(cols)`` for a fixed lookup table."""
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, (int, float)):
            return str(v)
        return q(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS {alias}({', '.join(columns)})"


#: Columns of the oracles' pivots. A view cannot hold a dynamic PIVOT; Spark's columns come from the data, so a
#: lost or extra value shows as a difference in columns.
PIVOT_VALUES = {
    "year": "(1995, 1996, 1997, 1998, 1999, 2000, 2001)",
    "gender": "('Female', 'Male', 'Total')",
    "source_dataset": "('EUROSTAT', 'IRCC', 'OECD_MIG', 'OTHER')",
}
YEARS_SQL = PIVOT_VALUES["year"]
