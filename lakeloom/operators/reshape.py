"""Reshaping operators: unpivot (G1/N2), checked pivot (G2), outer join with fill
(J3), NULL split (P17) and name → code lookup (P21)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom import rules as R
from lakeloom.functions.columns import code_or_prefix, coerce_numeric


def unpivot_years(wide: DataFrame, ids: Sequence[str], year_cols: Sequence[str],
                  year_name: str = "DateYear", value_name: str = "PeopleQtd") -> DataFrame:
    """G1: year-per-column → long rows; year as int, value coerced numeric, NULL → 0."""
    long = wide.select(*ids, *[F.col(c).cast("string").alias(c) for c in year_cols]).unpivot(
        list(ids), list(year_cols), year_name, value_name)
    return long.select(*ids, F.col(year_name).cast("int").alias(year_name),
                       F.coalesce(coerce_numeric(value_name), F.lit(0.0)).alias(value_name))


def pivot_unique(long: DataFrame, row_col: str, pivot_col: str, value: str) -> DataFrame:
    """One value per (row, pivot) cell, a column for each pivot value in the data; a
    duplicated cell fails the job (``raise_error`` evaluated inside the aggregate)."""
    return long.groupBy(row_col).pivot(pivot_col).agg(
        F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("duplicate pivot cell")))
         .otherwise(F.first(value)))


def outer_fill(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
               fill: dict) -> DataFrame:
    """Full outer join on a name, key taken from whichever side has it, fills applied."""
    j = left.join(right, left[left_key] == right[right_key], "full_outer")
    out = j.withColumn(left_key, F.coalesce(left[left_key], right[right_key])).drop(right_key)
    return out.na.fill(fill)


def null_split(df: DataFrame, col: str) -> tuple[DataFrame, DataFrame]:
    """(rows where ``col`` is NULL, rows where it is not)."""
    return df.where(F.col(col).isNull()), df.where(F.col(col).isNotNull())


def iso3_lookup(spark: SparkSession) -> DataFrame:
    """The fixed name → ISO3 table as a DataFrame (≈90 rows: a proven broadcast bound)."""
    return spark.createDataFrame(sorted(R.COUNTRY_ISO3.items()), "lk_name string, lk_code string")


def name_to_code(df: DataFrame, name_col: str, spark: SparkSession, out: str = "code") -> DataFrame:
    """Trimmed name looked up, else its upper-cased first three letters (≥ 3 chars), else itself."""
    lk = F.broadcast(iso3_lookup(spark))
    j = df.join(lk, F.trim(df[name_col]) == lk.lk_name, "left")
    return j.withColumn(out, code_or_prefix(name_col, F.col("lk_code"))).drop("lk_name", "lk_code")
