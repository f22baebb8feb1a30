"""Data-quality gates (Q1–Q6) and the reject side table.

The reference runs one Spark job per check; here every check of a stage is a
column of ONE aggregate (partial aggregation on each partition, one tiny
shuffle), and uniqueness is a single ``groupBy(id)`` whose map side already
collapses repeated ids. ``assert_expectations`` reads the one-row report.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom import rules as R
from lakeloom.functions.columns import int_overflow


def dq_report(df: DataFrame, critical_cols: Sequence[str], amount_col: str | None = None,
              id_col: str | None = None) -> DataFrame:
    """Q1–Q3 as one row: ``null_<col>``, ``negative_<amount>``, ``duplicate_<id>``.

    Duplicates follow ``count - count(DISTINCT id incl. NULL)``: NULL counts as one value.
    """
    checks: dict[str, Column] = {"row_count": F.count(F.lit(1))}
    for c in critical_cols:
        checks[f"null_{c}"] = F.count_if(F.col(c).isNull())
    if amount_col:
        checks[f"negative_{amount_col}"] = F.count_if(F.col(amount_col).try_cast("double") < 0)
    aggs = [e.alias(n) for n, e in checks.items()]
    if not id_col:
        return df.agg(*aggs)
    # per id value first (map-side combined), then every id group beyond its
    # first row is a duplicate; the NULL id forms one group like any value.
    per_id = df.groupBy(id_col).agg(*aggs)
    return per_id.agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(n) for n in checks],
                      F.coalesce(F.sum(F.col("row_count") - 1), F.lit(0)).cast("long")
                      .alias(f"duplicate_{id_col}"))


@dataclass(frozen=True)
class Expectations:
    """Q4/Q5 rule set for one frame."""
    columns: Sequence[str] = ()
    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    regex: dict[str, str] = field(default_factory=dict)
    in_set: dict[str, Sequence[str]] = field(default_factory=dict)


CLAIMS_EXPECTATIONS = Expectations(
    columns=R.CLAIMS_COLUMNS, not_null=("CLAIM_ID", "AMOUNT"), unique=("CLAIM_ID",),
    regex={"CLAIM_ID": R.CLAIM_ID_PATTERN})

TRANSACTIONS_EXPECTATIONS = Expectations(
    columns=R.TRANSACTIONS_COLUMNS, not_null=("NSE_ID",), unique=("NSE_ID",),
    in_set={"TRANSACTION_TYPE": list(R.TRANSACTION_TYPE_MAPPING.values()) + [R.TRANSACTION_TYPE_DEFAULT],
            "TRANSACTION_DIRECTION": list(R.TRANSACTION_DIRECTION_MAPPING.values()),
            "TRANSACTION_CATEGORY": [R.CATEGORY_POSITIVE, R.CATEGORY_NEGATIVE]})


def missing_columns(df: DataFrame, exp: Expectations) -> list[str]:
    """Q4: driver-side schema check (no job)."""
    return [c for c in exp.columns if c not in df.columns]


def expectations_report(df: DataFrame, exp: Expectations) -> DataFrame:
    """Q5 as one row of unexpected counts (NULLs are skipped by regex / in-set checks,
    as the expectation library does)."""
    checks: dict[str, Column] = {"row_count": F.count(F.lit(1))}
    for c in exp.not_null:
        checks[f"not_null_{c}"] = F.count_if(F.col(c).isNull())
    for c, pattern in exp.regex.items():
        checks[f"regex_{c}"] = F.count_if(F.col(c).isNotNull() & ~F.col(c).cast("string").rlike(pattern))
    for c, values in exp.in_set.items():
        checks[f"in_set_{c}"] = F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(list(values)))
    aggs = [e.alias(n) for n, e in checks.items()]
    names = list(checks)
    if not exp.unique:
        return df.agg(*aggs)
    # Two-level aggregate: per id value (map-side combined, so a hot id is one
    # partial row per partition), then sum. Rows whose non-null id repeats are
    # the "unexpected" rows of the uniqueness rule.
    first = exp.unique[0]
    per_id = df.groupBy(first).agg(*aggs)
    report = per_id.agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(n) for n in names],
                        F.coalesce(F.sum(F.when(F.col(first).isNotNull() & (F.col("row_count") > 1),
                                                F.col("row_count"))), F.lit(0))
                        .cast("long").alias(f"unique_{first}"))
    for c in exp.unique[1:]:
        dup = (df.groupBy(c).count()
               .agg(F.coalesce(F.sum(F.when(F.col(c).isNotNull() & (F.col("count") > 1),
                                            F.col("count"))), F.lit(0))
                    .cast("long").alias(f"unique_{c}")))
        # both sides are exactly one row: equi-join on a constant key
        report = (report.withColumn("_k", F.lit(1))
                  .join(dup.withColumn("_k", F.lit(1)), "_k").drop("_k"))
    return report


def assert_expectations(report: DataFrame, stage: str) -> None:
    """Q6: stop before the write if any count column of the one-row report is non-zero."""
    row = report.first().asDict()
    errors = [f"{k}={v} at {stage}" for k, v in row.items()
              if k != "row_count" and v not in (0, None)]
    if errors:
        raise RuntimeError("Data quality validation failed: " + "; ".join(errors))


def reject_reasons(checks: dict[str, Column]) -> Column:
    """Array of the names of failed checks (empty when the row is clean)."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in checks.items()]))


def split_rejects(df: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(clean rows, rejected rows with a ``reasons`` array).

    The reasons come out of a generator of one element: an expression would be
    copied into the filter and the projection, and every check run twice.
    """
    tagged = df.select("*", F.explode(F.array(reject_reasons(checks))).alias("reasons"))
    return (tagged.where(F.size("reasons") == 0).drop("reasons"),
            tagged.where(F.size("reasons") > 0))


def claims_checks(date_format: str, timestamp_format: str,
                  type_mapping=R.TRANSACTION_TYPE_MAPPING) -> dict[str, Column]:
    """Row rules of the claims input: id shape, lenient parses that failed although
    text was present, and claim types the rule table does not map (they would
    silently become the default label). Id numbers beyond an int would become NULL."""
    def bad(text: str, parsed: Column) -> Column:
        return F.col(text).isNotNull() & parsed.isNull()
    return {
        "claim_id_null": F.col("CLAIM_ID").isNull(),
        "claim_id_format": F.col("CLAIM_ID").isNotNull() & ~F.col("CLAIM_ID").rlike(R.CLAIM_ID_PATTERN),
        "claim_id_number_range": F.coalesce(int_overflow("CLAIM_ID"), F.lit(False)),
        "amount_null": F.col("AMOUNT").isNull(),
        "amount_not_decimal": bad("AMOUNT", F.col("AMOUNT").try_cast("decimal(16,5)")),
        "date_of_loss_pattern": bad("DATE_OF_LOSS", F.try_to_date(F.col("DATE_OF_LOSS"), date_format)),
        "creation_date_pattern": bad("CREATION_DATE",
                                     F.try_to_timestamp(F.col("CREATION_DATE"), F.lit(timestamp_format))),
        "claim_type_unmapped": F.col("CLAIM_TYPE").isNull() | ~F.col("CLAIM_TYPE").isin(list(type_mapping)),
    }
