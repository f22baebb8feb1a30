"""Declared schemas (no inference on the hot path)."""

from __future__ import annotations

from pyspark.sql import types as T

from lakeloom import rules as R

_OBS_TYPES = {"year": T.IntegerType(), "obs_value": T.DoubleType(), "fetch_ts": T.TimestampType()}

CANONICAL_SCHEMA = T.StructType([
    T.StructField(c, _OBS_TYPES.get(c, T.StringType()), True) for c in R.CANONICAL_COLUMNS])

CLAIMS_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in R.CLAIMS_COLUMNS])
CONTRACTS_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in R.CONTRACTS_COLUMNS])
MIGRATION_FILE_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True)
                                      for c in R.MIGRATION_FILE_COLUMNS])

TRANSACTIONS_SCHEMA = T.StructType([
    T.StructField("CONTRACT_SOURCE_SYSTEM", T.StringType()),
    T.StructField("CONTRACT_SOURCE_SYSTEM_ID", T.LongType()),
    T.StructField("SOURCE_SYSTEM_ID", T.IntegerType()),
    T.StructField("TRANSACTION_TYPE", T.StringType()),
    T.StructField("TRANSACTION_DIRECTION", T.StringType()),
    T.StructField("CONFORMED_VALUE", T.DecimalType(16, 5)),
    T.StructField("BUSINESS_DATE", T.DateType()),
    T.StructField("CREATION_DATE", T.TimestampType()),
    T.StructField("SYSTEM_TIMESTAMP", T.TimestampType()),
    T.StructField("NSE_ID", T.StringType()),
    T.StructField("TRANSACTION_CATEGORY", T.StringType()),
])
