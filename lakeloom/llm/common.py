"""Shared folder, staged tables and small helpers of the operators."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from lakeloom.session import checkpoint_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder below the session's ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read from there.

    It cuts lineage: a lost executor costs its tasks, not what came before. The
    folder belongs to the session's checkpoint folder and goes with it.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def per_process(name: str, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, made once a Python worker; tasks bring their own copies of this subpackage's globals."""
    kept = sys.__dict__.setdefault("_lakeloom_kept", {})
    if name not in kept:
        kept[name] = make()
    return kept[name]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
