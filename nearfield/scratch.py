"""Scratch folders that every executor can reach."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Folders made by this program and not removed yet.
_MADE: list[str] = []

#: Those made by what runs now in ``stored_alone``.
_INNER: ContextVar[list[str] | None] = ContextVar("_INNER", default=None)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the session's ``spark.checkpoint.dir``, else under its warehouse.

    Both should be shared by all executors of a cluster. The warehouse is the driver's own folder unless it is
    set, so on a cluster set one of them.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _MADE.append(path)
    if (inner := _INNER.get()) is not None:
        inner.append(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to a scratch table and read back: later steps don't repeat its lineage."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_alone(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """``stored(make(), name)``, after which the scratch tables that ``make`` has written on the way go."""
    token = _INNER.set(inner := [])
    try:
        df = make()
    finally:
        _INNER.reset(token)
    out = stored(df, name)
    _remove(df.sparkSession, inner)
    return out


def _remove(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        _MADE.remove(path)


def clean(spark: SparkSession) -> int:
    """Removes the scratch folders made so far, and returns how many. Results that are read from them lazily
    must have been written or collected before."""
    _remove(spark, made := _MADE[:])
    return len(made)
