"""Helpers that the operators share: ASCII lower-casing, written intermediate tables, scratch folders."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_OWN: dict[str, str] = {}
#: tables written so far, in order
_WRITTEN: list[str] = []


def ascii_lower(c: Column | str) -> Column:
    """Lower-case A-Z and nothing else (``lower`` would also change other letters)."""
    return F.translate(F.col(c) if isinstance(c, str) else c, UPPER, LOWER)


def ascii_words(text: str | None) -> list[bytes]:
    """UTF-8 words between blanks (space, tab to carriage return), A-Z lower-cased; bytes' own methods know ASCII only."""
    return text.encode().lower().split() if text else []


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    return next(n for n in (name, *(f"{name}_{i}" for i in range(len(taken) + 1))) if n.lower() not in taken)


def with_fields(rows: DataFrame, more: str) -> StructType:
    """The schema of ``rows``, whatever its names, and ``more`` fields."""
    return StructType([*rows.schema.fields, *StructType.fromDDL(more).fields])


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``). Only a local session, as in tests, may leave it unset and gets a
    folder of its own; elsewhere executors would write to disks that the others cannot read, so that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master, app = spark.sparkContext.master, spark.sparkContext.applicationId
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if app not in _OWN:
            _OWN[app] = f"file://{tempfile.mkdtemp(prefix='cellquant-')}"
        found = _OWN[app]
    return found.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: its lineage ends there and survives
    lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """``materialize`` what ``make`` returns, then delete the tables that were written on the way to it."""
    before = len(_WRITTEN)
    out = materialize(make(), name)
    spark = out.sparkSession
    for path in _WRITTEN[before:-1]:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    del _WRITTEN[before:-1]
    return out


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
