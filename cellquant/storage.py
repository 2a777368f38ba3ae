"""Written intermediate tables: a plan that is read more than once is stored, so that it is computed once and survives lost
executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


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


#: tables that the innermost ``scratch`` deletes when it ends
_SCRATCH: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


#: whether what a finished write has shuffled is deleted; else it stays until the driver's memory is collected
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def clean_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffled files when it has ended."""
    kept = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEAN, kept) if kept is not None else spark.conf.unset(_CLEAN)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back. It stays, unless a ``scratch`` is open."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    with clean_shuffles(df.sparkSession):
        df.write.parquet(path)
    if (held := _SCRATCH.get()) is not None:
        held.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that are stored inside are deleted at its end, when what was made of them has been written."""
    held: list[str] = []
    token = _SCRATCH.set(held)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        for path in held:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def in_slices(spark: SparkSession, n: int, make: Callable[[int], DataFrame], name: str) -> DataFrame:
    """The rows of ``make(0)`` to ``make(n - 1)``: each is written before the next is made, and what it stored and shuffled on the
    way is deleted then, so the disk holds the results and the work of one slice. One slice alone is not written."""
    if n == 1:
        return make(0)
    path, schema = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", None
    for k in range(n):
        with scratch(spark), clean_shuffles(spark):
            rows = make(k)
            rows.write.parquet(f"{path}/slice={k}")
            schema = rows.schema
    if (held := _SCRATCH.get()) is not None:
        held.append(path)
    return spark.read.schema(schema).parquet(*(f"{path}/slice={k}" for k in range(n)))
