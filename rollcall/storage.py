"""Where intermediate tables live."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="rollcall-")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; a local one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder()


#: Names of the tables that ``land_dealt`` has made, and where they lie.
_DEALT: dict[str, str] = {}
_JOB: ContextVar[str | None] = ContextVar("job", default=None)


@contextmanager
def job(spark: SparkSession) -> Iterator[None]:
    """Within it, landed tables share one folder, which goes at the end: for a job that has written all it makes by then."""
    if _JOB.get() is not None:
        yield
        return
    folder = f"{shared_folder(spark)}/rollcall/{uuid.uuid4().hex}"
    token = _JOB.set(folder)
    try:
        yield
    finally:
        _JOB.reset(token)
        for name in [n for n, path in _DEALT.items() if path.startswith(f"{folder}/")]:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            del _DEALT[name]
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Rows in a file where a caller knows about how many rows there are.
FILE_ROWS = 100_000


def land(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several branches read one costly result: the work is done once, a lost executor
    does not redo it, later branches read only their columns, and Spark knows the real size.
    A caller that knows about how many ``rows`` there are spares the folder many small files; rows that are much
    larger than a few hundred bytes count as several.
    """
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // FILE_ROWS)))
    path = _place(df.sparkSession, uuid.uuid4().hex, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _place(spark: SparkSession, own: str, name: str) -> str:
    return f"{_JOB.get()}/{own}/{name}" if _JOB.get() else f"{shared_folder(spark)}/rollcall/{own}/{name}"


def land_dealt(df: DataFrame, name: str, keys: list[str], parts: int) -> DataFrame:
    """``land``, with the rows dealt to ``parts`` buckets by ``keys``.

    Spark knows of the buckets, so joins and groups by these keys move only the other side. A frame that is dealt this way
    already, such as such a join, is not moved again.
    """
    spark, own = df.sparkSession, uuid.uuid4().hex
    path, table = _place(spark, own, name), f"rollcall_{name}_{own}"
    df.repartition(parts, *keys).write.bucketBy(parts, *keys).option("path", path).saveAsTable(table, format="parquet")
    _DEALT[table] = path
    return spark.table(table)
