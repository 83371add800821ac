"""Files that loads have seen, and meetings they have loaded (K2, J8), kept in buckets.

A load looks up the files of a folder by where they lie and how they look from outside (path, length, time of change),
and only those that are not known that way are read. Of these it looks up the hash of their content, and of their
meetings the key. Each look-up reads those buckets of the table that the incoming keys fall into, and
writes only the buckets that get new rows. How much it reads and writes thus follows what comes in, not
what has come in since the first load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall import schemas
from rollcall.operators.loads import Store
from rollcall.sources.files import binary_files

_SOURCES = schemas.SOURCES


def listing(spark: SparkSession, directory: str | list[str], glob: str) -> DataFrame:
    """path, location (the path as it is named), length and modified of the files of a folder, without their content; empty files are not listed."""
    return binary_files(spark, directory, glob).select(
        F.col("_metadata.file_path").alias("path"), F.col("path").alias("location"), "length", F.col("modificationTime").alias("modified")
    )


def look_up(store: Store, table: str, key: str, incoming: DataFrame) -> DataFrame:
    """The rows of an index table in the buckets that the keys of ``incoming`` fall into."""
    return store.version(table, _SOURCES[table], buckets=store.touched(incoming, key))


def unchanged_files(store: Store, files: DataFrame) -> DataFrame:
    """Files of a listing that are known by path, length and time, with the hash of their content."""
    return files.join(look_up(store, "known_file", "path", files), ["path", "length", "modified"])


def loaded_meetings(store: Store, files: DataFrame, sessions: DataFrame | None = None) -> DataFrame:
    """source_file_hash and session_source_key of all loaded meetings that share a hash with ``files`` or a key with ``sessions``."""
    found = look_up(store, "known_hash", "source_file_hash", files)
    if sessions is not None:
        found = found.unionByName(look_up(store, "known_session", "session_source_key", sessions)).distinct()
    return found


def remember(store: Store, batch_id: int, table: str, key: str, fresh: DataFrame) -> None:
    """Add rows to an index table: the buckets they fall into are written anew, others are left alone.

    Of rows with one key in ``fresh`` and in the table those of ``fresh`` stay.
    """
    buckets = store.touched(fresh, key)
    if not buckets:
        return
    names = _SOURCES[table].names
    before = store.version(table, _SOURCES[table], buckets=buckets).join(fresh.select(key), key, "left_anti")
    store.write_buckets(table, before.select(*names).unionByName(fresh.select(*names)), batch_id, key, buckets)
