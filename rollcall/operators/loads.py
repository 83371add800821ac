"""Raw load of parsed meetings (K1, K2) and the store that versions of tables are written to."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cache, cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import ArrayType, LongType, MapType, Row, StringType, StructField, StructType

from rollcall.operators import audit
from rollcall.operators.ranking import number_by_hash
from rollcall.operators.upsert import new_files
from rollcall.sources.perfile import join_file_facts
from rollcall.sources.meetings import ACTIVITY_FIELDS, PARTICIPANT_FIELDS, SUMMARY_FIELDS, Meetings
from rollcall.storage import land

PIPELINE = "TRAINING_ATTENDANCE"


@dataclass
class RawBatch:
    """The rows one batch of files adds. All but the sessions are made when they are asked for."""

    sessions: DataFrame
    list_errors: Callable[[], DataFrame]
    list_run_events: Callable[[], DataFrame]
    number_participants: Callable[[], DataFrame]
    number_activities: Callable[[], DataFrame]

    @cached_property
    def errors(self) -> DataFrame:
        return self.list_errors()

    @cached_property
    def run_events(self) -> DataFrame:
        return self.list_run_events()

    @cached_property
    def participants(self) -> DataFrame:
        return self.number_participants()

    @cached_property
    def activities(self) -> DataFrame:
        return self.number_activities()


@dataclass(frozen=True)
class Highest:
    """The highest keys in use, as columns or numbers."""

    run_id: Column | int = 0
    session: Column | int = 0
    participant: Column | int = 0
    activity: Column | int = 0


def raw_batch(meetings: Meetings, loaded: DataFrame, highest: Highest = Highest()) -> RawBatch:
    """Raw rows of all files that are new, with keys, plus one run per file.

    ``loaded`` holds source_file_hash and session_source_key of the sessions loaded so far. A file
    with a known hash is skipped: its run is a SUCCESS with no rows. A new file with a known
    meeting fails as a duplicate session; so does any file that could not be parsed. The other
    files of the batch go on.
    """
    runs = land(number_by_hash(meetings.files.select("path", "file_name"), ["path"], "run_id", highest.run_id, costly=True), "runs")
    fresh = new_files(meetings.sessions, loaded)
    first = fresh.groupBy("session_source_key").agg(F.min("path").alias("path"))
    accepted_keys = first.join(loaded.select("session_source_key"), "session_source_key", "left_anti")
    accepted = fresh.join(accepted_keys, ["session_source_key", "path"], "left_semi")
    duplicates = fresh.join(accepted_keys, ["session_source_key", "path"], "left_anti").select(
        "path", F.lit(None).cast("bigint").alias("source_row_number"), F.lit("DUPLICATE_SESSION").alias("error_code"),
        F.lit("The meeting is already loaded from another file.").alias("error_message"),
        F.col("source_file_name").alias("raw_record"),
    )
    numbered = number_by_hash(accepted, ["session_source_key"], "session_raw_id", highest.session, costly=True)
    sessions = numbered.join(runs.select("path", "run_id"), "path")

    @cache
    def owner() -> DataFrame:
        return land(sessions.select("path", "session_raw_id", "run_id", "dataset_name", "source_file_name").join(meetings.extents, "path"), "owners")

    def children(rows: DataFrame, key: str, fields: tuple[str, ...], start) -> DataFrame:
        owned = join_file_facts(rows, owner(), ["path"], "source_row_number", "last_row")
        return number_by_hash(owned, ["session_raw_id", "source_row_number"], key, start).select(
            key, "session_raw_id", "run_id", "dataset_name", "source_file_name", "source_row_number", *fields, "raw_record",
        )

    @cache
    def reported() -> DataFrame:
        # Row rejects of files that are skipped as known were logged when the file was loaded.
        skipped = meetings.sessions.select("path").join(fresh.select("path"), "path", "left_anti")
        return meetings.rejects.unionByName(duplicates).join(skipped, "path", "left_anti").join(runs, "path")

    def errors() -> DataFrame:
        return audit.error_rows(
            reported(), pipeline=PIPELINE, source="file_name", code=F.col("error_code"), message=F.col("error_message"),
            row_number="source_row_number", raw_record="raw_record",
        )

    def run_events() -> DataFrame:
        opened = runs.select("path", "run_id", F.lit(PIPELINE).alias("pipeline_name"), F.col("file_name").alias("source_name"))
        whole = F.col("source_row_number").isNull()
        per_file = reported().groupBy("path").agg(
            F.max(F.when(whole, F.col("error_message"))).alias("failure"), F.count_if(~whole).alias("rejected")
        )
        counts = audit.run_counts(
            sessions.select("path"),
            meetings.participants.select("path"), meetings.activities.select("path"), "path",
        )
        closed = opened.join(per_file, "path", "left").join(counts, "path", "left")
        zero = F.lit(0)
        succeeded = audit.finish_success(
            closed.where(F.col("failure").isNull()), F.coalesce("rows_read", zero), F.coalesce("rows_loaded", zero),
            F.coalesce("rejected", zero),
        )
        failed = audit.finish_failed(closed.where(F.col("failure").isNotNull()), F.col("failure"))
        return audit.start_runs(opened).unionByName(succeeded).unionByName(failed)

    session_rows = sessions.select(
        "session_raw_id", "session_source_key", "run_id", "dataset_name", "source_file_name", "source_file_hash", *SUMMARY_FIELDS
    )
    return RawBatch(
        session_rows, errors, run_events,
        lambda: children(meetings.participants, "participant_raw_id", PARTICIPANT_FIELDS, highest.participant),
        lambda: children(meetings.activities, "activity_raw_id", ACTIVITY_FIELDS, highest.activity),
    )


#: Hex digits of a bucket: 256 buckets of each table that is kept in buckets.
DIGITS = 2


def bucket_of(key, digits: int = DIGITS) -> Column:
    """The bucket of a key, the first hex digits of its hash; null is a key too."""
    return F.substring(F.sha2(F.coalesce(F.col(key).cast("string"), F.lit("\u0002")), 256), 1, digits)


class Store:
    """Tables in a shared folder, written batch by batch.

    The rows a batch adds to a table are one folder per part, and writing the part again replaces it. A
    dimension is written to a new version, and the one it was built from is not touched. Either the version is the
    whole table, or, for a table kept in buckets by its key, only those buckets that the batch changes; the
    table then is each bucket's latest version, and buckets nobody touched are not written or read.
    A batch counts from the moment ``commit`` has written its row, which is the last step. The row
    names the version of every dimension, or of every bucket, as of the batch, so a batch that leaves a dimension alone
    keeps the one before, and the highest keys in use, so a load does not look through all rows for
    them. Readers stop at the last committed batch. So several tables change together, and a job
    that dies half way leaves nothing behind that is read: the next run has the same number and
    overwrites it. A committed batch is not written again. There is one writer at a time.

    What an open batch has written is noted in the folder itself, with the highest keys that its writes have observed,
    so that any ``Store`` on the folder can commit it. From ``begin`` to ``commit`` a store works from the commit row
    that it began with, and does not look it up again. The number of buckets, 16 to the power of ``digits``, is fixed by
    the first commit.
    """

    _COMMIT = StructType([
        StructField("batch_id", LongType()), StructField("versions", MapType(StringType(), LongType())),
        StructField("highest", MapType(StringType(), LongType())),
    ])
    _NOTE = StructType([
        StructField("at", LongType()), StructField("name", StringType()), StructField("buckets", ArrayType(StringType())),
        StructField("highest", MapType(StringType(), LongType())),
    ])

    def __init__(self, spark: SparkSession, folder: str, digits: int = DIGITS):
        self.spark, self.folder, self._digits = spark, folder.rstrip("/"), digits
        self._base: Row | None = None
        self._own_notes: dict[int, list[Row]] = {}

    def _read(self, path: str, schema: StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], schema)

    def _last(self) -> Row:
        """The last commit row; batch 0 before the first. While a batch of this store is open, the one it began with."""
        if self._base is not None:
            return self._base
        commits = self._read(f"{self.folder}/_commits.parquet", self._COMMIT)
        last = commits.agg(F.max_by(F.struct("batch_id", "versions", "highest"), "batch_id").alias("c")).first()["c"]
        return last or Row(batch_id=0, versions={}, highest={})

    def last_batch(self) -> int:
        """The number of the last committed batch, 0 before the first."""
        return self._last()["batch_id"]

    def highest(self, key: str) -> int:
        """The highest value of a surrogate key as of the last committed batch, 0 before the first."""
        return self._last()["highest"].get(key, 0)

    @property
    def digits(self) -> int:
        """Hex digits of a bucket."""
        return self._last()["highest"].get("_digits", self._digits)

    def bucket(self, key: str) -> Column:
        return bucket_of(key, self.digits)

    def touched(self, rows: DataFrame, key: str) -> list[str]:
        """The buckets that the keys of ``rows`` fall into; there are 16 to the power of ``digits`` at most."""
        return sorted(row[0] for row in rows.select(self.bucket(key).alias("b")).distinct().collect())

    def begin(self) -> int:
        """The number of the next batch. Notes that an earlier try at it has left are dropped."""
        self._base = None
        base = self._last()
        number = base["batch_id"] + 1
        self.spark.createDataFrame([], self._NOTE).write.mode("overwrite").parquet(self._notes(number))
        self._base, self._own_notes = base, {number: []}
        return number

    def _notes(self, batch_id: int) -> str:
        return f"{self.folder}/_notes/batch_id={batch_id}"

    def _note(self, batch_id: int, name: str, buckets: list[str] | None, highest: dict[str, int]) -> None:
        note = Row(at=time.time_ns(), name=name, buckets=buckets, highest=highest)
        self.spark.createDataFrame([tuple(note)], self._NOTE).coalesce(1).write.mode("append").parquet(self._notes(batch_id))
        if batch_id in self._own_notes:
            self._own_notes[batch_id].append(note)

    def _noted(self, batch_id: int) -> tuple[dict[str, int], dict[str, int]]:
        """Versions and highest keys that an open batch has written; of a table written twice the last."""
        notes = self._own_notes.get(batch_id)
        notes = self._read(self._notes(batch_id), self._NOTE).collect() if notes is None else notes
        latest = {row["name"]: row for row in sorted(notes, key=lambda row: row["at"])}
        versions, highest = {}, {}
        for name, row in latest.items():
            if not row["highest"]:
                versions |= {name: batch_id} if row["buckets"] is None else {f"{name}/{b}": batch_id for b in row["buckets"]}
            for key, value in (row["highest"] or {}).items():
                highest[key] = max(value, highest.get(key, 0))
        return versions, highest

    def noted(self, batch_id: int) -> dict[str, int]:
        """The highest keys that the writes of an open batch have observed so far."""
        return self._noted(batch_id)[1]

    def commit(self, batch_id: int, highest: dict[str, int] | None = None) -> None:
        """Make a batch count. Keys that its writes did not observe are given as ``highest``."""
        self._base = None
        last = self._open(batch_id)
        versions, observed = self._noted(batch_id)
        keys = {"_digits": self._digits, **last["highest"]}
        for key, value in [*observed.items(), *(highest or {}).items()]:
            keys[key] = max(value, keys.get(key, 0))
        row = self.spark.createDataFrame([(batch_id, {**last["versions"], **versions}, keys)], self._COMMIT)
        row.coalesce(1).write.mode("append").parquet(f"{self.folder}/_commits.parquet")
        self._own_notes = {}

    def _open(self, batch_id: int) -> Row:
        """The last commit row, if ``batch_id`` comes after it."""
        last = self._last()
        if batch_id <= last["batch_id"]:
            raise ValueError(f"batch {batch_id} is committed")
        return last

    def write_batch(
        self, table: str, rows: DataFrame, batch_id: int, part: str = "all", highest: Sequence[str] = (), by: str | None = None
    ) -> dict[str, int]:
        """K1, K3-K5: the rows one part of a batch adds, in place of any an earlier try has left; in folders by the column ``by``, if given.

        Gives the number of rows and the highest values of the surrogate keys ``highest`` among them, observed
        while they are written; the latter are noted for the commit.
        """
        self._open(batch_id)
        seen = Observation()
        rows = rows if by is None else rows.repartition(by)
        watched = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *(F.max(key).alias(key) for key in highest))
        writer = watched.write.mode("overwrite")
        (writer if by is None else writer.partitionBy(by)).parquet(f"{self.folder}/{table}/batch_id={batch_id}/part={part}")
        found = {key: value for key, value in seen.get.items() if value is not None}
        if highest:
            self._note(batch_id, f"{table}:{part}", None, {key: found.get(key, 0) for key in highest})
        return found

    def rows(self, table: str, schema: StructType, batch_id: int | None = None, part: str | None = None, not_part: str | None = None) -> DataFrame:
        """Rows of all committed batches, or of one batch even if it is not committed yet; of all parts, one, or all but one."""
        folders = [StructField("batch_id", LongType()), StructField("part", StringType())]
        found = self._read(f"{self.folder}/{table}", StructType([*schema.fields, *folders]))
        chosen = F.col("batch_id") <= self.last_batch() if batch_id is None else F.col("batch_id") == batch_id
        if part is not None:
            chosen = chosen & (F.col("part") == part)
        if not_part is not None:
            chosen = chosen & (F.col("part") != not_part)
        return found.where(chosen).drop("batch_id", "part")

    def write_version(self, table: str, rows: DataFrame, batch_id: int) -> None:
        """K6, K7: the whole table as of a batch."""
        self._open(batch_id)
        rows.write.mode("overwrite").parquet(f"{self.folder}/{table}/version={batch_id}")
        self._note(batch_id, table, None, {})

    def write_buckets(self, table: str, rows: DataFrame, batch_id: int, key: str, buckets: list[str], highest: Sequence[str] = ()) -> dict[str, int]:
        """The named buckets of a table kept by ``key``, as of a batch; ``rows`` are all their rows, and no others.

        The rows of a bucket are written by one task each. Gives what ``write_batch`` gives.
        """
        self._open(batch_id)
        if not buckets:
            return {"rows": 0}
        seen = Observation()
        placed = rows.withColumn("bucket", self.bucket(key)).repartition(len(buckets), "bucket")
        watched = placed.observe(seen, F.count(F.lit(1)).alias("rows"), *(F.max(k).alias(k) for k in highest))
        watched.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/{table}/version={batch_id}")
        found = {k: value for k, value in seen.get.items() if value is not None}
        self._note(batch_id, table, buckets, {})
        if highest:
            self._note(batch_id, f"{table}:keys", None, {k: found.get(k, 0) for k in highest})
        return found

    def version(self, table: str, schema: StructType, batch_id: int | None = None, buckets: list[str] | None = None) -> DataFrame:
        """The table as of the last committed batch, or as an open batch sees it; of a table in buckets only ``buckets``, if given.

        Empty before the first version; a version that a commit names and that is gone is an error.
        """
        versions = dict(self._last()["versions"])
        if batch_id is not None:
            versions |= self._noted(batch_id)[0]
        paths = [f"{self.folder}/{table}/version={versions[table]}"] if table in versions else [
            f"{self.folder}/{table}/version={number}/bucket={bucket}"
            for name, _, bucket, number in ((*name.partition("/"), number) for name, number in sorted(versions.items()))
            if name == table and bucket and (buckets is None or bucket in buckets)
        ]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)


def replace_partitions(fresh: DataFrame, path: str, column: str) -> None:
    """K3 where the rows lie: of a table in folders by ``column`` the folders in ``fresh`` are written anew, the others stay as they are.

    The folders of each value are dealt to several tasks by the rows' own hash, so that a large one is no single task.
    """
    dealt = fresh.withColumn("_deal", F.pmod(F.xxhash64(*fresh.columns), F.lit(8)))
    dealt = dealt.repartition(F.col(column), F.col("_deal")).drop("_deal")
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """K8: a delimited file set with a header; quotes are doubled, as spreadsheet tools expect."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True).csv(path)
