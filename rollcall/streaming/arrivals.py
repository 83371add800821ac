"""The repeat-safe folder load, driven by the arrival of files.

The stream only notices new files; the load of a micro-batch is the batch job. Should a micro-batch
run twice, its files are known by their content hash the second time and are skipped.

Which files a micro-batch has is taken from the log that the source keeps in the checkpoint, and not from its rows:
a scan gives no row for a file of zero bytes, and such a file has to be reported too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from rollcall.operators.loads import Store
from rollcall.plans.batch import load_folder
from rollcall.sources.files import plain_name

_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def _log_offset(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """Up to which entry of the source's log a micro-batch goes; -1 before the first."""
    if batch_id < 0:
        return -1
    offsets = spark.read.text(f"{checkpoint}/offsets/{batch_id}").select(F.from_json("value", "logOffset bigint")["logOffset"].alias("offset"))
    return offsets.where("offset IS NOT NULL").first()["offset"]


def arrived(spark: SparkSession, checkpoint: str, batch_id: int) -> DataFrame:
    """``path`` of every file of a micro-batch, empty ones included. Only the entries of that batch are read."""
    checkpoint = checkpoint.rstrip("/")
    first, last = _log_offset(spark, checkpoint, batch_id - 1) + 1, _log_offset(spark, checkpoint, batch_id)
    # Every so often the source writes an entry together with all earlier ones.
    names = "{" + ",".join(f"{k},{k}.compact" for k in range(first, last + 1)) + "}"
    entries = spark.read.option("pathGlobFilter", names).text(f"{checkpoint}/sources/0").select(
        F.from_json("value", "path string, batchId bigint").alias("e")
    )
    own = entries.where(F.col("e.path").isNotNull() & F.col("e.batchId").between(first, last))
    return own.select(F.regexp_replace(plain_name("e.path"), "^file:/+", "file:/").alias("path")).distinct()


def load_arrivals(
    spark: SparkSession, directory: str, store: Store, checkpoint: str, glob: str = "Meeting*.csv", files_per_batch: int = 1000
) -> StreamingQuery:
    """Load all files that have arrived since the last call, then stop."""
    arrivals = (
        spark.readStream.format("binaryFile").schema(_FILE).option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_batch).load(directory).select("path", "length")
    )

    def load(_: DataFrame, batch_id: int) -> None:
        # At most files_per_batch paths; the files themselves are read by the executors.
        paths = [row.path for row in arrived(spark, checkpoint, batch_id).collect()]
        if paths:
            load_folder(spark, paths, store)

    return (
        arrivals.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
