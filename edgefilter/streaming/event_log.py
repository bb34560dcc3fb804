"""A replayable event source over files, with a start time.

Events lie as Parquet in folders by hour (``hour=2024-01-03-05``), so the folders
are a time index: a stream that starts at a time reads only the folders of that
hour and later, and of the first only the events from that time on. Files are
never changed once written; an epoch is the list of files that Spark's file source
notes in the stream's checkpoint before it reads them, so an epoch that is run
again, or read back by :func:`replay_epoch`, has the same rows. Any store that
Spark reads will do, and nothing listens on a port.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOUR = "hour"
_HOUR_FORMAT = "yyyy-MM-dd-HH"


def append_events(events: DataFrame, path: str, time_col: str = "ts", files_per_hour: int = 1) -> None:
    """Add events to the log, ``files_per_hour`` files for an hour; those without a time go to no hour and are left out.

    An hour's events are dealt to its files by a hash, so a busy hour is several tasks.
    """
    timed = events.where(F.col(time_col).isNotNull()).withColumn(HOUR, F.date_format(time_col, _HOUR_FORMAT))
    part = F.pmod(F.xxhash64(*events.columns), F.lit(files_per_hour))
    timed.withColumn("_part", part).repartition(HOUR, "_part").drop("_part").write.mode("append").partitionBy(HOUR).parquet(path)


def event_source(spark: SparkSession, path: str, schema: T.StructType, since: str | None = None, time_col: str = "ts",
                 files_per_epoch: int = 1000) -> DataFrame:
    """The stream of events from ``since`` (``yyyy-MM-dd HH:mm:ss``) on, or of all; the log may still grow.

    ``schema`` is that of the events. Epochs take at most ``files_per_epoch`` files, oldest first.
    """
    whole = T.StructType([*schema.fields, T.StructField(HOUR, T.StringType())])
    events = spark.readStream.schema(whole).option("maxFilesPerTrigger", files_per_epoch).parquet(path)
    if since is not None:
        start = F.lit(since).cast("timestamp_ntz")
        # the folder filter prunes; the time filter cuts the first hour
        events = events.where((F.col(HOUR) >= F.lit(since[:13].replace(" ", "-"))) & (F.col(time_col).cast("timestamp_ntz") >= start))
    return events.drop(HOUR)


def epoch_files(spark: SparkSession, checkpoint: str, epoch: int) -> list[str]:
    """The files that a stream's epoch took, from the source's log in its checkpoint (compacted or not)."""
    lines = spark.read.text(f"{checkpoint}/sources/0").where(F.col("value").startswith("{"))
    taken = lines.select(F.from_json("value", "path string, batchId long").alias("e")).select("e.*").where(
        F.col("batchId") == epoch).select("path").distinct().orderBy("path")
    return [unquote(r.path) for r in taken.collect()]        # at most files_per_epoch


def replay_epoch(spark: SparkSession, path: str, schema: T.StructType, checkpoint: str, epoch: int, since: str | None = None,
                 time_col: str = "ts") -> DataFrame:
    """The rows of one epoch of a stream of :func:`event_source`, as a batch."""
    files = epoch_files(spark, checkpoint, epoch)
    if not files:
        return spark.createDataFrame([], schema)
    events = spark.read.schema(schema).option("basePath", path).parquet(*files)
    if since is not None:
        events = events.where(F.col(time_col).cast("timestamp_ntz") >= F.lit(since).cast("timestamp_ntz"))
    return events.select(*schema.names)
