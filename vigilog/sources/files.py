"""Event files and statistics snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from vigilog import schema as S
from vigilog.operators import parsing, stats
from vigilog.sinks import snapshots

_SCAN = T.StructType(S.WIRE_EVENT.fields + [T.StructField(parsing.CORRUPT, T.StringType())])


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def scan_events(spark: SparkSession, path: str, array_file: bool = False) -> DataFrame:
    """Events of JSON files, one per line or (``array_file``) one array per file.

    A missing path gives no rows. Unreadable input stays as a row with its
    text in ``_corrupt``. A file with an array is read by one task, so large
    logs belong in line files.
    """
    try:
        return (spark.read.schema(_SCAN).option("multiLine", array_file)
                .option("columnNameOfCorruptRecord", parsing.CORRUPT).json(path))
    except AnalysisException as error:
        if not _missing(error):
            raise
        return spark.createDataFrame([], _SCAN)


def quarantine(scanned: DataFrame, path: str) -> None:
    """Append the unreadable input of a scan to a side table, with the id where it could be read."""
    # Spark refuses to scan for the corrupt text alone; the id is the second column.
    bad = scanned.filter(F.col(parsing.CORRUPT).isNotNull()).select(F.col(parsing.CORRUPT).alias("raw"), "event_id")
    bad.withColumn("found_at", F.current_timestamp()).write.mode("append").parquet(path)


def load_stats(spark: SparkSession, path: str) -> DataFrame:
    """Latest committed statistics; none yet gives the empty table."""
    latest = snapshots.latest_version(spark, path)
    if latest is None:
        return stats.empty_stats(spark)
    return spark.read.schema(S.STATS).parquet(latest)


def load_stats_document(spark: SparkSession, path: str, backup: str | None = None) -> DataFrame:
    """Statistics from a JSON document, or from the latest of a folder of versions.

    Missing gives the empty table. What is no JSON object counts nothing and,
    with ``backup``, is appended there as it was found, with the time.
    """
    try:
        text = spark.read.option("wholetext", True).text(snapshots.latest_version(spark, path) or path)
    except AnalysisException as error:
        if not _missing(error):
            raise
        return stats.empty_stats(spark)
    readable = F.json_object_keys("value").isNotNull()
    if backup is not None:
        bad = text.filter(~readable).select(F.col("value").alias("raw"), F.current_timestamp().alias("found_at"))
        if not bad.isEmpty():
            bad.write.mode("append").parquet(backup)
    return stats.read_stats_document(text.filter(readable))


def stream_json(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """A folder of line files as a record stream with a ``value`` column."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def stream_table(spark: SparkSession, path: str, schema: T.StructType,
                 files_per_trigger: int | None = None) -> DataFrame:
    """A parquet path, folder or single file, as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # A glob is accepted for a folder and for a single file alike.
    folder, _, name = path.rstrip("/").rpartition("/")
    return reader.parquet(f"{folder}/[{name[0]}]{name[1:]}")
