"""Raw board snapshots (bronze): batch and file-stream readers.

Landing layout (input contract, written by the collector with a temp file
and an atomic rename): ``<root>/<YYYY-MM-DD>/<stop id, ':' -> '_'>/<YYYYMMDDTHHMMSSZ>.json``,
one multi-line JSON document per file. Only ``*.json`` is read, so
in-flight ``*.json.tmp`` files are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from quaystat.schema import SNAPSHOT_DDL

CORRUPT_COLUMN = "_corrupt_record"
SOURCE_FILE_COLUMN = "source_file"


class MissingInputError(FileNotFoundError):
    """The input path does not exist."""


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def remove_path(spark: SparkSession, path: str) -> None:
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def require_path(spark: SparkSession, path: str, what: str) -> None:
    if not path_exists(spark, path):
        raise MissingInputError(f"no {what} at {path}")


def _reader_schema() -> str:
    return f"{SNAPSHOT_DDL}, {CORRUPT_COLUMN} STRING"


def _options(reader, multi_line: bool = True):
    return (
        reader.option("multiLine", multi_line)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .schema(_reader_schema())
    )


def read_snapshots(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Read every ``*.json`` snapshot below ``path`` with the fixed schema.

    ``multi_line=True`` is the landing contract (one pretty-printed document
    per file); ``False`` reads JSON Lines bundles (one document per line).
    Adds ``source_file`` (from the file metadata) and keeps
    ``_corrupt_record`` so malformed files can be rejected with their name.
    """
    require_path(spark, path, "snapshot folder")
    df = _options(spark.read, multi_line).json(path)
    return df.withColumn(SOURCE_FILE_COLUMN, F.col("_metadata.file_path"))


def stream_snapshots(spark: SparkSession, path: str, max_files_per_trigger: int | None = None, archive: str | None = None) -> DataFrame:
    """The same snapshots as a file stream (new files only, per checkpoint).

    With ``archive`` (a folder outside ``path``) files of batches that are done move there, so that a run lists the
    files that landed since and not all that ever did.
    """
    reader = _options(spark.readStream)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    df = reader.json(path)
    return df.withColumn(SOURCE_FILE_COLUMN, F.col("_metadata.file_path"))
