"""Table and stream sources. Schemas are declared, so no pass over the data is spent on inference."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packetloom.schemas import ALERT, PACKET, SCORING_REQUEST

CORRUPT = "_corrupt_record"
FILE_TIME = "__timestamp"


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def _missing_path(error: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in (error.getCondition() or "")


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header; an absent path gives an empty table."""
    try:
        return spark.read.schema(schema).csv(path, header=True)
    except AnalysisException as error:
        if _missing_path(error):
            return empty(spark, schema)
        raise


def read_pool(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    source_type: str,
    max_files: int | None = None,
    since: str | None = None,
) -> DataFrame:
    """All ``*.csv`` of a folder with ``__timestamp`` (file time, epoch seconds) and ``source_type``.

    ``max_files`` keeps the newest files, ``since`` the files changed at or after a time; both select files by their
    metadata before any row of the others is parsed. Unreadable files are skipped.
    """
    reader = spark.read.schema(schema).option("header", True).option("ignoreCorruptFiles", True)
    reader = reader.option("pathGlobFilter", "*.csv")
    if since is not None:
        reader = reader.option("modifiedAfter", since)
    try:
        rows = reader.csv(folder) if max_files is None else _newest(spark, reader, folder, max_files)
    except AnalysisException as error:
        if not _missing_path(error):
            raise
        rows = None
    if rows is None:
        tagged = T.StructType(
            [*schema.fields, T.StructField(FILE_TIME, T.DoubleType()), T.StructField("source_type", T.StringType())]
        )
        return empty(spark, tagged)
    modified = F.unix_micros(F.col("_metadata.file_modification_time")).cast("double") / F.lit(1e6)
    return rows.withColumn(FILE_TIME, modified).withColumn("source_type", F.lit(source_type))


def _newest(spark: SparkSession, reader, folder: str, max_files: int) -> DataFrame | None:
    """Rows of the newest files; of files with one time the smaller paths count as newer.

    The listing is ordered as a table and only the border, the last file that still counts, comes to the driver. Files
    are then left out by their metadata, so no list of paths is carried around.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder).select("path", "modificationTime")
    border = files.orderBy(F.col("modificationTime").desc(), "path").limit(max_files)
    border = border.orderBy("modificationTime", F.col("path").desc()).first()
    if border is None:
        return None
    at, path = F.col("_metadata.file_modification_time"), F.col("_metadata.file_path")
    last = F.lit(border["modificationTime"])
    return reader.csv(folder).where((at > last) | ((at == last) & (path <= F.lit(border["path"]))))


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType = ALERT) -> DataFrame:
    """JSON lines; lines that are no JSON are skipped, fields of a wrong type become NULL, an absent path is empty."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    try:
        rows = spark.read.schema(with_corrupt).option("columnNameOfCorruptRecord", CORRUPT).json(path)
    except AnalysisException as error:
        if _missing_path(error):
            return empty(spark, schema)
        raise
    parsable = F.col(CORRUPT).isNull() | F.try_parse_json(F.col(CORRUPT)).isNotNull()
    return rows.where(parsable).select(*schema.names)


def read_jsonl_inferred(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines with inferred types, for ad-hoc tables."""
    return spark.read.json(path)


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """Scoring requests as JSON lines."""
    return read_jsonl(spark, path, SCORING_REQUEST)


def packet_stream(spark: SparkSession, path: str, file_format: str = "json", schema: T.StructType = PACKET, **options) -> DataFrame:
    """Packets arriving as files, with the event time ``ts``. Another connector only changes this reader."""
    rows = spark.readStream.schema(schema).options(**options).format(file_format).load(path)
    return with_packet_time(rows)


def with_packet_time(packets: DataFrame) -> DataFrame:
    return packets.withColumn("ts", F.timestamp_micros(F.round(F.col("timestamp") * 1e6).cast("bigint")))

