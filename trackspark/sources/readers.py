"""Sources: sample tables, position streams, state documents, metadata text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackspark.config import CHUNKED_SCHEMA, CLEAN_SCHEMA, RAW_SCHEMA
from trackspark.operators.metadata import clean_fields

STATE_DDL = (
    "match_id int, batchId bigint, generatedAtUnix double, currentMatchSecond double, "
    "field struct<xMin:int,xMax:int,yMin:int,yMax:int>, "
    "positions array<struct<sid:int,ts:bigint,x:double,y:double,z:double,half:int,"
    "matchSecond:double,speed_kmh:double>>, "
    "heatmap_by_sid map<string,array<array<double>>>"
)
STATS_DDL = (
    "match_id int, batchId bigint, "
    "stats map<string,map<string,struct<distance_1m:double,time_1m:double>>>"
)


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw samples without header; unreadable fields become null."""
    return spark.read.schema(RAW_SCHEMA).option("header", False).csv(path)


def read_clean_csv(spark: SparkSession, path: str) -> DataFrame:
    """Cleaned samples; ``match_id`` follows where the folders name it."""
    return spark.read.schema(CLEAN_SCHEMA).option("header", True).csv(path)


def read_chunks(spark: SparkSession, path: str, first: int | None = None,
                last: int | None = None, match_id: int | None = None) -> DataFrame:
    """Chunked samples; the range becomes a partition filter, so other chunks are not read.

    ``match_id`` follows where the folders name it, and can be asked for. All folders are listed.
    """
    df = spark.read.schema(CHUNKED_SCHEMA).parquet(path)
    if match_id is not None:
        df = df.where(F.col("match_id") == match_id)
    if first is not None:
        df = df.where(F.col("chunkId") >= first)
    if last is not None:
        df = df.where(F.col("chunkId") <= last)
    return df


def list_chunks(chunks: DataFrame) -> DataFrame:
    """Chunk ids in play order."""
    return chunks.select("chunkId").distinct().orderBy("chunkId")


def read_position_stream(spark: SparkSession, path: str, files_per_trigger: int = 1,
                         schema=CHUNKED_SCHEMA, **options: str) -> DataFrame:
    """Chunks as a stream. ``chunkId`` is in the schema, so an empty folder starts the same."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.parquet(path)


def _documents(spark: SparkSession, path: str, ddl: str, required: str) -> DataFrame:
    return spark.read.schema(ddl).option("mode", "PERMISSIVE").json(path).where(
        F.col(required).isNotNull())


def read_positions_state(spark: SparkSession, path: str) -> DataFrame:
    """Position documents, one per match; malformed ones are left out."""
    return _documents(spark, path, STATE_DDL, "positions")


def read_stats_state(spark: SparkSession, path: str) -> DataFrame:
    return _documents(spark, path, STATS_DDL, "stats")


def read_latin1_lines(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """Lines of latin-1 text files as (path, line_no, line); blank lines are skipped.

    Files stay splittable. A line number is the byte offset of its split plus its rank in the
    split, which is unique and ascending inside a file.
    """
    # A separator that text never holds and no quoting give whole lines in one column.
    raw = (
        spark.read.schema("line string")
        .option("sep", "\u0001").option("quote", "").option("escape", "")
        .option("encoding", "ISO-8859-1").option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob).csv(path)
    )
    # the path is percent-encoded, so a plus sign in it stands for itself
    path_text = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    located = raw.select(
        F.url_decode(path_text).alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), "line")
    w = Window.partitionBy("path", "block").orderBy("id")
    return located.where(F.trim("line") != "").select(
        "path", (F.col("block") + F.row_number().over(w)).alias("line_no"), "line")


def split_quoted(line: Column) -> Column:
    """Fields of a ``;`` line; quoted fields may hold separators and doubled quotes."""
    outside = F.split(line, r';(?=(?:[^"]*"[^"]*")*[^"]*$)')
    unquoted = F.transform(outside, lambda v: F.when(
        v.rlike('^".*"$'),
        F.replace(F.substring(v, F.lit(2), F.length(v) - 2), F.lit('""'), F.lit('"')),
    ).otherwise(v))
    return F.when(line.contains('"'), unquoted).otherwise(F.split(line, ";"))


def _half_of(path: Column, pattern: str) -> Column:
    name = F.regexp_extract(path, pattern, 1)
    return F.when(name == "1st Half", 1).when(name == "2nd Half", 2).otherwise(0)


def _match_of(path: Column, match_id: int) -> Column:
    """The match that a folder ``match_id=`` names, else the given one."""
    return F.coalesce(F.regexp_extract(path, r"/match_id=(\d+)/", 1).try_cast("int"),
                      F.lit(match_id))


def read_possession_files(spark: SparkSession, path: str, match_id: int = 1) -> DataFrame:
    """Possession files (``1st Half/``, ``2nd Half/`` or flat) as metadata rows.

    The player is the file stem, the half is the folder right above the file. Folders
    ``match_id=`` above tell matches apart, else all is one match. In a match with half folders,
    loose files are ignored.
    """
    lines = read_latin1_lines(spark, path)
    stem = F.regexp_extract("path", r"([^/]+)\.csv$", 1)
    rows = lines.select(
        _match_of(F.col("path"), match_id).alias("match_id"), stem.alias("file_player"),
        _half_of(F.col("path"), r"/([^/]+)/[^/]+$").alias("half"), "line_no",
        clean_fields(split_quoted(F.col("line"))).alias("fields"),
    ).where(F.size("fields") > 0)
    halved = rows.where(F.col("half") > 0).select("match_id").distinct().withColumn(
        "halved", F.lit(True))
    return rows.join(halved, "match_id", "left").where(
        (F.col("half") > 0) | F.col("halved").isNull()).drop("halved")


def read_event_files(spark: SparkSession, path: str, match_id: int = 1) -> DataFrame:
    """Match-event files ``<folder>/<half>.csv`` as raw lines, matches as for possession."""
    folder = F.regexp_extract("path", r"([^/]+)/[^/]+\.csv$", 1)
    return read_latin1_lines(spark, path).select(
        _match_of(F.col("path"), match_id).alias("match_id"), folder.alias("folder"),
        _half_of(F.col("path"), r"/([^/]+)\.csv$").alias("half"), "line_no", "line")
