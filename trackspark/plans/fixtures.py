"""Tracking inputs derived from the ``events`` table (see FIXTURES.md, part B).

All of it is row-wise, so it scales with ``events`` and works on a stream as well.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackspark.config import BALL_SIDS, MATCH, PLAYERS
from trackspark.dims import inline_table, match_clock, sensor_rows
from trackspark.functions.once import computed_once
from trackspark.operators.clean import (
    clean_matches,
    clean_samples,
    position_columns,
    valid_positions,
)
from trackspark.operators.metadata import clean_fields

MATCH_ID = 1
TIE = ("event_id",)
SENSOR_IDS = [*BALL_SIDS, *(r[0] for r in sensor_rows() if r[2] != "ball")]

# (event_id * 2654435761) mod 2^32 in two 16-bit halves, so that large ids cannot overflow
_HASH = ("((event_id % 65536) * 2654435761 + "
         "((event_id div 65536) % 65536 * 2654435761) % 65536 * 65536) % 4294967296")

# other spellings of some roster names, as they occur in file names
SPELLINGS = {
    "Niklas Waelzlein": "Niklas Wälzlein",
    "Wili Sommer": "WILI  SOMMER",
    "Kevin Baer": "kevin bär",
    "Ben Mueller": "Ben Müller",
    "Leon Heinze": " Léon Heinze ",
}


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a glob, because a plain path to a single file is refused as a stream source
    schema = read_events(spark, sf_dir).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")


def raw_from_events(events: DataFrame) -> DataFrame:
    h = F.expr(_HASH)
    ids = F.array(*[F.lit(s) for s in SENSOR_IDS])
    e = events.select("event_id", "user_id", "event_type", "value", "ts", h.alias("h"))
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    e = e.select(
        F.lit(MATCH_ID).alias("match_id"), "event_id", "user_id", "event_type",
        F.get(ids, (F.shiftright("h", 16) % len(SENSOR_IDS)).cast("int")).alias("sid"),
        (F.lit(10720000000000000) + (micros - F.lit(1704067200000000)) * 1620).alias("ts"),
        F.when(F.col("event_id") % 97 != 0, F.col("h") % 140001 - 70000).cast("int").alias("x"),
        ((F.col("event_id") * 7919 + F.col("user_id") * 104729) % 67001 - 33500
         ).cast("int").alias("y"),
        (F.col("event_id") % 2000).cast("int").alias("z"),
        (F.round(F.col("value") * 100).cast("bigint") * 1000).alias("v"),
        ((F.col("event_id") % 5000) * 1000).alias("a_abs"))
    zero = F.lit(0)
    return e.select(
        "match_id", "event_id", "user_id", "event_type", "sid", "ts", "x", "y", "z",
        (F.col("v") * F.when(F.col("sid").isin(*BALL_SIDS), 4).otherwise(1)).alias("v_abs"),
        "a_abs", *[zero.alias(c) for c in ("vx", "vy", "vz", "ax", "ay", "az")])


def raw_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_from_events(read_events(spark, sf_dir))


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_samples(raw_samples(spark, sf_dir))


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return position_columns(valid_positions(clean(spark, sf_dir)), ("match_id", "event_id"))


def position_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_from_events(stream_events(spark, sf_dir))
    return position_columns(valid_positions(clean_samples(raw)), ("match_id", "event_id"))


# eight matches, one with half of all rows, each with a clock of its own
MATCHES, CLOCK_SHIFT = 8, 10**15
MATCH_OF = "case when event_id % 2 = 0 then 1 else 2 + event_id div 2 % 7 end"


def league_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The samples dealt over MATCHES, cleaned by the clock of each."""
    raw = raw_samples(spark, sf_dir).withColumn("match_id", F.expr(MATCH_OF).cast("int"))
    raw = raw.withColumn("ts", F.col("ts") + (F.col("match_id") - 1) * F.lit(CLOCK_SHIFT))
    shift = (F.col("match_id") - 1) * F.lit(CLOCK_SHIFT)
    clock = match_clock(spark, list(range(1, MATCHES + 1))).withColumns({
        c: F.col(c) + shift for c in ("start_ts", "end_ts")})
    return clean_matches(raw, clock)


def league_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return position_columns(valid_positions(league_samples(spark, sf_dir)),
                            ("match_id", "event_id"))


def matches(spark: SparkSession) -> DataFrame:
    return inline_table(spark, [(MATCH_ID,)], {"match_id": "int"})


def second_ticks(spark: SparkSession) -> DataFrame:
    every = F.sequence(F.lit(0), F.lit(MATCH.last_tick)).cast("array<double>")
    return matches(spark).select("match_id", F.explode(every).alias("t"))


def _half_millis() -> F.Column:
    start = F.when(F.col("half") == 1, F.lit(MATCH.first_half_start_ts)).otherwise(
        F.lit(MATCH.second_half_start_ts))
    return F.floor((F.col("ts") - start) / F.lit(1_000_000_000)).cast("bigint")


def _time_text(ms: F.Column, mark: str) -> F.Column:
    def digits(value: F.Column, n: int) -> F.Column:
        return F.lpad(value.cast("int").cast("string"), n, "0")

    return F.concat(
        digits(F.floor(ms / 3_600_000), 2), F.lit(":"), digits(F.floor(ms / 60_000) % 60, 2),
        F.lit(":"), digits(F.floor(ms / 1000) % 60, 2), F.lit(mark), digits(ms % 1000, 3))


def possession_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(match_id, file_player, half, line_no, fields) as the file reader gives them."""
    files = inline_table(
        spark, [(i, SPELLINGS.get(p[0], p[0])) for i, p in enumerate(PLAYERS)],
        {"player_ord": "int", "file_player": "string"})
    text = (
        F.when(F.col("event_type") == "signup", "Possession Begin")
        .when(F.col("event_type") == "purchase", "Possession End")
        .when(F.col("event_type") == "click", "Interval")
        .otherwise("Note")
    )
    rows = clean(spark, sf_dir).select(
        "match_id", (F.col("user_id") % 16).cast("int").alias("player_ord"), "half",
        F.col("event_id").alias("line_no"), text.alias("event_text"), _half_millis().alias("m"))
    rows = computed_once(rows, ["match_id", "half", "player_ord", "line_no"],
                         event_text=F.col("event_text"), m=F.col("m"))
    later = F.col("m") + F.col("line_no") % 20 * 1000
    fields = F.array(
        F.col("line_no").cast("string"), F.col("event_text"), _time_text(F.col("m"), ","),
        F.when(F.col("event_text") == "Interval", _time_text(later, ",")))
    return computed_once(
        rows.join(files, "player_ord"), ["match_id", "file_player", "half", "line_no"],
        fields=clean_fields(fields))


def match_event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(match_id, folder, half, line_no, line) as the file reader gives them."""
    rows = clean(spark, sf_dir).where(F.col("event_type") == "error")
    folder = F.when(F.col("user_id") % 2 == 0, "Shot on Goal").otherwise("Game Interruption")
    time = F.when(F.col("event_id") % 50 == 0, "n/a").otherwise(_time_text(_half_millis(), "."))
    subject = F.concat(F.lit("Player "), (F.col("user_id") % 16).cast("string"))
    rows = rows.withColumn("line_no", F.col("event_id"))
    return computed_once(
        rows, ["match_id", "half", "line_no"], folder=folder,
        line=F.concat_ws(";", F.col("event_id").cast("string"), subject, time))


def _write_latin1_files(lines: DataFrame, path: str) -> None:
    """(folder, name, line_no, line) as latin-1 files ``folder/name.csv``, one task a file."""
    spark, parts = lines.sparkSession, f"{path}/_parts"
    lines.repartition("folder", "name").sortWithinPartitions("folder", "name", "line_no").select(
        "folder", "name", "line").write.partitionBy("folder", "name").option(
        "encoding", "ISO-8859-1").option("sep", "\u0001").option("escapeQuotes", False).option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(parts)
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    fs = path_of(path).getFileSystem(spark._jsc.hadoopConfiguration())
    # Spark names its files itself; there are as many as the roster has files
    for found in fs.globStatus(path_of(f"{parts}/folder=*/name=*/part-*")):
        at = found.getPath()
        name, folder = (unquote(p.getName().split("=", 1)[1])
                        for p in (at.getParent(), at.getParent().getParent()))
        fs.mkdirs(path_of(f"{path}/{folder}"))
        fs.rename(at, path_of(path_of(f"{path}/{folder}"), f"{name}.csv"))
    fs.delete(path_of(parts), True)


_HALF_NAME = "case half when 1 then '1st Half' else '2nd Half' end"


def write_possession_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    _write_latin1_files(possession_rows(spark, sf_dir).select(
        F.expr(_HALF_NAME).alias("folder"), F.col("file_player").alias("name"), "line_no",
        F.concat_ws(";", "fields").alias("line")), path)


def write_event_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    _write_latin1_files(match_event_lines(spark, sf_dir).select(
        "folder", F.expr(_HALF_NAME).alias("name"), "line_no", "line"), path)
