"""The live view: one query over one scan, and the state documents built from its log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from trackspark.config import MATCH, MatchConfig
from trackspark.operators.heatmap import dense_grid, smooth
from trackspark.operators.running import latest_stats
from trackspark.sources.batchlog import newest_batch, read_batch_log
from trackspark.sources.sinks import positions_documents, stats_documents
from trackspark.streaming.pipeline import start_log
from trackspark.streaming.stateful import KINDS, live_stream, state_store


LOG_KEYS = ["kind", *dict.fromkeys(key for keys, _ in KINDS.values() for key in keys)]


def start_live(valid: DataFrame, out: str, checkpoint: str, trigger: str | None = MATCH.trigger,
               tie: str | None = None, cfg: MatchConfig = MATCH) -> StreamingQuery:
    """Start latest positions, heatmap cells and running statistics over one valid stream.

    One stateful query reads the source once and gives rows of all three kinds, which a batch
    writes in one go. ``trigger=None`` drains the source and stops.
    """
    with state_store(valid.sparkSession):
        return start_log(live_stream(valid, tie, cfg), out, checkpoint, trigger=trigger,
                         name="live", keys=LOG_KEYS)


def live_tables(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """Current content of the log, by kind of rows."""
    return {kind: read_batch_log(spark, out, list(keys), {"kind": kind}).select(*keys, *values)
            for kind, (keys, values) in KINDS.items()}


def live_documents(spark: SparkSession, out: str, cfg: MatchConfig = MATCH
                   ) -> tuple[DataFrame, DataFrame]:
    """Position and statistics documents per match, as of the newest batch of the log."""
    tables = live_tables(spark, out)
    newest = newest_batch(spark, out)
    grids = dense_grid(smooth(tables["heatmap"], cfg=cfg), cfg=cfg)
    positions = positions_documents(tables["positions"], grids, newest, cfg)
    return positions, stats_documents(latest_stats(tables["stats"]), newest)
