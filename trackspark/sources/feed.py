"""A streaming source of indexed chunks whose offset is the chunk, not the time of a file."""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

# the reader travels with the query, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows handed on at a time, and bytes of a column read at a time.
BATCH_ROWS, BUFFER_BYTES = 1 << 13, 1 << 18


@dataclass
class _Part(InputPartition):
    """The chunks ``after`` < id <= ``upto`` of one file."""

    file: str
    match_id: int | None
    after: int
    upto: int


class ChunkFeed(DataSource):
    """Options: path, index, chunks (a trigger), position, and last (optional)."""

    @classmethod
    def name(cls) -> str:
        return "chunk_feed"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return ChunkFeedReader(schema, dict(self.options))


def _store(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path)


class ChunkFeedReader(DataSourceStreamReader):
    """Hands out chunks in order, as many a trigger as asked for.

    A query asks for the newest offset before it names the one it has reached, so the end of each
    planned batch is written to ``position``; a new query finds none there. If one died before
    its batch was done, Spark plans the same batch anew from its own log.
    """

    def __init__(self, schema: StructType, options: dict[str, str]):
        from pyspark.sql.pandas.types import to_arrow_schema

        self.options = options
        self.arrow = to_arrow_schema(schema)
        self.at: int | None = None
        self.files: dict[str, tuple[int | None, int, int]] = {}
        self.parts_read: set[str] = set()

    def _position(self) -> tuple:
        store, path = _store(self.options["position"])
        return store, f"{path}/chunk.json"

    def initialOffset(self) -> dict:
        return {"chunk": -1}

    def _reached(self) -> int:
        from pyarrow import fs

        store, path = self._position()
        if store.get_file_info(path).type == fs.FileType.NotFound:
            return -1
        with store.open_input_file(path) as source:
            return json.loads(source.read())["chunk"]

    def _look(self) -> None:
        """Take in what was added to the index."""
        import pyarrow.parquet as pq
        from pyarrow import fs

        store, path = _store(f"{self.options['path']}/{self.options['index']}")
        for part in store.get_file_info(fs.FileSelector(path)):
            if part.base_name in self.parts_read or not part.base_name.endswith(".parquet"):
                continue
            with store.open_input_file(part.path) as source:
                rows = pq.read_table(source).to_pylist()
            self.parts_read.add(part.base_name)
            for row in rows:
                chunk = row["chunkId"]
                match, low, high = self.files.get(row["file"], (row.get("match_id"), chunk, chunk))
                self.files[row["file"]] = match, min(low, chunk), max(high, chunk)
        self.files = {f: x for f, x in self.files.items() if x[2] > self.at}

    def latestOffset(self) -> dict:
        if self.at is None:
            self.at = self._reached()
        self._look()
        end = int(self.options.get("last", 1 << 62))
        later = [max(low, self.at + 1) for _, low, _ in self.files.values()]
        step = int(self.options["chunks"])
        upto = min((min(later) // step + 1) * step - 1, end) if later else self.at
        newest = max((high for _, _, high in self.files.values()), default=self.at)
        return {"chunk": max(self.at, min(upto, newest))}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        after, upto = start["chunk"], end["chunk"]
        if self.at is None:  # a batch that was planned before the query stopped
            self.at = after
            self._look()
        parts = [_Part(f"{self.options['path']}/{f}", match, after, upto)
                 for f, (match, low, high) in sorted(self.files.items())
                 if low <= upto and high > after]
        if upto > self.at:
            store, path = self._position()
            store.create_dir(path.rsplit("/", 1)[0])
            with store.open_output_stream(path) as sink:
                sink.write(json.dumps(end).encode())
        self.at = upto
        return parts

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        store, path = _store(partition.file)
        wanted = [c for c in self.arrow.names if c != "match_id"]
        # pages are read as they are needed: a scan of a dataset decodes whole row groups ahead
        with store.open_input_file(path) as source, pq.ParquetFile(
                source, buffer_size=BUFFER_BYTES) as data:
            groups = [g for g in range(data.num_row_groups)
                      if _may_hold(data.metadata.row_group(g), partition)]
            for batch in data.iter_batches(BATCH_ROWS, groups, wanted, use_threads=False):
                chunk = batch.column("chunkId")
                batch = batch.filter(pc.and_(pc.greater(chunk, partition.after),
                                             pc.less_equal(chunk, partition.upto)))
                columns = {c: batch.column(c) for c in wanted}
                columns["match_id"] = pa.array([partition.match_id] * batch.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [columns[f.name].cast(f.type) for f in self.arrow], schema=self.arrow)


def _may_hold(group, part: _Part) -> bool:
    """Whether a row group can hold chunks of the part, by its statistics."""
    for i in range(group.num_columns):
        column = group.column(i)
        if column.path_in_schema == "chunkId" and column.is_stats_set:
            found = column.statistics
            return not found.has_min_max or found.min <= part.upto and found.max > part.after
    return True
