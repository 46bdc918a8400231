"""The `seqlog` data source: the log as a stream with one offset per stream, and for SQL."""

import time
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from urllib.parse import urlsplit

from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)

from seqlog.functions.records import LOG_SCHEMA
from seqlog.sources.basin import (
    append_path,
    commit_path,
    escape,
    files_path,
    fold_chain,
    folds_path,
    records_path,
    streams_path,
)
from seqlog.sources.options import NEXT, SourceOptions

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


@dataclass
class SeqRange(InputPartition):
    """Positions [first, next) of a stream that are in one file, which begins at `base`."""

    stream: str
    file: str
    base: int
    first: int
    next: int
    stamp: int


def open_path(path: str):
    """File system and plain path for a local path or a URI."""
    from pyarrow import fs

    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), parts.path
    uri = path.replace("s3a://", "s3://", 1)
    return fs.FileSystem.from_uri(uri)


def child_directories(path: str) -> list[str]:
    from pyarrow import fs

    system, root = open_path(path)
    found = system.get_file_info(fs.FileSelector(root))
    return [info.path for info in found if info.type == fs.FileType.Directory]


def read_columns(path: str, columns: list[str]) -> list[dict]:
    import pyarrow.dataset as ds

    system, root = open_path(path)
    dataset = ds.dataset(root, filesystem=system, format="parquet")
    return dataset.to_table(columns=columns).to_pylist() if dataset.files else []


def read_file(system, path: str, columns: list[str]) -> list[dict]:
    import pyarrow.parquet as pq

    return pq.read_table(path, columns=columns, filesystem=system, partitioning=None).to_pylist()


class LogIndex:
    """Driver-side view of a basin's metadata: one entry per unread record file, never records.

    It opens with the folded positions; afterwards it reads the commits that came since, and each
    declaration of a stream once.
    """

    def __init__(self, basin: str):
        self.basin = basin
        self.commit: int | None = None
        self.files: dict[str, list[tuple[int, int, str, int]]] = {}
        self.tails: dict[str, int] = {}
        self.read_declarations: set[str] = set()
        self.newest: dict[str, dict] = {}

    def refresh(self) -> None:
        """Read the folds, the first time, and the files of the appends published since."""
        if self.commit is None:
            self._open_folds()
        while True:
            system, path = open_path(commit_path(self.basin, self.commit + 1))
            if not system.get_file_info(path).is_file:
                return
            append_id = system.open_input_file(path).read().decode().split("\n")[0]
            columns = ["stream", "folder", "file", "place", "records", "origin", "append_ts"]
            rows = read_columns(append_path(files_path(self.basin), append_id), columns)
            for row in sorted(rows, key=lambda r: (r["stream"], r["place"])):
                first = self.tails.get(row["stream"], row["origin"])
                self._add(row, first, first + row["records"])
            self.commit += 1

    def _open_folds(self) -> None:
        system, root = open_path(folds_path(self.basin))
        names = [directory.rsplit("/", 1)[-1] for directory in child_directories(folds_path(self.basin))]
        done = lambda name: system.get_file_info(f"{root}/{name}/tails/_SUCCESS").is_file
        chain = fold_chain(names, done)
        columns = ["stream", "folder", "file", "first_seq", "next_seq", "append_ts"]
        for name in reversed(chain):
            for row in read_columns(f"{folds_path(self.basin)}/{name}/positions", columns):
                self._add(row, row["first_seq"], row["next_seq"])
        self.commit = int(chain[0].split("-")[1]) - 1 if chain else -1

    def _add(self, row: dict, first: int, end: int) -> None:
        stream = row["stream"]
        file = f"{append_path(records_path(self.basin), row['folder'])}/stream={escape(stream)}/{row['file']}"
        stamp = row["append_ts"].replace(tzinfo=timezone.utc) - EPOCH
        self.files.setdefault(stream, []).append((first, end, file, stamp // timedelta(microseconds=1)))
        self.tails[stream] = max(end, self.tails.get(stream, 0))

    def declared(self) -> dict[str, dict]:
        """Newest declaration per stream; a stream known from appends alone starts at 0."""
        from pyarrow import fs

        system, root = open_path(streams_path(self.basin))
        for info in system.get_file_info(fs.FileSelector(root)):
            if not info.path.endswith(".parquet") or info.path in self.read_declarations:
                continue
            self.read_declarations.add(info.path)
            for row in read_file(system, info.path, ["stream", "deleted_at", "first_seq", "version"]):
                current = self.newest.get(row["stream"])
                if current is None or current["version"] <= row["version"]:
                    self.newest[row["stream"]] = {
                        "version": row["version"],
                        "first_seq": row["first_seq"],
                        "deleted": row["deleted_at"] is not None,
                    }
        known = {s: {"version": None, "first_seq": 0, "deleted": False} for s in self.tails}
        return known | self.newest

    def forget(self, offsets: dict[str, int]) -> None:
        for stream, position in offsets.items():
            self.files[stream] = [f for f in self.files.get(stream, []) if f[1] > position]

    def plan(self, stream: str, start: int, end: int, size: int) -> list[SeqRange]:
        """Ranges of at most `size` records covering [start, end), each inside one file."""
        planned = []
        for first, after, file, stamp in self.files.get(stream, []):
            low, high = max(first, start), min(after, end)
            planned += [
                SeqRange(stream, file, first, at, min(at + size, high), stamp) for at in range(low, high, size)
            ]
        return planned


def read_range(partition: SeqRange):
    """Arrow batches of one range; row groups that lie outside are not read."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    header = pa.struct([("name", pa.binary()), ("value", pa.binary())])
    stamp = pa.scalar(partition.stamp, pa.timestamp("us", tz="UTC"))
    system, path = open_path(partition.file)
    with system.open_input_file(path) as source:
        file, begin = pq.ParquetFile(source), partition.base
        for group in range(file.num_row_groups):
            end = begin + file.metadata.row_group(group).num_rows
            if end > partition.first and begin < partition.next:
                for batch in file.iter_batches(row_groups=[group], columns=["headers", "body"]):
                    low = max(0, partition.first - begin)
                    part = batch.slice(low, max(0, min(batch.num_rows, partition.next - begin) - low))
                    n, at = part.num_rows, begin + low
                    begin += batch.num_rows
                    if n:
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.repeat(pa.scalar(partition.stream, pa.string()), n),
                                pa.array(range(at, at + n), pa.int64()),
                                part.column("headers").cast(pa.list_(header)),
                                part.column("body").cast(pa.binary()),
                                pa.repeat(stamp, n),
                            ],
                            names=["stream", "seq_num", "headers", "body", "append_ts"],
                        )
            begin = end


class SeqLogStreamReader(DataSourceStreamReader):
    """Offsets are {stream: next position}. A stream missing from the start offset is new: it begins
    at its first retained record, or, under NEXT, at the position pinned when it was found."""

    def __init__(self, options: SourceOptions):
        self.options = options
        self.index = LogIndex(options.basin)
        self.known: set[str] = set()
        self.listed_at: float | None = None
        self.position: dict[str, int] | None = None

    def _discover(self) -> None:
        interval = self.options.discovery_interval_ms
        now = time.monotonic()
        due = self.listed_at is None or (
            interval is not None and (now - self.listed_at) * 1000 >= interval
        )
        if not due:
            return
        if self.options.streams:
            self.known.update(self.options.streams)
        else:
            prefix = self.options.discovery_prefix
            for stream, entry in self.index.declared().items():
                if stream.startswith(prefix) and not entry["deleted"]:
                    self.known.add(stream)
        self.listed_at = now

    def _tail(self, stream: str, declared: dict[str, dict]) -> int:
        first = declared.get(stream, {}).get("first_seq", 0)
        return max(self.index.tails.get(stream, 0), first)

    def _first_position(self) -> dict[str, int]:
        if self.options.start_behavior != NEXT:
            return {}
        self.index.refresh()
        self._discover()
        declared = self.index.declared()
        return {s: self._tail(s, declared) for s in sorted(self.known)}

    def initialOffset(self) -> dict:
        if self.position is None:
            self.position = self._first_position()
        return dict(self.position)

    def latestOffset(self) -> dict:
        self.index.refresh()
        self._discover()
        declared = self.index.declared()
        # A restarted query plans its last batch again before it asks for the latest offset, so an
        # unknown position means a new query.
        if self.position is None:
            self.position = self._first_position()
        latest = {
            s: self._tail(s, declared) for s in sorted(self.known | set(self.position))
        }
        if self.options.capped:
            for stream, tail in latest.items():
                if stream in self.position:
                    start = self.position[stream]
                elif self.options.start_behavior == NEXT:
                    start = tail
                else:
                    start = declared.get(stream, {}).get("first_seq", 0)
                latest[stream] = min(tail, start + self.options.max_records_per_stream)
        return latest

    def partitions(self, start: dict, end: dict) -> list[SeqRange]:
        self.index.refresh()
        declared = self.index.declared()
        planned = []
        for stream, stop in end.items():
            first = declared.get(stream, {}).get("first_seq", 0)
            if stream in start:
                begin = start[stream]
                if stop < begin:
                    raise ValueError(f"stream {stream}: asked to read from {begin} back to {stop}")
                if begin < first and begin < stop:
                    if self.options.fail_on_data_loss:
                        raise ValueError(
                            f"stream {stream}: position {begin} is below the first retained "
                            f"position {first}"
                        )
                    begin = first
            else:
                begin = stop if self.options.start_behavior == NEXT else first
            planned += self.index.plan(stream, begin, stop, self.options.records_per_partition)
        self.position = dict(end)
        self.known.update(end)
        return planned

    def read(self, partition: SeqRange):
        return read_range(partition)

    def commit(self, end: dict) -> None:
        self.index.forget(end)


class SeqLogBatchReader(DataSourceReader):
    """Bounded read up to the current tails. Stream equality and position bounds cut the plan."""

    def __init__(self, options: SourceOptions):
        self.options = options
        self.low = 0
        self.high: int | None = None
        self.only: str | None = None

    def pushFilters(self, filters):
        for f in filters:
            bound = getattr(f, "value", None)
            if isinstance(f, EqualTo) and f.attribute == ("stream",):
                self.only = bound
            elif isinstance(f, GreaterThan) and f.attribute == ("seq_num",):
                self.low = max(self.low, bound + 1)
            elif isinstance(f, GreaterThanOrEqual) and f.attribute == ("seq_num",):
                self.low = max(self.low, bound)
            elif isinstance(f, LessThan) and f.attribute == ("seq_num",):
                self.high = bound if self.high is None else min(self.high, bound)
            elif isinstance(f, LessThanOrEqual) and f.attribute == ("seq_num",):
                self.high = bound + 1 if self.high is None else min(self.high, bound + 1)
            # Spark keeps every filter as well: pushing only narrows what is planned.
            yield f

    def partitions(self) -> list[SeqRange]:
        reader = SeqLogStreamReader(self.options)
        reader.index.refresh()
        reader._discover()
        declared = reader.index.declared()
        planned = []
        for stream in sorted(reader.known):
            if self.only is not None and stream != self.only:
                continue
            tail = reader._tail(stream, declared)
            begin = tail
            if self.options.start_behavior != NEXT:
                begin = max(declared.get(stream, {}).get("first_seq", 0), self.low)
            stop = tail if self.high is None else min(tail, self.high)
            planned += reader.index.plan(stream, begin, stop, self.options.records_per_partition)
        return planned or [SeqRange("", "", 0, 0, 0, 0)]

    def read(self, partition: SeqRange):
        return read_range(partition) if partition.next > partition.first else iter(())


class SeqLogDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "seqlog"

    def schema(self):
        return LOG_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return SeqLogBatchReader(SourceOptions.parse(dict(self.options)))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return SeqLogStreamReader(SourceOptions.parse(dict(self.options)))

    def writer(self, schema, overwrite: bool):
        from seqlog.sinks.writer import SeqLogWriter, SinkOptions

        if overwrite:
            raise ValueError("a log is appended to, never overwritten")
        return SeqLogWriter(SinkOptions.parse(dict(self.options), schema, streaming=False))

    def streamWriter(self, schema, overwrite: bool):
        from seqlog.sinks.writer import SeqLogStreamWriter, SinkOptions

        if overwrite:
            raise ValueError("a log is appended to, never overwritten: use output mode append")
        return SeqLogStreamWriter(SinkOptions.parse(dict(self.options), schema, streaming=True))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SeqLogDataSource)


def read_stream(spark: SparkSession, options: SourceOptions):
    """The log as a streaming frame with LOG_SCHEMA; no watermark is assigned."""
    register(spark)
    return spark.readStream.format("seqlog").options(**options.as_reader_options()).load()
