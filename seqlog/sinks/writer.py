"""Writer of the `seqlog` data source: frames of records, batch and streaming, as appends.

Each task writes its partition's records in order, a file per stream, and reports them; the driver
lists the files and publishes the append. Positions follow the order of partitions, so a frame that is
sorted keeps its order. What tasks of a failed write left is removed, or stays unpublished and unread.
"""

import json
import os
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage

from seqlog.operators.batching import MAX_RECORD_BYTES, checked
from seqlog.sources.basin import append_path, commit_path, escape, files_path, published_path, records_path
from seqlog.sources.datasource import LogIndex, open_path
from seqlog.sources.options import KNOWN

HEADER = pa.struct([("name", pa.binary()), ("value", pa.binary())])
STORED = pa.schema([("headers", pa.list_(HEADER)), ("body", pa.binary())])
FILES = pa.schema(
    [
        ("stream", pa.string()), ("folder", pa.string()), ("file", pa.string()), ("place", pa.int64()), ("records", pa.int64()),
        ("origin", pa.int64()), ("append_ts", pa.timestamp("us", tz="UTC")),
    ]
)
#: Streams of one task whose files are open at a time.
OPEN_FILES = 100
#: Columns that the log sets itself: a table has them, so an insert may name them, but only with nulls.
OWN_COLUMNS = ("seq_num", "append_ts")


@dataclass(frozen=True)
class SinkOptions:
    """Where to write. A record's own column `stream` routes it; where that is missing or null, the option does.

    Options of the source may stand beside those of the sink, as a table has one set.
    """

    basin: str
    stream: str | None
    writer: str
    max_record_bytes: int

    @classmethod
    def parse(cls, options: dict[str, str], schema: T.StructType, streaming: bool) -> "SinkOptions":
        given = {k.lower(): v for k, v in options.items()}
        unknown = sorted(set(given) - KNOWN - {"checkpointlocation"})
        if unknown:
            raise ValueError(f"unknown option {unknown[0]}")
        basin, stream = given.get("basin") or given.get("path") or "", given.get("stream") or None
        if not basin:
            raise ValueError("the sink needs a basin")
        if streaming and not given.get("writer"):
            raise ValueError("a streaming sink needs a writer: a name of its own for each checkpoint")
        columns = {f.name: f.dataType for f in schema.fields}
        if columns.get("body") != T.BinaryType():
            raise ValueError("a frame of records has a binary column body")
        if stream is None and columns.get("stream") != T.StringType():
            raise ValueError("the sink needs a stream, or a string column stream in the frame")
        extra = sorted(set(columns) - {"stream", "headers", "body", *OWN_COLUMNS})
        if extra:
            raise ValueError(f"a record has stream, headers and body, not {extra[0]}")
        limit = checked("maxRecordBytes", int(given.get("maxrecordbytes") or MAX_RECORD_BYTES), 1, MAX_RECORD_BYTES)
        return cls(basin, stream, given.get("writer") or "batch", limit)


@dataclass
class Written(WriterCommitMessage):
    """Files of one task in a folder of the records: (stream, file, place, records)."""

    folder: str = ""
    files: list[tuple[str, str, int, int]] = field(default_factory=list)


def _octets(column: pa.Array) -> list[int]:
    """Metered size of every record's headers."""
    return [sum(len(h["name"] or b"") + len(h["value"] or b"") for h in row or []) for row in column.to_pylist()]


def write_records(options: SinkOptions, batches) -> Written:
    """Write one task's records; the order of its rows stays within each stream."""
    part, token = TaskContext.get().partitionId(), uuid.uuid4().hex
    # Which append this becomes, only the commit decides: a task has a folder of its own.
    done, open_files, cut = Written(f"{options.writer}-{token}"), {}, 0
    folder = append_path(records_path(options.basin), done.folder)

    def close_all() -> None:
        for stream, (writer, name, place) in open_files.items():
            writer.close()
            done.files.append((stream, name, place, counts.pop((stream, name))))
        open_files.clear()

    counts: dict[tuple[str, str], int] = {}
    for batch in batches:
        names = batch.schema.names
        body = batch.column("body").cast(pa.binary())
        if "headers" in names:
            headers = batch.column("headers").cast(pa.list_(HEADER))
        else:
            headers = pa.array([[]] * batch.num_rows, pa.list_(HEADER))
        for name in set(OWN_COLUMNS) & set(names):
            if batch.column(name).null_count < batch.num_rows:
                raise ValueError(f"{name} is set by the log: leave it null")
        own = batch.column("stream").to_pylist() if "stream" in names else [None] * batch.num_rows
        streams = [options.stream if stream is None else stream for stream in own]
        sizes = [n + len(b or b"") for n, b in zip(_octets(headers), body.to_pylist(), strict=True)]
        for stream, size in zip(streams, sizes, strict=True):
            if not stream:
                raise ValueError("record without a stream")
            if size > options.max_record_bytes:
                raise ValueError(f"record over the size limit in {stream}")
        table = pa.Table.from_arrays([headers, body], schema=STORED)
        rows: dict[str, list[int]] = {}
        for at, stream in enumerate(streams):
            rows.setdefault(stream, []).append(at)
        for stream, at in rows.items():
            if stream not in open_files:
                if len(open_files) >= OPEN_FILES:
                    close_all()
                name = f"part-{part:05d}-{token}.c{cut:03d}.parquet"
                system, path = open_path(f"{folder}/stream={escape(stream)}/{name}")
                system.create_dir(os.path.dirname(path), recursive=True)
                writer = pq.ParquetWriter(path, STORED, filesystem=system, compression="snappy")
                open_files[stream] = (writer, name, part * 1_000_000 + cut)
                cut += 1
            writer, name, _ = open_files[stream]
            writer.write_table(table.take(at) if len(at) < table.num_rows else table)
            counts[stream, name] = counts.get((stream, name), 0) + len(at)
    close_all()
    return done


def list_files(basin: str, append_id: str, tasks: list[Written]) -> None:
    """Write the append's table of files."""
    index = LogIndex(basin)
    declared, now = index.declared(), datetime.now(timezone.utc)
    rows = [
        {
            "stream": stream, "folder": task.folder, "file": file, "place": place, "records": records,
            "origin": declared.get(stream, {}).get("first_seq") or 0, "append_ts": now,
        }
        for task in tasks
        for stream, file, place, records in task.files
    ]
    system, path = open_path(append_path(files_path(basin), append_id))
    system.create_dir(path, recursive=True)
    pq.write_table(pa.Table.from_pylist(rows, FILES), f"{path}/part-00000.parquet", filesystem=system)
    with system.open_output_stream(f"{path}/_SUCCESS"):
        pass


def _publish_as(basin: str, number: int, text: str) -> bool:
    """Make a commit, unless the number is taken."""
    system, target = open_path(commit_path(basin, number))
    draft = f"{os.path.dirname(target)}/.{os.path.basename(target)}-{uuid.uuid4().hex}"
    if not isinstance(system, (fs.LocalFileSystem, fs.HadoopFileSystem)):
        raise ValueError("this file system cannot refuse to replace a file; use the append functions")
    with system.open_output_stream(draft) as stream:
        stream.write(text.encode())
    try:
        if isinstance(system, fs.LocalFileSystem):
            os.link(draft, target)
        else:
            system.move(draft, target)
    except OSError:
        if not system.get_file_info(target).is_file:
            raise
        return False
    finally:
        if system.get_file_info(draft).is_file:
            system.delete_file(draft)
    return True


def publish(basin: str, append_id: str, batch: str = "") -> int:
    """Give an append the next commit number, noting the batch that it holds."""
    index = LogIndex(basin)
    index.refresh()
    number, text = index.commit + 1, f"{append_id}\n{batch}" if batch else append_id
    while not _publish_as(basin, number, text):
        number += 1
    return number


def drop_records(basin: str, messages: list) -> None:
    """Delete what tasks have reported."""
    for task in messages:
        if task:
            system, path = open_path(append_path(records_path(basin), task.folder))
            if system.get_file_info(path).type == fs.FileType.Directory:
                system.delete_dir(path)


def commit(options: SinkOptions, messages: list, batch: str = "") -> int:
    """Publish what all tasks have written as one append."""
    append_id = f"{options.writer}-{uuid.uuid4().hex}"
    list_files(options.basin, append_id, [task for task in messages if task])
    return publish(options.basin, append_id, batch)


class SeqLogWriter(DataSourceArrowWriter):
    """One append."""

    def __init__(self, options: SinkOptions):
        self.options = options

    def write(self, iterator) -> Written:
        return write_records(self.options, iterator)

    def commit(self, messages: list) -> None:
        commit(self.options, messages)

    def abort(self, messages: list) -> None:
        drop_records(self.options.basin, messages)


class SeqLogStreamWriter(DataSourceStreamArrowWriter):
    """An append per micro-batch, known by writer and batch id: a batch that runs again adds nothing."""

    def __init__(self, options: SinkOptions):
        self.options = options

    def write(self, iterator) -> Written:
        return write_records(self.options, iterator)

    def _batch(self, batch_id: int) -> str:
        return f"{self.options.writer}-{batch_id:012d}"

    def commit(self, messages: list, batchId: int) -> None:
        if self._published(batchId):
            drop_records(self.options.basin, messages)
        else:
            self._note(self._batch(batchId), commit(self.options, messages, self._batch(batchId)))

    def _note(self, batch: str, number: int) -> None:
        system, path = open_path(published_path(self.options.basin, batch))
        with system.open_output_stream(path) as stream:
            stream.write(json.dumps(number).encode())

    def _published(self, batch_id: int) -> bool:
        """Whether the batch is noted, or was published after the batch before it and not noted."""
        system, path = open_path(published_path(self.options.basin, self._batch(batch_id)))
        if system.get_file_info(path).is_file:
            return True
        system, path = open_path(published_path(self.options.basin, self._batch(batch_id - 1)))
        number = 0
        if batch_id and system.get_file_info(path).is_file:
            number = json.loads(system.open_input_file(path).read()) + 1
        while True:
            system, path = open_path(commit_path(self.options.basin, number))
            if not system.get_file_info(path).is_file:
                return False
            if system.open_input_file(path).read().decode().split("\n")[1:] == [self._batch(batch_id)]:
                self._note(self._batch(batch_id), number)
                return True
            number += 1

    def abort(self, messages: list, batchId: int) -> None:
        drop_records(self.options.basin, messages)
