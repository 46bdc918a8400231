"""Numbers and texts of a block as compressed binary values, and rows that are dealt into buckets."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

KINDS = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<string>": pa.list_(pa.string())}


def arrow_schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, KINDS[kind]) for name, kind in (field.split() for field in ddl.split(","))])


def packed(values: np.ndarray) -> bytes:
    """Numbers by planes of their bytes, compressed: high bytes that agree take no room."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, n: int, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data, n * width, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(kind).ravel()


def all_unpacked(column: pa.ChunkedArray, sizes: list[int], kind: type) -> np.ndarray:
    parts = [unpacked(data, n, kind) for data, n in zip(column.to_pylist(), sizes, strict=True)]
    return np.concatenate(parts) if parts else np.empty(0, kind)


def packed_texts(texts: list, kind: pa.DataType | None = None) -> bytes:
    """Texts and nulls, or octets, as one compressed value."""
    column = pa.RecordBatch.from_arrays([pa.array(texts, kind or pa.string())], names=["text"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, column.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(column)
    return sink.getvalue().to_pybytes()


def unpacked_texts(data: bytes) -> list:
    return pa.ipc.open_stream(data).read_all().column("text").to_pylist()


def runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Begin and end of every run of equal values."""
    if len(values):
        edges = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
        yield from zip(edges, edges[1:], strict=False)


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Which of `buckets` equal ranges each hash lies in, so sorted hashes have sorted buckets."""
    if buckets >= 1 << 32:
        raise ValueError("hashes are dealt by their upper 32 bits")
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def whole_buckets(batches: Iterator[pa.RecordBatch], elements: int) -> Iterator[pa.Table]:
    """Rows sorted by `bucket`, with `n` elements each, as tables of some `elements` that cut no bucket."""
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += pc.sum(batch.column("n")).as_py()
        if size < elements:
            continue
        rows, size = pa.Table.from_batches(held), 0
        bucket = rows.column("bucket")
        cut = pc.index(bucket, bucket[-1]).as_py()
        if cut:
            yield rows.slice(0, cut)
        held = rows.slice(cut).to_batches()
    if held:
        yield pa.Table.from_batches(held)
