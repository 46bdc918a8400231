"""Small builders shared by the tests."""

from datetime import datetime, timezone

from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqlog.functions.records import LOG_SCHEMA, STREAMS_SCHEMA, no_headers
from seqlog.sinks.append import append_to_streams
from seqlog.sources.basin import declare_streams

EPOCH = datetime(2024, 1, 1, tzinfo=timezone.utc)


def log_frame(spark, bodies, stream="s", headers=None):
    """LOG_SCHEMA rows from texts, numbered from 0."""
    rows = [
        (
            stream,
            i,
            [(bytearray(n.encode()), bytearray(v.encode())) for n, v in (headers[i] if headers else [])],
            None if body is None else bytearray(body.encode() if isinstance(body, str) else body),
            EPOCH,
        )
        for i, body in enumerate(bodies)
    ]
    return spark.createDataFrame(rows, LOG_SCHEMA)


def append_lines(spark, basin, lines, writer="test", batch_id=None):
    """Append (stream, body) pairs in the given order."""
    schema = T.StructType(
        [
            T.StructField("at", T.LongType()),
            T.StructField("stream", T.StringType()),
            T.StructField("body", T.StringType()),
        ]
    )
    rows = [(i, stream, body) for i, (stream, body) in enumerate(lines)]
    frame = spark.createDataFrame(rows, schema)
    encoded = frame.select(
        "at", "stream", F.col("body").cast("binary").alias("body"), no_headers().alias("headers")
    )
    return append_to_streams(
        encoded, basin, "stream", order_by=["at"], writer=writer, batch_id=batch_id
    )


def declare(spark, basin, *entries):
    """entries: (stream, deleted, first_seq)."""
    rows = [(s, EPOCH, EPOCH if deleted else None, first) for s, deleted, first in entries]
    declare_streams(spark, basin, spark.createDataFrame(rows, STREAMS_SCHEMA))


def pairs(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())
