"""Appending records to streams with contiguous, ordered positions."""

import re
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqlog.functions.plan import computed_once
from seqlog.functions.records import HEADER_TYPE, metered_bytes
from seqlog.operators.batching import MAX_RECORD_BYTES, checked
from seqlog.operators.changelog import compact_upserts, upsert_encode
from seqlog.operators.numbering import ordered
from seqlog.plans.staging import child_names, write_once
from seqlog.sources.basin import (
    FILES_SCHEMA,
    FOLD_EVERY,
    append_path,
    declared_streams,
    files_path,
    fold,
    is_published,
    publish,
    published_path,
    records_path,
    streams_path,
)

MAX_FILE_RECORDS = 1_000_000


def append_name(writer: str, batch_id: int | None = None) -> str:
    """Name of an append: that of a batch id is the same each time, one without is new."""
    return f"{writer}-{uuid.uuid4().hex}" if batch_id is None else f"{writer}-{batch_id:012d}"


def append_to_streams(
    df: DataFrame,
    basin: str,
    route: Column | str,
    order_by: list = (),
    writer: str = "batch",
    batch_id: int | None = None,
    max_record_bytes: int = MAX_RECORD_BYTES,
) -> str:
    """Append records (`headers`, `body`) to the streams named by `route`; returns the append's name.

    Positions continue each stream's tail, gap-free and ascending by `order_by` (arrival order
    without one). Many tasks write one stream, and every record is written once. Appends with a batch id
    are known by writer and batch id: repeating a published one adds nothing, repeating a broken one
    replaces what it left. Appends at the same time follow each other in the order of their publication.
    A record above `max_record_bytes` fails the append.
    """
    spark = df.sparkSession
    checked("max_record_bytes", max_record_bytes, 1, MAX_RECORD_BYTES)
    if not re.fullmatch(r"[A-Za-z0-9_.]+", writer):
        raise ValueError(f"writer must be letters, digits, _ and . only, not {writer!r}")
    append_id = append_name(writer, batch_id)
    if batch_id is not None and is_published(spark, basin, append_id):
        return append_id

    stream = F.col(route) if isinstance(route, str) else route
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    order_names = [f"_order{i}" for i in range(len(order))]
    rows = df.select(
        stream.cast("string").alias("stream"),
        F.col("headers").cast(f"array<{HEADER_TYPE.simpleString()}>").alias("headers"),
        F.col("body").cast("binary").alias("body"),
        *[c.alias(n) for c, n in zip(order, order_names)],
    )
    # The size check must not make Spark encode every record a second time.
    rows = computed_once(rows, [], {name: F.col(name) for name in rows.columns})
    problem = F.when(
        F.coalesce(F.col("stream"), F.lit("")) == "", F.lit("record without a stream")
    ).when(
        metered_bytes() > F.lit(max_record_bytes),
        F.concat(F.lit("record over the size limit in "), F.col("stream")),
    )
    sound = F.when(problem.isNull(), F.lit(True)).otherwise(
        F.raise_error(problem).cast("boolean")
    )
    target = append_path(records_path(basin), append_id)
    (
        ordered(rows.where(sound), ["stream"], order_names)
        .select("stream", "headers", "body")
        .write.mode("overwrite")
        .option("maxRecordsPerFile", MAX_FILE_RECORDS)
        .partitionBy("stream")
        .parquet(target)
    )
    _list_files(df, basin, append_id, target)
    number = publish(spark, basin, append_id)
    if batch_id is not None:
        write_once(spark, published_path(basin, append_id), str(number))
    if (number + 1) % FOLD_EVERY == 0:
        fold(spark, basin, number)
    return append_id


def _list_files(df: DataFrame, basin: str, append_id: str, target: str) -> None:
    """Write the append's table of files; their footers are read, no record is."""
    spark = df.sparkSession
    name = F.col("_metadata.file_name")
    found = spark.read.schema("stream string").parquet(target).groupBy("stream", name.alias("file")).agg(
        F.count("*").alias("records")
    )
    # Files are named by task, and by number within a task that cut its share.
    part = F.regexp_extract("file", r"^part-(\d+)", 1).cast("bigint")
    cut = F.regexp_extract("file", r"\.c(\d+)\.", 1).cast("bigint")
    files = found.withColumn("place", part * 1_000_000 + cut).withColumn("folder", F.lit(append_id))
    if any(child.endswith(".parquet") for child in child_names(spark, streams_path(basin))):
        begins = declared_streams(spark, basin).groupBy("stream").agg(F.max_by("first_seq", "version").alias("origin"))
        files = files.join(begins, "stream", "left")
    else:
        files = files.withColumn("origin", F.lit(0).cast("bigint"))
    files = files.withColumn("origin", F.coalesce("origin", F.lit(0).cast("bigint")))
    files = files.withColumn("append_ts", F.lit(datetime.now(timezone.utc)))
    files.select(*FILES_SCHEMA.names).write.mode("overwrite").parquet(append_path(files_path(basin), append_id))


def append_to_stream(df: DataFrame, basin: str, stream: str, **options) -> str:
    """append_to_streams with a single target stream."""
    if not basin or not stream:
        raise ValueError("the sink needs a basin and a stream")
    return append_to_streams(df, basin, F.lit(stream), **options)


def write_upserts(
    df: DataFrame,
    basin: str,
    stream: str,
    keys: list[str],
    columns: list[str] | None = None,
    kind: str = "_kind",
    order_by: list[str] = (),
    **options,
) -> str:
    """Encode changes, keep the last one per key of this append, and append them in order.

    Without `order_by` the arrival order decides which change is the last. An `order_by` column is
    not stored unless `columns` names it.
    """
    order = list(order_by)
    declared = columns or [c for c in df.columns if c != kind and c not in order]
    last = last_changes(df, keys, declared, kind, order)
    return append_to_stream(last, basin, stream, order_by=["_place"], **options)


def last_changes(
    df: DataFrame, keys: list[str], columns: list[str], kind: str = "_kind", order: list[str] = ()
) -> DataFrame:
    """Changes as records, the last one per key, with their `_place` in `order` or else in order of arrival."""
    if not order:
        df, order = df.withColumn("_arrival", F.monotonically_increasing_id()), ["_arrival"]
    place_of = df.withColumn("_place", F.struct(*order))
    encoded = upsert_encode(place_of, keys, columns, kind, keep=["_place"])
    return compact_upserts(encoded, order="_place")


def append_sink(
    basin: str, route: Column | str, writer: str, encode: Callable | None = None, **options
) -> Callable[[DataFrame, int], None]:
    """foreachBatch function appending every micro-batch once, by its batch id."""

    def write(df: DataFrame, batch_id: int) -> None:
        records = encode(df) if encode else df
        name = query_writer(df, writer)
        append_to_streams(records, basin, route, writer=name, batch_id=batch_id, **options)

    return write


def query_writer(df: DataFrame, writer: str) -> str:
    """The writer's name within the streaming query that runs this micro-batch.

    Batch ids count within a query: a query with a new checkpoint starts at 0 again, and its batches
    must not be taken for those of another one. Outside of a streaming query the name stays.
    """
    query = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{writer}.{query.replace('-', '')}" if query else writer


def upsert_sink(
    basin: str, stream: str, keys: list[str], writer: str, **options
) -> Callable[[DataFrame, int], None]:
    """foreachBatch function for the upsert sink."""

    def write(df: DataFrame, batch_id: int) -> None:
        name = query_writer(df, writer)
        write_upserts(df, basin, stream, keys, writer=name, batch_id=batch_id, **options)

    return write


def fan_out(*sinks: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """foreachBatch function feeding several sinks from one computation of the micro-batch."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            for sink in sinks:
                sink(df, batch_id)
        finally:
            df.unpersist()

    return write
