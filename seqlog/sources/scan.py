"""Bounded reads of the log: chosen streams, start positions, limits, progress."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqlog.functions.records import LOG_SCHEMA, metered_bytes
from seqlog.plans.staging import join_side
from seqlog.sources.basin import check_tail, list_streams, live_streams, located, positions, record_files, records
from seqlog.sources.options import NEXT, SourceOptions


def scan(
    spark: SparkSession, options: SourceOptions, resume: DataFrame | None = None
) -> DataFrame:
    """Records of the selected streams from their start positions, as LOG_SCHEMA.

    The files to read come from `positions`, by stream and start: a file that ends before the start is
    never opened, however many there are, and unpublished appends are never seen. `resume` holds
    (stream, next_seq); a stream in it starts there whatever the start behaviour, others start by
    `start_behavior`. The driver holds one entry per file, as Spark's own file listing does.
    """
    starts = start_positions(spark, options, resume).select("stream", "_start")
    files = positions(spark, options.basin).where(_selected(options))
    found = located(files.join(starts, "stream").where("next_seq > _start"), "_start")
    begin = {f.stream: f["_start"] for f in found}
    return record_files(spark, options.basin, found, begin).where(_selected(options)).select(*LOG_SCHEMA.names)


def finished_records(spark: SparkSession, basin: str) -> DataFrame:
    """Records of every published append, deleted and trimmed streams included."""
    return records(spark, basin)


def _selected(options: SourceOptions) -> Column:
    if options.streams:
        return F.col("stream").isin(*options.streams)
    return F.startswith("stream", F.lit(options.discovery_prefix))


def start_positions(
    spark: SparkSession, options: SourceOptions, resume: DataFrame | None = None
) -> DataFrame:
    """(stream, _start) for the fixed streams, or for the live ones with the prefix."""
    if options.streams:
        listing = list_streams(spark, options.basin).where(_selected(options))
    else:
        listing = live_streams(list_streams(spark, options.basin, options.discovery_prefix))
    if options.start_behavior == NEXT:
        tails = check_tail(spark, options.basin)
        begin = listing.join(tails, "stream").withColumnRenamed("next_seq", "_start")
    else:
        begin = listing.withColumn("_start", F.col("first_seq"))
    if resume is None:
        return begin
    begin = begin.join(resume.select("stream", "next_seq"), "stream", "left")
    if options.fail_on_data_loss:
        gap = F.coalesce(F.col("next_seq") < F.col("first_seq"), F.lit(False))
        message = F.concat(F.lit("records below the first retained position are gone: "), "stream")
        begin = begin.where(
            F.when(gap, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
        )
    return begin.withColumn("_start", F.coalesce("next_seq", "_start"))


def read_limited(
    rows: DataFrame, start: int, count: int, listing: DataFrame | None = None
) -> DataFrame:
    """The first `count` records of each stream from position `start` on.

    Where the stream is trimmed beyond `start`, they begin at the first retained position: that of
    `listing`, else the first one present. Positions are contiguous from there, so the limit is a range.
    """
    kept = rows.where(F.col("seq_num") >= start)
    if listing is None:
        begins = kept.groupBy("stream").agg(F.min("seq_num").alias("_from"))
    else:
        begins = listing.select("stream", F.greatest("first_seq", F.lit(start)).alias("_from"))
    inside = (F.col("seq_num") >= F.col("_from")) & (F.col("seq_num") < F.col("_from") + count)
    return join_side(kept, begins, ["stream"], "inner", F.col("seq_num")).where(inside).select(*rows.columns)


def detect_trim_gap(resume: DataFrame, listing: DataFrame) -> DataFrame:
    """Resume positions that point below the first retained record."""
    return (
        resume.join(listing.select("stream", "first_seq"), "stream")
        .where("next_seq < first_seq")
        .select("stream", "next_seq", "first_seq")
    )


def stream_progress(consumed: DataFrame) -> DataFrame:
    """Per stream: the next position, records and metered bytes consumed."""
    return consumed.groupBy("stream").agg(
        (F.max("seq_num") + 1).alias("next_seq"),
        F.count("*").alias("consumed_records"),
        F.sum(metered_bytes()).alias("consumed_bytes"),
    )


def observe_progress(log: DataFrame, name: str = "progress") -> DataFrame:
    """The same totals as a metric of every micro-batch, found in the query's progress."""
    return log.observe(
        name,
        F.count(F.lit(1)).alias("consumed_records"),
        F.coalesce(F.sum(metered_bytes()), F.lit(0)).alias("consumed_bytes"),
    )
