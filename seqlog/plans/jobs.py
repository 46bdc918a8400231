"""The event-analytics jobs: which queries lead to a purchase, and the best of them per item."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from seqlog.functions.codec import decode_with_context, encode_json, json_decode, parse_kv_events
from seqlog.operators.pattern import Sequence, match_sequence
from seqlog.operators.topk import top_k_lists
from seqlog.sinks.append import append_sink, upsert_sink
from seqlog.sources.datasource import read_stream
from seqlog.sources.options import SourceOptions
from seqlog.streaming.matcher import match_sequence_stream, matches_only
from seqlog.streaming.slices import flagged_groups, match_slices
from seqlog.streaming.topk import changed_counts, top_k_changes, top_k_stream

# Fixed values of the analytics job.
EVENT_PREFIX = "host/"
ROLLUP_STREAM = "rollup/converting-queries-per-item"
FEATURE_STREAM = "feature/top-5-converting-queries-per-item"
WITHIN_MS = 10 * 60 * 1000
LATENESS = "5 seconds"
LATENESS_MS = 5_000
TRIGGER = "5 seconds"
REDISCOVERY_MS = 30_000
TOP_K = 5

CONVERSION_SCHEMA = T.StructType(
    [
        T.StructField("userId", T.LongType()),
        T.StructField("matchedSearchQuery", T.StringType()),
        T.StructField("matchedItemId", T.LongType()),
    ]
)
FEATURE_SCHEMA = T.StructType(
    [
        T.StructField("item", T.LongType()),
        T.StructField("top_queries", T.ArrayType(T.StringType())),
    ]
)


def conversion_sequence(
    within_ms: int = WITHIN_MS, inclusive: bool = False, same_item: bool = False
) -> Sequence:
    """Search, view, cart, buy on adjacent events; optionally on one and the same item."""
    return Sequence(
        steps=(
            ("A", "action = 'search'"),
            ("B", "action = 'view'"),
            ("C", "action = 'cart'"),
            ("D", "action = 'buy'"),
        ),
        measures={"matchedSearchQuery": ("A", "query"), "matchedItemId": ("D", "item_id")},
        within_ms=within_ms,
        inclusive=inclusive,
        same=("item_id",) if same_item else (),
        over=("B", "C", "D") if same_item else (),
    )


def as_conversions(matches: DataFrame) -> DataFrame:
    """Sink columns and types; a match without a query or item does not fit the schema."""
    return matches.where("matchedSearchQuery IS NOT NULL AND matchedItemId IS NOT NULL").select(
        F.col("user_id").cast("bigint").alias("userId"),
        "matchedSearchQuery",
        F.col("matchedItemId").cast("bigint").alias("matchedItemId"),
    )


def conversions(events: DataFrame, sequence: Sequence | None = None) -> DataFrame:
    return as_conversions(match_sequence(events, sequence or conversion_sequence(), ["user_id"]))


def features(converted: DataFrame, k: int = TOP_K) -> DataFrame:
    lists = top_k_lists(converted, "matchedItemId", "matchedSearchQuery", k, "top_queries")
    return lists.withColumnRenamed("matchedItemId", "item")


def conversions_stream(
    logs: list[DataFrame], sequence: Sequence | None = None, lateness: str = LATENESS
) -> DataFrame:
    events = [parse_kv_events(log) for log in logs]
    found = match_sequence_stream(
        events, sequence or conversion_sequence(), ["user_id"], lateness=lateness
    )
    return as_conversions(matches_only(found))


def features_stream(converted: DataFrame, k: int = TOP_K) -> DataFrame:
    lists = top_k_stream(converted, "matchedItemId", "matchedSearchQuery", k, "top_queries")
    return lists.withColumnRenamed("matchedItemId", "item")


def _start(writer: DataStreamWriter, checkpoint: str, trigger: str | None) -> StreamingQuery:
    if trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.option("checkpointLocation", checkpoint).start()


def drain(query: StreamingQuery) -> None:
    """Process everything there is, let the watermark advance over it, and stop.

    The available-now trigger ends before the empty batch that fires the last timers.
    """
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def start_conversions(
    spark: SparkSession,
    basin: str,
    checkpoint: str,
    sequence: Sequence | None = None,
    lateness_ms: int = LATENESS_MS,
    trigger: str | None = TRIGGER,
    max_records_per_stream: int | None = None,
    prefixes: tuple[str, ...] = (EVENT_PREFIX,),
) -> StreamingQuery:
    """Event streams to the rollup stream. Each prefix is a group with a watermark of its own.

    Rows that can still be part of a match are kept under the checkpoint, in `slices`.
    """
    sequence = sequence or conversion_sequence()
    logs = [
        read_stream(
            spark,
            SourceOptions(
                basin,
                discovery_prefix=prefix,
                discovery_interval_ms=REDISCOVERY_MS,
                max_records_per_stream=max_records_per_stream,
                available_now=False,
            ),
        )
        for prefix in prefixes
    ]
    rows = flagged_groups([parse_kv_events(log) for log in logs], sequence, ["user_id"])
    append = append_sink(
        basin, F.lit(ROLLUP_STREAM), "conversions", lambda found: encode_json(as_conversions(found))
    )
    slices = match_slices(
        append, f"{checkpoint}/slices", sequence, ["user_id"], len(logs), lateness_ms=lateness_ms
    )
    return _start(rows.writeStream.foreachBatch(slices), checkpoint, trigger)


def start_features(
    spark: SparkSession,
    basin: str,
    checkpoint: str,
    k: int = TOP_K,
    trigger: str | None = TRIGGER,
    max_records_per_stream: int | None = None,
) -> StreamingQuery:
    """Rollup stream to the upsert stream of best queries per item.

    Counts are state of Spark's aggregation; the lists are kept under the checkpoint, in `lists`.
    """
    source = SourceOptions(
        basin,
        streams=(ROLLUP_STREAM,),
        max_records_per_stream=max_records_per_stream,
        available_now=False,
    )
    converted = json_decode(read_stream(spark, source).select("body"), CONVERSION_SCHEMA)
    sink = upsert_sink(basin, FEATURE_STREAM, ["item"], "features")
    lists = top_k_changes(sink, f"{checkpoint}/lists", "item", k, "top_queries")
    counts = changed_counts(converted, "matchedItemId", "matchedSearchQuery")
    return _start(counts.writeStream.outputMode("update").foreachBatch(lists), checkpoint, trigger)


def start_context_print(
    spark: SparkSession, source: SourceOptions, checkpoint: str, trigger: str | None = TRIGGER
) -> StreamingQuery:
    """Print every record with its stream and position."""
    decoded = decode_with_context(read_stream(spark, source))
    writer = decoded.writeStream.format("console").option("truncate", "false")
    return _start(writer, checkpoint, trigger)
