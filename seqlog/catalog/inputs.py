"""Inputs of the registered queries, derived from the driver's tables by Spark."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqlog.functions.codec import parse_kv_events
from seqlog.functions.records import LOG_SCHEMA, no_headers
from seqlog.operators.changelog import upsert_encode
from seqlog.plans.session import configure
from seqlog.plans.staging import scratch_path
from seqlog.sinks.append import append_to_stream, append_to_streams
from seqlog.sources.basin import create_basin, declare_streams
from seqlog.sources.scan import finished_records

_basins: dict[tuple[str, str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, user_id, event_type, epoch_ms, k."""
    events = table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        "user_id",
        "event_type",
        F.unix_millis(F.col("ts").cast("timestamp")).alias("epoch_ms"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )


def kv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, stream, body): one delimited line per event, spread over ten host streams."""
    user = F.concat(F.lit("user="), F.col("user_id").cast("string"))
    time = F.concat(F.lit("epoch_ms="), F.col("epoch_ms").cast("string"))
    action = (
        F.when(F.col("event_type") == "view", F.lit("view"))
        .when(F.col("event_type") == "click", F.lit("cart"))
        .when(F.col("event_type") == "purchase", F.lit("buy"))
    )
    middle = (
        F.when(F.col("event_type") == "signup", F.concat(F.lit("search=q"), F.col("k") % 15))
        .when(
            action.isNotNull(),
            F.concat(F.lit("item="), F.col("k") % 20, F.lit(";action="), action),
        )
        .otherwise(F.lit("broken"))
    )
    return raw_events(spark, sf_dir).select(
        "event_id",
        F.concat(F.lit("host/000"), F.col("user_id") % 10).alias("stream"),
        F.concat_ws(";", user, middle, time).alias("body"),
    )


def stream_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host streams, plus one feature and one further host stream per supplier."""
    created = F.lit("2024-01-01 00:00:00").cast("timestamp")
    never = F.lit(None).cast("timestamp")
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("bigint").alias("k"))
    deleted = F.when(F.col("k") % 2 == 1, F.lit("2024-02-01 00:00:00").cast("timestamp"))
    trimmed = F.when(F.col("k") % 2 == 0, F.lit(5)).otherwise(F.lit(0)).cast("bigint")
    host = spark.range(10).select(F.col("id").alias("k"))
    return (
        host.select(
            F.concat(F.lit("host/000"), F.col("k")).alias("stream"),
            created.alias("created_at"),
            never.alias("deleted_at"),
            trimmed.alias("first_seq"),
        )
        .unionByName(
            suppliers.select(
                F.concat(F.lit("feature/s"), F.col("k")).alias("stream"),
                created.alias("created_at"),
                never.alias("deleted_at"),
                F.lit(0).cast("bigint").alias("first_seq"),
            )
        )
        .unionByName(
            suppliers.select(
                F.concat(F.lit("host/x"), F.col("k")).alias("stream"),
                created.alias("created_at"),
                deleted.alias("deleted_at"),
                F.lit(0).cast("bigint").alias("first_seq"),
            )
        )
    )


def scratch_basin(spark: SparkSession, label: str) -> str:
    return create_basin(spark, scratch_path(configure(spark), label))


def _built(spark: SparkSession, sf_dir: str, label: str, fill: Callable[[str], None]) -> str:
    """A basin that queries only read: written once per session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _basins:
        basin = scratch_basin(spark, label)
        fill(basin)
        _basins[key] = basin
    return _basins[key]


def kv_appends(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Every event line as a record: the first three quarters, and the rest."""
    lines = kv_lines(spark, sf_dir)
    last = lines.agg(F.max("event_id")).first()[0]
    appended = lines.select("event_id", "stream", "body", no_headers().alias("headers"))
    cut = F.col("event_id") <= F.lit(last * 3 // 4)
    return appended.where(cut), appended.where(~cut)


def kv_basin(spark: SparkSession, sf_dir: str) -> str:
    """A log holding every event line, written in two appends."""

    def fill(basin: str) -> None:
        for batch, part in enumerate(kv_appends(spark, sf_dir)):
            append_to_streams(
                part, basin, "stream", order_by=["event_id"], writer="host", batch_id=batch
            )
        declare_streams(spark, basin, stream_listing(spark, sf_dir))

    return _built(spark, sf_dir, "kv", fill)


def kvlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finished_records(spark, kv_basin(spark, sf_dir))


def parsed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_kv_events(kvlog(spark, sf_dir))


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, custkey, status, pri, _kind): every order updates or deletes its customer's row."""
    gone = (F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 3 == 0)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
        F.col("o_custkey").cast("bigint").alias("custkey"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("pri"),
        F.when(gone, F.lit("-D")).otherwise(F.lit("+U")).alias("_kind"),
    )


CHANGE_STREAM = "orders/changes"
CHANGE_SCHEMA = T.StructType(
    [
        T.StructField("custkey", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("pri", T.StringType()),
    ]
)


def change_basin(spark: SparkSession, sf_dir: str) -> str:
    """A log with one encoded change per order, in order-key order, nothing compacted."""

    def fill(basin: str) -> None:
        changes = order_changes(spark, sf_dir)
        encoded = upsert_encode(changes, ["custkey"], CHANGE_SCHEMA.names, keep=["o_orderkey"])
        append_to_stream(encoded, basin, CHANGE_STREAM, order_by=["o_orderkey"])

    return _built(spark, sf_dir, "changes", fill)


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finished_records(spark, change_basin(spark, sf_dir)).select(*LOG_SCHEMA.names)


ORDER_STREAM = "orders/all"
ORDER_SCHEMA = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in ORDER_SCHEMA.fields]
    return table(spark, sf_dir, "orders").select(*columns)


def item_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item, query) of every event."""
    return raw_events(spark, sf_dir).select(
        (F.col("k") % 20).alias("item"),
        F.concat(F.lit("q"), F.col("user_id") % 15).alias("query"),
    )
