"""One query per operator, over the driver's tables."""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqlog.catalog import inputs
from seqlog.functions.codec import (
    custom_encode,
    decode_text,
    decode_with_context,
    encode_json,
    event_time,
    flat_decode,
    json_decode,
    parse_kv_events,
    parse_kv_rejects,
)
from seqlog.functions.records import action_to_kind, header, metered_bytes
from seqlog.operators.batching import batches_by_bytes, batches_by_count, oversize_records
from seqlog.operators.changelog import (
    assert_insert_only,
    compact_upserts,
    is_insert,
    materialize_latest,
    materialize_updates_only,
    normalize_changelog,
    project_key_value,
    upsert_decode,
    upsert_encode,
    with_key_action,
)
from seqlog.operators.lateness import late_rows
from seqlog.operators.numbering import number_rows
from seqlog.operators.pattern import Sequence, match_sequence, match_sequence_dense, reconcile
from seqlog.operators.topk import count_by, rank_by_count, top_k, top_k_lists
from seqlog.plans.jobs import (
    CONVERSION_SCHEMA,
    FEATURE_SCHEMA,
    FEATURE_STREAM,
    ROLLUP_STREAM,
    conversion_sequence,
    conversions,
    drain,
    start_conversions,
    start_features,
)
from seqlog.plans.session import configure
from seqlog.plans.staging import scratch_path, stage
from seqlog.plans.tables import UPSERT, LogTable, Tables
from seqlog.sinks.append import append_to_stream, append_to_streams, write_upserts
from seqlog.sources.basin import check_tail, list_streams, live_streams, new_streams
from seqlog.sources.datasource import register
from seqlog.sources.options import NEXT, SourceOptions
from seqlog.sources.scan import (
    detect_trim_gap,
    read_limited,
    scan,
    start_positions,
    stream_progress,
)

DAY_MS = 24 * 60 * 60 * 1000
TIME_TEXT = "yyyy-MM-dd HH:mm:ss.SSS"

Query = Callable[[SparkSession, str], DataFrame]


def _text(column: str = "body") -> Column:
    return F.col(column).cast("string")


def _lines(log: DataFrame) -> DataFrame:
    return log.select("stream", "seq_num", _text().alias("body"))


# --- scans --------------------------------------------------------------------------------------


def scan_static_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    basin = inputs.kv_basin(spark, sf_dir)
    return _lines(scan(spark, SourceOptions(basin, ("host/0000", "host/0003", "host/0000"))))


def scan_prefix_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    basin = inputs.kv_basin(spark, sf_dir)
    return _lines(scan(spark, SourceOptions(basin, discovery_prefix="host/")))


def _listing(frame: DataFrame) -> DataFrame:
    return frame.select(
        "stream",
        F.date_format("created_at", TIME_TEXT).alias("created_at"),
        F.date_format("deleted_at", TIME_TEXT).alias("deleted_at"),
        "first_seq",
    )


def list_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listing(list_streams(spark, inputs.kv_basin(spark, sf_dir))).orderBy("stream")


def list_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = list_streams(spark, inputs.kv_basin(spark, sf_dir))
    return _listing(live_streams(listing)).orderBy("stream")


def discover_new_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = list_streams(spark, inputs.kv_basin(spark, sf_dir))
    known = listing.where(F.regexp_extract("stream", "([0-9]+)$", 1).cast("bigint") % 2 == 0)
    return new_streams(listing, known).select("stream", "first_seq")


def scan_start_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    basin = inputs.kv_basin(spark, sf_dir)
    rows = scan(spark, SourceOptions(basin, discovery_prefix="host/000", start_behavior="FIRST"))
    return rows.groupBy("stream").agg(
        F.min("seq_num").alias("first_read"), F.count("*").alias("records")
    )


def scan_start_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reader with NEXT starts between two appends: its positions are pinned then, and it gets the second."""
    basin = inputs.scratch_basin(spark, "next")
    first, second = inputs.kv_appends(spark, sf_dir)
    append_to_streams(first, basin, "stream", order_by=["event_id"])
    source = SourceOptions(basin, discovery_prefix="host/000", start_behavior=NEXT)
    pinned, _ = stage(start_positions(spark, source).select("stream", "_start"), "pinned")
    append_to_streams(second, basin, "stream", order_by=["event_id"])
    return _lines(scan(spark, source, resume=pinned.withColumnRenamed("_start", "next_seq")))


def _halfway(spark: SparkSession, basin: str) -> DataFrame:
    tails = check_tail(spark, basin)
    return tails.where("next_seq > 0").select("stream", F.expr("next_seq DIV 2").alias("next_seq"))


def scan_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    basin = inputs.kv_basin(spark, sf_dir)
    source = SourceOptions(basin, discovery_prefix="host/", fail_on_data_loss=False)
    return _lines(scan(spark, source, resume=_halfway(spark, basin)))


def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    basin = inputs.kv_basin(spark, sf_dir)
    source = SourceOptions(basin, discovery_prefix="host/", fail_on_data_loss=False)
    return stream_progress(scan(spark, source, resume=_halfway(spark, basin)))


def tails(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_tail(spark, inputs.kv_basin(spark, sf_dir))


def limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(read_limited(inputs.kvlog(spark, sf_dir), 10, 5))


def trim_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = list_streams(spark, inputs.kv_basin(spark, sf_dir))
    resume = listing.select("stream", (F.length("stream") % 7).cast("bigint").alias("next_seq"))
    return detect_trim_gap(resume, listing)


# --- decoding and encoding ----------------------------------------------------------------------


def text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_text(inputs.kvlog(spark, sf_dir))


def text_with_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_with_context(inputs.kvlog(spark, sf_dir))


def split_pieces(batches: Iterator) -> Iterator:
    """User decoder: one row per piece of a line."""
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        pieces = pc.split_pattern(batch.column("body").cast(pa.string()), ";")
        parent = pc.list_parent_indices(pieces)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("stream").take(parent),
                batch.column("seq_num").take(parent),
                pc.list_flatten(pieces),
            ],
            names=["stream", "seq_num", "piece"],
        )


def pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = inputs.kvlog(spark, sf_dir)
    return flat_decode(log, split_pieces, "stream string, seq_num bigint, piece string")


def props(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.table(spark, sf_dir, "events").select("event_id", "props")
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    return json_decode(events, schema, on_error="fail", text="props").select("event_id", "k")


def encode_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.order_rows(spark, sf_dir)
    encoded = encode_json(rows, rows.columns, keep=["o_orderkey"])
    return encoded.select(
        "o_orderkey", F.size("headers").cast("bigint").alias("n_headers"), _text().alias("body")
    )


def encode_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    @F.pandas_udf("string")
    def line(key: pd.Series, status: pd.Series) -> pd.Series:
        return "customer " + key.astype("string") + " " + status.str.lower()

    rows = inputs.order_rows(spark, sf_dir)
    encoded = custom_encode(
        rows,
        line("o_custkey", "o_orderstatus"),
        F.array(header("priority", F.col("o_orderpriority"))),
        keep=["o_orderkey"],
    )
    return encoded.select(
        "o_orderkey",
        _text().alias("body"),
        F.col("headers")[0]["name"].cast("string").alias("header_name"),
        F.col("headers")[0]["value"].cast("string").alias("header_value"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_kv_events(inputs.kvlog(spark, sf_dir))


def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_kv_rejects(inputs.kvlog(spark, sf_dir))


def event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = inputs.parsed_events(spark, sf_dir)
    return parsed.select(
        "stream", "seq_num", F.date_format(event_time(), TIME_TEXT).alias("event_time")
    )


# --- changelog ----------------------------------------------------------------------------------


def key_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = inputs.order_changes(spark, sf_dir).select("o_orderkey", "custkey", "status", "pri")
    split = project_key_value(changes, ["custkey", "o_orderkey"])
    return split.select(
        F.to_json("key").alias("key"), F.to_json("value").alias("value")
    )


def encode_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = inputs.order_changes(spark, sf_dir)
    encoded = upsert_encode(
        changes, ["custkey"], inputs.CHANGE_SCHEMA.names, keep=["o_orderkey"]
    )
    return encoded.select(
        "o_orderkey",
        F.col("headers")[0]["name"].cast("string").alias("first_header"),
        F.col("headers")[0]["value"].cast("string").alias("key"),
        F.col("headers")[1]["name"].cast("string").alias("second_header"),
        F.col("headers")[1]["value"].cast("string").alias("action"),
        _text().alias("body"),
    )


def key_and_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_key_action(inputs.change_log(spark, sf_dir))
    return found.select("seq_num", _text("_key").alias("key"), F.col("_action").alias("action"))


def kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_key_action(inputs.change_log(spark, sf_dir))
    return found.select("seq_num", action_to_kind().alias("kind"))


def _as_kind(frame: DataFrame) -> DataFrame:
    return frame.withColumnRenamed("_kind", "kind")


def decode_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = inputs.change_log(spark, sf_dir)
    return _as_kind(upsert_decode(log, inputs.CHANGE_SCHEMA, ["custkey"], keep=["seq_num"]))


def compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = inputs.change_log(spark, sf_dir)
    batched = log.withColumn("append_batch", F.expr("seq_num DIV 1000"))
    last = compact_upserts(batched, batch="append_batch")
    found = with_key_action(last)
    return found.select(
        "append_batch", "seq_num", _text("_key").alias("key"), _text().alias("body")
    )


def _kinds_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    which = F.col("o_orderkey") % 4
    kind = (
        F.when(which == 0, F.lit("+I"))
        .when(which == 1, F.lit("-U"))
        .when(which == 2, F.lit("+U"))
        .otherwise(F.lit("-D"))
    )
    return inputs.order_rows(spark, sf_dir).select("o_orderkey", kind.alias("_kind"))


def insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inserts go through the guard, which would fail on any other kind."""
    rows = _kinds_of_orders(spark, sf_dir)
    passed = assert_insert_only(rows.where(is_insert())).withColumn("_kind", F.lit("+I"))
    others = rows.where(~is_insert())
    return _as_kind(
        passed.withColumn("accepted", F.lit(True)).unionByName(others.withColumn("accepted", F.lit(False)))
    )


def normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = normalize_changelog(_kinds_of_orders(spark, sf_dir))
    return changes.withColumnRenamed("_action", "action")


def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize_latest(inputs.change_log(spark, sf_dir), inputs.CHANGE_SCHEMA, ["custkey"])


def updates_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = inputs.change_log(spark, sf_dir)
    return materialize_updates_only(log, inputs.CHANGE_SCHEMA, ["custkey"]).orderBy("custkey")


def as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = inputs.change_log(spark, sf_dir)
    return materialize_latest(log, inputs.CHANGE_SCHEMA, ["custkey"], until=10_000)


# --- sinks and tables ---------------------------------------------------------------------------


def append_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    basin = inputs.scratch_basin(spark, "append")
    rows = inputs.order_rows(spark, sf_dir)
    encoded = encode_json(rows, rows.columns, keep=["o_orderkey"])
    append_to_stream(encoded, basin, inputs.ORDER_STREAM, order_by=["o_orderkey"])
    log = scan(spark, SourceOptions(basin, (inputs.ORDER_STREAM,)))
    return json_decode(log.select("seq_num", "body"), inputs.ORDER_SCHEMA)


def upsert_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    basin = inputs.scratch_basin(spark, "upsert")
    changes = inputs.order_changes(spark, sf_dir)
    write_upserts(
        changes,
        basin,
        inputs.CHANGE_STREAM,
        ["custkey"],
        inputs.CHANGE_SCHEMA.names,
        order_by=["o_orderkey"],
    )
    log = scan(spark, SourceOptions(basin, (inputs.CHANGE_STREAM,)))
    return _as_kind(upsert_decode(log, inputs.CHANGE_SCHEMA, ["custkey"], keep=["seq_num"]))


def _order_table(basin: str) -> LogTable:
    return LogTable(
        inputs.ORDER_SCHEMA, options={"basin": basin}, stream=inputs.ORDER_STREAM
    )


def sql_insert_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    basin = inputs.scratch_basin(spark, "table")
    inputs.order_rows(spark, sf_dir).createOrReplaceTempView("orders_input")
    tables = Tables(spark)
    tables.create("orders_log", _order_table(basin))
    for status in ("IN ('O', 'P')", "NOT IN ('O', 'P')"):
        tables.insert_into(
            "orders_log", f"SELECT * FROM orders_input WHERE o_orderstatus {status}"
        )
    return spark.sql("SELECT * FROM orders_log")


def sql_scan_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain SQL over the registered source: a log of inserts, written by SQL and scanned whole."""
    register(configure(spark))
    basin = inputs.scratch_basin(spark, "inserts")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY VIEW order_records USING seqlog "
        f"OPTIONS (basin '{basin}', stream '{inputs.ORDER_STREAM}')"
    )
    inputs.order_rows(spark, sf_dir).createOrReplaceTempView("orders_input")
    spark.sql(
        "INSERT INTO order_records (body) SELECT CAST(to_json(struct(o_orderkey, o_orderstatus)) AS BINARY)"
        " FROM orders_input ORDER BY o_orderkey"
    )
    return spark.sql(
        "SELECT seq_num, r.o_orderkey, r.o_orderstatus FROM (SELECT seq_num,"
        " from_json(CAST(body AS STRING), 'o_orderkey BIGINT, o_orderstatus STRING') AS r FROM order_records)"
    )


def _change_table(basin: str) -> LogTable:
    return LogTable(
        inputs.CHANGE_SCHEMA,
        connector=UPSERT,
        options={"basin": basin},
        stream=inputs.CHANGE_STREAM,
        keys=("custkey",),
    )


def sql_insert_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    basin = inputs.scratch_basin(spark, "upsert-table")
    inputs.order_changes(spark, sf_dir).createOrReplaceTempView("changes_input")
    tables = Tables(spark)
    tables.create("changes_log", _change_table(basin))
    for parity in (0, 1):
        tables.insert_into(
            "changes_log",
            f"SELECT * FROM changes_input WHERE o_orderkey % 2 = {parity}",
            order_by=["o_orderkey"],
        )
    return _as_kind(spark.sql("SELECT * FROM changes_log"))


def sql_scan_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Tables(configure(spark))
    tables.create("changes", _change_table(inputs.change_basin(spark, sf_dir)))
    return spark.sql("SELECT custkey, status, pri, _kind AS kind FROM changes")


def preserves_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    basin = inputs.scratch_basin(spark, "order")
    rows = inputs.order_rows(spark, sf_dir)
    encoded = custom_encode(
        rows, F.col("o_orderkey").cast("string"), keep=["o_custkey", "o_orderkey"]
    )
    append_to_stream(
        encoded, basin, inputs.ORDER_STREAM, order_by=["o_custkey", F.negative("o_orderkey")]
    )
    log = scan(spark, SourceOptions(basin, (inputs.ORDER_STREAM,)))
    return log.select("seq_num", _text().cast("bigint").alias("o_orderkey"))


def routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    basin = inputs.scratch_basin(spark, "route")
    rows = inputs.order_rows(spark, sf_dir)
    encoded = custom_encode(
        rows, F.col("o_orderkey").cast("string"), keep=["o_custkey", "o_orderkey"]
    )
    route = F.concat(F.lit("orders/"), F.col("o_custkey") % 4)
    append_to_streams(encoded, basin, route, order_by=["o_orderkey"])
    log = scan(spark, SourceOptions(basin, discovery_prefix="orders/"))
    return log.select("stream", "seq_num", _text().cast("bigint").alias("o_orderkey"))


def _numbered_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = inputs.table(spark, sf_dir, "documents").select(
        "doc_id",
        F.lit("documents").alias("stream"),
        F.octet_length("text").cast("bigint").alias("size"),
    )
    return number_rows(documents, ["stream"], ["doc_id"])


def by_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = _numbered_documents(spark, sf_dir)
    batched = batches_by_count(batches_by_count(numbered), 100, name="batch_of_100")
    return batched.select("doc_id", "append_batch", "batch_of_100")


def by_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    batched = batches_by_bytes(_numbered_documents(spark, sf_dir), "size", limit=65_536)
    return batched.select("doc_id", "append_block", "append_in_block")


def oversize(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = inputs.table(spark, sf_dir, "documents")
    sized = documents.select("doc_id", F.octet_length("text").cast("bigint").alias("size"))
    return oversize_records(sized, "size", 5_000)


def metering(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = F.array(header("lang", F.col("lang")), header("source", F.col("source")))
    documents = inputs.table(spark, sf_dir, "documents")
    encoded = custom_encode(documents, F.col("text"), headers, keep=["doc_id"])
    return encoded.select("doc_id", metered_bytes().alias("metered_bytes"))


# --- event time, sequences ----------------------------------------------------------------------


def late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 97th event arrives 600 places later; a hundred places make a micro-batch."""
    arrival = F.col("event_id") + F.when(F.col("event_id") % 97 == 0, 600).otherwise(0)
    rows = inputs.raw_events(spark, sf_dir).select(
        "event_id", "epoch_ms", arrival.alias("arrival")
    )
    batched = rows.withColumn("batch", F.expr("arrival DIV 100")).drop("arrival")
    return late_rows(batched, "batch")


def _matches(spark: SparkSession, sf_dir: str, sequence: Sequence) -> DataFrame:
    return conversions(inputs.parsed_events(spark, sf_dir), sequence)


def match_conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matches(spark, sf_dir, conversion_sequence(3 * DAY_MS))


def match_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matches(spark, sf_dir, conversion_sequence(DAY_MS))


def match_same_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View, cart and buy of one item; users come back to an item of their own in place of even ones."""
    rows = inputs.parsed_events(spark, sf_dir)
    item = F.when(F.col("item_id") % 2 == 0, F.col("user_id") % 20).otherwise(F.col("item_id"))
    sequence = conversion_sequence(30 * DAY_MS, same_item=True)
    return conversions(rows.withColumn("item_id", item.cast(rows.schema["item_id"].dataType)), sequence)


def match_generic(spark: SparkSession, sf_dir: str) -> DataFrame:
    sequence = Sequence(
        steps=(
            ("seen", "event_type = 'view'"),
            ("taken", "event_type = 'click'"),
            ("paid", "event_type = 'purchase'"),
        ),
        measures={"first_event": ("seen", "event_id"), "last_event": ("paid", "event_id")},
        within_ms=3 * DAY_MS,
    )
    rows = inputs.raw_events(spark, sf_dir)
    return match_sequence(rows, sequence, ["user_id"], ties=["event_id"])


def match_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The generic steps with a third of all users taken for one, cut by row number."""
    sequence = Sequence(
        steps=(
            ("seen", "event_type = 'view'"),
            ("taken", "event_type = 'click'"),
            ("paid", "event_type = 'purchase'"),
        ),
        measures={"first_event": ("seen", "event_id"), "last_event": ("paid", "event_id")},
        within_ms=3 * DAY_MS,
    )
    one = F.when(F.col("user_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id"))
    rows = inputs.raw_events(spark, sf_dir).withColumn("user_id", one)
    return match_sequence_dense(rows, sequence, ["user_id"], ties=["event_id"], dense_rows=200)


def stream_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversion job over the log of lines, read back from its output stream."""
    basin = inputs.scratch_basin(spark, "stream-match")
    lines = inputs.kv_lines(spark, sf_dir)
    encoded = custom_encode(lines, F.col("body"), keep=["stream", "event_id"])
    append_to_streams(encoded, basin, "stream", order_by=["event_id"])
    drain(
        start_conversions(
            spark,
            basin,
            scratch_path(spark, "checkpoint"),
            conversion_sequence(3 * DAY_MS),
            trigger=None,
        )
    )
    log = scan(spark, SourceOptions(basin, (ROLLUP_STREAM,)))
    return json_decode(log.select("body"), CONVERSION_SCHEMA)


def reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Found conversions against a doctored copy: a third left out, some with another item."""
    # Both sides read the matches: write them once.
    known, _ = stage(match_conversions(spark, sf_dir), "conversions")
    kept = known.where(F.col("userId") % 3 != 0)
    changed = F.when(F.col("userId") % 5 == 0, F.col("matchedItemId") + 100)
    doctored = kept.withColumn("matchedItemId", F.coalesce(changed, F.col("matchedItemId")))
    return reconcile(doctored, known)


# --- counts and ranks ---------------------------------------------------------------------------


def _item_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by(inputs.item_queries(spark, sf_dir), ["item", "query"])


def ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_by_count(_item_counts(spark, sf_dir), "item", "query")


def top5_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_item_counts(spark, sf_dir), "item", "query", 5)


def _joined(frame: DataFrame) -> DataFrame:
    return frame.withColumn("top_queries", F.array_join("top_queries", ","))


def top5_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(
        top_k_lists(inputs.item_queries(spark, sf_dir), "item", "query", 5, "top_queries")
    )


def stream_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature job over a rollup stream, folded to the current state of its upsert stream."""
    basin = inputs.scratch_basin(spark, "stream-top5")
    found = inputs.raw_events(spark, sf_dir).select(
        F.col("user_id").alias("userId"),
        F.concat(F.lit("q"), F.col("user_id") % 15).alias("matchedSearchQuery"),
        (F.col("k") % 20).alias("matchedItemId"),
    )
    append_to_stream(encode_json(found), basin, ROLLUP_STREAM)
    drain(start_features(spark, basin, scratch_path(spark, "checkpoint"), trigger=None))
    log = scan(spark, SourceOptions(basin, (FEATURE_STREAM,)))
    return _joined(materialize_latest(log, FEATURE_SCHEMA, ["item"]))


def sql_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs.item_queries(spark, sf_dir).createOrReplaceTempView("item_queries")
    return spark.sql(
        """
        WITH counted AS (
          SELECT item, query, count(*) AS n FROM item_queries GROUP BY item, query
        ), ranked AS (
          SELECT item, query, row_number() OVER (PARTITION BY item ORDER BY n DESC, query) AS rn
          FROM counted
        )
        SELECT item,
               array_join(transform(array_sort(collect_list(struct(rn, query))), p -> p.query), ',')
                 AS top_queries
        FROM ranked WHERE rn <= 5 GROUP BY item
        """
    )


QUERIES: dict[str, Query] = {
    "scan_static_streams": scan_static_streams,
    "scan_prefix_streams": scan_prefix_streams,
    "list_streams": list_all,
    "list_live_streams": list_live,
    "discover_new_streams": discover_new_streams,
    "scan_start_first": scan_start_first,
    "scan_start_next": scan_start_next,
    "scan_resume": scan_resume,
    "stream_progress": progress,
    "check_tail": tails,
    "read_limited": limited,
    "detect_trim_gap": trim_gap,
    "decode_text": text,
    "decode_with_context": text_with_context,
    "flat_decode": pieces,
    "json_decode": props,
    "append_encode_json": encode_rows,
    "custom_encode": encode_custom,
    "parse_kv_events": events,
    "parse_kv_rejects": rejects,
    "event_time_column": event_times,
    "project_key_value": key_value,
    "upsert_encode": encode_changes,
    "extract_key_action": key_and_action,
    "action_to_kind": kinds,
    "upsert_decode": decode_changes,
    "compact_upserts": compact,
    "insert_only_guard": insert_only,
    "normalize_changelog": normalize,
    "materialize_latest": latest,
    "materialize_updates_only": updates_only,
    "materialize_as_of": as_of,
    "append_roundtrip": append_roundtrip,
    "upsert_roundtrip": upsert_roundtrip,
    "sql_insert_append": sql_insert_append,
    "sql_scan_insert_only": sql_scan_insert_only,
    "sql_insert_upsert": sql_insert_upsert,
    "sql_scan_upsert": sql_scan_upsert,
    "append_preserves_order": preserves_order,
    "route_to_streams": routed,
    "append_batches_by_count": by_count,
    "append_batches_by_bytes": by_bytes,
    "oversize_records": oversize,
    "record_metering": metering,
    "late_rows": late,
    "match_conversions": match_conversions,
    "match_within_bound": match_within,
    "match_same_item": match_same_item,
    "match_generic_steps": match_generic,
    "match_dense_key": match_dense,
    "stream_match_conversions": stream_matches,
    "reconcile_conversions": reconciled,
    "count_item_query": _item_counts,
    "rank_item_query": ranked,
    "top5_rows": top5_rows,
    "top5_queries_per_item": top5_lists,
    "stream_top5_upserts": stream_top5,
    "sql_pipeline": sql_pipeline,
}
