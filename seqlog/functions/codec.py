"""Bytes to columns and back: text, JSON, delimited key=value lines, user code."""

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqlog.functions.plan import computed_once
from seqlog.functions.records import no_headers

JSON_OPTIONS = {"ignoreNullFields": "false"}
CORRUPT = "_corrupt"

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.IntegerType()),
        T.StructField("action", T.StringType()),
        T.StructField("item_id", T.IntegerType()),
        T.StructField("query", T.StringType()),
        T.StructField("epoch_ms", T.LongType()),
    ]
)


def body_text(body="body", invalid: str = "replace") -> Column:
    """Body as a string; invalid UTF-8 is replaced (`replace`), nulled (`null`) or fatal (`fail`)."""
    body = F.col(body) if isinstance(body, str) else body
    if invalid == "replace":
        return F.make_valid_utf8(body.cast("string"))
    if invalid == "null":
        return F.try_validate_utf8(body.cast("string"))
    if invalid == "fail":
        return F.validate_utf8(body.cast("string"))
    raise ValueError(f"invalid must be replace, null or fail, not {invalid!r}")


def decode_text(log: DataFrame, name: str = "text", invalid: str = "replace") -> DataFrame:
    """Only the decoded body; stream and position are dropped."""
    return log.select(body_text(invalid=invalid).alias(name))


def decode_with_context(log: DataFrame, name: str = "text", invalid: str = "replace") -> DataFrame:
    return log.select("stream", "seq_num", body_text(invalid=invalid).alias(name))


def flat_decode(log: DataFrame, fn: Callable[[Iterator], Iterator], schema) -> DataFrame:
    """User decoder over Arrow batches of (stream, seq_num, headers, body): any number of rows out."""
    return log.select("stream", "seq_num", "headers", "body").mapInArrow(fn, schema)


def register_decoder(spark: SparkSession, name: str, fn: Callable, schema: str) -> None:
    """The same for SQL: `fn(stream, seq_num, body)` yields tuples, and `name` becomes a table
    function for lateral joins, as in `FROM log, LATERAL name(stream, seq_num, body)`."""

    class Decoder:
        def eval(self, stream: str, seq_num: int, body: bytes):
            yield from fn(stream, seq_num, body)

    spark.udtf.register(name, F.udtf(Decoder, returnType=schema))


def json_decode(log: DataFrame, schema: T.StructType, on_error: str = "fail", text=None) -> DataFrame:
    """Body to the declared columns, beside whatever else the frame carries.

    `fail` stops the job on text that is not the declared JSON, `null` yields null columns, and
    `dead_letter` keeps the row and sets `_corrupt` to the offending text.
    """
    source = body_text() if text is None else (F.col(text) if isinstance(text, str) else text)
    kept = [c for c in log.columns if c != "body"]
    if on_error not in ("fail", "null", "dead_letter"):
        raise ValueError(f"on_error must be fail, null or dead_letter, not {on_error!r}")
    columns = [F.col(f"_json.{f.name}").alias(f.name) for f in schema.fields]
    if on_error == "null":
        parsed = {"_json": F.from_json(source, schema)}
        return computed_once(log, kept, parsed).select(*kept, *columns)
    strict = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = {"_text": source, "_json": F.from_json(source, strict, options)}
    # An empty body parses to a null struct and a malformed one to a struct of nulls.
    bad = F.when(
        F.col("_json").isNull() | F.col(f"_json.{CORRUPT}").isNotNull(),
        F.coalesce(F.col("_text"), F.lit("")),
    )
    decoded = computed_once(log, kept, parsed)
    if on_error == "dead_letter":
        return decoded.select(*kept, *columns, bad.alias(CORRUPT))
    message = F.concat(F.lit("body is not the declared JSON: "), bad)
    sound = F.when(bad.isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return decoded.where(sound).select(*kept, *columns)


def json_body(columns: list[str]) -> Column:
    return F.to_json(F.struct(*columns), JSON_OPTIONS).cast("binary")


def encode_json(df: DataFrame, columns: list[str] | None = None, keep: list[str] = ()) -> DataFrame:
    """Whole row (or `columns`) to a record body without headers; `keep` columns stay beside it."""
    return df.select(
        *keep, no_headers().alias("headers"), json_body(columns or df.columns).alias("body")
    )


def custom_encode(df: DataFrame, body, headers=None, keep: list[str] = ()) -> DataFrame:
    """Record from user expressions: any Column, including a pandas_udf call."""
    return df.select(
        *keep,
        (no_headers() if headers is None else headers).alias("headers"),
        body.cast("binary").alias("body"),
    )


# --- delimited key=value event lines ------------------------------------------------------------

# Every piece between semicolons needs a '='; names hold neither, values may hold '='.
_SHAPE = r"\A[^;=]*=[^;]*(;[^;=]*=[^;]*)*\z"
_WHOLE_NUMBER = r"\A[+-]?[0-9]+\z"


def _with_pairs(log: DataFrame) -> DataFrame:
    """Add `_line`, `_fault` (faults of shape only) and `_pairs`, the name-to-text map of a good line."""
    # Empty pieces at the end of a line do not count; inner ones make it bad.
    lines = log.withColumn("_line", F.rtrim(body_text(), F.lit(";")))
    names = F.transform(F.split("_line", ";"), lambda p: F.substring_index(p, "=", 1))
    fault = F.when(~F.coalesce(F.col("_line").rlike(_SHAPE), F.lit(False)), F.lit("shape")).when(
        F.size(F.array_distinct(names)) < F.size(names), F.lit("repeated name")
    )
    # Repeated names never reach str_to_map, which would fail the whole job on them.
    pairs = F.when(F.col("_fault").isNull(), F.str_to_map("_line", F.lit(";"), F.lit("=")))
    return lines.withColumn("_fault", fault).withColumn("_pairs", pairs)


def _parsed(log: DataFrame, keep: list[str]) -> DataFrame:
    """`keep`, the event columns, and `reason`, null for a good line."""
    pairs = F.col("_pairs")

    def text(name: str) -> Column:
        return F.try_element_at(pairs, F.lit(name))

    def number(name: str, kind: str) -> Column:
        value = text(name)
        return F.when(value.rlike(_WHOLE_NUMBER), value.try_cast(kind))

    user, item, time = number("user", "int"), number("item", "int"), number("epoch_ms", "bigint")
    reason = F.coalesce(
        F.col("_fault"),
        F.when(text("user").isNull(), F.lit("no user")),
        F.when(user.isNull(), F.lit("user")),
        F.when(text("item").isNotNull() & item.isNull(), F.lit("item")),
        F.when(time.isNull(), F.lit("epoch_ms")),
    )
    columns = {
        "user_id": user,
        "action": F.coalesce(text("action"), F.lit("search")),
        "item_id": item,
        "query": text("search"),
        "epoch_ms": time,
        "reason": reason,
    }
    return computed_once(_with_pairs(log), keep, columns)


def parse_kv_events(log: DataFrame, keep: list[str] = ("stream", "seq_num")) -> DataFrame:
    """Typed events of the good lines. A missing action means `search`; unknown names are ignored."""
    return _parsed(log, list(keep)).where("reason IS NULL").select(*keep, *EVENT_SCHEMA.names)


def parse_kv_rejects(log: DataFrame, keep: list[str] = ("stream", "seq_num")) -> DataFrame:
    """The lines parse_kv_events drops, each with the first reason found."""
    rejects = _parsed(log, [*keep, "body"]).where("reason IS NOT NULL")
    return rejects.select(*keep, body_text().alias("body"), "reason")


def event_time(epoch_ms="epoch_ms") -> Column:
    return F.timestamp_millis(epoch_ms)


def with_event_time(events: DataFrame, name: str = "event_time") -> DataFrame:
    return events.withColumn(name, event_time())


def with_watermark(events: DataFrame, delay: str = "5 seconds") -> DataFrame:
    """Event time with bounded lateness, for streaming frames."""
    return with_event_time(events).withWatermark("event_time", delay)
