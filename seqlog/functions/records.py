"""Record schemas, headers, and what can be read off a single record."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the wire format.
KEY_HEADER = "@key"
ACTION_HEADER = "@action"
UPDATE_FLAG = "u"
DELETE_FLAG = "d"

# Change kinds as an engine writes them.
INSERT = "+I"
UPDATE_BEFORE = "-U"
UPDATE_AFTER = "+U"
DELETE = "-D"

HEADER_TYPE = T.StructType(
    [T.StructField("name", T.BinaryType()), T.StructField("value", T.BinaryType())]
)
APPEND_SCHEMA = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("headers", T.ArrayType(HEADER_TYPE)),
        T.StructField("body", T.BinaryType()),
    ]
)
LOG_SCHEMA = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("seq_num", T.LongType()),
        T.StructField("headers", T.ArrayType(HEADER_TYPE)),
        T.StructField("body", T.BinaryType()),
        T.StructField("append_ts", T.TimestampType()),
    ]
)
STREAMS_SCHEMA = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("deleted_at", T.TimestampType()),
        T.StructField("first_seq", T.LongType()),
    ]
)


def octets(text: str) -> Column:
    return F.lit(bytearray(text.encode()))


def header(name: str, value: Column) -> Column:
    return F.struct(octets(name).alias("name"), value.cast("binary").alias("value"))


def no_headers() -> Column:
    return F.array().cast(T.ArrayType(HEADER_TYPE))


def metered_bytes(
    headers="headers", body="body", per_record: int = 0, per_header: int = 0
) -> Column:
    """Octets of the body and of every header name and value, plus optional fixed overheads."""
    headers, body = _col(headers), _col(body)
    header_octets = F.aggregate(
        F.coalesce(headers, no_headers()),
        F.lit(0).cast("bigint"),
        lambda total, h: total
        + F.coalesce(F.octet_length(h["name"]), F.lit(0))
        + F.coalesce(F.octet_length(h["value"]), F.lit(0))
        + F.lit(per_header),
    )
    return (
        F.lit(per_record).cast("bigint")
        + F.coalesce(F.octet_length(body), F.lit(0)).cast("bigint")
        + header_octets
    )


def key_and_action(headers="headers") -> Column:
    """struct(key BINARY, action STRING) at the first header where both are known, else null.

    A later key or valid action replaces an earlier one until both are set; an unknown action
    changes nothing. Headers in the writer's own order (key, then action) skip the fold.
    """
    headers = _col(headers)
    empty = F.struct(
        F.lit(None).cast("binary").alias("key"), F.lit(None).cast("string").alias("action")
    )
    flags = (octets(UPDATE_FLAG), octets(DELETE_FLAG))

    def step(seen: Column, h: Column) -> Column:
        is_key = h["name"] == octets(KEY_HEADER)
        is_action = (h["name"] == octets(ACTION_HEADER)) & h["value"].isin(*flags)
        advanced = F.struct(
            F.when(is_key, h["value"]).otherwise(seen["key"]).alias("key"),
            F.when(is_action, h["value"].cast("string")).otherwise(seen["action"]).alias("action"),
        )
        return F.when(seen["key"].isNotNull() & seen["action"].isNotNull(), seen).otherwise(advanced)

    def finish(seen: Column) -> Column:
        return F.when(seen["key"].isNotNull() & seen["action"].isNotNull(), seen)

    first, second = F.get(headers, F.lit(0)), F.get(headers, F.lit(1))
    usual = (
        (first["name"] == octets(KEY_HEADER))
        & first["value"].isNotNull()
        & (second["name"] == octets(ACTION_HEADER))
        & second["value"].isin(*flags)
    )
    direct = F.struct(
        first["value"].alias("key"), second["value"].cast("string").alias("action")
    )
    return (
        F.when(headers.isNull(), F.lit(None))
        .when(usual, direct)
        .otherwise(F.aggregate(headers, empty, step, finish))
    )


def action_to_kind(action="_action") -> Column:
    """'u' -> '+U', 'd' -> '-D', anything else -> null."""
    action = _col(action)
    return F.when(action == UPDATE_FLAG, F.lit(UPDATE_AFTER)).when(
        action == DELETE_FLAG, F.lit(DELETE)
    )


def kind_to_action(kind="_kind") -> Column:
    """Inserts and after-images become 'u', deletes 'd'; anything else fails the job."""
    kind = _col(kind)
    return (
        F.when(kind.isin(INSERT, UPDATE_AFTER, UPDATE_FLAG), F.lit(UPDATE_FLAG))
        .when(kind.isin(DELETE, DELETE_FLAG), F.lit(DELETE_FLAG))
        .otherwise(
            F.raise_error(
                F.concat(F.lit("unsupported row kind: "), F.coalesce(kind, F.lit("null")))
            ).cast("string")
        )
    )


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value
