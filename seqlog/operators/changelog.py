"""Keyed changes as records, and records as keyed changes."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqlog.functions.codec import body_text, json_body
from seqlog.functions.plan import computed_once
from seqlog.functions.records import (
    ACTION_HEADER,
    DELETE_FLAG,
    INSERT,
    KEY_HEADER,
    UPDATE_BEFORE,
    UPDATE_FLAG,
    action_to_kind,
    header,
    key_and_action,
    kind_to_action,
)


def split_key_value(columns: list[str], keys: list[str]) -> tuple[list[str], list[str]]:
    """Key columns as declared in `keys`, and the remaining columns in their own order."""
    missing = [k for k in keys if k not in columns]
    if missing:
        raise ValueError(f"key columns not in the schema: {missing}")
    if len(set(keys)) < len(keys):
        raise ValueError(f"repeated key columns: {keys}")
    values = [c for c in columns if c not in keys]
    if not keys or not values:
        raise ValueError("an upsert table needs at least one key and one value column")
    return list(keys), values


def project_key_value(df: DataFrame, keys: list[str], columns: list[str] | None = None) -> DataFrame:
    """The row as two structs, `key` and `value`."""
    key_columns, value_columns = split_key_value(columns or df.columns, keys)
    return df.select(F.struct(*key_columns).alias("key"), F.struct(*value_columns).alias("value"))


def upsert_encode(
    df: DataFrame,
    keys: list[str],
    columns: list[str] | None = None,
    kind: str = "_kind",
    keep: list[str] = (),
) -> DataFrame:
    """Changes to records: key and action as headers, the value columns as a JSON body.

    A delete has an empty body. A before-image fails the job; drop those with
    normalize_changelog first. Without a kind column every row is an insert.
    """
    declared = columns or [c for c in df.columns if c != kind and c not in keep]
    key_columns, value_columns = split_key_value(declared, keys)
    action = kind_to_action(kind) if kind in df.columns else F.lit(UPDATE_FLAG)
    staged = df.withColumn("_flag", action)
    body = F.when(F.col("_flag") == DELETE_FLAG, F.lit(bytearray())).otherwise(
        json_body(value_columns)
    )
    headers = F.array(
        header(KEY_HEADER, json_body(key_columns)), header(ACTION_HEADER, F.col("_flag"))
    )
    return staged.select(*keep, headers.alias("headers"), body.alias("body"))


def with_key_action(log: DataFrame) -> DataFrame:
    """Add `_key` (bytes) and `_action`; both null where the headers do not settle them."""
    found = computed_once(log, log.columns, {"_found": key_and_action()})
    return found.select(
        *log.columns, F.col("_found.key").alias("_key"), F.col("_found.action").alias("_action")
    )


def upsert_decode(
    log: DataFrame,
    schema: T.StructType,
    keys: list[str],
    keep: list[str] = (),
    on_missing: str = "fail",
) -> DataFrame:
    """Records to rows in the declared column order, with `_kind`; value columns null on delete.

    Columns are put back by name, so the key columns may stand anywhere in the schema.
    `on_missing` settles records without key or action: `fail`, or `drop`.
    """
    if on_missing not in ("fail", "drop"):
        raise ValueError(f"on_missing must be fail or drop, not {on_missing!r}")
    found = with_key_action(log)
    if on_missing == "fail":
        found = found.where(_or_fail(F.col("_key").isNotNull(), "record without key or action header"))
    else:
        found = found.where(F.col("_key").isNotNull())
    return _decode_parts(found, schema, keys, keep)


def _decode_parts(found: DataFrame, schema: T.StructType, keys: list[str], keep) -> DataFrame:
    key_columns, value_columns = split_key_value(schema.names, keys)
    key_schema = T.StructType([schema[c] for c in key_columns])
    value_schema = T.StructType([schema[c] for c in value_columns])
    strict = {"mode": "FAILFAST"}
    live = F.when(F.octet_length("body") > 0, body_text())
    key = F.make_valid_utf8(F.col("_key").cast("string"))
    decoded = computed_once(
        found,
        [*keep, "_action"],
        {"_k": F.from_json(key, key_schema, strict), "_v": F.from_json(live, value_schema, strict)},
    )
    columns = [
        F.col(f"_k.{c}" if c in key_columns else f"_v.{c}").alias(c) for c in schema.names
    ]
    return decoded.select(*keep, *columns, action_to_kind().alias("_kind"))


def _or_fail(condition: Column, message: str) -> Column:
    return F.when(condition, F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean"))


def compact_upserts(log: DataFrame, batch: str | None = None, order: str = "seq_num") -> DataFrame:
    """Per stream and batch keep the last record of each key; records without a key are all kept.

    Keys and positions are a stream's own: a frame without a `stream` column is one stream. One
    aggregation that combines before the shuffle, so a key holding most of the rows sends one
    record per task. Unkeyed records group by their own position and never meet a real key.
    """
    group = [*(["stream"] if "stream" in log.columns else []), *([batch] if batch else [])]
    found = with_key_action(log).withColumn(
        "_own", F.when(F.col("_key").isNull(), F.col(order))
    )
    last = found.groupBy(*group, "_key", "_own").agg(
        F.max_by(F.struct(*log.columns), F.col(order)).alias("_last")
    )
    return last.select("_last.*")


def is_insert(kind: str = "_kind") -> Column:
    return F.coalesce(F.col(kind) == INSERT, F.lit(False))


def assert_insert_only(df: DataFrame, kind: str = "_kind") -> DataFrame:
    """Pass inserts through without the kind column; any other kind fails the job."""
    return df.where(_or_fail(is_insert(kind), "this table takes inserts only")).drop(kind)


def normalize_changelog(df: DataFrame, kind: str = "_kind") -> DataFrame:
    """Drop before-images and name the remaining changes `u` or `d` in `_action`."""
    return df.where(F.col(kind) != UPDATE_BEFORE).withColumn("_action", kind_to_action(kind)).drop(kind)


def latest_per_key(log: DataFrame) -> DataFrame:
    """Newest keyed record per stream and key: (stream, _key, _action, body, seq_num).

    The same plan works on a stream in update or complete mode, where it emits the keys that
    changed; a tombstone stays visible as action `d`.
    """
    found = with_key_action(log).where(F.col("_key").isNotNull())
    newest = found.groupBy("stream", "_key").agg(
        F.max_by(F.struct("_action", "body", "seq_num"), F.col("seq_num")).alias("_last")
    )
    return newest.select("stream", "_key", "_last.*")


def materialize_latest(
    log: DataFrame, schema: T.StructType, keys: list[str], until: int | None = None
) -> DataFrame:
    """Current state: the newest value of every key whose newest record is not a tombstone.

    `until` limits it to positions before that one. Only the winning bodies are parsed.
    """
    if until is not None:
        log = log.where(F.col("seq_num") < until)
    live = latest_per_key(log).where(F.col("_action") == UPDATE_FLAG)
    return _decode_parts(live, schema, keys, []).drop("_kind")


def materialize_updates_only(log: DataFrame, schema: T.StructType, keys: list[str]) -> DataFrame:
    """As materialize_latest but tombstones are ignored: a deleted key keeps its last value."""
    found = with_key_action(log).where(F.col("_action") == UPDATE_FLAG)
    newest = found.groupBy("stream", "_key").agg(
        F.max_by(F.struct("_action", "body"), F.col("seq_num")).alias("_last")
    )
    rows = newest.select("stream", "_key", "_last.*")
    return _decode_parts(rows, schema, keys, []).drop("_kind")
