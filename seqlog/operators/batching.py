"""Cutting a stream into appends, and the size limits of records and appends."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Hard limits of one append.
MAX_BATCH_RECORDS = 1000
MAX_BATCH_BYTES = 1024 * 1024
MAX_RECORD_BYTES = 1024 * 1024


def checked(name: str, value: int, low: int, high: int) -> int:
    if not low <= value <= high:
        raise ValueError(f"{name} must be between {low} and {high}, not {value}")
    return value


def batches_by_count(
    df: DataFrame, limit: int = MAX_BATCH_RECORDS, position: str = "seq_num", name: str = "append_batch"
) -> DataFrame:
    """At most `limit` records per append; a plain projection, since positions are contiguous."""
    checked("limit", limit, 1, MAX_BATCH_RECORDS)
    return df.withColumn(name, F.expr(f"`{position}` DIV {limit}L"))


def batches_by_bytes(
    df: DataFrame,
    size: str,
    limit: int = MAX_BATCH_BYTES,
    records: int = MAX_BATCH_RECORDS,
    keys: list[str] = ("stream",),
    position: str = "seq_num",
) -> DataFrame:
    """At most `limit` bytes and `records` records per append, in order, filled greedily.

    An append never holds more than `records` records, so the fold starts afresh at each block of
    that many positions: every block is its own group, whatever share of the rows a stream has.
    A record larger than the limit stands alone. Adds `append_block` and `append_in_block`.
    """
    checked("limit", limit, 1, MAX_BATCH_BYTES)
    blocks = batches_by_count(df, records, position, "append_block")
    sizes = F.array_sort(
        F.collect_list(F.struct(F.col(position).alias("at"), F.col(size).cast("bigint").alias("size")))
    )
    start = F.struct(
        F.lit(0).cast("bigint").alias("used"), F.array().cast("array<bigint>").alias("starts")
    )

    def step(state: Column, record: Column) -> Column:
        fresh = (F.size(state["starts"]) == 0) | (state["used"] + record["size"] > limit)
        return F.struct(
            F.when(fresh, record["size"]).otherwise(state["used"] + record["size"]).alias("used"),
            F.when(fresh, F.concat(state["starts"], F.array(record["at"].cast("bigint"))))
            .otherwise(state["starts"])
            .alias("starts"),
        )

    # Only sizes are folded; the records meet the first positions of their block's appends again by
    # block, which holds at most `records` rows.
    folded = blocks.groupBy(*keys, "append_block").agg(
        F.aggregate(sizes, start, step, lambda s: s["starts"]).alias("_starts")
    )
    before = F.filter("_starts", lambda first: first <= F.col(position))
    return (
        blocks.join(folded, [*keys, "append_block"])
        .withColumn("append_in_block", (F.size(before) - 1).cast("bigint"))
        .drop("_starts")
    )


def oversize_records(df: DataFrame, size: str, limit: int = MAX_RECORD_BYTES) -> DataFrame:
    checked("limit", limit, 1, MAX_RECORD_BYTES)
    return df.where(F.col(size) > limit)
