"""Contiguous row numbers per key without putting a key into one task."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqlog.plans.staging import join_side, remove_path, stage


@dataclass(frozen=True)
class Placed:
    """Rows written in order, and the runs of each key inside each partition.

    `rows` carries `_part` and `_at` (place inside the partition); `runs` has one row per key and
    partition: `_from` (place of the first row), `_n` and `_before` (rows of the key in earlier
    partitions).
    """

    rows: DataFrame
    runs: DataFrame
    keys: tuple[str, ...]
    paths: tuple[str, ...]

    def discard(self) -> None:
        """Delete the written tables, once nothing reads them any more."""
        for path in self.paths:
            remove_path(self.rows.sparkSession, path)


def place(df: DataFrame, keys: list[str], order: list) -> Placed:
    """Order `df` by key and `order`, write it once, and measure the runs.

    With an order, rows are range-partitioned, so a key with a third of all rows is cut across many
    partitions. Ties go by content, so that a task run again after a lost executor sends its rows
    where they went before; equal rows go by arrival, which lets a long run of them be cut as well.
    Without an order the arrival order stands and nothing is shuffled. The written copy matters:
    range bounds come from sampling, so two separate runs of the plan need not agree on them.
    """
    if order:
        df = ordered(df, keys, order)
    placed = df.withColumn("_part", F.spark_partition_id()).withColumn(
        "_at", F.monotonically_increasing_id()
    )
    rows, rows_path = stage(placed, "placed")
    measured = rows.groupBy(*keys, "_part").agg(
        F.count("*").alias("_n"), F.min("_at").alias("_from")
    )
    earlier = (
        Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    runs = measured.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    runs, runs_path = stage(runs, "runs")
    return Placed(rows, runs, tuple(keys), (rows_path, runs_path))


def ordered(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Partitions in order of key and `order`, ties by content; without an order, each in order of key and arrival."""
    df = df.withColumn("_arrival", F.monotonically_increasing_id())
    if not order:
        return df.sortWithinPartitions(*keys, "_arrival").drop("_arrival")
    hashable = [f.name for f in df.schema.fields if f.name != "_arrival" and not _has_map(f.dataType)]
    df = df.withColumn("_content", F.xxhash64(*hashable))
    sort = [*keys, *order, "_content", "_arrival"]
    return df.repartitionByRange(*sort).sortWithinPartitions(*sort).drop("_content", "_arrival")


def _has_map(kind: T.DataType) -> bool:
    return "map<" in kind.simpleString()


def numbered(placed: Placed, name: str, base: str | None = None) -> DataFrame:
    """Attach the zero-based (or `base`-based) number. Needs one run per key and partition."""
    start = F.col("_before") - F.col("_from")
    if base:
        start = start + F.col(base)
    offsets = placed.runs.select(*placed.keys, "_part", start.alias("_start"))
    joined = join_side(
        placed.rows, offsets, [*placed.keys, "_part"], "inner", spread=F.col("_at")
    )
    number = (F.col("_at") + F.col("_start")).cast("bigint")
    return joined.withColumn(name, number).drop("_part", "_at", "_start")


def number_rows(df: DataFrame, keys: list[str], order: list, name: str = "seq_num") -> DataFrame:
    """Zero-based position of every row within its key, in `order`."""
    if not order:
        raise ValueError("number_rows needs an order")
    return numbered(place(df, keys, order), name)


def running_max(df: DataFrame, step: str, value: str, fan: int = 65_536) -> DataFrame:
    """Per step, the largest value of all earlier steps, as (step, earlier).

    Steps are folded in blocks of `fan`, first inside each block, then across blocks, so no task
    sees more than `fan` rows of the first level. Steps are not negative; rows without one are left out.
    """
    # Written once: three levels read it, and it is as small as the number of steps.
    known = df.where(F.col(step).isNotNull())
    steps, _ = stage(known.groupBy(step).agg(F.max(value).alias("_value")), "steps")
    steps = steps.withColumn("_block", F.expr(f"`{step}` DIV {fan}L"))
    blocks = steps.groupBy("_block").agg(F.max("_value").alias("_value"))
    # Second level: blocks of blocks, then one frame of at most steps / fan**2 rows.
    blocks = blocks.withColumn("_outer", F.expr(f"_block DIV {fan}L"))
    outers = blocks.groupBy("_outer").agg(F.max("_value").alias("_value"))

    def before(order: str, *partition: str):
        window = Window.partitionBy(*partition).orderBy(order)
        return F.max("_value").over(window.rowsBetween(Window.unboundedPreceding, -1))

    outer_before = outers.select("_outer", before("_outer").alias("_outer_max"))
    block_before = (
        blocks.withColumn("_in_outer", before("_block", "_outer"))
        .join(outer_before, "_outer")
        .select("_block", F.greatest("_in_outer", "_outer_max").alias("_block_max"))
    )
    return (
        steps.withColumn("_in_block", before(step, "_block"))
        .join(block_before, "_block")
        .select(step, F.greatest("_in_block", "_block_max").alias("earlier"))
    )
