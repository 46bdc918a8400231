"""Continuously maintained best-k lists."""

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from seqlog.operators.topk import limited
from seqlog.streaming.marks import last_mark, leave_mark, table_path, tidy

SALTS = 32
#: After so many batches the lists of all groups are written anew, in one table.
FOLD_BATCHES = 16


class CountingTopK(StatefulProcessor):
    """Counts of one share of a group's values; emits that share's best k when they change.

    Counts only grow, so the new best k come from the old best k and the values just counted; the
    rest of the share is never read again.
    """

    def __init__(self, k: int, value_type: T.DataType, output: list[str]):
        self.k = k
        self.output = output
        self.value = T.StructType([T.StructField("value", value_type)])
        self.best_schema = T.StructType(
            [T.StructField("value", value_type), T.StructField("n", T.LongType())]
        )

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getMapState("counts", self.value, "n bigint")
        self.best = handle.getListState("best", self.best_schema)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        added: dict = {}
        for row in rows:
            added[row["value"]] = added.get(row["value"], 0) + row["n"]
        before = [tuple(r) for r in self.best.get()]
        candidates = dict(before)
        for value, n in added.items():
            held = self.counts.getValue((value,))
            total = n + (held[0] if held else 0)
            self.counts.updateValue((value,), (total,))
            candidates[value] = total
        best = sorted(candidates.items(), key=lambda item: (-item[1], item[0]))[: self.k]
        if best != before:
            self.best.put(best)
            yield Row(*self.output)(*key, [Row(value=v, n=n) for v, n in best])

    def close(self) -> None:
        pass


class MergingTopK(StatefulProcessor):
    """Merges the best k of a group's shares; emits the list of values when it changes."""

    def __init__(self, k: int, value_type: T.DataType, output: list[str]):
        self.k = k
        self.output = output
        pair = T.StructType(
            [T.StructField("value", value_type), T.StructField("n", T.LongType())]
        )
        self.share = T.StructType([T.StructField("best", T.ArrayType(pair))])
        self.list = T.StructType([T.StructField("values", T.ArrayType(value_type))])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.shares = handle.getMapState("shares", "salt int", self.share)
        self.shown = handle.getValueState("shown", self.list)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        for row in rows:
            self.shares.updateValue((row["salt"],), (row["best"],))
        pairs = [(p[0], p[1]) for (best,) in self.shares.values() for p in best]
        best = sorted(pairs, key=lambda p: (-p[1], p[0]))[: self.k]
        values = [value for value, _ in best]
        before = list(self.shown.get()[0]) if self.shown.exists() else None
        if values != before:
            self.shown.update((values,))
            yield Row(*self.output)(*key, values)

    def close(self) -> None:
        pass


def combine_batches(group: str, value: str):
    """Arrow function counting (group, value) inside each batch, before anything is shuffled."""

    def combine(batches):
        import pyarrow as pa

        for batch in batches:
            table = pa.Table.from_batches([batch])
            counted = table.group_by([group, value]).aggregate([([], "count_all")])
            counted = counted.rename_columns([group, "value", "n"])
            yield from counted.to_batches()

    return combine


def top_k_stream(
    events: DataFrame, group: str, value: str, k: int, name: str = "top_values", salts: int = SALTS
) -> DataFrame:
    """Streaming twin of top_k_lists: one row per group and micro-batch whose list changed.

    Rows are counted per Arrow batch, then per (group, share) where a share is a hash class of the
    value, and the shares' best k are merged per group. Every value lives in one share, so the
    merge is exact, and a group with a third of all rows is counted by `salts` tasks.
    """
    pairs = events.select(group, value).where(F.col(value).isNotNull())
    group_type, value_type = pairs.schema[group].dataType, pairs.schema[value].dataType
    counted_schema = T.StructType(
        [
            T.StructField(group, group_type),
            T.StructField("value", value_type),
            T.StructField("n", T.LongType()),
        ]
    )
    counted = pairs.mapInArrow(combine_batches(group, value), counted_schema)
    salted = counted.withColumn(
        "salt", F.pmod(F.xxhash64("value"), F.lit(salts).cast("bigint")).cast("int")
    )
    pair = T.StructType([T.StructField("value", value_type), T.StructField("n", T.LongType())])
    share_schema = T.StructType(
        [
            T.StructField(group, group_type),
            T.StructField("salt", T.IntegerType()),
            T.StructField("best", T.ArrayType(pair)),
        ]
    )
    shares = salted.groupBy(group, "salt").transformWithState(
        CountingTopK(k, value_type, share_schema.names), share_schema, "append", "None"
    )
    list_schema = T.StructType(
        [T.StructField(group, group_type), T.StructField(name, T.ArrayType(value_type))]
    )
    return shares.groupBy(group).transformWithState(
        MergingTopK(k, value_type, list_schema.names), list_schema, "append", "None"
    )


def changed_counts(events: DataFrame, group: str, value: str) -> DataFrame:
    """Streaming frame for update mode: each (group, value) that a micro-batch adds to, with its count so far.

    The counts are the state of Spark's own aggregation, which combines before the shuffle. Null values do
    not count; a null group is a group.
    """
    pairs = events.where(F.col(value).isNotNull())
    return pairs.groupBy(F.col(group).alias("_group"), F.col(value).alias("_value")).agg(
        F.count("*").alias("_n")
    )


def top_k_changes(
    sink: Callable[[DataFrame, int], None],
    folder: str,
    group: str,
    k: int,
    name: str = "top_values",
    fold_batches: int = FOLD_BATCHES,
) -> Callable[[DataFrame, int], None]:
    """foreachBatch function over changed_counts: gives `sink` the lists that each batch changes.

    Counts only grow, so a group's new best k are among its old ones and the k largest counts just changed.
    An old entry with an outdated count does no harm: if its value changed and is not among the k largest
    changed ones, those are ahead of it with either count.

    A batch writes the lists of its groups once, under `folder`, which belongs to one checkpoint; every
    `fold_batches` batches it writes those of all groups, and the earlier tables go. So a batch reads k
    entries of each group known, whatever the number of values. A batch that runs again writes the same.
    """

    def process(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        held = last_mark(spark, folder, batch_id, {"held": []})["held"]
        tidy(spark, folder, batch_id, held)
        entry = F.struct((-F.col("_n")).alias("back"), F.col("_value").alias("value"))
        fresh = (
            limited(df, "_group", "_value", k, "_n")
            .groupBy("_group")
            .agg(F.collect_list(entry).alias("_fresh"))
        )
        list_type = fresh.schema["_fresh"].dataType
        schema = T.StructType(
            [
                fresh.schema["_group"],
                T.StructField("_best", list_type),
                T.StructField("_changed", T.BooleanType()),
            ]
        )
        rows = fresh.withColumns({"_best": F.lit(None).cast(list_type), "_batch": F.lit(None).cast("long")})
        for batch in held:
            kept = spark.read.schema(schema).parquet(table_path(folder, batch))
            rows = rows.unionByName(
                kept.select("_group", F.lit(None).cast(list_type).alias("_fresh"), "_best").withColumn(
                    "_batch", F.lit(batch).cast("long")
                )
            )
        met = rows.groupBy("_group").agg(
            F.max("_fresh").alias("_fresh"), F.max_by("_best", "_batch").alias("_old")
        )
        folding = len(held) >= fold_batches
        if not folding:
            met = met.where("_fresh IS NOT NULL")
        none = F.array().cast(list_type)
        new, old = F.coalesce("_fresh", none), F.coalesce("_old", none)
        other = F.filter(old, lambda e: ~F.exists(new, lambda f: f["value"] == e["value"]))
        best = F.slice(F.sort_array(F.concat(new, other)), 1, k)
        values = lambda entries: F.transform(entries, lambda e: e["value"])
        merged = met.select("_group", best.alias("_best"), old.alias("_old")).select(
            "_group", "_best", (values("_best") != values("_old")).alias("_changed")
        )
        path = table_path(folder, batch_id)
        merged.write.mode("overwrite").parquet(path)
        lists = spark.read.schema(schema).parquet(path).where("_changed")
        sink(lists.select(F.col("_group").alias(group), values("_best").alias(name)), batch_id)
        leave_mark(spark, folder, batch_id, {"held": [batch_id] if folding else [*held, batch_id]})

    return process
