"""Sequence matching on a stream by slices of event time, with the batch matcher."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqlog.operators.pattern import Sequence, flagged, match_flagged
from seqlog.streaming.marks import last_mark, leave_mark, table_path, tidy

GROUP = "_group"
#: The mark before the first batch.
NOTHING = {"newest": {}, "late": 0, "held": []}


def flagged_groups(
    events: list[DataFrame],
    sequence: Sequence,
    keys: list[str],
    time_ms: str = "epoch_ms",
    ties: list[str] = ("stream", "seq_num"),
) -> DataFrame:
    """Flagged rows of several streaming frames, each with its number; rows without a time are left out."""
    parts = [
        flagged(frame, sequence, list(keys), time_ms, list(ties)).withColumn(GROUP, F.lit(i))
        for i, frame in enumerate(events)
    ]
    return reduce(DataFrame.unionByName, parts).where("_ms IS NOT NULL")


def match_slices(
    sink: Callable[[DataFrame, int], None],
    folder: str,
    sequence: Sequence,
    keys: list[str],
    groups: int = 1,
    ties: int = 2,
    lateness_ms: int = 5_000,
) -> Callable[[DataFrame, int], None]:
    """foreachBatch function over flagged_groups: gives `sink` the matches that each batch completes.

    The watermark is the newest time of the slowest group less `lateness_ms`; it stands still until every
    group has rows. A row at or behind it on arrival takes no part and is counted. A batch moves it from
    m0 to m1 and matches the slice of rows from `within_ms` before m0 up to m1: every row of a match that
    ends in between is there, and no later row can get between them. Matches that end up to m0 were given
    before.

    A batch's rows are written once, under `folder`, which belongs to one checkpoint. What passes from
    batch to batch is a small file: newest time per group, late rows so far, and the batches whose rows can
    still be in a slice. Others are removed. A batch that runs again writes the same, so the sink has to
    know a batch by its id, as append_sink does.
    """
    look_back = sequence.within_ms

    def process(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        before = last_mark(spark, folder, batch_id, NOTHING)
        m0 = _watermark(before["newest"], groups, lateness_ms)
        tidy(spark, folder, batch_id, [batch for batch, _ in before["held"]])
        path = table_path(folder, batch_id)
        late = F.lit(False) if m0 is None else F.col("_ms") <= m0
        df.withColumn("_late", late).write.mode("overwrite").parquet(path)

        schema = T.StructType([*df.schema, T.StructField("_late", T.BooleanType())])
        stats = spark.read.schema(schema).parquet(path).groupBy(GROUP).agg(
            F.max("_ms").alias("newest"), F.count_if("_late").alias("late")
        )
        newest, late_rows = dict(before["newest"]), before["late"]
        reached = []
        for row in stats.collect():  # one row per group
            group = str(row[GROUP])
            newest[group] = max(row["newest"], newest.get(group, row["newest"]))
            late_rows += row["late"]
            reached.append(row["newest"])
        held = [*before["held"], *([[batch_id, max(reached)]] if reached else [])]
        m1 = _watermark(newest, groups, lateness_ms)

        if m1 is not None and held and (m0 is None or m1 > m0):
            paths = [table_path(folder, batch) for batch, _ in held]
            # Files written before a change of the sequence hold other columns; reading fails then.
            rows = spark.read.schema(schema).parquet(*paths).where(~F.col("_late") & (F.col("_ms") <= m1))
            if m0 is not None:
                rows = rows.where(F.col("_ms") >= m0 - look_back)
            sink(match_flagged(rows.drop("_late", GROUP), sequence, keys, ties, m0), batch_id)
        floor = None if m1 is None else m1 - look_back
        mark = {
            "newest": newest,
            "late": late_rows,
            "held": [[b, top] for b, top in held if floor is None or top >= floor],
        }
        leave_mark(spark, folder, batch_id, mark)

    return process


def late_rows_so_far(spark: SparkSession, folder: str) -> int:
    """How many rows came at or behind the watermark, over all batches of the query."""
    return last_mark(spark, folder, None, NOTHING)["late"]


def _watermark(newest: dict[str, int], groups: int, lateness_ms: int) -> int | None:
    return min(newest.values()) - lateness_ms if len(newest) == groups else None
