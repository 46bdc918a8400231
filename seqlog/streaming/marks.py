"""What a foreachBatch function hands from batch to batch: a small mark per batch, and tables beside it."""

import json

from pyspark.sql import SparkSession

from seqlog.plans.staging import child_names, read_text, remove_path, write_once


def table_path(folder: str, batch_id: int) -> str:
    return f"{folder}/rows/{batch_id:012d}"


def last_mark(spark: SparkSession, folder: str, batch_id: int | None, default: dict) -> dict:
    """The mark of the last batch before `batch_id`, or of the last one of all."""
    names = [n for n in child_names(spark, f"{folder}/marks") if n.isdigit()]
    earlier = [n for n in names if batch_id is None or int(n) < batch_id]
    if not earlier:
        return default
    return json.loads(read_text(spark, f"{folder}/marks/{max(earlier)}"))


def leave_mark(spark: SparkSession, folder: str, batch_id: int, mark: dict) -> None:
    write_once(spark, f"{folder}/marks/{batch_id:012d}", json.dumps(mark))


def tidy(spark: SparkSession, folder: str, batch_id: int, held: list[int]) -> None:
    """Remove what neither this batch nor a repetition of it reads: it needs the tables in `held`."""
    needed = {f"{batch:012d}" for batch in held}
    for name in child_names(spark, f"{folder}/rows"):
        if name.isdigit() and int(name) < batch_id and name not in needed:
            remove_path(spark, f"{folder}/rows/{name}")
    marks = sorted(n for n in child_names(spark, f"{folder}/marks") if n.isdigit() and int(n) < batch_id)
    for name in marks[:-1]:
        remove_path(spark, f"{folder}/marks/{name}")
