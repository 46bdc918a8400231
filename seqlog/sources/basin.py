"""The Parquet tables of a basin: record files, published appends, positions, and declared streams.

An append writes its records once, in order, and lists its files with their numbers of records. It is
published under the next free commit number. A record's position is the first one of its file plus its
row in the file, and a file's first position follows from the files published before it; so it is fixed
by the commit number alone, and appenders at the same time cannot share positions. Every FOLD_EVERY commits the positions
worked out so far are written as a table, so that readers work out those of the latest commits only.
"""

import time
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqlog.functions.records import HEADER_TYPE, LOG_SCHEMA, STREAMS_SCHEMA
from seqlog.plans.staging import (
    SMALL_SIDE_ROWS,
    child_names,
    join_counted,
    make_directory,
    path_exists,
    read_text,
    write_once,
)

RECORDS_SCHEMA = T.StructType([*LOG_SCHEMA.fields, T.StructField("append_id", T.StringType())])
#: What a record file holds; the other columns of a record follow from where it stands.
STORED_SCHEMA = T.StructType(
    [T.StructField("headers", T.ArrayType(HEADER_TYPE)), T.StructField("body", T.BinaryType())]
)
#: Files of one append: `folder` of the records holds them, `place` orders those of a stream, `origin` is where the
#: stream begins if they are its first.
FILES_SCHEMA = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("folder", T.StringType()),
        T.StructField("file", T.StringType()),
        T.StructField("place", T.LongType()),
        T.StructField("records", T.LongType()),
        T.StructField("origin", T.LongType()),
        T.StructField("append_ts", T.TimestampType()),
    ]
)
POSITIONS_SCHEMA = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("append_id", T.StringType()),
        T.StructField("commit", T.LongType()),
        T.StructField("folder", T.StringType()),
        T.StructField("file", T.StringType()),
        T.StructField("first_seq", T.LongType()),
        T.StructField("next_seq", T.LongType()),
        T.StructField("records", T.LongType()),
        T.StructField("append_ts", T.TimestampType()),
    ]
)
TAILS_SCHEMA = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("next_seq", T.LongType()),
    ]
)
DECLARED_SCHEMA = T.StructType([*STREAMS_SCHEMA.fields, T.StructField("version", T.LongType())])
#: Commits whose positions are folded together.
FOLD_EVERY = 64


def records_path(basin: str) -> str:
    return f"{basin.rstrip('/')}/records"


def files_path(basin: str) -> str:
    return f"{basin.rstrip('/')}/files"


def commit_path(basin: str, number: int) -> str:
    return f"{basin.rstrip('/')}/commits/{number:012d}"


def published_path(basin: str, append_id: str) -> str:
    return f"{basin.rstrip('/')}/published/{append_id}"


def folds_path(basin: str) -> str:
    return f"{basin.rstrip('/')}/folds"


def streams_path(basin: str) -> str:
    return f"{basin.rstrip('/')}/streams"


def append_path(table: str, append_id: str) -> str:
    return f"{table}/append_id={append_id}"


def create_basin(spark: SparkSession, basin: str) -> str:
    """Make an empty basin; an existing one is left as it is."""
    for name in ("records", "files", "commits", "published", "folds", "streams"):
        make_directory(spark, f"{basin.rstrip('/')}/{name}")
    return basin


# Fixed set: characters a partition directory name holds as %XX.
ESCAPED = set("\"#%'*/:=?\\\x7f{[]^") | {chr(i) for i in range(1, 32)}


def escape(value: str) -> str:
    return "".join(f"%{ord(c):02X}" if c in ESCAPED else c for c in value)


def publish(spark: SparkSession, basin: str, append_id: str) -> int:
    """Give an append the next commit number; its files must be complete."""
    number = newest_fold(spark, basin).upto + 1
    while not write_once(spark, commit_path(basin, number), append_id):
        number += 1
    return number


def published_appends(
    spark: SparkSession, basin: str, after: int, upto: int | None = None
) -> list[tuple[int, str]]:
    """(commit, append) above a commit number. Numbers have no gaps, so no folder is listed."""
    found, number = [], after + 1
    while upto is None or number <= upto:
        text = read_text(spark, commit_path(basin, number))
        if text is None:
            break
        found.append((number, text.split("\n")[0]))
        number += 1
    return found


def is_published(spark: SparkSession, basin: str, append_id: str) -> bool:
    if path_exists(spark, published_path(basin, append_id)):
        return True
    if not path_exists(spark, f"{append_path(files_path(basin), append_id)}/_SUCCESS"):
        return False
    # Complete, but not noted: it was broken off just before or after it was published.
    return not positions(spark, basin).where(F.col("append_id") == append_id).isEmpty()


@dataclass(frozen=True)
class Fold:
    """Written positions of all commits up to `upto`, and the tails after it."""

    upto: int
    positions: tuple[str, ...]
    tails: str | None


def fold_chain(names: list[str], complete) -> list[str]:
    """Of folds named by their first commit and the one after their last, those that reach without gap or
    overlap from the newest complete one to the first."""
    chain: list[str] = []
    for name in sorted(names, key=lambda n: n.split("-")[::-1], reverse=True):
        since, upto = name.split("-")
        if (not chain or upto == chain[-1].split("-")[0]) and complete(name):
            chain.append(name)
    return chain


def newest_fold(spark: SparkSession, basin: str) -> Fold:
    root = folds_path(basin)
    chain = fold_chain(child_names(spark, root), lambda name: path_exists(spark, f"{root}/{name}/tails/_SUCCESS"))
    if not chain:
        return Fold(-1, (), None)
    paths = tuple(f"{root}/{name}/positions" for name in chain)
    return Fold(int(chain[0].split("-")[1]) - 1, paths, f"{root}/{chain[0]}/tails")


def fold(spark: SparkSession, basin: str, upto: int) -> None:
    """Write the positions of the commits since the last fold, and the tails after them."""
    last = newest_fold(spark, basin)
    if last.upto >= upto:
        return
    path = f"{folds_path(basin)}/{last.upto + 1:012d}-{upto + 1:012d}"
    later = _later_positions(spark, basin, last, upto)
    later.sort("stream", "first_seq").write.mode("overwrite").parquet(f"{path}/positions")
    written = spark.read.schema(POSITIONS_SCHEMA).parquet(f"{path}/positions")
    _tails(spark, last, written).write.mode("overwrite").parquet(f"{path}/tails")


def fold_due(spark: SparkSession, basin: str) -> None:
    """Fold if FOLD_EVERY commits have come since the last one: for appends that no Spark job follows."""
    last = newest_fold(spark, basin).upto
    if read_text(spark, commit_path(basin, last + FOLD_EVERY)) is not None:
        fold(spark, basin, last + FOLD_EVERY)


def positions(spark: SparkSession, basin: str) -> DataFrame:
    """One row per published record file: its stream, append, commit and positions."""
    last = newest_fold(spark, basin)
    later = _later_positions(spark, basin, last)
    if not last.positions:
        return later
    return spark.read.schema(POSITIONS_SCHEMA).parquet(*last.positions).unionByName(later)


def _later_positions(spark: SparkSession, basin: str, last: Fold, upto: int | None = None) -> DataFrame:
    """Positions of the files that were published after a fold."""
    commits = published_appends(spark, basin, last.upto, upto)
    if not commits:
        return spark.createDataFrame([], POSITIONS_SCHEMA)
    root = files_path(basin)
    schema = T.StructType([*FILES_SCHEMA.fields, T.StructField("append_id", T.StringType())])
    paths = [append_path(root, append_id) for _, append_id in commits]
    files = spark.read.schema(schema).option("basePath", root).parquet(*paths)
    numbers = pa.table({"commit": [n for n, _ in commits], "append_id": [a for _, a in commits]})
    # As many rows as there are commits since the fold.
    files = files.join(F.broadcast(spark.createDataFrame(numbers)), "append_id")
    if last.tails:
        tails = spark.read.schema(TAILS_SCHEMA).parquet(last.tails)
        files = files.join(tails.select("stream", F.col("next_seq").alias("_tail")), "stream", "left")
    else:
        files = files.withColumn("_tail", F.lit(None).cast("bigint"))
    order = Window.partitionBy("stream").orderBy("commit", "place")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce("_tail", F.first("origin").over(order)) + F.coalesce(F.sum("records").over(earlier), F.lit(0))
    files = files.withColumn("first_seq", first).withColumn("next_seq", F.col("first_seq") + F.col("records"))
    return files.select(*POSITIONS_SCHEMA.names)


def _tails(spark: SparkSession, last: Fold, later: DataFrame) -> DataFrame:
    ends = later.select("stream", F.col("append_ts").alias("created_at"), "next_seq")
    if last.tails:
        ends = ends.unionByName(spark.read.schema(TAILS_SCHEMA).parquet(last.tails))
    return ends.groupBy("stream").agg(
        F.min("created_at").alias("created_at"), F.max("next_seq").alias("next_seq")
    )


def current_tails(spark: SparkSession, basin: str) -> DataFrame:
    """(stream, created_at, next_seq) of every appended stream: the last fold's, and what came after it."""
    last = newest_fold(spark, basin)
    return _tails(spark, last, _later_positions(spark, basin, last))


def records(spark: SparkSession, basin: str) -> DataFrame:
    """Records of every published append, deleted and trimmed streams included."""
    return record_files(spark, basin, located(positions(spark, basin)))


def located(files: DataFrame, *more: str) -> list:
    """Rows of `positions` as record_files takes them."""
    stamp = F.unix_micros("append_ts").alias("stamp")
    return files.select("append_id", "stream", "folder", "file", "first_seq", "next_seq", stamp, *more).collect()


def record_files(spark: SparkSession, basin: str, files: list, starts: dict[str, int] | None = None) -> DataFrame:
    """Records of located files, from `starts` on per stream; no other file is listed or opened."""
    if not files:
        return spark.createDataFrame([], RECORDS_SCHEMA)
    root = records_path(basin)
    paths = [f"{append_path(root, f.folder)}/stream={escape(f.stream)}/{f.file}" for f in files]
    schema = T.StructType(
        [*STORED_SCHEMA.fields, T.StructField("append_id", T.StringType()), T.StructField("stream", T.StringType())]
    )
    stored = spark.read.schema(schema).option("basePath", root).parquet(*paths).drop("append_id")
    rows = stored.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_at"))
    bases = pa.table(
        {
            "stream": [f.stream for f in files],
            "_file": [f.file for f in files],
            "append_id": [f.append_id for f in files],
            "_first": pa.array([f.first_seq for f in files], pa.int64()),
            "_skip": pa.array([max(0, (starts or {}).get(f.stream, 0) - f.first_seq) for f in files], pa.int64()),
            "_stamp": pa.array([f.stamp for f in files], pa.int64()),
        }
    )
    small = len(files) <= SMALL_SIDE_ROWS
    based = join_counted(rows, spark.createDataFrame(bases), ["stream", "_file"], "inner", F.col("_at"), small)
    if bases.column("_skip").to_pylist() != [0] * len(files):
        based = based.where("_at >= _skip")
    return based.select(
        "stream", (F.col("_first") + F.col("_at")).alias("seq_num"), "headers", "body",
        F.timestamp_micros("_stamp").alias("append_ts"), "append_id",
    )


def declare_streams(spark: SparkSession, basin: str, streams: DataFrame) -> None:
    """Create streams, or change what is known of them: deletion time, first retained position."""
    rows = streams.select(*STREAMS_SCHEMA.names, F.lit(time.time_ns()).alias("version"))
    rows.write.mode("append").parquet(streams_path(basin))


def declared_streams(spark: SparkSession, basin: str) -> DataFrame:
    return spark.read.schema(DECLARED_SCHEMA).parquet(streams_path(basin))


def list_streams(spark: SparkSession, basin: str, prefix: str = "") -> DataFrame:
    """Every stream of the basin once: its newest declaration, or what its first append tells."""
    appended = current_tails(spark, basin).select(
        "stream",
        "created_at",
        F.lit(None).cast("timestamp").alias("deleted_at"),
        F.lit(0).cast("bigint").alias("first_seq"),
        F.lit(-1).cast("bigint").alias("version"),
    )
    entries = declared_streams(spark, basin).unionByName(appended).where(F.startswith("stream", F.lit(prefix)))
    newest = entries.groupBy("stream").agg(
        F.max_by(F.struct("created_at", "deleted_at", "first_seq"), "version").alias("_entry")
    )
    return newest.select("stream", "_entry.*")


def live_streams(listing: DataFrame) -> DataFrame:
    return listing.where("deleted_at IS NULL")


def new_streams(listing: DataFrame, known: DataFrame) -> DataFrame:
    """Live streams not seen before. A known stream stays known, deleted or not."""
    return live_streams(listing).join(known.select("stream"), "stream", "left_anti")


def check_tail(spark: SparkSession, basin: str, appends: Column | None = None) -> DataFrame:
    """Next position of every stream: (stream, next_seq). No record is read.

    `appends`, a condition on positions, limits it to some appends: the tails of an earlier time.
    """
    if appends is None:
        ends = current_tails(spark, basin).select("stream", F.col("next_seq").alias("_end"))
    else:
        files = positions(spark, basin).where(appends)
        ends = files.groupBy("stream").agg(F.max("next_seq").alias("_end"))
    listing = list_streams(spark, basin).select("stream", "first_seq")
    return listing.join(ends, "stream", "left").select(
        "stream", F.coalesce("_end", "first_seq").alias("next_seq")
    )
