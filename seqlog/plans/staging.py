"""Written intermediate tables in the folder all executors share."""

import os
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SMALL_SIDE_ROWS = 100_000
SALTS = 32


def shared_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a local one only for local sessions without it."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="seqlog-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    application = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/seqlog-{application}/{label}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession) -> None:
    """Delete everything this application wrote under scratch_path; for the end of a job."""
    remove_path(spark, f"{shared_root(spark)}/seqlog-{spark.sparkContext.applicationId}")


def stage(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write `df` once; return it as read back from the written table, and the table's path.

    Later jobs neither recompute it nor lose it with an executor. A columnar table rather than
    checkpoint(), so that a pass over two columns reads only those two.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def make_directory(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(target)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def child_names(spark: SparkSession, path: str) -> list[str]:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(target):
        return []
    return [status.getPath().getName() for status in system.listStatus(target)]


def write_once(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file that holds `text`, unless there is one of that name: then False, and nothing changes.

    Of several callers at once one gets True. The file appears with its content: it is renamed from
    another name, which fails if the target is there (on object stores only as far as they keep to that),
    or linked, on a local file system.
    """
    jvm = spark._jvm
    target, conf = jvm.org.apache.hadoop.fs.Path(path), spark._jsc.hadoopConfiguration()
    draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}-{uuid.uuid4().hex}")
    system = target.getFileSystem(conf)
    stream = system.create(draft)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        if system.getScheme() == "file":
            os.link(draft.toUri().getPath(), target.toUri().getPath())
        else:
            kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
            options = spark.sparkContext._gateway.new_array(kind, 1)
            options[0] = kind.NONE
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(draft, target, options)
    except (FileExistsError, Py4JJavaError) as error:
        if isinstance(error, Py4JJavaError) and not system.exists(target):
            raise
        return False
    finally:
        system.delete(draft, False)
    return True


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small file, None if there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(target):
        return None
    stream = system.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def join_side(
    rows: DataFrame,
    side: DataFrame,
    on: list[str],
    how: str,
    spread: Column,
    limit: int = SMALL_SIDE_ROWS,
) -> DataFrame:
    """Equi-join a large frame with a side table that has one row per key.

    The side is counted first. Up to `limit` rows it is broadcast. Beyond that the join shuffles, and
    `spread` (any well-mixed integer of the large side) salts the keys, so a key holding a third of
    all rows still lands in many tasks.
    """
    return join_counted(rows, side, on, how, spread, side.limit(limit + 1).count() <= limit)


def join_counted(
    rows: DataFrame, side: DataFrame, on: list[str], how: str, spread: Column, small: bool
) -> DataFrame:
    """join_side for a caller that has counted the side itself."""
    if small:
        return rows.join(F.broadcast(side), on, how)
    salted_rows = rows.withColumn("_salt", F.pmod(spread.cast("bigint"), F.lit(SALTS)).cast("int"))
    salted_side = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted_rows.join(salted_side, [*on, "_salt"], how).drop("_salt")
