"""What the operators of this folder share: written steps, words, hashes, connected classes."""

import ctypes
from collections import defaultdict
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from seqlog.plans.staging import remove_path, stage

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: White space that separates words: blank and U+0009 to U+000D, which bytes.split() also takes.
GAP = r"[\x20\x09-\x0D]+"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Jobs inside drop their shuffle files as soon as they end."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Jobs inside hand at most so many rows at once to Python."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def free_name(name: str, taken: list[str]) -> str:
    """`name`, with as many underscores after it as it takes to be none of `taken` in any case."""
    held = {t.lower() for t in taken}
    while name.lower() in held:
        name += "_"
    return name


def give_back() -> None:
    """Hand freed memory to the system: Python workers outlive their tasks, and an executor pays for them."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
    if trim:
        trim(0)


def frugal(task: Callable) -> Callable:
    """A function of batches that gives memory back when its task ends."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from task(batches)
        finally:
            give_back()

    return run


def frugal_pair(join: Callable) -> Callable:
    """A function of two tables that gives memory back after each pair."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        try:
            return join(left, right)
        finally:
            give_back()

    return run


def written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """`df` as a table in the shared folder, read back; its shuffle files are gone afterwards."""
    with shuffles_removed(df.sparkSession):
        return stage(df, label)


def drop_written(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        remove_path(spark, path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def coded(texts: list[str], lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of all texts as positions in their dictionary, the dictionary's hashes, words per text.

    `lower` turns A-Z into a-z, and nothing else.
    """
    known: defaultdict[bytes, int] = defaultdict(count().__next__)
    place, codes, sizes = known.__getitem__, [], []
    for text in texts:
        words = text.encode("utf-8").lower().split() if lower else text.encode("utf-8").split()
        codes.extend(map(place, words))
        sizes.append(len(words))
    return np.array(codes, np.int64), word_hashes(list(known)), np.array(sizes, np.int64)


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every run of `size` consecutive word hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n]
    return mixed(total)


def min_labels(edges: DataFrame) -> DataFrame:
    """Smallest id reachable over undirected `edges` (a, b): columns id, label; one row per id.

    Alternates the two star operations of distributed connected components (every node links its
    larger neighbours to its smallest one, then all neighbours) until the links are stars. The
    number of rounds is logarithmic in the length of the longest chain; each round is written, so
    a lost executor costs one round at most. A node's neighbours are only ever reduced to their
    minimum, never gathered.
    """
    spark = edges.sparkSession
    least, most = F.least("a", "b"), F.greatest("a", "b")
    current, path = written(
        edges.select(most.alias("a"), least.alias("b")).where("a <> b").distinct(), "links"
    )
    while True:
        # All neighbours: each node's larger neighbours link to its smallest one.
        both = current.union(current.select("b", "a")).toDF("a", "b")
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Smaller neighbours only: they and the node link to the smallest.
        small_low = large.groupBy("a").agg(F.min("b").alias("m"))
        relinked = (
            large.join(small_low, "a")
            .select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("e"))
            .select(F.col("e.b").alias("a"), F.col("e.m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        following, following_path = written(relinked, "links")
        drop_written(spark, path)
        current, path = following, following_path
        # Done when every node links once, to one that links nowhere.
        ends = current.select(F.col("a").alias("id"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(
            current.select("b", F.lit(0), F.lit(1))
        )
        degrees = ends.groupBy("id").agg(F.sum("out").alias("out"), F.sum("into").alias("into"))
        if degrees.where("out > 1 OR (out > 0 AND into > 0)").isEmpty():
            break
    labelled = current.select(F.col("a").alias("id"), F.col("b").alias("label"))
    return labelled.union(labelled.select("label", "label").distinct())
