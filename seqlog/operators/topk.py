"""Grouped counts, ranks and best-k lists."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqlog.operators.numbering import number_rows


def count_by(df: DataFrame, group: list[str], name: str = "n") -> DataFrame:
    """Grouped count; on a stream the same plan runs in update mode."""
    return df.groupBy(*group).agg(F.count("*").alias(name))


def rank_by_count(counts: DataFrame, group: str, value: str, n: str = "n") -> DataFrame:
    """Full ranking inside each group: largest count first, ties by value ascending, from 1.

    Every row is ranked, so the group is ordered across tasks rather than inside one.
    """
    ranked = number_rows(counts, [group], [F.col(n).desc(), F.col(value).asc()], "_place")
    return ranked.withColumn("rn", F.col("_place") + 1).drop("_place")


#: Fixed value: from this k on Spark sends all rows of a group to the task that ranks it.
RANKED_AFTER_SHUFFLE = 1000
SHARES = 64


def limited(counts: DataFrame, group: str, value: str, k: int, n: str = "n") -> DataFrame:
    """The k best rows per group with their rank `rn`, from 1, as an int.

    The rank limit is applied before the shuffle as well, so a task sends at most k rows of any group.
    From a k of 1,000 Spark does without that, so each group is ranked in shares by hash of the value
    first, and only their best k meet.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    order = [F.col(n).desc(), F.col(value).asc()]
    if k >= RANKED_AFTER_SHUFFLE:
        shared = counts.withColumn("_share", F.pmod(F.xxhash64(value), F.lit(SHARES)))
        share = Window.partitionBy(group, "_share").orderBy(*order)
        counts = shared.withColumn("rn", F.row_number().over(share)).where(F.col("rn") <= k).drop("_share", "rn")
    ranked = counts.withColumn("rn", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return ranked.where(F.col("rn") <= k)


def top_k(counts: DataFrame, group: str, value: str, k: int, n: str = "n") -> DataFrame:
    """The k best rows per group with their rank `rn`, from 1."""
    ranked = limited(counts, group, value, k, n)
    return ranked.withColumn("rn", F.col("rn").cast("bigint"))


def top_k_lists(
    df: DataFrame, group: str, value: str, k: int, name: str = "top_values"
) -> DataFrame:
    """One row per group with its k most frequent values, best first; null values do not count."""
    counts = count_by(df.where(F.col(value).isNotNull()), [group, value])
    best = top_k(counts, group, value, k)
    pairs = F.array_sort(F.collect_list(F.struct("rn", value)))
    return best.groupBy(group).agg(F.transform(pairs, lambda p: p[value]).alias(name))
