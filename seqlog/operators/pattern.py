"""Strict sequences of adjacent events per key, and reconciliation of two result sets."""

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqlog.operators.numbering import number_rows
from seqlog.plans.staging import SMALL_SIDE_ROWS, stage

BUCKET_FACTOR = 8
#: Rows of a key within one time bucket from which match_sequence_dense cuts by number.
DENSE_ROWS = 1_000_000


@dataclass(frozen=True)
class Sequence:
    """What to look for: one SQL predicate per step, in order, on adjacent rows of a key.

    `measures` maps an output column to (step name, input column). `within_ms` bounds last minus
    first, exclusively unless `inclusive`. `same` lists SQL expressions that must be equal and not
    null over the steps named in `over`.
    """

    steps: tuple[tuple[str, str], ...]
    measures: dict[str, tuple[str, str]]
    within_ms: int
    inclusive: bool = False
    same: tuple[str, ...] = ()
    over: tuple[str, ...] = ()
    bucket_factor: int = field(default=BUCKET_FACTOR)

    def __post_init__(self):
        if len(self.steps) < 2:
            raise ValueError("a sequence needs at least two steps")
        if self.within_ms < 1 or self.bucket_factor < 1:
            raise ValueError("within_ms and bucket_factor must be at least 1")
        unknown = [s for s, _ in self.measures.values() if s not in self.names]
        unknown += [s for s in self.over if s not in self.names]
        if unknown or len(set(self.names)) < len(self.names):
            raise ValueError(f"step names must be unique and known: {unknown or self.names}")

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.steps]

    @property
    def bucket_ms(self) -> int:
        return self.within_ms * self.bucket_factor


def step_flags(sequence: Sequence) -> Column:
    """Bit i is set where the row satisfies step i."""
    flags = F.lit(0)
    for i, (_, predicate) in enumerate(sequence.steps):
        flags = flags.bitwiseOR(F.when(F.expr(predicate), F.lit(1 << i)).otherwise(F.lit(0)))
    return flags


def whole_steps(column: str, width: int) -> Column:
    """Floor of `column` / `width` in 64-bit integers, for negative values too."""
    return F.expr(f"(`{column}` - pmod(`{column}`, {width}L)) DIV {width}L")


def sequence_inputs(sequence: Sequence) -> list[str]:
    return list(dict.fromkeys(column for _, column in sequence.measures.values()))


def flagged(
    events: DataFrame, sequence: Sequence, keys: list[str], time_ms: str, ties: list[str]
) -> DataFrame:
    """What matching needs of a row: keys, time, ties, one bit per step, measured and equal values."""
    return events.select(
        *keys,
        F.col(time_ms).cast("bigint").alias("_ms"),
        *[F.col(t).alias(f"_tie{i}") for i, t in enumerate(ties)],
        step_flags(sequence).alias("_flags"),
        *[F.col(c).alias(f"_in{i}") for i, c in enumerate(sequence_inputs(sequence))],
        *[F.expr(e).alias(f"_same{i}") for i, e in enumerate(sequence.same)],
    )


def bucketed(rows: DataFrame, sequence: Sequence) -> DataFrame:
    """Cut every key of flagged rows into time buckets that can be matched independently.

    A row belongs to its own bucket, and a row in the first `within_ms` of a bucket also to the one
    before, as look-ahead. A match is reported in the bucket of its first row (`_home`): all rows up
    to the bound are there, so the result is exact, while a key with a third of all rows is spread
    over as many tasks as it has buckets. About one row in `bucket_factor` is sent twice.
    """
    width = sequence.bucket_ms
    own = rows.withColumn("_own", whole_steps("_ms", width))
    ahead = F.pmod(F.col("_ms"), F.lit(width).cast("bigint")) < F.lit(sequence.within_ms)
    buckets = F.when(ahead, F.array(F.col("_own"), F.col("_own") - 1)).otherwise(
        F.array(F.col("_own"))
    )
    spread = own.withColumn("_bucket", F.explode(buckets)).withColumn(
        "_home", F.col("_bucket") == F.col("_own")
    )
    return spread.drop("_own")


def match_sequence(
    events: DataFrame,
    sequence: Sequence,
    keys: list[str],
    time_ms: str = "epoch_ms",
    ties: list[str] = ("stream", "seq_num"),
) -> DataFrame:
    """One row per match: the key columns and the measures.

    Any other row of the key between two steps breaks a match. Attempts start at every row. Equal
    times are ordered by `ties`.
    """
    rows = flagged(events, sequence, list(keys), time_ms, list(ties))
    return match_flagged(rows, sequence, list(keys), len(ties))


def match_flagged(
    flagged_rows: DataFrame,
    sequence: Sequence,
    keys: list[str],
    ties: int,
    ended_after: int | None = None,
) -> DataFrame:
    """match_sequence over flagged rows; with `ended_after` only matches whose last row is later."""
    rows = bucketed(flagged_rows, sequence)
    return _adjacent(rows, sequence, keys, [*keys, "_bucket"], ties, ended_after)


def match_sequence_dense(
    events: DataFrame,
    sequence: Sequence,
    keys: list[str],
    time_ms: str = "epoch_ms",
    ties: list[str] = ("stream", "seq_num"),
    dense_rows: int = DENSE_ROWS,
) -> DataFrame:
    """match_sequence for keys that have more rows within one time bucket than a task should hold.

    Keys with over `dense_rows` rows in a bucket are found by an aggregation that combines before the
    shuffle. Their rows are numbered in order and cut into chunks of `dense_rows`, whatever the times; a
    chunk also gets the rows that follow it, one less than there are steps, since only adjacent rows can
    match. All other keys go by time buckets. The flagged rows and the numbered ones are written once, as
    scratch tables, as the result reads them.
    """
    if dense_rows < len(sequence.steps):
        raise ValueError("dense_rows must be at least the number of steps")
    rows, _ = stage(flagged(events, sequence, list(keys), time_ms, list(ties)), "flagged")
    sizes = rows.groupBy(*keys, whole_steps("_ms", sequence.bucket_ms).alias("_own")).count()
    dense, _ = stage(
        sizes.where(F.col("count") > dense_rows)
        .select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)])
        .distinct()
        .withColumn("_dense", F.monotonically_increasing_id()),
        "dense-keys",
    )
    found = dense.count()
    if not found:
        return match_flagged(rows, sequence, list(keys), len(ties))
    side = F.broadcast(dense) if found <= SMALL_SIDE_ROWS else dense
    same_key = reduce(
        Column.__and__, [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
    )
    sparse = match_flagged(rows.join(side, same_key, "left_anti"), sequence, list(keys), len(ties))

    order = ["_ms", *[f"_tie{i}" for i in range(len(ties))]]
    members = rows.join(side, same_key).drop(*[f"_key{i}" for i in range(len(keys))])
    placed = number_rows(members, ["_dense"], order, "_number")
    own, place = F.expr(f"_number DIV {dense_rows}L"), F.col("_number") % dense_rows
    handed_on = (place < len(sequence.steps) - 1) & (own > 0)
    chunks = (
        placed.withColumn("_own", own)
        .withColumn("_chunk", F.explode(F.when(handed_on, F.array(own, own - 1)).otherwise(F.array(own))))
        .withColumn("_home", F.col("_chunk") == F.col("_own"))
    )
    return sparse.unionByName(
        _adjacent(chunks, sequence, list(keys), ["_dense", "_chunk"], len(ties))
    )


def _adjacent(
    rows: DataFrame,
    sequence: Sequence,
    keys: list[str],
    group: list[str],
    ties: int,
    ended_after: int | None = None,
) -> DataFrame:
    """Matches of adjacent rows within every group that start in a row of its own (`_home`)."""
    inputs = sequence_inputs(sequence)
    order = ["_ms", *[f"_tie{i}" for i in range(ties)]]
    window = Window.partitionBy(*group).orderBy(*order)
    index = {name: i for i, name in enumerate(sequence.names)}
    last = len(sequence.steps) - 1

    def at(column: str, step: int) -> Column:
        return F.lead(column, step).over(window) if step else F.col(column)

    ahead = rows.select(
        *keys,
        "_home",
        *[at("_flags", i).alias(f"_flags{i}") for i in range(last + 1)],
        (at("_ms", last) - F.col("_ms")).alias("_span"),
        at("_ms", last).alias("_end"),
        *[
            at(f"_in{inputs.index(column)}", index[step]).alias(name)
            for name, (step, column) in sequence.measures.items()
        ],
        *[
            at(f"_same{i}", index[step]).alias(f"_same{i}_{step}")
            for i in range(len(sequence.same))
            for step in sequence.over
        ],
    )
    in_time = (
        F.col("_span") <= sequence.within_ms
        if sequence.inclusive
        else F.col("_span") < sequence.within_ms
    )
    keep = F.col("_home") & in_time
    if ended_after is not None:
        keep = keep & (F.col("_end") > ended_after)
    for i in range(last + 1):
        keep = keep & (F.col(f"_flags{i}").bitwiseAND(F.lit(1 << i)) != 0)
    for i in range(len(sequence.same)):
        first = F.col(f"_same{i}_{sequence.over[0]}")
        for step in sequence.over:
            keep = keep & (F.col(f"_same{i}_{step}") == first)
    return ahead.where(keep).select(*keys, *sequence.measures)


def reconcile(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows one side has more often than the other, with `status` and the number of copies.

    `missing` is in `expected` only, `extra` in `actual` only. One aggregation over both sides that
    combines before the shuffle, in place of two multiset differences.
    """
    columns = expected.columns
    both = actual.select(*columns, F.lit(1).alias("_side")).unionByName(
        expected.select(*columns, F.lit(-1).alias("_side"))
    )
    balance = both.groupBy(*columns).agg(F.sum("_side").alias("_balance"))
    return balance.where("_balance <> 0").select(
        *columns,
        F.when(F.col("_balance") > 0, F.lit("extra")).otherwise(F.lit("missing")).alias("status"),
        F.abs("_balance").alias("copies"),
    )
