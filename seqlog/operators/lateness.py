"""Which rows a bounded-lateness watermark leaves out, on a bounded input."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqlog.operators.numbering import running_max
from seqlog.plans.staging import join_side, stage


def late_rows(df: DataFrame, batch: str, time_ms: str = "epoch_ms", delay_ms: int = 5000) -> DataFrame:
    """Rows at or behind the watermark left by all earlier batches: largest time minus the delay.

    There is one mark per batch, written once. Up to a counted size marks are broadcast; beyond it the
    join is salted, so a batch with most of the rows spreads over tasks. Rows without batch or time are
    not late.
    """
    marks, _ = stage(running_max(df.select(batch, time_ms), batch, time_ms), "marks")
    joined = join_side(df, marks, [batch], "inner", spread=F.xxhash64(time_ms))
    return joined.where(F.col(time_ms) <= F.col("earlier") - F.lit(delay_ms)).select(*df.columns)
