"""Shaping plans so that costly expressions are evaluated once per row."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, keep: list[str], columns: dict[str, Column]) -> DataFrame:
    """`keep` plus the named expressions, each evaluated once whatever is built on top.

    The optimizer moves filters below a projection by copying its expressions into the condition, so
    a parsed value tested three times would be parsed three times, and once more for the output.
    It does not copy through a generator, and a generator over one struct adds no rows.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select(*keep, F.inline(F.array(row)))
