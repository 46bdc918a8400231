"""Mixing sources to target weights by Poisson replication.

A source's mean repetition rate is its target share of the mix over its share of the corpus. A document's
count is Poisson with that mean: a uniform number hashed from seed and id is put through the inverse
distribution, so a document's count never depends on partitions or other documents. Every document is
exploded by its count and the copies are scattered by a hashed key, sorted within the partitions.

Means above PART are a sum of independent parts, so the distribution table of a source stays short and
nothing underflows. That table has one row per source; documents meet it in a join that is broadcast up
to a counted size and salted beyond, so a source with a third of all rows is no hot key.

A null source is a source of its own. A source without target weight has weight zero and is not in the
mix. Rows with equal ids share their draw; null ids count as one id. Columns are kept as they are; where the
input has a column `copy`, `copies` or `order_key`, the new one is named with an underscore more. Texts are
only carried, whatever their length. An empty table gives no rows.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqlog.llm.common import free_name, table
from seqlog.plans.staging import join_side

#: Largest mean of one part, and terms of its distribution; the rest of the tail is below 1e-18.
PART, TERMS = 8, 48
#: Sources whose distribution tables may be broadcast; a table has some 400 bytes.
SMALL_SOURCES = 10_000
SEED = 7
#: Exponent of the default targets: 1 keeps the corpus' shares, 0 makes sources equal.
FLATTENING = 0.7


def flattened_targets(docs: DataFrame, power: float = FLATTENING, source_col: str = "source") -> DataFrame:
    """source, rows and weight proportional to rows ** power."""
    rows = docs.groupBy(F.col(source_col).alias("source")).agg(F.count("*").alias("n"))
    return rows.withColumn("weight", F.pow(F.col("n").cast("double"), F.lit(power)))


def uniform(seed: int, *keys: Column) -> Column:
    """A number in [0, 1) with 52 random bits."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("")) for k in keys]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def distributions(targets: DataFrame, epochs: float) -> DataFrame:
    """Per source: mean rate, number of parts and the distribution function of a part."""
    # Sums in whole millionths, so that they do not depend on the order of the sources.
    totals = targets.agg(
        F.sum("n").alias("rows"), F.sum(F.round(F.col("weight") * 1e6).cast("long")).alias("weight")
    ).first()
    all_rows, all_weight = totals["rows"] or 0, totals["weight"] or 1
    rates = targets.selectExpr(
        "source",
        "CAST(round(weight * 1e6) AS BIGINT) / CAST("
        f"{all_weight}L AS DOUBLE) * {all_rows}L * {epochs:.17g}D / n AS rate",
    )
    parts = rates.withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / PART)).cast("int"))
    return parts.withColumn(
        "table",
        F.expr(
            f"""aggregate(sequence(1, {TERMS}),
                  named_struct('p', exp(-rate / parts), 'c', exp(-rate / parts), 't', array(exp(-rate / parts))),
                  (a, k) -> named_struct('p', a.p * (rate / parts) / k, 'c', a.c + a.p * (rate / parts) / k,
                                         't', concat(a.t, array(a.c + a.p * (rate / parts) / k)))).t"""
        ),
    )


def mix(
    docs: DataFrame, targets: DataFrame | None = None, epochs: float = 1.0, seed: int = SEED,
    id_col: str = "doc_id", source_col: str = "source",
) -> DataFrame:
    """`docs` repeated by count, with `copy` (from 1), `copies` and `order_key`, the global order.

    `targets` has source, n (rows of the corpus) and weight; `epochs` is the size of the mix over the
    size of the corpus.
    """
    targets = flattened_targets(docs, source_col=source_col) if targets is None else targets
    side = distributions(targets, epochs).select(
        F.coalesce("source", F.lit("")).alias("_source"),
        F.col("source").isNull().alias("_none"),
        F.col("parts").alias("_parts"),
        F.col("table").alias("_table"),
    )
    rows = docs.select(
        F.struct("*").alias("_row"),
        F.col(id_col).alias("_id"),
        F.coalesce(source_col, F.lit("")).alias("_source"),
        F.col(source_col).isNull().alias("_none"),
    )
    joined = join_side(rows, side, ["_source", "_none"], "inner", F.xxhash64("_id"), SMALL_SOURCES)
    draws = F.aggregate(
        F.sequence(F.lit(1), F.col("_parts")),
        F.lit(0),
        lambda total, part: total
        + F.size(F.filter("_table", lambda c: c <= uniform(seed, F.col("_id"), part))),
    )
    key = F.md5(F.concat_ws("|", F.lit(f"{seed}|order"), F.coalesce(F.col("_id").cast("string"), F.lit("")), F.col("_copy")))
    names = [free_name(n, docs.columns) for n in ("copy", "copies", "order_key")]
    return (
        joined.select("_row", "_id", draws.alias("_copies"))
        .where("_copies > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .select(
            *[F.col("_row").getField(c).alias(c) for c in docs.columns],
            *[made.alias(name) for made, name in zip((F.col("_copy"), F.col("_copies"), key), names)],
        )
        .repartition(F.col(names[2]))
        .sortWithinPartitions(names[2])
    )


def op7_mixing(spark, sf_dir) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def mix_sql(docs: str, columns: str, epochs: float = 1.0, seed: int = SEED, power: float = FLATTENING) -> str:
    """The same rows in DuckDB; `docs` names the input."""
    draw = f"('0x' || left(md5('{seed}|' || coalesce(CAST(d.doc_id AS VARCHAR), '') || '|' || part), 13))::BIGINT::DOUBLE / {1 << 52}"
    return f"""
    WITH counted AS (SELECT source, count(*) AS n, CAST(round(pow(count(*)::DOUBLE, {power}) * 1e6) AS BIGINT) AS weight
                     FROM {docs} GROUP BY source),
    rates AS (SELECT source, weight / CAST(sum(weight) OVER () AS DOUBLE) * CAST(sum(n) OVER () AS BIGINT) * {epochs:.17g} / n AS rate FROM counted),
    parts AS (SELECT source, rate, greatest(1, CAST(ceil(rate / {PART}) AS INT)) AS parts FROM rates),
    terms AS (SELECT source, 0 AS k, exp(-rate / parts) AS p, exp(-rate / parts) AS c, rate / parts AS mean FROM parts),
    tables AS (
      WITH RECURSIVE t AS (SELECT * FROM terms UNION ALL
        SELECT source, k + 1, p * mean / (k + 1), c + p * mean / (k + 1), mean FROM t WHERE k < {TERMS})
      SELECT source, list(c ORDER BY k) AS entries FROM t GROUP BY source),
    drawn AS (
      SELECT d.*, CAST(list_sum(list_transform(range(1, parts + 1), lambda part: len(list_filter(entries, lambda c: c <= {draw})))) AS INT) AS copies
      FROM {docs} d JOIN parts USING (source) JOIN tables USING (source))
    SELECT {columns}, CAST(copy AS INT) AS copy, copies,
           md5('{seed}|order|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || copy) AS order_key
    FROM (SELECT *, unnest(range(1, copies + 1)) AS copy FROM drawn WHERE copies > 0)"""


OP7_SQL = mix_sql("documents", "doc_id, text, lang, source, n_chars")
