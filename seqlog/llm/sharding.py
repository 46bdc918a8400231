"""Shards of a corpus by a two-pass external shuffle.

Pass one scatters records by a seeded hash into buckets that fit in memory: the hash is uniform, so a
bucket holds about the same bytes whatever source, text or key is frequent. Pass two puts each bucket
into random order with Fisher-Yates (Spark's `shuffle` of an array) and writes it. Buckets one after
the other are one random order of the corpus; it is cut into shards whose row counts differ by at
most one. Bucket counts come first, as a small table, so every record gets its slot in its own task.

Spark's `shuffle` draws from the seed plus the number of the partition, so that number is fixed here: bucket b
is in partition b modulo their number, which follows from the bytes alone, and a partition goes through its
buckets in order. So rows, seed and bucket size decide the result, however the input is partitioned, and a
task that runs again gives the same.

Null ids and texts are hashed like values. Rows that share id and text are counted first; equal ones among
them are numbered, and the number is hashed too, so any number of them is scattered like other rows. Other
columns are carried along under their own names; where the input has a column `shard` or `slot`, the new one
is named with an underscore more. Maps cannot be sorted in Spark, so a column that holds one is refused. An
empty table gives no rows. A text larger than a bucket is one record of its bucket.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqlog.llm.common import free_name, shuffles_removed, table, written
from seqlog.plans.staging import join_side, remove_path, scratch_path

#: Text bytes of a bucket: an array in one task's memory.
BUCKET_BYTES = 16 << 20
#: Partitions of a pass; with more buckets a partition holds several, one after the other.
PARTITIONS = 10_000


def shard_rows(
    docs: DataFrame, shards: int = 8, seed: int = 1, bucket_bytes: int = BUCKET_BYTES,
    id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
) -> tuple[DataFrame, str]:
    """The written shards (columns of `docs`, shard, slot) and the folder they are in."""
    spark = docs.sparkSession
    if any("map<" in f.dataType.simpleString() for f in docs.schema):
        raise ValueError("a column that holds a map cannot be sorted")
    size = F.coalesce(F.octet_length(text_col), F.lit(0)) + 1
    total = docs.agg(F.count("*").alias("n"), F.sum(size).alias("bytes")).first()
    buckets = max(1, -(-(total["bytes"] or 0) // bucket_bytes))
    partitions = min(buckets, PARTITIONS)
    rows = docs.select(
        F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("_key"), F.struct("*").alias("_row")
    )
    shared, shared_path = written(rows.groupBy("_key").agg(F.count("*").alias("_n")).where("_n > 1"), "shared-keys")
    keyed = scattered(rows, shared).withColumn("_bucket", F.pmod("_key", F.lit(buckets)))
    records = keyed.select("_bucket", F.struct("_key", "_row").alias("_record"))
    counts = records.groupBy("_bucket").agg(F.count("*").alias("n"))
    offsets = counts.selectExpr(
        "_bucket", "sum(n) OVER (ORDER BY _bucket ROWS UNBOUNDED PRECEDING) - n AS _before"
    )
    gathered = (
        # A bucket's offset goes where its records go.
        records.unionByName(offsets, allowMissingColumns=True)
        .withColumn("_part", F.pmod("_bucket", F.lit(partitions)).cast("int"))
        .repartitionById(partitions, "_part")
    )
    # By _part as well, so that Spark sees that the rows of a group are together.
    gathered = gathered.groupBy("_part", "_bucket").agg(
        # Sorted first: the order in which blocks arrive must not reach the result.
        F.sort_array(F.collect_list("_record")).alias("_records"),
        F.max("_before").alias("_before"),
    )
    placed = (
        gathered.sortWithinPartitions("_bucket")
        .select("_before", F.shuffle("_records", seed).alias("_records"))
        .select("_before", F.posexplode("_records").alias("_place", "_record"))
        .withColumn("_place", F.col("_before") + F.col("_place"))
    )
    shard_name = free_name("shard", docs.columns)
    slot_name = free_name("slot", [*docs.columns, shard_name])
    shard = F.expr(f"_place * {shards} div {max(1, total['n'])}").cast("int")
    result = placed.select("_record._row", shard.alias("_shard"), "_place").select(
        *[F.col("_row").getField(c).alias(c) for c in docs.columns],
        F.col("_shard").alias(shard_name),
        F.expr(f"_place - (_shard * {total['n']}L + {shards - 1}) div {shards}").alias(slot_name),
    )
    path = path or scratch_path(spark, "shards")
    with shuffles_removed(spark):
        result.sortWithinPartitions(shard_name, slot_name).write.partitionBy(shard_name).parquet(path)
    remove_path(spark, shared_path)
    return spark.read.schema(result.schema).parquet(path), path


def scattered(rows: DataFrame, shared: DataFrame) -> DataFrame:
    """_key and _row, the number of a row among equal ones mixed into keys that are in `shared`."""
    marked = join_side(rows, shared, ["_key"], "left", F.monotonically_increasing_id())
    alone = marked.where("_n IS NULL").select("_key", "_row")
    # Equal rows cannot be told apart: they are counted, and as many are made again.
    equal = marked.where("_n IS NOT NULL").groupBy("_key", "_row").agg(F.count("*").alias("_n"))
    again = equal.select("_key", "_row", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_number"))
    return alone.union(again.select(F.xxhash64("_key", "_number").alias("_key"), "_row"))


def op6_sharding(spark, sf_dir) -> DataFrame:
    rows, _ = shard_rows(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
