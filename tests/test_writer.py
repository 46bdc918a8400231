"""The `seqlog` format as a sink: batch, streaming and SQL."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqlog.functions.codec import encode_json
from seqlog.plans.staging import child_names, scratch_path
from seqlog.plans.tables import UPSERT, LogTable, Tables
from seqlog.sinks import writer
from seqlog.sources import basin as basins
from seqlog.sources.basin import check_tail, commit_path, newest_fold, published_path, records, records_path
from seqlog.sources.datasource import read_stream, register
from seqlog.sources.options import SourceOptions
from seqlog.sources.scan import scan
from tests.helpers import append_lines, declare, pairs
from tests.test_log import remove, texts

ROW = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.IntegerType())])


def lines(spark, count, streams=3, partitions=4):
    at = F.col("id").cast("string")
    rows = spark.range(0, count, 1, partitions)
    return rows.select(F.concat(F.lit("h/ü="), (F.col("id") % streams)).alias("stream"), at.cast("binary").alias("body"))


def save(frame, basin, **options):
    register(frame.sparkSession)
    frame.write.format("seqlog").mode("append").option("basin", basin).options(**options).save()


def test_batch_keeps_the_order_of_partitions(spark, basin, monkeypatch):
    save(lines(spark, 1_000), basin)
    save(lines(spark, 30), basin)
    append_lines(spark, basin, [("h/ü=0", "last")])
    got = {}
    for stream, seq, text in texts(records(spark, basin)):
        got.setdefault(stream, []).append((seq, text))
    for k in range(3):
        expected = [str(i) for i in range(k, 1_000, 3)] + [str(i) for i in range(k, 30, 3)] + (["last"] if k == 0 else [])
        assert got[f"h/ü={k}"] == list(enumerate(expected))
    assert texts(scan(spark, SourceOptions(basin, discovery_prefix="h/"))) == texts(records(spark, basin))


def test_headers_origin_and_a_stream_for_all(spark, basin):
    declare(spark, basin, ("one", False, 7))
    name, value = F.lit(bytearray(b"n")).alias("name"), F.lit(bytearray(b"v")).alias("value")
    frame = lines(spark, 2, partitions=1).select("body", F.array(F.struct(name, value)).alias("headers"))
    save(frame, basin, stream="one")
    rows = records(spark, basin).collect()
    assert [(r.stream, r.seq_num) for r in rows] == [("one", 7), ("one", 8)]
    assert [(bytes(h.name), bytes(h.value)) for h in rows[0].headers] == [(b"n", b"v")]


def test_many_streams_in_one_task(spark, basin):
    """More streams than open files: a stream's records go on in a later file."""
    save(lines(spark, 1_000, streams=writer.OPEN_FILES + 50, partitions=1), basin)
    tails = dict(pairs(check_tail(spark, basin), "stream", "next_seq"))
    assert len(tails) == writer.OPEN_FILES + 50 and sum(tails.values()) == 1_000


def test_a_failed_write_leaves_nothing(spark, basin):
    save(lines(spark, 3), basin)
    broken = lines(spark, 100).withColumn("stream", F.when(F.col("body") != F.lit(bytearray(b"99")), F.col("stream")))
    with pytest.raises(Exception, match="record without a stream"):
        save(broken, basin)
    with pytest.raises(Exception, match="over the size limit"):
        save(lines(spark, 20), basin, maxRecordBytes="1")
    assert records(spark, basin).count() == 3
    save(lines(spark, 3), basin)
    assert pairs(check_tail(spark, basin), "next_seq") == [(2,)] * 3


def test_refusals(spark, basin):
    register(spark)
    frame = lines(spark, 3)
    for bad, options in (
        (frame.drop("stream"), {}),
        (frame.withColumn("body", F.lit("text")), {}),
        (frame.withColumn("more", F.lit(1)), {}),
        (frame, {"nonsense": "1"}),
    ):
        with pytest.raises(Exception):
            save(bad, basin, **options)
    with pytest.raises(Exception, match="set by the log"):
        save(frame.withColumn("seq_num", F.lit(5)), basin)
    with pytest.raises(Exception, match="overwritten"):
        frame.write.format("seqlog").mode("overwrite").option("basin", basin).save()
    assert not child_names(spark, f"{basin}/commits")


def test_sql_insert(spark, basin):
    register(spark)
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW log_view USING seqlog OPTIONS (basin '{basin}', stream 't')")
    spark.sql("INSERT INTO log_view (body) SELECT CAST(id AS STRING)::BINARY FROM range(0, 5, 1, 2)")
    spark.sql("INSERT INTO log_view (stream, body) VALUES ('t', 'x'::BINARY), ('u', 'y'::BINARY)")
    assert texts(spark.table("log_view")) == [*(("t", i, str(i)) for i in range(5)), ("t", 5, "x")]
    assert texts(records(spark, basin))[-1] == ("u", 0, "y")


def stream_of(spark, basin, prefix):
    return read_stream(spark, SourceOptions(basin, discovery_prefix=prefix)).select(
        F.concat(F.lit("out/"), "stream").alias("stream"), "headers", "body"
    )


def drained(frame, basin, checkpoint, writer="copy"):
    sink = frame.writeStream.format("seqlog").option("basin", basin).option("writer", writer)
    query = sink.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def test_stream_appends_every_batch_once(spark, basin, checkpoint):
    target = basins.create_basin(spark, scratch_path(spark, "test-target"))
    for i in range(3):
        append_lines(spark, basin, [("a", f"{i}{k}") for k in range(4)])
        drained(stream_of(spark, basin, ""), target, checkpoint)
    expected = [("out/a", i, f"{i // 4}{i % 4}") for i in range(12)]
    assert texts(records(spark, target)) == expected
    with pytest.raises(Exception, match="writer"):
        drained(stream_of(spark, basin, ""), target, scratch_path(spark, "c"), writer="")


@pytest.mark.parametrize("noted", [True, False])
def test_a_micro_batch_that_runs_again_adds_nothing(spark, basin, checkpoint, noted):
    """The query is broken off after its batch was published, before Spark noted that: the batch runs again."""
    target = basins.create_basin(spark, scratch_path(spark, "test-target"))
    for i in range(2):
        append_lines(spark, basin, [("a", str(i))])
        drained(stream_of(spark, basin, ""), target, checkpoint)
    remove(spark, f"{checkpoint}/commits/1")
    if not noted:
        remove(spark, published_path(target, "copy-000000000001"))
    folders = child_names(spark, records_path(target))
    drained(stream_of(spark, basin, ""), target, checkpoint)
    assert texts(records(spark, target)) == [("out/a", 0, "0"), ("out/a", 1, "1")]
    assert sorted(child_names(spark, records_path(target))) == sorted(folders)
    append_lines(spark, basin, [("a", "2")])
    drained(stream_of(spark, basin, ""), target, checkpoint)
    assert texts(records(spark, target))[-1] == ("out/a", 2, "2")


def test_table_streams_into_the_log(spark, basin, checkpoint):
    append_lines(spark, basin, [("a", '{"k":"x","v":1}'), ("a", '{"k":"y","v":2}')])
    source = LogTable(ROW, options={"basin": basin}, stream="a")
    for table, kind in (
        (LogTable(ROW, options={"basin": basin}, stream="plain"), []),
        (LogTable(ROW, connector=UPSERT, options={"basin": basin}, stream="keyed", keys=("k",)), ["+U"]),
    ):
        frame = source.read_stream(spark)
        for k in kind:
            frame = frame.withColumn("_kind", F.lit(k))
        sink = table.write_stream(frame, table.stream).option("checkpointLocation", f"{checkpoint}-{table.stream}")
        sink.trigger(availableNow=True).start().awaitTermination()
        assert pairs(table.read(spark), *ROW.names) == [("x", 1), ("y", 2)]


def test_inserts_are_folded(spark, basin, monkeypatch):
    monkeypatch.setattr(basins, "FOLD_EVERY", 2)
    tables = Tables(spark)
    tables.create("folded", LogTable(ROW, options={"basin": basin}, stream="t"))
    for i in range(5):
        tables.insert_into("folded", f"SELECT 'a' AS k, {i} AS v")
    assert newest_fold(spark, basin).upto == 3 and commit_path(basin, 4).endswith("4")
    assert pairs(spark.table("folded"), "v") == [(i,) for i in range(5)]
    assert encode_json(spark.table("folded"), ["k", "v"]).count() == 5
