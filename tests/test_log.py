import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqlog.functions.records import STREAMS_SCHEMA, no_headers
from seqlog.plans.staging import join_side, path_exists, scratch_path, shared_root
from seqlog.plans.tables import UPSERT, LogTable, Tables
from seqlog.sinks import append
from seqlog.sinks.append import append_to_stream, append_to_streams, write_upserts
from seqlog.sources import basin as basins
from seqlog.sources.basin import (
    check_tail,
    commit_path,
    create_basin,
    list_streams,
    live_streams,
    new_streams,
    newest_fold,
    positions,
    publish,
    published_path,
    records,
)
from seqlog.sources.datasource import escape, register
from seqlog.sources.options import REFUSED, SourceOptions
from seqlog.sources.scan import detect_trim_gap, read_limited, scan, stream_progress
from tests.helpers import append_lines, declare, pairs


def texts(frame):
    rows = frame.select("stream", "seq_num", F.col("body").cast("string").alias("t")).collect()
    return sorted((r["stream"], r["seq_num"], r["t"]) for r in rows)


def test_positions_are_contiguous_and_follow_the_order(spark, basin):
    rng = random.Random(1)
    rows = [(i, "a" if rng.random() < 0.6 else rng.choice("bcde")) for i in range(20_000)]
    frame = spark.createDataFrame(rows, "at bigint, stream string").repartition(7)
    encoded = frame.select(
        "at", "stream", F.col("at").cast("string").cast("binary").alias("body"), no_headers().alias("headers")
    )
    append_to_streams(encoded, basin, "stream", order_by=["at"])
    got = {}
    for stream, seq, text in texts(records(spark, basin)):
        got.setdefault(stream, []).append((seq, int(text)))
    for stream, line in got.items():
        assert line == list(enumerate(at for at, s in rows if s == stream))


def test_equal_order_values_still_number_without_gaps(spark, basin):
    frame = spark.range(5_000).select(
        F.lit(1).alias("at"), no_headers().alias("headers"), F.lit("x").cast("binary").alias("body")
    )
    append_to_stream(frame, basin, "s", order_by=["at"])
    seqs = sorted(r["seq_num"] for r in records(spark, basin).collect())
    assert seqs == list(range(5_000))


def test_arrival_order_without_an_order(spark, basin):
    frame = spark.range(1_000).coalesce(1).select(
        no_headers().alias("headers"), F.col("id").cast("string").cast("binary").alias("body")
    )
    append_to_stream(frame, basin, "s")
    assert [int(t) for _, _, t in texts(records(spark, basin))] == list(range(1_000))


def test_appends_continue_the_tail_and_repeat_nothing(spark, basin):
    append_lines(spark, basin, [("a", "0"), ("b", "0"), ("a", "1")], batch_id=0)
    append_lines(spark, basin, [("a", "2")], batch_id=1)
    append_lines(spark, basin, [("a", "2")], batch_id=1)
    append_lines(spark, basin, [("a", "3")])
    assert texts(records(spark, basin)) == [
        ("a", 0, "0"),
        ("a", 1, "1"),
        ("a", 2, "2"),
        ("a", 3, "3"),
        ("b", 0, "0"),
    ]
    assert pairs(check_tail(spark, basin), "stream", "next_seq") == [("a", 4), ("b", 1)]


def remove(spark, path):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def test_a_broken_append_is_replaced(spark, basin):
    """Records and files without a commit are what a crash before the publication leaves."""
    append_lines(spark, basin, [("a", "0")], batch_id=0)
    append_lines(spark, basin, [("a", "1"), ("a", "2")], batch_id=1)
    remove(spark, commit_path(basin, 1))
    remove(spark, published_path(basin, "test-000000000001"))
    source = SourceOptions(basin, ("a",))
    assert texts(scan(spark, source)) == [("a", 0, "0")]
    append_lines(spark, basin, [("a", "1"), ("a", "2")], batch_id=1)
    assert texts(scan(spark, source)) == [("a", 0, "0"), ("a", 1, "1"), ("a", 2, "2")]


def test_a_published_append_that_was_not_noted_is_not_repeated(spark, basin, monkeypatch):
    monkeypatch.setattr(append, "FOLD_EVERY", 2)
    for i in range(3):
        append_lines(spark, basin, [("a", str(i))], batch_id=i)
    for i in (0, 2):  # one that is folded, one that is not
        remove(spark, published_path(basin, f"test-{i:012d}"))
        append_lines(spark, basin, [("a", str(i))], batch_id=i)
    assert [(s, t) for _, s, t in texts(records(spark, basin))] == [(0, "0"), (1, "1"), (2, "2")]


def test_folds_carry_positions_and_tails(spark, basin, monkeypatch):
    """Readers work out the positions of the commits since the last fold only."""
    monkeypatch.setattr(append, "FOLD_EVERY", 3)
    declare(spark, basin, ("late", False, 40))
    for i in range(7):
        append_lines(spark, basin, [("a" if i else "b", str(i))], writer="one", batch_id=i)
    append_lines(spark, basin, [("c", "0"), ("late", "0"), ("late", "1")], writer="two")
    last = newest_fold(spark, basin)
    assert last.upto == 5 and len(last.positions) == 2
    tails = {"a": 6, "b": 1, "c": 1, "late": 42}
    assert dict(pairs(check_tail(spark, basin), "stream", "next_seq")) == tails
    expected = [("a", i, str(i + 1)) for i in range(6)] + [("b", 0, "0"), ("c", 0, "0"), ("late", 40, "0"), ("late", 41, "1")]
    assert texts(records(spark, basin)) == expected
    opened = []
    read = basins.read_text
    monkeypatch.setattr(basins, "read_text", lambda spark, path: opened.append(path) or read(spark, path))
    positions(spark, basin)
    assert len(opened) == 3  # commits 6 and 7, and that there is no 8
    earlier = check_tail(spark, basin, F.col("append_id") <= "one-000000000002")
    assert dict(pairs(earlier, "stream", "next_seq")) == {"a": 2, "b": 1, "c": 0, "late": 40}
    # A fold that was broken off does not count; the next one covers its commits, too.
    remove(spark, f"{last.tails}/_SUCCESS")
    assert newest_fold(spark, basin).upto == 2 and texts(records(spark, basin)) == expected
    append_lines(spark, basin, [("c", "1")])
    assert newest_fold(spark, basin).upto == 8
    assert texts(records(spark, basin)) == sorted([*expected, ("c", 1, "1")])
    register(spark)
    read = spark.read.format("seqlog").option("basin", basin).option("discoveryPrefix", "").load()
    assert texts(read) == sorted([*expected, ("c", 1, "1")])
    with pytest.raises(ValueError, match="writer"):
        append_lines(spark, basin, [("a", "x")], writer="a/b")


def test_a_missing_basin_is_an_error(spark):
    register(spark)
    reader = spark.read.format("seqlog").option("basin", scratch_path(spark, "nothing"))
    with pytest.raises(Exception):
        reader.option("discoveryPrefix", "h/").load().collect()


def test_an_append_leaves_no_staging_behind(spark, basin):
    folder = f"{shared_root(spark)}/seqlog-{spark.sparkContext.applicationId}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())

    def staged():
        names = [s.getPath().getName() for s in system.listStatus(hadoop)]
        return {n for n in names if n.startswith(("placed-", "runs-"))}

    before = staged()
    append_lines(spark, basin, [("a", "0")])
    assert staged() == before


def test_record_limits(spark, basin):
    big = spark.sql("SELECT CAST(repeat('x', 101) AS BINARY) AS body").withColumn("headers", no_headers())
    with pytest.raises(Exception, match="over the size limit"):
        append_to_stream(big, basin, "s", max_record_bytes=100)
    assert not path_exists(spark, commit_path(basin, 0))
    with pytest.raises(Exception, match="without a stream"):
        append_to_streams(big, basin, F.lit(None).cast("string"))
    for limit in (0, 1024 * 1024 + 1):
        with pytest.raises(ValueError):
            append_to_stream(big, basin, "s", max_record_bytes=limit)
    for missing in (("", "s"), (basin, "")):
        with pytest.raises(ValueError):
            append_to_stream(big, *missing)


def test_start_positions(spark, basin):
    append_lines(spark, basin, [("s", str(i)) for i in range(10)])
    declare(spark, basin, ("s", False, 5), ("empty", False, 0))

    def read(**options):
        resume = options.pop("resume", None)
        if resume is not None:
            resume = spark.createDataFrame([("s", resume)], "stream string, next_seq bigint")
        rows = scan(spark, SourceOptions(basin, ("s", "empty"), **options), resume=resume)
        return [seq for _, seq, _ in texts(rows)]

    assert read() == [5, 6, 7, 8, 9]
    assert read(start_behavior="NEXT") == []
    assert read(resume=7) == [7, 8, 9]
    assert read(resume=7, start_behavior="NEXT") == [7, 8, 9]
    assert read(resume=10) == []
    with pytest.raises(Exception, match="below the first retained position"):
        read(resume=3)
    tails = dict(pairs(check_tail(spark, basin), "stream", "next_seq"))
    assert tails == {"s": 10, "empty": 0}
    resume = spark.createDataFrame([("s", 3), ("empty", 0)], "stream string, next_seq bigint")
    gaps = detect_trim_gap(resume, list_streams(spark, basin))
    assert [tuple(r) for r in gaps.collect()] == [("s", 3, 5)]


def test_discovery(spark, basin):
    declare(spark, basin, ("h/0", False, 0), ("h/1", False, 0), ("g/9", False, 0))
    known = list_streams(spark, basin, "h/").select("stream")
    assert pairs(known, "stream") == [("h/0",), ("h/1",)]
    known = spark.createDataFrame(known.collect(), "stream string")
    declare(spark, basin, ("h/1", True, 0), ("h/2", False, 0), ("h/3", True, 0))
    listing = list_streams(spark, basin, "h/")
    assert pairs(live_streams(listing), "stream") == [("h/0",), ("h/2",)]
    assert pairs(new_streams(listing, known), "stream") == [("h/2",)]


def test_prefix_reads_live_streams_and_names_win_over_it(spark, basin):
    append_lines(spark, basin, [("h/0", "a"), ("h/1", "b"), ("g/0", "c")])
    declare(spark, basin, ("h/1", True, 0))
    by_prefix = scan(spark, SourceOptions(basin, discovery_prefix="h/"))
    assert texts(by_prefix) == [("h/0", 0, "a")]
    both = SourceOptions(basin, ("g/0", "h/1", "g/0"), discovery_prefix="h/")
    assert texts(scan(spark, both)) == [("g/0", 0, "c"), ("h/1", 0, "b")]


def test_limits_and_progress(spark, basin):
    append_lines(spark, basin, [("a", "xx") for _ in range(10)] + [("b", "y")])
    rows = records(spark, basin)
    assert [s for _, s, _ in texts(read_limited(rows, 4, 3))] == [4, 5, 6]
    trimmed = rows.where("stream = 'a' AND seq_num >= 5")
    assert [s for _, s, _ in texts(read_limited(trimmed, 3, 5))] == [5, 6, 7, 8, 9]
    listing = spark.createDataFrame([("a", 6), ("b", 0)], "stream string, first_seq long")
    assert [s for _, s, _ in texts(read_limited(rows, 3, 2, listing))] == [6, 7]
    progress = stream_progress(rows.where("seq_num >= 1"))
    assert pairs(progress, "stream", "next_seq", "consumed_records", "consumed_bytes") == [("a", 10, 9, 18)]


def test_stream_scan_prunes_partitions(spark, basin):
    append_lines(spark, basin, [("a", "0"), ("b", "0")])
    plan = scan(spark, SourceOptions(basin, ("a",)))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "stream" in plan.split("PartitionFilters: [")[1][:200]


def test_a_scan_opens_only_the_files_it_needs(spark, basin):
    for i in range(3):
        append_lines(spark, basin, [("a", str(2 * i)), ("a", str(2 * i + 1)), ("b", "x")], batch_id=i)
    source = SourceOptions(basin, discovery_prefix="")

    def opened(frame):
        return len([f for f in frame.inputFiles() if "/records/" in f])

    assert opened(scan(spark, source)) == 6
    resume = spark.createDataFrame([("a", 3), ("b", 3)], "stream string, next_seq bigint")
    rest = scan(spark, source, resume=resume)
    assert opened(rest) == 2
    assert [s for _, s, _ in texts(rest)] == [3, 4, 5]
    at_the_end = spark.createDataFrame([("a", 6), ("b", 3)], "stream string, next_seq bigint")
    assert scan(spark, source, resume=at_the_end).count() == 0


@pytest.mark.parametrize("writers", [("batch", "batch"), ("one", "two")])
def test_two_writers_never_share_positions(spark, basin, writers):
    def run(writer):
        for i in range(4):
            append_lines(spark, basin, [("a", f"{writer}{i}{k}") for k in range(5)], writer=writer)

    with ThreadPoolExecutor(2) as pool:
        for done in [pool.submit(run, w) for w in writers]:
            done.result()
    got = [(s, t) for _, s, t in texts(scan(spark, SourceOptions(basin, ("a",))))]
    assert [s for s, _ in got] == list(range(40))
    assert sorted(t for _, t in got) == sorted(f"{w}{i}{k}" for w in writers for i in range(4) for k in range(5))
    # Each append's records stay together and in order.
    assert all(got[i][1][-1] == str(i % 5) for i in range(40))


def test_one_of_many_gets_a_commit(spark, basin):
    with ThreadPoolExecutor(16) as pool:
        numbers = list(pool.map(lambda i: publish(spark, basin, f"x-{i}"), range(48)))
    assert sorted(numbers) == list(range(48))


def test_an_append_published_meanwhile_comes_first(spark, basin, monkeypatch):
    append_lines(spark, basin, [("a", "0")])
    raced = []

    def overtaken(session, where, append_id):
        if not raced:
            raced.append(True)
            append_lines(spark, basin, [("a", "first")], writer="other")
        return publish(session, where, append_id)

    monkeypatch.setattr(append, "publish", overtaken)
    append_lines(spark, basin, [("a", "second"), ("b", "0")])
    rows = texts(scan(spark, SourceOptions(basin, discovery_prefix="")))
    assert rows == [("a", 0, "0"), ("a", 1, "first"), ("a", 2, "second"), ("b", 0, "0")]
    append_lines(spark, basin, [("a", "third")])
    assert pairs(check_tail(spark, basin), "stream", "next_seq") == [("a", 4), ("b", 1)]


def test_files_are_in_order_however_a_task_cuts_them(spark, basin, monkeypatch):
    monkeypatch.setattr(append, "MAX_FILE_RECORDS", 3)
    lines = [("a", f"{i:04d}") for i in range(500)]
    append_lines(spark, basin, lines)
    assert texts(records(spark, basin)) == [("a", i, t) for i, (_, t) in enumerate(lines)]
    resume = spark.createDataFrame([("a", 77)], "stream string, next_seq bigint")
    assert [s for _, s, _ in texts(scan(spark, SourceOptions(basin, ("a",)), resume))] == list(range(77, 500))


def test_an_empty_stream_name_is_refused(spark, basin):
    with pytest.raises(Exception, match="record without a stream"):
        append_lines(spark, basin, [("", "x"), ("a", "y")])


def test_options():
    for bad in (
        dict(basin="", streams=("a",)),
        dict(basin="b"),
        dict(basin="b", streams=("",)),
        dict(basin="b", streams=("a",), start_behavior="LAST"),
        dict(basin="b", streams=("a",), max_records_per_stream=0),
        dict(basin="b", streams=("a",), max_records_per_stream=5),
    ):
        with pytest.raises(ValueError):
            SourceOptions(**bad)
    given = {"basin": "b", "streams": "a, c,a", "startBehavior": "next", "maxRecordsPerStream": "7", "availableNow": "false"}
    parsed = SourceOptions.parse(given)
    assert (parsed.streams, parsed.start_behavior, parsed.max_records_per_stream) == (("a", "c"), "NEXT", 7)
    assert SourceOptions.parse(parsed.as_reader_options()) == parsed
    for name in [*REFUSED, "nonsense"]:
        with pytest.raises(ValueError):
            SourceOptions.parse({"basin": "b", "streams": "a", name: "1"})


def test_source_format_agrees_with_the_scan(spark, basin):
    register(spark)
    names = ["h/a=b", "h/ü x", "h/%", "g"]
    append_lines(spark, basin, [(n, str(i)) for i in range(30) for n in names])
    append_lines(spark, basin, [(n, "more") for n in names])
    declare(spark, basin, ("h/%", False, 12))
    reader = spark.read.format("seqlog").option("basin", basin)
    read = reader.option("discoveryPrefix", "h/").option("recordsPerPartition", "7").load()
    expected = scan(spark, SourceOptions(basin, discovery_prefix="h/"))
    assert texts(read) == texts(expected)
    assert len(texts(read)) == 31 * 3 - 12
    assert read.schema == expected.schema
    narrow = read.where("stream = 'h/%' AND seq_num > 20 AND seq_num <= 25")
    assert [s for _, s, _ in texts(narrow)] == [21, 22, 23, 24, 25]
    assert read.where("seq_num >= 28 AND seq_num < 30").count() == 6
    assert escape("h/a=b") == "h%2Fa%3Db"


ROW = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.IntegerType())])


def test_plain_table(spark, basin):
    tables = Tables(spark)
    tables.create("plain_table", LogTable(ROW, options={"basin": basin}, stream="t", keys=("k",)))
    tables.insert_into("plain_table", "SELECT 1 AS v, 'a' AS k")
    tables.insert_into("plain_table", "SELECT 'a' AS k, 2 AS v")
    assert pairs(spark.table("plain_table"), "k", "v") == [("a", 1), ("a", 2)]
    with pytest.raises(Exception, match="inserts only"):
        tables.insert_into("plain_table", "SELECT 'a' AS k, 2 AS v, '-D' AS _kind")


def test_upsert_table(spark, basin):
    tables = Tables(spark)
    table = LogTable(ROW, connector=UPSERT, options={"basin": basin}, stream="t", keys=("k",))
    tables.create("upsert_table", table)
    tables.insert_into(
        "upsert_table",
        "SELECT * FROM VALUES (1, 'a', 1, '+I'), (2, 'b', 2, '+I'), (3, 'a', 3, '+U') AS t(at, k, v, _kind)",
        order_by=["at"],
    )
    tables.insert_into("upsert_table", "SELECT 'b' AS k, 9 AS v, '-D' AS _kind")
    rows = {tuple(r) for r in spark.table("upsert_table").collect()}
    assert rows == {("b", 2, "+U"), ("a", 3, "+U"), ("b", None, "-D")}


def test_text_and_raw_tables(spark, basin):
    one = T.StructType([T.StructField("line", T.StringType())])
    raw = T.StructType([T.StructField("data", T.BinaryType())])
    LogTable(one, format="text", options={"basin": basin}, stream="t").write(spark.sql("SELECT 'hi' AS line"))
    assert LogTable(one, format="text", options={"basin": basin}, stream="t").read(spark).first()[0] == "hi"
    assert bytes(LogTable(raw, format="raw", options={"basin": basin}, stream="t").read(spark).first()[0]) == b"hi"


def test_table_checks(basin):
    for bad in (
        dict(schema=ROW, connector="other"),
        dict(schema=ROW, format="avro"),
        dict(schema=ROW, format="text"),
        dict(schema=ROW, connector=UPSERT),
        dict(schema=ROW, connector=UPSERT, keys=("k", "v")),
        dict(schema=ROW, connector=UPSERT, format="raw", keys=("k",)),
    ):
        with pytest.raises(ValueError):
            LogTable(**bad)


def test_upserts_compact_one_append(spark, basin):
    frame = spark.createDataFrame(
        [(1, "a", 1), (2, "b", 2), (3, "a", 3)], "at int, k string, v int"
    )
    write_upserts(frame, basin, "t", ["k"], order_by=["at"])
    assert [t for _, _, t in texts(records(spark, basin))] == ['{"v":2}', '{"v":3}']


def test_create_basin_keeps_what_is_there(spark):
    path = create_basin(spark, scratch_path(spark, "again"))
    append_lines(spark, path, [("a", "0")])
    create_basin(spark, path)
    assert records(spark, path).count() == 1 and positions(spark, path).count() == 1
    assert list_streams(spark, path).schema.names == STREAMS_SCHEMA.names


@pytest.mark.parametrize("how", ["inner", "left"])
def test_a_side_too_large_to_broadcast_gives_the_same_join(spark, how):
    rows = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    side = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    small = join_side(rows, side, ["k"], how, F.col("v"))
    large = join_side(rows, side, ["k"], how, F.col("v"), limit=2)
    assert pairs_with_null(small) == pairs_with_null(large)


def pairs_with_null(frame):
    return sorted((r["k"], r["v"], -1 if r["w"] is None else r["w"]) for r in frame.collect())
