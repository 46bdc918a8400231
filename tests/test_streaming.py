"""Streaming twins against their batch operators, restarts included."""

import random
import re
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqlog.functions.codec import (
    custom_encode,
    decode_text,
    decode_with_context,
    encode_json,
    flat_decode,
    json_decode,
    parse_kv_events,
    parse_kv_rejects,
    with_watermark,
)
from seqlog.operators.changelog import (
    compact_upserts,
    latest_per_key,
    materialize_latest,
    upsert_decode,
    upsert_encode,
    with_key_action,
)
from seqlog.operators.pattern import match_sequence
from seqlog.operators.topk import count_by, top_k_lists
from seqlog.plans.jobs import (
    CONVERSION_SCHEMA,
    FEATURE_SCHEMA,
    FEATURE_STREAM,
    ROLLUP_STREAM,
    conversion_sequence,
    conversions,
    drain,
    features,
    start_context_print,
    start_conversions,
    start_features,
)
from seqlog.plans.tables import UPSERT, LogTable
from seqlog.sinks.append import append_sink, append_to_stream, fan_out, upsert_sink
from seqlog.sources.basin import records
from seqlog.sources.datasource import read_stream
from seqlog.sources.options import SourceOptions
from seqlog.sources.scan import observe_progress, scan
from seqlog.streaming.matcher import match_sequence_stream, matches_only
from seqlog.streaming.topk import top_k_stream
from tests.helpers import append_lines, declare
from tests.test_pattern import SAMPLE


@pytest.fixture(autouse=True, scope="module")
def few_state_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


class Sink:
    """Collects what each micro-batch holds."""

    def __init__(self):
        self.batches = {}

    def __call__(self, frame, batch_id):
        self.batches[batch_id] = [tuple(r) for r in frame.collect()]

    @property
    def rows(self):
        return [row for batch in self.batches.values() for row in batch]


def start(frame, checkpoint, sink, mode="append"):
    writer = frame.writeStream.foreachBatch(sink).outputMode(mode)
    return writer.option("checkpointLocation", checkpoint).start()


def run(frame, checkpoint, mode="append"):
    sink = Sink()
    query = start(frame, checkpoint, sink, mode)
    drain(query)
    return sink


def seqs(frame):
    return frame.select("stream", "seq_num")


# --- source -------------------------------------------------------------------------------------


def test_fixed_streams_and_resume(spark, basin, checkpoint):
    append_lines(spark, basin, [("a", "0"), ("b", "0"), ("c", "0"), ("a", "1")])
    source = SourceOptions(basin, ("a", "b", "a"))
    first = run(seqs(read_stream(spark, source)), checkpoint)
    assert sorted(first.rows) == [("a", 0), ("a", 1), ("b", 0)]
    assert run(seqs(read_stream(spark, source)), checkpoint).rows == []
    append_lines(spark, basin, [("a", "2"), ("c", "1")])
    assert run(seqs(read_stream(spark, source)), checkpoint).rows == [("a", 2)]
    # A name added to the list later starts by the start behaviour.
    wider = SourceOptions(basin, ("a", "b", "c"))
    assert sorted(run(seqs(read_stream(spark, wider)), checkpoint).rows) == [("c", 0), ("c", 1)]


def test_stream_equals_scan_in_small_ranges(spark, basin, checkpoint):
    append_lines(spark, basin, [(f"h/{i % 3}", str(i)) for i in range(100)])
    append_lines(spark, basin, [(f"h/{i % 4}", str(i)) for i in range(50)])
    source = SourceOptions(basin, discovery_prefix="h/", records_per_partition=7)
    got = run(read_stream(spark, source), checkpoint).rows
    assert sorted(map(repr, got)) == sorted(repr(tuple(r)) for r in scan(spark, source).collect())


def test_streams_appear_while_running(spark, basin, checkpoint):
    append_lines(spark, basin, [("h/0", "0"), ("g/0", "0")])
    declare(spark, basin, ("h/9", True, 0))
    source = SourceOptions(basin, discovery_prefix="h/", discovery_interval_ms=1)
    sink = Sink()
    query = start(seqs(read_stream(spark, source)), checkpoint, sink)
    try:
        query.processAllAvailable()
        append_lines(spark, basin, [("h/1", "0"), ("h/0", "1"), ("h/9", "0")])
        query.processAllAvailable()
        # A known stream stays known after it is deleted: what is left is read.
        declare(spark, basin, ("h/1", True, 0))
        append_lines(spark, basin, [("h/1", "1")])
        query.processAllAvailable()
    finally:
        query.stop()
    assert sorted(sink.rows) == [("h/0", 0), ("h/0", 1), ("h/1", 0), ("h/1", 1)]


def test_without_an_interval_streams_are_listed_once(spark, basin, checkpoint):
    append_lines(spark, basin, [("h/0", "0")])
    source = SourceOptions(basin, discovery_prefix="h/")
    sink = Sink()
    query = start(seqs(read_stream(spark, source)), checkpoint, sink)
    try:
        query.processAllAvailable()
        append_lines(spark, basin, [("h/1", "0"), ("h/0", "1")])
        query.processAllAvailable()
    finally:
        query.stop()
    assert sorted(sink.rows) == [("h/0", 0), ("h/0", 1)]
    # The next start lists again.
    assert run(seqs(read_stream(spark, source)), checkpoint).rows == [("h/1", 0)]


def test_start_at_next_is_pinned(spark, basin, checkpoint):
    append_lines(spark, basin, [("h/0", "0"), ("h/0", "1")])
    source = SourceOptions(
        basin, discovery_prefix="h/", start_behavior="NEXT", discovery_interval_ms=1
    )
    assert run(seqs(read_stream(spark, source)), checkpoint).rows == []
    append_lines(spark, basin, [("h/0", "2")])
    assert run(seqs(read_stream(spark, source)), checkpoint).rows == [("h/0", 2)]


def test_progress_is_a_metric_of_every_batch(spark, basin, checkpoint):
    append_lines(spark, basin, [("a", "xx"), ("a", "yyy"), ("b", "z")])
    log = observe_progress(read_stream(spark, SourceOptions(basin, ("a", "b"))))
    query = start(log, checkpoint, Sink())
    try:
        query.processAllAvailable()
        observed = [p.observedMetrics["progress"] for p in query.recentProgress if p.numInputRows]
    finally:
        query.stop()
    assert [(o["consumed_records"], o["consumed_bytes"]) for o in observed] == [(3, 6)]


def test_cap_bounds_every_batch(spark, basin, checkpoint):
    append_lines(spark, basin, [("a", str(i)) for i in range(10)] + [("b", "0")])
    source = SourceOptions(basin, ("a", "b"), max_records_per_stream=4, available_now=False)
    sink = run(seqs(read_stream(spark, source)), checkpoint)
    assert [len(b) for b in sink.batches.values() if b] == [5, 4, 2]
    assert sorted(sink.rows) == [("a", i) for i in range(10)] + [("b", 0)]
    append_lines(spark, basin, [("a", str(i)) for i in range(10, 16)])
    again = run(seqs(read_stream(spark, source)), checkpoint)
    assert [len(b) for b in again.batches.values() if b] == [4, 2]
    assert sorted(again.rows) == [("a", i) for i in range(10, 16)]


def test_a_new_checkpoint_appends_its_own_batches(spark, basin, checkpoint):
    """Batch ids of two queries are not the same batches, whatever the sink is called."""
    for part, lines in enumerate((["a", "b", "c"], ["d", "e"])):
        source = f"in/{part}"
        append_lines(spark, basin, [(source, line) for line in lines], writer=f"in{part}")
        frame = read_stream(spark, SourceOptions(basin, (source,))).select("headers", "body")
        sink = append_sink(basin, F.lit("out"), "copy")
        for _ in range(2):  # the same checkpoint again adds nothing
            writer = frame.writeStream.foreachBatch(sink).option("checkpointLocation", f"{checkpoint}-{part}")
            drain(writer.start())
    out = records(spark, basin).where("stream = 'out'").orderBy("seq_num").collect()
    assert [r.seq_num for r in out] == [0, 1, 2, 3, 4]
    assert sorted(bytes(r.body).decode() for r in out) == ["a", "b", "c", "d", "e"]


def test_available_now_ignores_the_cap(spark, basin, checkpoint):
    append_lines(spark, basin, [("a", str(i)) for i in range(10)])
    source = SourceOptions(basin, ("a",), max_records_per_stream=4, available_now=True)
    sink = Sink()
    frame = seqs(read_stream(spark, source))
    writer = frame.writeStream.foreachBatch(sink).trigger(availableNow=True)
    writer.option("checkpointLocation", checkpoint).start().awaitTermination()
    assert len(sink.rows) == 10


def test_first_position_and_trim_gap(spark, basin, checkpoint):
    append_lines(spark, basin, [("a", str(i)) for i in range(6)])
    declare(spark, basin, ("a", False, 2))
    source = SourceOptions(basin, ("a",))
    first = run(seqs(read_stream(spark, source)), checkpoint)
    assert sorted(first.rows) == [("a", i) for i in range(2, 6)]
    append_lines(spark, basin, [("a", str(i)) for i in range(6, 10)])
    declare(spark, basin, ("a", False, 8))
    query = start(seqs(read_stream(spark, source)), checkpoint, Sink())
    with pytest.raises(Exception, match="below the first retained"):
        try:
            query.processAllAvailable()
        finally:
            query.stop()
    lenient = SourceOptions(basin, ("a",), fail_on_data_loss=False)
    assert sorted(run(seqs(read_stream(spark, lenient)), checkpoint).rows) == [("a", 8), ("a", 9)]


# --- stateless operators ------------------------------------------------------------------------

STATE = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.IntegerType())])


def split_pieces(log):
    # A nested function travels to the workers by value; this module is not installed there.
    def pieces(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            split = pc.split_pattern(batch.column("body").cast(pa.string()), ";")
            yield pa.RecordBatch.from_arrays([pc.list_flatten(split)], names=["p"])

    return flat_decode(log, pieces, "p string")


def change_lines(spark, basin, changes, writer="changes"):
    """changes: (at, k, v, kind), appended without compaction."""
    frame = spark.createDataFrame(changes, "at bigint, k string, v int, _kind string")
    encoded = upsert_encode(frame, ["k"], ["k", "v"], keep=["at"])
    append_to_stream(encoded, basin, "changes", order_by=["at"], writer=writer)


STATELESS = {
    "text": lambda log: decode_text(log),
    "context": lambda log: decode_with_context(log),
    "flat": split_pieces,
    "json": lambda log: json_decode(log, STATE, on_error="dead_letter").select("seq_num", "k", "v", "_corrupt"),
    "events": lambda log: parse_kv_events(log),
    "rejects": lambda log: parse_kv_rejects(log),
    "encode_json": lambda log: encode_json(parse_kv_events(log)).select(F.col("body").cast("string")),
    "custom_encode": lambda log: custom_encode(decode_text(log), F.upper("text")).select(
        F.col("body").cast("string")
    ),
}


@pytest.mark.parametrize("name", sorted(STATELESS))
def test_stateless_twins(spark, basin, checkpoint, name):
    lines = SAMPLE + ["broken", "user=1;user=2;epoch_ms=1", '{"k":"a","v":1}', ""]
    append_lines(spark, basin, [(f"h/{i % 2}", line) for i, line in enumerate(lines)])
    source = SourceOptions(basin, discovery_prefix="h/")
    expected = [tuple(r) for r in STATELESS[name](scan(spark, source)).collect()]
    got = run(STATELESS[name](read_stream(spark, source)), checkpoint).rows
    assert expected and sorted(map(repr, got)) == sorted(map(repr, expected))


def test_changelog_twins(spark, basin, checkpoint):
    rng = random.Random(2)
    changes = [(i, rng.choice("abcd"), i, rng.choice(["+I", "+U", "-D"])) for i in range(80)]
    change_lines(spark, basin, changes[:50])
    change_lines(spark, basin, changes[50:])
    source = SourceOptions(basin, ("changes",))
    batch = scan(spark, source)

    decoded = run(upsert_decode(read_stream(spark, source), STATE, ["k"]), checkpoint + "-d").rows
    assert sorted(map(repr, decoded)) == sorted(
        repr(tuple(r)) for r in upsert_decode(batch, STATE, ["k"]).collect()
    )
    found = run(with_key_action(read_stream(spark, source)).select("seq_num", "_action"), checkpoint + "-k")
    assert len(found.rows) == 80
    encoded = run(
        upsert_encode(upsert_decode(read_stream(spark, source), STATE, ["k"]), ["k"]).select(
            F.col("body").cast("string")
        ),
        checkpoint + "-e",
    ).rows
    assert sorted(encoded) == sorted(
        tuple(r) for r in batch.select(F.col("body").cast("string")).collect()
    )


def test_state_follows_the_stream(spark, basin, checkpoint):
    """latest_per_key in update mode, folded over batches and a restart, equals the batch state."""
    source = SourceOptions(basin, ("changes",))
    state = {}
    rng = random.Random(4)
    at = 0
    for _ in range(3):
        changes = [(at + i, rng.choice("abcde"), at + i, rng.choice(["+I", "-D"])) for i in range(20)]
        at += 20
        change_lines(spark, basin, changes)
        frame = latest_per_key(read_stream(spark, source)).select(
            F.col("_key").cast("string"), "_action", F.col("body").cast("string")
        )
        for key, action, body in run(frame, checkpoint, mode="update").rows:
            state[key] = None if action == "d" else body
        live = {f'{{"k":"{r["k"]}"}}': f'{{"v":{r["v"]}}}' for r in
                materialize_latest(scan(spark, source), STATE, ["k"]).collect()}
        assert {k: v for k, v in state.items() if v is not None} == live


def test_streaming_upsert_table_source(spark, basin, checkpoint):
    change_lines(spark, basin, [(0, "a", 1, "+I"), (1, "a", 2, "-D")])
    table = LogTable(STATE, connector=UPSERT, options={"basin": basin}, stream="changes", keys=("k",))
    table.read_stream(spark).createOrReplaceTempView("streaming_changes")
    rows = run(spark.sql("SELECT k, v, _kind FROM streaming_changes"), checkpoint).rows
    assert rows == [("a", 1, "+U"), ("a", None, "-D")]


# --- sinks --------------------------------------------------------------------------------------


def body_texts(spark, basin, stream):
    rows = records(spark, basin).where(F.col("stream") == stream)
    return [r[0] for r in rows.orderBy("seq_num").select(F.col("body").cast("string")).collect()]


def test_append_sink_and_fan_out(spark, basin, checkpoint):
    append_lines(spark, basin, [("in", f'{{"k":"{c}","v":{i}}}') for i, c in enumerate("abab")])
    source = SourceOptions(basin, ("in",))

    def job():
        decoded = json_decode(read_stream(spark, source).select("seq_num", "body"), STATE)
        sinks = fan_out(
            append_sink(
                basin,
                F.lit("out/all"),
                "all",
                lambda df: encode_json(df, ["k", "v"], keep=["seq_num"]),
                order_by=["seq_num"],
            ),
            upsert_sink(basin, "out/state", ["k"], "state", columns=["k", "v"], order_by=["seq_num"]),
        )
        return decoded.writeStream.foreachBatch(sinks).option("checkpointLocation", checkpoint).start()

    drain(job())
    append_lines(spark, basin, [("in", '{"k":"c","v":9}')])
    drain(job())
    assert body_texts(spark, basin, "out/all") == body_texts(spark, basin, "in")
    assert body_texts(spark, basin, "out/state") == ['{"v":2}', '{"v":3}', '{"v":9}']


def test_a_replayed_batch_adds_nothing(spark, basin):
    sink = append_sink(basin, F.lit("out"), "w", lambda df: custom_encode(df, F.col("x")))
    frame = spark.sql("SELECT 'one' AS x")
    for batch in (0, 0, 1, 1, 0):
        sink(frame, batch)
    assert body_texts(spark, basin, "out") == ["one", "one"]


def test_routed_and_compacted_inside_a_batch(spark, basin, checkpoint):
    change_lines(spark, basin, [(0, "a", 1, "+I"), (1, "b", 2, "+I"), (2, "a", 3, "+U")])
    log = read_stream(spark, SourceOptions(basin, ("changes",)))

    def write(df, batch_id):
        kept = compact_upserts(df)
        route = F.concat(F.lit("by/"), F.get_json_object(with_key(df), "$.k"))
        append_sink(basin, route, "route", order_by=["seq_num"])(kept, batch_id)

    def with_key(df):
        return F.col("headers")[0]["value"].cast("string")

    drain(start(log, checkpoint, write))
    assert body_texts(spark, basin, "by/a") == ['{"v":3}']
    assert body_texts(spark, basin, "by/b") == ['{"v":2}']


def test_console(spark, basin, checkpoint):
    append_lines(spark, basin, [("a", "0")])
    query = start_context_print(spark, SourceOptions(basin, ("a",)), checkpoint, trigger=None)
    drain(query)
    assert query.exception() is None


# --- event time ---------------------------------------------------------------------------------

ACTIONS = ["search", "view", "cart", "buy"]


def journeys(seed, count, users, step_ms=900):
    """Lines of mostly finished journeys, in time order, two events never at the same time."""
    rng = random.Random(seed)
    lines, at = [], 1_700_000_000_000
    progress = {u: 0 for u in range(users)}
    for _ in range(count):
        at += rng.randint(1, step_ms)
        user = 0 if rng.random() < 0.33 else rng.randrange(users)
        step = progress[user]
        if rng.random() < 0.1:
            step = rng.randrange(4)
        progress[user] = (step + 1) % 4
        detail = f"search=q{rng.randrange(6)}" if step == 0 else f"item={rng.randrange(4)};action={ACTIONS[step]}"
        lines.append((at, f"user={user};{detail};epoch_ms={at}"))
    return lines


def shuffled(lines, seed, within_ms=4_000):
    """The same lines, displaced by less than the lateness bound."""
    rng = random.Random(seed)
    return [line for _, line in sorted((at + rng.randint(0, within_ms), line) for at, line in lines)]


def expected_conversions(spark, lines, sequence):
    """Batch answer over the rows the watermark has passed at the end."""
    texts = spark.createDataFrame([("h", i, t) for i, (_, t) in enumerate(lines)], "stream string, seq_num bigint, body string")
    parsed = parse_kv_events(texts.withColumn("body", F.col("body").cast("binary")))
    passed = lines[-1][0] - 5_000
    return sorted(tuple(r) for r in conversions(parsed.where(F.col("epoch_ms") <= passed), sequence).collect())


@pytest.mark.parametrize("within_ms", [600_000, 20_000])
def test_matcher_equals_batch(spark, basin, checkpoint, within_ms):
    lines = journeys(within_ms, 600, 7)
    sequence = conversion_sequence(within_ms)
    expected = expected_conversions(spark, lines, sequence)
    arrival = shuffled(lines, 3)
    for part in range(2):
        chunk = arrival[part * 300 : (part + 1) * 300]
        append_lines(spark, basin, [(f"host/{i % 3}", t) for i, t in enumerate(chunk)])
        # Stopped and restarted for every part.
        drain(start_conversions(spark, basin, checkpoint, sequence, trigger=None))
    log = records(spark, basin).where(F.col("stream") == ROLLUP_STREAM)
    got = [tuple(r) for r in json_decode(log.select("body"), CONVERSION_SCHEMA).collect()]
    assert sorted(got) == expected
    assert len(got) > 20


def test_buckets_do_not_change_the_stream(spark, basin, checkpoint):
    """Matches across many narrow buckets, with the generic matcher and all its options."""
    from dataclasses import replace

    lines = journeys(9, 500, 3)
    append_lines(spark, basin, [("host/0", t) for t in shuffled(lines, 1)])
    sequence = replace(
        conversion_sequence(6_000, inclusive=True, same_item=True),
        bucket_factor=1,
        same=("item_id % 2",),
    )
    source = SourceOptions(basin, ("host/0",))
    events = parse_kv_events(read_stream(spark, source))
    found = run(matches_only(match_sequence_stream(events, sequence, ["user_id"])), checkpoint).rows
    passed = F.col("epoch_ms") <= lines[-1][0] - 5_000
    batch = match_sequence(parse_kv_events(scan(spark, source)).where(passed), sequence, ["user_id"])
    assert sorted(found) == sorted(tuple(r) for r in batch.collect())
    assert len(found) > 5


def test_documentation_sample_needs_the_watermark(spark, basin, checkpoint):
    append_lines(spark, basin, [("host/0000", line) for line in SAMPLE[:-1]])
    drain(start_conversions(spark, basin, checkpoint, trigger=None))
    assert body_texts(spark, basin, ROLLUP_STREAM) == []
    append_lines(spark, basin, [("host/0001", SAMPLE[-1])])
    drain(start_conversions(spark, basin, checkpoint, trigger=None))
    assert body_texts(spark, basin, ROLLUP_STREAM) == [
        '{"userId":7,"matchedSearchQuery":"kettle","matchedItemId":12}'
    ]


def test_late_rows_take_no_part_and_are_counted(spark, basin, checkpoint):
    def line(user, what, at):
        return ("host/0", f"user={user};{what};epoch_ms={at}")

    source = SourceOptions(basin, ("host/0",))
    found = match_sequence_stream(
        parse_kv_events(read_stream(spark, source)), conversion_sequence(), ["user_id"]
    )
    sink = Sink()
    query = start(found, checkpoint, sink)
    try:
        append_lines(spark, basin, [line(1, "search=q", 1_000), line(9, "search=z", 100_000)])
        query.processAllAvailable()
        # The watermark is at 95,000: the first of these is late, the rest is not.
        append_lines(
            spark,
            basin,
            [
                line(1, "item=1;action=view", 95_000),
                line(1, "item=1;action=view", 95_001),
                line(1, "item=1;action=cart", 95_002),
                line(1, "item=1;action=buy", 95_003),
                line(9, "search=z", 900_000),
            ],
        )
        query.processAllAvailable()
        progress = [o for p in query.recentProgress for o in p["stateOperators"]]
    finally:
        query.stop()
    # Spark drops what is late when the batch starts; the processor reports what still got through.
    dropped = sum(o["numRowsDroppedByWatermark"] for o in progress)
    reported = sum(row[3] for row in sink.rows if row[3])
    assert [row for row in sink.rows if row[3] is None] == [(1, "q", 1, None)]
    assert dropped + reported >= 1


def test_a_quiet_stream_does_not_hold_the_watermark(spark, basin, checkpoint):
    """The watermark follows the newest event of all streams, so filler events are not needed."""
    append_lines(spark, basin, [("host/0", SAMPLE[0])] + [("host/1", l) for l in SAMPLE[1:]])
    declare(spark, basin, ("host/quiet", False, 0))
    drain(start_conversions(spark, basin, checkpoint, trigger=None))
    assert len(body_texts(spark, basin, ROLLUP_STREAM)) == 1


@pytest.mark.parametrize("grouped", [False, True])
def test_a_lagging_group_with_its_own_watermark_is_not_late(spark, basin, checkpoint, grouped):
    """One host runs an hour behind the other; read batch by batch."""

    def lines(host, user, start):
        steps = ["search=q", "item=1;action=view", "item=1;action=cart", "item=1;action=buy"]
        return [(host, f"user={user};{what};epoch_ms={start + i}") for i, what in enumerate(steps)]

    early, late = lines("host/a", 1, 1_000), lines("host/b", 2, 3_600_000)
    early.append(("host/a", "user=1;search=z;epoch_ms=7000000"))
    late.append(("host/b", "user=2;search=z;epoch_ms=7000000"))
    append_lines(spark, basin, early + late)
    # A batch holds one record of each stream, so the watermark of one query soon passes host/a.
    drain(
        start_conversions(
            spark,
            basin,
            checkpoint,
            trigger=None,
            max_records_per_stream=1,
            prefixes=("host/a", "host/b") if grouped else ("host/",),
        )
    )
    log = records(spark, basin).where(F.col("stream") == ROLLUP_STREAM)
    users = {r["userId"] for r in json_decode(log.select("body"), CONVERSION_SCHEMA).collect()}
    assert users == ({1, 2} if grouped else {2})


def test_watermark_column(spark, basin, checkpoint):
    append_lines(spark, basin, [("host/0", line) for line in SAMPLE])
    events = with_watermark(parse_kv_events(read_stream(spark, SourceOptions(basin, ("host/0",)))))
    counts = events.groupBy(F.window("event_time", "1 minute")).count()
    sink = Sink()
    query = start(counts, checkpoint, sink)
    try:
        query.processAllAvailable()
        marks = [p["eventTime"].get("watermark") for p in query.recentProgress if p["eventTime"]]
    finally:
        query.stop()
    newest = max(int(re.search(r"epoch_ms=(\d+)", line)[1]) for line in SAMPLE)
    mark = datetime.fromtimestamp(newest // 1000 - 5, timezone.utc)
    assert marks[-1] == mark.strftime("%Y-%m-%dT%H:%M:%S.") + f"{newest % 1000:03d}Z"
    # The last line closes the window of the others.
    assert [row[1] for row in sink.rows] == [len(SAMPLE) - 1]


# --- counts and lists ---------------------------------------------------------------------------


def conversion_rows(seed, count):
    rng = random.Random(seed)
    return [(rng.randrange(50), f"q{min(rng.randrange(12), rng.randrange(12))}", 0 if rng.random() < 0.4 else rng.randrange(6))
            for _ in range(count)]


def append_conversions(spark, basin, rows, writer="rollup"):
    frame = spark.createDataFrame(rows, CONVERSION_SCHEMA)
    append_to_stream(encode_json(frame), basin, ROLLUP_STREAM, writer=writer)


def test_counts_in_update_mode(spark, basin, checkpoint):
    counts, rows = {}, []
    for seed in range(2):
        part = conversion_rows(seed, 60)
        rows += part
        append_conversions(spark, basin, part)
        log = read_stream(spark, SourceOptions(basin, (ROLLUP_STREAM,)))
        decoded = json_decode(log.select("body"), CONVERSION_SCHEMA)
        frame = count_by(decoded, ["matchedItemId", "matchedSearchQuery"])
        for item, query, n in run(frame, checkpoint, mode="update").rows:
            counts[item, query] = n
    batch = count_by(spark.createDataFrame(rows, CONVERSION_SCHEMA), ["matchedItemId", "matchedSearchQuery"])
    assert counts == {(i, q): n for i, q, n in (tuple(r) for r in batch.collect())}


@pytest.mark.parametrize("cap", [None, 90])
def test_features_equal_batch(spark, basin, checkpoint, cap):
    rows = []
    for seed in range(2):
        part = conversion_rows(seed, 150)
        rows += part
        append_conversions(spark, basin, part)
        drain(start_features(spark, basin, checkpoint, trigger=None, max_records_per_stream=cap))
        log = scan(spark, SourceOptions(basin, (FEATURE_STREAM,)))
        got = {tuple(map(repr, r)) for r in materialize_latest(log, FEATURE_SCHEMA, ["item"]).collect()}
        expected = features(spark.createDataFrame(rows, CONVERSION_SCHEMA))
        assert got == {tuple(map(repr, r)) for r in expected.collect()}


def test_lists_are_emitted_only_when_they_change(spark, basin, checkpoint):
    log = lambda: json_decode(
        read_stream(spark, SourceOptions(basin, (ROLLUP_STREAM,))).select("body"), CONVERSION_SCHEMA
    )

    def step(*rows):
        append_conversions(spark, basin, [(1, q, i) for i, q in rows])
        frame = top_k_stream(log(), "matchedItemId", "matchedSearchQuery", 2)
        return sorted(run(frame, checkpoint).rows)

    assert step((1, "a"), (1, "a"), (1, "b"), (2, "x")) == [(1, ["a", "b"]), (2, ["x"])]
    assert step((1, "a"), (1, "c")) == []
    assert step((1, "c"), (2, "y")) == [(1, ["a", "c"]), (2, ["x", "y"])]
    assert step((1, "b"), (1, "b"), (1, "b")) == [(1, ["b", "a"])]


def test_whole_pipeline_with_restarts(spark, basin, checkpoint):
    lines = journeys(11, 500, 6)
    sequence = conversion_sequence()
    arrival = shuffled(lines, 2)
    for part in range(2):
        chunk = arrival[part * 250 : (part + 1) * 250]
        append_lines(spark, basin, [(f"host/{i % 2}", t) for i, t in enumerate(chunk)])
        drain(start_conversions(spark, basin, checkpoint + "-c", sequence, trigger=None))
        drain(start_features(spark, basin, checkpoint + "-f", trigger=None))
    expected = spark.createDataFrame(expected_conversions(spark, lines, sequence), CONVERSION_SCHEMA)
    lists = top_k_lists(expected, "matchedItemId", "matchedSearchQuery", 5)
    log = scan(spark, SourceOptions(basin, (FEATURE_STREAM,)))
    got = materialize_latest(log, FEATURE_SCHEMA, ["item"])
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(
        map(repr, (tuple(r) for r in lists.collect()))
    )
