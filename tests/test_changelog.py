import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqlog.functions.records import LOG_SCHEMA, action_to_kind
from seqlog.operators.changelog import (
    assert_insert_only,
    compact_upserts,
    is_insert,
    materialize_latest,
    materialize_updates_only,
    normalize_changelog,
    project_key_value,
    split_key_value,
    upsert_decode,
    upsert_encode,
    with_key_action,
)
from tests.helpers import EPOCH, log_frame

K, A = "@key", "@action"
HEADERS = [
    ([(K, "a"), (A, "u")], ("a", "u")),
    ([(A, "d"), (K, "a")], ("a", "d")),
    ([(K, "a"), (K, "b"), (A, "u")], ("b", "u")),
    ([(K, "a"), (A, "u"), (K, "b")], ("a", "u")),
    ([(K, "a"), (A, "x"), (A, "d")], ("a", "d")),
    ([(A, "u"), (A, "x"), (K, "a")], ("a", "u")),
    ([(A, "u"), (A, "d"), (K, "k")], ("k", "d")),
    ([("other", "1"), (K, "a"), (A, "u")], ("a", "u")),
    ([(K, "a"), (A, "x")], (None, None)),
    ([(A, "u")], (None, None)),
    ([], (None, None)),
]


def test_header_walk(spark):
    log = log_frame(spark, [""] * len(HEADERS), headers=[h for h, _ in HEADERS])
    rows = with_key_action(log).orderBy("seq_num").collect()
    got = [(r["_key"].decode() if r["_key"] is not None else None, r["_action"]) for r in rows]
    assert got == [expected for _, expected in HEADERS]


def test_action_to_kind(spark):
    frame = spark.createDataFrame([("u",), ("d",), ("x",), (None,)], "_action string")
    assert [r[0] for r in frame.select(action_to_kind()).collect()] == ["+U", "-D", None, None]


SAMPLE = T.StructType(
    [T.StructField("index", T.StringType()), T.StructField("content", T.IntegerType())]
)


def encoded_text(frame):
    return frame.select(
        F.expr("transform(headers, h -> concat(CAST(h.name AS STRING), '=', CAST(h.value AS STRING)))"),
        F.col("body").cast("string"),
    ).collect()


def test_upsert_codec(spark):
    rows = spark.createDataFrame([("265", 4, "+I")], "index string, content int, _kind string")
    assert [tuple(r) for r in encoded_text(upsert_encode(rows, ["index"]))] == [
        (['@key={"index":"265"}', "@action=u"], '{"content":4}')
    ]
    deleted = rows.withColumn("_kind", F.lit("-D"))
    encoded = upsert_encode(deleted, ["index"])
    assert [tuple(r) for r in encoded_text(encoded)] == [(['@key={"index":"265"}', "@action=d"], "")]
    assert [tuple(r) for r in upsert_decode(encoded, SAMPLE, ["index"]).collect()] == [
        ("265", None, "-D")
    ]
    with pytest.raises(Exception, match="unsupported row kind"):
        upsert_encode(rows.withColumn("_kind", F.lit("-U")), ["index"]).collect()


def test_key_columns_may_come_last(spark):
    schema = T.StructType(
        [
            T.StructField("content", T.IntegerType()),
            T.StructField("part", T.StringType()),
            T.StructField("index", T.StringType()),
        ]
    )
    rows = spark.createDataFrame([(1, "p", "i"), (None, "q", "j")], schema)
    encoded = upsert_encode(rows, ["index", "part"])
    decoded = upsert_decode(encoded, schema, ["index", "part"])
    assert decoded.columns == ["content", "part", "index", "_kind"]
    assert sorted(tuple(r)[1:] for r in decoded.collect()) == [("p", "i", "+U"), ("q", "j", "+U")]
    assert encoded_text(encoded)[0][0][0] == '@key={"index":"i","part":"p"}'


def test_missing_headers(spark):
    log = log_frame(spark, ["{}"])
    with pytest.raises(Exception, match="without key or action"):
        upsert_decode(log, SAMPLE, ["index"]).collect()
    assert upsert_decode(log, SAMPLE, ["index"], on_missing="drop").count() == 0


def test_bad_body_is_fatal(spark):
    log = log_frame(spark, ["{oops"], headers=[[(K, '{"index":"1"}'), (A, "u")]])
    with pytest.raises(Exception):
        upsert_decode(log, SAMPLE, ["index"]).collect()


def test_key_value_split():
    assert split_key_value(["a", "b", "c"], ["c", "a"]) == (["c", "a"], ["b"])
    for keys in ([], ["a", "b", "c"], ["z"], ["a", "a"]):
        with pytest.raises(ValueError):
            split_key_value(["a", "b", "c"], keys)


def test_project_key_value(spark):
    row = project_key_value(spark.sql("SELECT 1 AS a, 2 AS b, 3 AS c"), ["c"]).first()
    assert (tuple(row["key"]), tuple(row["value"])) == ((3,), (1, 2))


def records(spark, changes, stream="s"):
    """changes: (key or None, action, value)."""
    headers = [[] if k is None else [(K, f'{{"k":"{k}"}}'), (A, a)] for k, a, _ in changes]
    bodies = ["" if a == "d" else f'{{"v":{v}}}' for _, a, v in changes]
    return log_frame(spark, bodies, stream, headers)


STATE = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.IntegerType())])


def test_compaction(spark):
    log = records(
        spark,
        [("a", "u", 1), ("b", "u", 2), ("a", "d", 0), ("b", "u", 3), (None, "u", 5), (None, "u", 5)],
    )
    kept = compact_upserts(log).orderBy("seq_num")
    assert [r["seq_num"] for r in kept.collect()] == [2, 3, 4, 5]
    assert kept.columns == log.columns


def test_compaction_keeps_streams_apart(spark):
    rows = [("a", "u", 1), ("a", "u", 2), (None, "u", 5)]
    one, two = records(spark, rows), records(spark, rows).withColumn("stream", F.lit("t"))
    kept = compact_upserts(one.union(two)).select("stream", "seq_num").collect()
    assert sorted(map(tuple, kept)) == sorted([(s, n) for s in (one.first()["stream"], "t") for n in (1, 2)])


def test_an_unkeyed_record_never_meets_a_key_that_looks_like_its_position(spark):
    log = log_frame(spark, ["x", "y"], headers=[[(K, "1"), (A, "u")], []])
    assert compact_upserts(log).count() == 2


def test_materialize(spark):
    log = records(
        spark,
        [("a", "u", 1), ("b", "u", 2), ("a", "d", 0), ("c", "u", 3), ("c", "d", 0), ("c", "u", 4)],
    )
    assert sorted(tuple(r) for r in materialize_latest(log, STATE, ["k"]).collect()) == [("b", 2), ("c", 4)]
    assert sorted(tuple(r) for r in materialize_updates_only(log, STATE, ["k"]).collect()) == [
        ("a", 1),
        ("b", 2),
        ("c", 4),
    ]
    assert sorted(tuple(r) for r in materialize_latest(log, STATE, ["k"], until=4).collect()) == [
        ("b", 2),
        ("c", 3),
    ]


def test_compacting_does_not_change_the_state(spark):
    """Many random changelogs, one per stream, compacted in random batches."""
    rng = random.Random(7)
    rows, expected = [], {}
    for case in range(60):
        state = {}
        for seq in range(rng.randint(0, 40)):
            key, action, value = rng.choice("abcdef"), rng.choice("uud"), rng.randint(0, 99)
            headers = [
                (bytearray(K.encode()), bytearray(f'{{"k":"{case}{key}"}}'.encode())),
                (bytearray(A.encode()), bytearray(action.encode())),
            ]
            body = b"" if action == "d" else f'{{"v":{value}}}'.encode()
            rows.append((f"s{case}", seq, headers, bytearray(body), EPOCH))
            if action == "d":
                state.pop(f"{case}{key}", None)
            else:
                state[f"{case}{key}"] = value
        expected.update(state)
    log = spark.createDataFrame(rows, LOG_SCHEMA)
    compacted = compact_upserts(
        log.withColumn("batch", F.concat("stream", F.expr("seq_num DIV 7"))), batch="batch"
    ).drop("batch")
    for frame in (log, compacted):
        got = {r["k"]: r["v"] for r in materialize_latest(frame, STATE, ["k"]).collect()}
        assert got == expected
    assert compacted.count() < log.count()


def test_insert_only(spark):
    frame = spark.createDataFrame([(1, "+I"), (2, "+I")], "a int, _kind string")
    assert assert_insert_only(frame).columns == ["a"]
    mixed = spark.createDataFrame([(1, "+I"), (2, "-D"), (3, None)], "a int, _kind string")
    assert [r[0] for r in mixed.select(is_insert()).collect()] == [True, False, False]
    with pytest.raises(Exception, match="inserts only"):
        assert_insert_only(mixed).collect()


def test_normalize(spark):
    frame = spark.createDataFrame(
        [(1, "+I"), (2, "-U"), (3, "+U"), (4, "-D")], "a int, _kind string"
    )
    rows = normalize_changelog(frame).collect()
    assert [(r["a"], r["_action"]) for r in rows] == [(1, "u"), (3, "u"), (4, "d")]
