import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqlog.functions.codec import (
    body_text,
    custom_encode,
    decode_text,
    decode_with_context,
    encode_json,
    flat_decode,
    json_decode,
    parse_kv_events,
    parse_kv_rejects,
    register_decoder,
    with_event_time,
)
from seqlog.functions.records import header, metered_bytes
from tests.helpers import log_frame

GOOD = {
    "user=1;search=a=b;epoch_ms=5": (1, "search", None, "a=b", 5),
    "user=1;search=;epoch_ms=5": (1, "search", None, "", 5),
    "user=1;item=3;epoch_ms=5": (1, "search", 3, None, 5),
    "user=+1;item=3;action=view;epoch_ms=5;": (1, "view", 3, None, 5),
    "user=1;action=;epoch_ms=5;;;": (1, "", None, None, 5),
    "user=-7;other=x;epoch_ms=-5": (-7, "search", None, None, -5),
    "epoch_ms=9223372036854775807;user=2147483647": (2147483647, "search", None, None, 2**63 - 1),
    "=x;user=1;epoch_ms=5": (1, "search", None, None, 5),
    "user=1;search=größe;epoch_ms=5": (1, "search", None, "größe", 5),
}
BAD = {
    "user=1;;epoch_ms=5": "shape",
    "user=1;x;epoch_ms=5": "shape",
    ";user=1;epoch_ms=5": "shape",
    "user=1;user=2;epoch_ms=5": "repeated name",
    "user= 1;epoch_ms=5": "user",
    "user=2147483648;epoch_ms=5": "user",
    "user=;epoch_ms=5": "user",
    "user=1\n;epoch_ms=5": "user",
    "user=1;item=;action=view;epoch_ms=5": "item",
    "user=1;item=1.0;epoch_ms=5": "item",
    "user=1;search=a": "epoch_ms",
    "user=1;epoch_ms=": "epoch_ms",
    "user=1;epoch_ms=9223372036854775808": "epoch_ms",
    "search=a;epoch_ms=5": "no user",
    "": "shape",
    ";;": "shape",
}


def test_good_lines(spark):
    lines = list(GOOD)
    rows = parse_kv_events(log_frame(spark, lines)).collect()
    got = {lines[r["seq_num"]]: tuple(r)[2:] for r in rows}
    assert got == GOOD


def test_bad_lines_are_kept_with_a_reason(spark):
    lines = list(BAD) + list(GOOD)
    rows = parse_kv_rejects(log_frame(spark, lines)).collect()
    assert {r["body"]: r["reason"] for r in rows} == BAD
    assert parse_kv_events(log_frame(spark, list(BAD))).count() == 0


def test_null_body_is_rejected(spark):
    log = log_frame(spark, [None])
    assert parse_kv_events(log).count() == 0
    assert parse_kv_rejects(log).count() == 1


def test_event_time_keeps_milliseconds(spark):
    events = parse_kv_events(log_frame(spark, ["user=1;search=a;epoch_ms=1739603607844"]))
    shown = with_event_time(events).select(F.date_format("event_time", "HH:mm:ss.SSS")).first()[0]
    assert shown == "07:13:27.844"


def test_text_with_and_without_context(spark):
    log = log_frame(spark, ["a", "b"])
    assert [r[0] for r in decode_text(log).collect()] == ["a", "b"]
    assert [tuple(r) for r in decode_with_context(log).collect()] == [("s", 0, "a"), ("s", 1, "b")]


def test_invalid_utf8(spark):
    log = log_frame(spark, [b"ok\xff"])
    assert log.select(body_text()).first()[0] == "ok�"
    assert log.select(body_text(invalid="null")).first()[0] is None
    with pytest.raises(Exception, match="UTF"):
        log.select(body_text(invalid="fail")).collect()


def test_flat_decode_gives_any_number_of_rows(spark):
    def words(batches):
        for batch in batches:
            for stream, body in zip(batch.column("stream"), batch.column("body")):
                found = body.as_py().decode().split()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([stream.as_py()] * len(found), pa.string()), pa.array(found, pa.string())],
                    names=["stream", "word"],
                )

    out = flat_decode(log_frame(spark, ["a b", "", "c"]), words, "stream string, word string")
    assert [r["word"] for r in out.collect()] == ["a", "b", "c"]


def test_sql_decoder(spark):
    def letters(stream, seq_num, body):
        for letter in body.decode():
            yield (f"{stream}{seq_num}", letter)

    register_decoder(spark, "letters", letters, "place string, letter string")
    log_frame(spark, ["ab", "", "c"]).createOrReplaceTempView("lettered_log")
    rows = spark.sql(
        "SELECT l.* FROM lettered_log t, LATERAL letters(t.stream, t.seq_num, t.body) l"
    ).collect()
    assert sorted(tuple(r) for r in rows) == [("s0", "a"), ("s0", "b"), ("s2", "c")]


SCHEMA = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])


def test_json_modes(spark):
    log = log_frame(spark, ['{"a":1,"b":"x"}', "", "{oops", '{"a":"no"}'])
    rows = json_decode(log, SCHEMA, on_error="dead_letter").orderBy("seq_num").collect()
    assert [(r["a"], r["b"]) for r in rows] == [(1, "x"), (None, None), (None, None), (None, None)]
    assert [r["_corrupt"] for r in rows] == [None, "", "{oops", '{"a":"no"}']
    assert json_decode(log, SCHEMA, on_error="null").where("a IS NOT NULL").count() == 1
    with pytest.raises(Exception, match="not the declared JSON"):
        json_decode(log, SCHEMA, on_error="fail").collect()
    with pytest.raises(ValueError):
        json_decode(log, SCHEMA, on_error="other")


def test_json_types_round_trip(spark):
    frame = spark.sql(
        "SELECT 1 AS i, 2L AS l, 'x' AS s, CAST(NULL AS STRING) AS n, true AS b, 1.5D AS d, "
        "CAST('1.25' AS DECIMAL(10,2)) AS m, DATE '2024-01-02' AS dt, "
        "TIMESTAMP '2024-01-02 03:04:05.678' AS ts, array('p','q') AS arr, map('k', 1) AS mp, "
        "named_struct('z', 1) AS st, CAST('raw' AS BINARY) AS bin"
    )
    encoded = encode_json(frame)
    assert encoded.select(F.size("headers")).first()[0] == 0
    assert '"n":null' in encoded.select(F.col("body").cast("string")).first()[0]
    back = json_decode(encoded, frame.schema).select(*frame.columns)
    assert back.collect() == frame.collect()


def test_custom_encode_and_metering(spark):
    frame = spark.sql("SELECT 'bö' AS text, 'en' AS lang")
    encoded = custom_encode(frame, F.upper("text"), F.array(header("lang", F.col("lang"))))
    assert encoded.select(F.col("body").cast("string")).first()[0] == "BÖ"
    sizes = encoded.select(
        metered_bytes().alias("plain"), metered_bytes(per_record=8, per_header=2).alias("more")
    ).first()
    assert tuple(sizes) == (3 + 4 + 2, 3 + 4 + 2 + 8 + 2)
