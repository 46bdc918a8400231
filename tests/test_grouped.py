"""Numbering, ranks, top-k, batching, lateness."""

import random

import pytest
from pyspark.sql import functions as F

from seqlog.operators.batching import batches_by_bytes, batches_by_count, oversize_records
from seqlog.operators.lateness import late_rows
from seqlog.operators.numbering import number_rows, running_max
from seqlog.operators.topk import count_by, rank_by_count, top_k, top_k_lists
from seqlog.plans import staging


def test_top_k_golden(spark):
    letters = "eeedddccbaz"
    frame = spark.createDataFrame([(1, x) for x in letters], "item int, query string")
    assert [tuple(r) for r in top_k_lists(frame, "item", "query", 5).collect()] == [
        (1, ["d", "e", "c", "a", "b"])
    ]
    rows = top_k(count_by(frame, ["item", "query"]), "item", "query", 2).collect()
    assert sorted((r["rn"], r["query"], r["n"]) for r in rows) == [(1, "d", 3), (2, "e", 3)]
    with pytest.raises(ValueError):
        top_k(frame, "item", "query", 0)


def test_null_values_do_not_count(spark):
    frame = spark.createDataFrame([(1, None), (1, None), (1, "a")], "item int, query string")
    assert top_k_lists(frame, "item", "query", 5).first()["top_values"] == ["a"]


def test_the_rank_limit_is_applied_before_the_shuffle(spark):
    frame = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    plan = top_k(count_by(frame, ["g", "v"]), "g", "v", 5)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_rank_of_one_hot_group(spark):
    rng = random.Random(3)
    rows = [("hot", f"q{rng.randint(0, 400)}") for _ in range(3000)]
    rows += [(f"g{i % 9}", f"q{i % 13}") for i in range(3000)]
    counts = count_by(spark.createDataFrame(rows, "g string, q string"), ["g", "q"])
    ranked = rank_by_count(counts, "g", "q").collect()
    by_group = {}
    for r in ranked:
        by_group.setdefault(r["g"], []).append((r["rn"], r["n"], r["q"]))
    for line in by_group.values():
        line.sort()
        assert [rn for rn, _, _ in line] == list(range(1, len(line) + 1))
        assert [(-n, q) for _, n, q in line] == sorted((-n, q) for _, n, q in line)


def test_number_rows_needs_an_order(spark):
    with pytest.raises(ValueError):
        number_rows(spark.range(3), ["id"], [])


@pytest.mark.parametrize("fan", [2, 3, 1000])
def test_running_max_over_blocks(spark, fan):
    rng = random.Random(fan)
    rows = [(rng.randint(0, 60), rng.randint(0, 10**6)) for _ in range(300)]
    best = {}
    for step, value in rows:
        best[step] = max(best.get(step, -1), value)
    expected, seen = {}, None
    for step in sorted(best):
        expected[step] = seen
        seen = best[step] if seen is None else max(seen, best[step])
    got = running_max(spark.createDataFrame(rows, "s bigint, v bigint"), "s", "v", fan=fan)
    assert {r["s"]: r["earlier"] for r in got.collect()} == expected


@pytest.mark.parametrize("limit", [0, 1_000])
def test_late_rows_of_a_batch_with_most_rows(spark, monkeypatch, limit):
    """Marks broadcast or salted: the same rows, repeated ones and other columns included."""
    monkeypatch.setattr(staging.join_side, "__defaults__", (limit,))
    rng = random.Random(limit)
    rows = [(rng.choice([3, 3, 3, 3, 1, 5, 9, None]), rng.choice([None, rng.randrange(60_000)]), i % 7) for i in range(2_000)]
    got = late_rows(spark.createDataFrame(rows, "batch bigint, epoch_ms bigint, earlier_id bigint"), "batch")
    newest = {}
    for batch, at, _ in rows:
        if batch is not None and at is not None:
            newest[batch] = max(newest.get(batch, at), at)
    marks = {b: max((t for c, t in newest.items() if c < b), default=None) for b in newest}
    late = [r for r in rows if None not in r[:2] and marks[r[0]] is not None and r[1] <= marks[r[0]] - 5000]
    assert got.columns == ["batch", "epoch_ms", "earlier_id"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(late) and late


def test_late_rows(spark):
    rows = [(0, 1000), (0, 90_000), (1, 85_000), (1, 85_001), (1, 200_000), (2, 100_000), (3, 195_000)]
    late = late_rows(spark.createDataFrame(rows, "batch bigint, epoch_ms bigint"), "batch")
    assert sorted(tuple(r) for r in late.collect()) == [(1, 85_000), (2, 100_000), (3, 195_000)]


def greedy(sizes, limit, records):
    out, batch, used = [], 0, 0
    for i, size in enumerate(sizes):
        if i % records == 0:
            batch, used, fresh = 0, 0, True
        else:
            fresh = used + size > limit
            batch += fresh
        used = size if fresh else used + size
        out.append((i // records, batch))
    return out


def test_batches_by_bytes(spark):
    rng = random.Random(5)
    sizes = [rng.choice([0, 1, 10, 40, 99, 100, 101, 250]) for _ in range(500)]
    frame = spark.createDataFrame([("s", i, n) for i, n in enumerate(sizes)], "stream string, seq_num bigint, size int")
    rows = batches_by_bytes(frame, "size", limit=100, records=64).orderBy("seq_num").collect()
    assert [(r["append_block"], r["append_in_block"]) for r in rows] == greedy(sizes, 100, 64)
    totals = {}
    for r in rows:
        totals.setdefault((r["append_block"], r["append_in_block"]), []).append(r["size"])
    assert all(sum(v) <= 100 or len(v) == 1 for v in totals.values())


def test_batch_limits(spark):
    frame = spark.range(2500).withColumnRenamed("id", "seq_num")
    counts = batches_by_count(frame).groupBy("append_batch").count().collect()
    assert sorted(tuple(r) for r in counts) == [(0, 1000), (1, 1000), (2, 500)]
    for bad in (0, 1001):
        with pytest.raises(ValueError):
            batches_by_count(frame, bad)
    with pytest.raises(ValueError):
        oversize_records(frame, "seq_num", 0)
    assert oversize_records(frame, "seq_num", 2000).count() == 499
