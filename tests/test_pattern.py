import random
from dataclasses import replace

import pytest

from seqlog.functions.codec import parse_kv_events
from seqlog.operators.pattern import Sequence, match_sequence, match_sequence_dense, reconcile
from seqlog.plans.jobs import conversion_sequence, conversions, features
from tests.helpers import log_frame

# One conversion of user 7, another user's events between, and a later line that moves the watermark.
SAMPLE = """\
user=7;search=kettle;epoch_ms=1700000000000
user=2;item=9;action=view;epoch_ms=1700000000500
user=7;item=12;action=view;epoch_ms=1700000001200
user=3;search=lamp;epoch_ms=1700000002000
user=7;item=12;action=cart;epoch_ms=1700000003400
user=2;item=9;action=cart;epoch_ms=1700000004000
user=7;item=12;action=buy;epoch_ms=1700000006000
user=7;search=kettle;epoch_ms=1700002106000
""".splitlines()

ACTIONS = {"s": "search", "v": "view", "c": "cart", "b": "buy"}
EVENT = "stream string, seq_num bigint, user_id int, action string, item_id int, query string, epoch_ms bigint"


def events(spark, steps):
    """steps: (user, letter, detail, ms); detail is the query of a search, else the item."""
    rows = []
    for i, (user, letter, detail, ms) in enumerate(steps):
        query, item = (detail, None) if letter == "s" else (None, detail)
        rows.append(("h", i, user, ACTIONS[letter], item, query, ms))
    return spark.createDataFrame(rows, EVENT)


def found(spark, steps, **options):
    sequence = conversion_sequence(**options)
    rows = match_sequence(events(spark, steps), sequence, ["user_id"]).collect()
    return sorted(tuple(r) for r in rows)


def test_sample_lines(spark):
    parsed = parse_kv_events(log_frame(spark, SAMPLE))
    assert parsed.count() == 8
    matched = conversions(parsed)
    assert [tuple(r) for r in matched.collect()] == [(7, "kettle", 12)]
    assert [tuple(r) for r in features(matched).collect()] == [(12, ["kettle"])]
    assert conversions(parsed, conversion_sequence(6_000)).count() == 0
    assert conversions(parsed, conversion_sequence(6_001)).count() == 1


GOLDEN = [
    ([(1, "s", "q", 0), (1, "v", 3, 1), (1, "c", 3, 2), (1, "b", 3, 3)], [(1, "q", 3)]),
    ([(1, "s", "q", 0), (1, "v", 3, 1), (1, "v", 3, 2), (1, "c", 3, 3), (1, "b", 3, 4)], []),
    ([(1, "s", "q", 0), (2, "v", 9, 1), (1, "v", 3, 2), (1, "c", 3, 3), (1, "b", 3, 4)], [(1, "q", 3)]),
    ([(1, "s", "q1", 0), (1, "s", "q2", 1), (1, "v", 3, 2), (1, "c", 3, 3), (1, "b", 3, 4)], [(1, "q2", 3)]),
    ([(1, "s", "q", 0), (1, "v", 1, 1), (1, "c", 2, 2), (1, "b", 3, 3)], [(1, "q", 3)]),
    ([(1, "s", "q", 0), (1, "v", 3, 1), (1, "c", 3, 2), (1, "b", 3, 599_999)], [(1, "q", 3)]),
    ([(1, "s", "q", 0), (1, "v", 3, 1), (1, "c", 3, 2), (1, "b", 3, 600_000)], []),
    (
        [(1, x, d, i) for i, (x, d) in enumerate([("s", "q"), ("v", 3), ("c", 3), ("b", 3)] * 2)],
        [(1, "q", 3), (1, "q", 3)],
    ),
    ([(1, "c", 3, 2), (1, "v", 3, 1), (1, "b", 3, 3), (1, "s", "q", 0)], [(1, "q", 3)]),
]


@pytest.mark.parametrize("case", range(len(GOLDEN)))
def test_golden(spark, case):
    steps, expected = GOLDEN[case]
    assert found(spark, steps) == expected


def test_inclusive_bound_and_same_item(spark):
    edge = GOLDEN[6][0]
    assert found(spark, edge, inclusive=True) == [(1, "q", 3)]
    assert found(spark, GOLDEN[4][0], same_item=True) == []
    assert found(spark, GOLDEN[0][0], same_item=True) == [(1, "q", 3)]


def test_equal_times_follow_stream_and_position(spark):
    steps = [(1, "s", "q", 5), (1, "v", 3, 5), (1, "c", 3, 5), (1, "b", 3, 5)]
    assert found(spark, steps) == [(1, "q", 3)]
    assert found(spark, [steps[1], steps[0], *steps[2:]]) == []


def brute_force(rows, sequence):
    """Reference answer by walking each user's rows in time order."""
    by_user = {}
    for row in rows:
        by_user.setdefault(row[2], []).append(row)
    width, out = len(sequence.steps), []
    wanted = [p.split("'")[1] for _, p in sequence.steps]
    for user, line in by_user.items():
        line.sort(key=lambda r: (r[6], r[0], r[1]))
        for i in range(len(line) - width + 1):
            window = line[i : i + width]
            span = window[-1][6] - window[0][6]
            if [r[3] for r in window] != wanted:
                continue
            if span < sequence.within_ms or (sequence.inclusive and span == sequence.within_ms):
                out.append((user, window[0][1], window[-1][1]))
    return sorted(out)


@pytest.mark.parametrize("factor", [1, 2, 8])
@pytest.mark.parametrize("inclusive", [False, True])
def test_buckets_never_change_the_result(spark, factor, inclusive):
    """One user holds a third of the rows; times repeat, are negative, and hit bucket edges."""
    rng = random.Random(factor)
    rows = []
    for i in range(6000):
        user = 0 if i % 3 == 0 else rng.randint(1, 20)
        rows.append(("h", i, user, rng.choice(["view", "cart", "view", "cart", "buy"]), 1, None, rng.randint(-9000, 9000)))
    base = Sequence(
        steps=(("A", "action = 'view'"), ("B", "action = 'cart'"), ("C", "action = 'view'")),
        measures={"first": ("A", "seq_num"), "last": ("C", "seq_num")},
        within_ms=40,
        inclusive=inclusive,
        bucket_factor=factor,
    )
    frame = spark.createDataFrame(rows, EVENT)
    got = sorted(tuple(r) for r in match_sequence(frame, base, ["user_id"]).collect())
    assert got == brute_force(rows, base)
    assert len(got) > 50
    wide = replace(base, bucket_factor=64)
    assert sorted(tuple(r) for r in match_sequence(frame, wide, ["user_id"]).collect()) == got


def test_overlapping_matches_start_at_every_row(spark):
    rows = [("h", i, 1, "view", 1, None, i) for i in range(5)]
    sequence = Sequence(
        steps=(("A", "action = 'view'"), ("B", "action = 'view'")),
        measures={"at": ("A", "seq_num")},
        within_ms=10,
    )
    got = match_sequence(spark.createDataFrame(rows, EVENT), sequence, ["user_id"]).collect()
    assert sorted(r["at"] for r in got) == [0, 1, 2, 3]


def test_sequence_is_checked():
    steps = (("A", "true"), ("B", "true"))
    for bad in (
        dict(steps=steps[:1], measures={}, within_ms=1),
        dict(steps=steps, measures={"x": ("Z", "c")}, within_ms=1),
        dict(steps=(steps[0], steps[0]), measures={}, within_ms=1),
        dict(steps=steps, measures={}, within_ms=0),
    ):
        with pytest.raises(ValueError):
            Sequence(**bad)


def test_reconcile_counts_copies(spark):
    actual = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "x string")
    expected = spark.createDataFrame([("a",), ("c",), ("c",), (None,)], "x string")
    rows = sorted(tuple(r) for r in reconcile(actual, expected).collect())
    assert rows == [("a", "extra", 1), ("b", "extra", 1), ("c", "missing", 2)]


@pytest.mark.parametrize("dense_rows", [3, 7, 100, 1_000_000])
def test_dense_keys_are_cut_by_number(spark, dense_rows):
    """Every third row is one user's, within one bucket; times repeat, some users and times are null."""
    rng = random.Random(dense_rows)
    rows = []
    for i in range(3000):
        user = 0 if i % 3 == 0 else None if i % 11 == 0 else rng.randint(1, 20)
        at = rng.randint(0, 300) if user in (0, None) else rng.randint(-9000, 9000)
        rows.append(("h", i, user, rng.choice(["view", "cart", "view", "cart", "buy"]), 1, None, at))
    sequence = Sequence(
        steps=(("A", "action = 'view'"), ("B", "action = 'cart'"), ("C", "action = 'view'")),
        measures={"first": ("A", "seq_num"), "last": ("C", "seq_num")},
        within_ms=60,
    )
    untimed = [("h", 3000 + i, 0, "view", 1, None, None) for i in range(30)]
    frame = spark.createDataFrame(rows + untimed, EVENT)
    got = [tuple(r) for r in match_sequence_dense(frame, sequence, ["user_id"], dense_rows=dense_rows).collect()]
    assert sorted(got, key=repr) == sorted(brute_force_by_key(rows, sequence), key=repr)
    assert len(got) > 50


def brute_force_by_key(rows, sequence):
    """brute_force, user by user, as null and numbers have no common order."""
    users = {row[2] for row in rows}
    return [found for user in users for found in brute_force([r for r in rows if r[2] == user], sequence)]


def test_dense_matching_of_nothing_and_its_bound(spark):
    sequence = conversion_sequence()
    empty = spark.createDataFrame([], EVENT)
    assert match_sequence_dense(empty, sequence, ["user_id"]).count() == 0
    with pytest.raises(ValueError, match="dense_rows"):
        match_sequence_dense(empty, sequence, ["user_id"], dense_rows=3)
