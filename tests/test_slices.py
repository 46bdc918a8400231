"""Slices of a stream against a plain loop over the same micro-batches."""

import random

import pytest
from pyspark.sql import functions as F

from seqlog.operators.pattern import Sequence
from seqlog.plans.staging import child_names, scratch_path
from seqlog.streaming.slices import flagged_groups, late_rows_so_far, match_slices

SCHEMA = "user_id bigint, epoch_ms bigint, stream string, seq_num bigint, kind string"
LATENESS = 50


def sequence(within_ms, inclusive):
    steps = (("a", "kind = 'x'"), ("b", "kind IN ('x', 'y')"), ("c", "kind = 'y'"))
    measures = {"first": ("a", "seq_num"), "last": ("c", "seq_num")}
    return Sequence(steps, measures, within_ms, inclusive, bucket_factor=2)


def made_batches(seed, groups):
    """Rows in arrival order: displaced, some late, a third of them one user's, times that tie, nulls."""
    rng = random.Random(seed)
    rows, at = [], 1_000
    for i in range(420):
        at += rng.choice([0, 0, 1, 3, 9, 25])
        seen = None if rng.random() < 0.02 else at - (400 if rng.random() < 0.05 else rng.randrange(40))
        user = None if rng.random() < 0.1 else 0 if rng.random() < 0.4 else rng.randrange(4)
        rows.append((i % groups, (user, seen, f"h/{i % groups}", i, rng.choice(["x", "y", "y", "z", None]))))
    cuts = sorted(rng.sample(range(1, 419), 6))
    parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, 420])]
    return [*parts[:3], [], *parts[3:]]


def plain(batches, groups, within_ms, inclusive):
    """Every match over the rows that were in time, and how many were not."""
    newest, taken, late = {}, [], 0
    for batch in batches:
        mark = min(newest.values()) - LATENESS if len(newest) == groups else None
        for group, row in batch:
            if row[1] is None:
                continue
            if mark is not None and row[1] <= mark:
                late += 1
                continue
            taken.append(row)
        for group, row in batch:
            if row[1] is not None:
                newest[group] = max(newest.get(group, row[1]), row[1])
    mark = min(newest.values()) - LATENESS
    found, lines = [], {}
    for row in sorted((r for r in taken if r[1] <= mark), key=lambda r: (r[1], r[2], r[3])):
        lines.setdefault(row[0], []).append(row)
    for user, line in lines.items():
        for a, b, c in zip(line, line[1:], line[2:]):
            span = c[1] - a[1]
            in_time = span <= within_ms if inclusive else span < within_ms
            if in_time and a[4] == "x" and b[4] in ("x", "y") and c[4] == "y":
                found.append((user, a[3], c[3]))
    return sorted(found, key=repr), late


@pytest.mark.parametrize("seed, groups, within_ms, inclusive", [(1, 1, 60, False), (2, 2, 40, True), (3, 3, 5_000, True)])
def test_slices_equal_a_plain_loop(spark, seed, groups, within_ms, inclusive):
    batches = made_batches(seed, groups)
    wanted = sequence(within_ms, inclusive)
    folder, given = scratch_path(spark, "test-slices"), {}

    def sink(found, batch_id):
        rows = sorted((tuple(r) for r in found.collect()), key=repr)
        assert given.setdefault(batch_id, rows) == rows  # a repeated batch gives the same again

    for batch_id, batch in enumerate(batches):
        frames = [
            spark.createDataFrame([row for group, row in batch if group == g], SCHEMA) for g in range(groups)
        ]
        # A new function each time, as after a restart; batch 4 runs twice.
        for _ in range(2 if batch_id == 4 else 1):
            process = match_slices(sink, folder, wanted, ["user_id"], groups, lateness_ms=LATENESS)
            process(flagged_groups(frames, wanted, ["user_id"]), batch_id)
    expected, late = plain(batches, groups, within_ms, inclusive)
    assert sorted((row for rows in given.values() for row in rows), key=repr) == expected
    assert sum(bool(rows) for rows in given.values()) > 2 and len(expected) > 10
    assert late_rows_so_far(spark, folder) == late > 0
    if within_ms < 100:  # short look-back: early batches are gone
        assert len([n for n in child_names(spark, f"{folder}/rows") if n.isdigit()]) < len(batches) - 2
    assert len([n for n in child_names(spark, f"{folder}/marks") if n.isdigit()]) <= 2


def test_nothing_passes_before_every_group_has_rows(spark):
    wanted, folder, given = sequence(100, False), scratch_path(spark, "test-slices"), []
    process = match_slices(lambda f, b: given.extend(f.collect()), folder, wanted, ["user_id"], 2, lateness_ms=0)

    def push(batch_id, first, second):
        frames = [spark.createDataFrame(rows, SCHEMA) for rows in (first, second)]
        process(flagged_groups(frames, wanted, ["user_id"]), batch_id)

    push(0, [(1, 10, "a", 0, "x"), (1, 12, "a", 1, "y"), (1, 14, "a", 2, "y"), (1, 900, "a", 3, "z")], [])
    assert given == [] and late_rows_so_far(spark, folder) == 0
    # Earlier than anything of the other group, yet not late.
    push(1, [], [(2, 5, "b", 0, "x"), (2, 6, "b", 1, "x"), (2, 13, "b", 2, "y")])
    assert [tuple(r) for r in given] == [(2, 0, 2)]
    push(2, [], [(2, 13, "b", 3, "y"), (2, 14, "b", 4, "z")])
    assert late_rows_so_far(spark, folder) == 1
    assert sorted(tuple(r) for r in given) == [(1, 0, 2), (2, 0, 2)]


def test_empty_stream(spark):
    wanted, folder = sequence(100, False), scratch_path(spark, "test-slices")
    empty = flagged_groups([spark.createDataFrame([], SCHEMA)], wanted, ["user_id"])
    for batch_id in range(2):
        match_slices(lambda f, b: pytest.fail("nothing to give"), folder, wanted, ["user_id"])(empty, batch_id)
    assert late_rows_so_far(spark, folder) == 0
