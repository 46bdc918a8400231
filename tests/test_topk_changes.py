"""Best-k lists kept from batch to batch, against plain Python."""

import random
from collections import Counter, defaultdict

import pytest

from seqlog.operators.topk import limited
from seqlog.plans.staging import child_names
from seqlog.streaming.topk import top_k_changes

SCHEMA = "_group long, _value string, _n long"


def best(counts, k):
    groups = defaultdict(list)
    for (group, value), n in counts.items():
        groups[group].append((-n, value))
    return {g: [v for _, v in sorted(entries)[:k]] for g, entries in groups.items()}


@pytest.mark.parametrize("fold", [1, 3])
def test_lists_follow_the_counts(spark, checkpoint, fold):
    rng, counts, shown, given = random.Random(fold), Counter(), {}, {}

    def sink(frame, batch_id):
        given[batch_id] = {r["item"]: list(r["top"]) for r in frame.collect()}

    process = top_k_changes(sink, checkpoint, "item", 3, "top", fold_batches=fold)
    for batch in range(6):
        # Group 0 is hot, group None is one like others, ties are frequent.
        pairs = Counter(
            (rng.choice([0, 0, 0, 1, 2, None]), rng.choice("abcdefgh")) for _ in range(rng.choice([0, 4, 20]))
        )
        counts.update(pairs)
        rows = [(g, v, counts[g, v]) for g, v in pairs]
        frame = spark.createDataFrame(rows, SCHEMA)
        process(frame, batch)
        expected = {g: v for g, v in best(counts, 3).items() if shown.get(g) != v}
        assert given[batch] == expected
        if batch == 3:  # a batch that failed before its end runs again
            process(frame, batch)
            assert given[batch] == expected
        shown.update(expected)
        assert len(child_names(spark, f"{checkpoint}/rows")) <= fold + 2


def test_limit_in_shares_equals_the_plain_one(spark, monkeypatch):
    from seqlog.operators import topk

    rng = random.Random(4)
    rows = [(rng.choice([1, 1, 1, 2, None]), f"v{i}", rng.randrange(5)) for i in range(400)]
    frame = spark.createDataFrame(rows, "g long, v string, n long")
    plain = sorted(map(repr, limited(frame, "g", "v", 7).collect()))
    monkeypatch.setattr(topk, "RANKED_AFTER_SHUFFLE", 1)
    assert sorted(map(repr, limited(frame, "g", "v", 7).collect())) == plain
    assert limited(frame, "g", "v", 7).columns == ["g", "v", "n", "rn"]
