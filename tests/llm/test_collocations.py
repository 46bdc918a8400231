"""Collocations against counting every phrase in plain Python, however the work is cut."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from seqlog.llm import collocations as col
from seqlog.llm import packing

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def by_hand(rows, longest, least, best):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        n, found = totals[lang], []
        frequent = {p: a for p, a in f.items() if a >= least}
        for p, a in frequent.items():
            if len(p) < 2:
                continue
            around = [
                b for q, b in frequent.items()
                if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            ]
            if any(100 * b >= 100 * a for b in around):
                continue
            score, _, left, right = min(
                (1000 * a * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))
            )
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:best], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def got(frame):
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert frame.columns == columns
    return sorted(tuple(r) for r in frame.collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    words = ["the", "The", "of", "a", "ab", "é", "É", "漢", "x\xa0y", "-", "\x00", "b", "ſ", "…"]
    ends = [" "] * 9 + ["  ", "\t", ". ", ",", "\n", "\x0b", "\x1c"]
    made = []
    for i in range(160):
        text = "".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randint(0, 60)))
        made.append((rng.choice(["en", "en", "en", "fr", None, ""]), text))
    made += [("en", "once upon a time there was"), ("de", "drei mal drei mal drei mal drei")] * 9
    made += [("fr", None), ("fr", ""), (None, " \t"), ("xx", "..."), ("xx", "alone"), ("long", "to be or " * 4_000)]
    return made


@pytest.fixture(scope="module")
def docs(spark, rows):
    """Repeated rows, null ids, extra columns named like results and steps."""
    schema = "doc_id long, lang string, text string, phrase string, block int, n string, id string"
    return spark.createDataFrame(
        [(None if i % 5 == 0 else i % 40, lang, text, "x", 1, "y", "z") for i, (lang, text) in enumerate(rows)], schema
    ).repartition(4)


SMALL = col.Sizes(block=300, held=500, shard=7, merged=20, ranked=10)


@pytest.mark.parametrize(
    "longest, least, best, sizes",
    [(5, 3, 2_000, col.Sizes()), (5, 2, 12, SMALL), (2, 9, None, SMALL), (3, 1, 40, SMALL), (6, 9, 5, col.Sizes())],
)
def test_against_counting(docs, rows, longest, least, best, sizes):
    expected = by_hand(rows, longest, least, best)
    assert expected and got(col.collocations(docs, longest=longest, least=least, best=best, sizes=sizes)) == expected


def test_stripes_hold_extensions_totals_and_maxima(docs, rows):
    """Of every size, the totals of the stripes are the counts of their prefixes."""
    from pyspark.sql import functions as F

    merges, _ = col._levels(docs, F.col("text"), F.col("lang"), 4, 4, SMALL)
    for shorter, longer in zip(merges, merges[1:], strict=False):
        counts = {r.id: r.times for r in shorter.where("kind = 'phrase'").collect()}
        stripes = longer.where("kind = 'stripe'").groupBy("prefix").agg(F.sum("total").alias("t"), F.max("most").alias("m"))
        merged = {r.prefix: (r.t, r.m) for r in stripes.collect()}
        assert {p: t for p, (t, _) in merged.items()} == counts
        best = Counter()
        for r in longer.where("kind = 'phrase'").collect():
            best[r.prefix] = max(best[r.prefix], r.times)
        assert all(m == best[p] or (p not in best and m < 4) for p, (_, m) in merged.items())


def test_buckets_are_whole():
    buckets = [1] * 5 + [2] * 2 + [3] * 9 + [4]
    batches = [pa.RecordBatch.from_pydict({"bucket": [b], "n": [3]}) for b in buckets]
    tables = [t["bucket"].to_pylist() for t in packing.whole_buckets(iter(batches), 6)]
    assert [b for t in tables for b in t] == buckets and sum(len(set(t)) for t in tables) == 4


def test_packing():
    for kind in (np.int32, np.int64):
        for values in ([], [5], [-1, 2**31 - 1, 0, 7] * 50):
            values = np.array(values, kind)
            assert packing.unpacked(packing.packed(values), len(values), kind).tolist() == values.tolist()


def test_gaps():
    gaps = lambda *v: col.without_gaps(np.array(v, np.int32)).tolist()
    assert gaps(-1, -1, 3, -1, -1, 4, 5, -1) == [3, -1, 4, 5, -1]
    assert gaps() == [] and gaps(-1, -1) == [] and gaps(2) == [2]


def test_empty_and_refused(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert got(col.collocations(empty)) == []
    rare = spark.createDataFrame([("a b c", "en"), (None, None)], "text string, lang string")
    assert got(col.collocations(rare)) == []
    with pytest.raises(ValueError):
        col.collocations(rare, longest=1)
