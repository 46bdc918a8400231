"""Registered queries on the driver's tables: SQL where there is any, the pipeline stage by stage."""

import os

import corpus_pipeline
import duckdb
import pytest

from seqlog.llm.queries import ORACLE, QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    frame = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    order = sorted(names)
    assert sorted(frame.columns) == order
    expected = sorted(repr([row[names.index(c)] for c in order]) for row in result.fetchall())
    assert sorted(repr([row[c] for c in order]) for row in frame.collect()) == expected


def test_every_operator_has_a_query():
    assert {name.split("_")[0] for name in QUERIES} == {"pipeline", *(f"op{n}" for n in range(1, 14))}


def test_pipeline_stages(spark):
    """Each stage against plain Python over what the stage before it kept. Near copies share 80 % of five-word runs: 0.828 here on five words, 0.831 on three."""
    from test_operators import link_classes, removed_by_brute_force

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    text = " ".join(f"w{k}" for k in range(100))
    copy = text + "".join(f" v{k}" for k in range(20))
    made = spark.createDataFrame([(-2, text), (-1, copy)], "doc_id long, text string")
    frame = docs.unionByName(made, allowMissingColumns=True)
    texts = {r.doc_id: r.text or "" for r in frame.collect()}
    sets = {}
    for i, text in texts.items():
        words = text.encode().lower().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    classes = link_classes(links, sets)
    assert classes[-1] == -2
    survivors = {i for i in classes if classes[i] == i}
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["near_dedup"](spark, frame, SF_DIR)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(survivors)
    cut = stages["substring_dedup"](spark, kept, SF_DIR)
    got = {r.doc_id: r.text for r in cut.collect()}
    for i, (_, removed, left) in removed_by_brute_force([(i, texts[i]) for i in survivors]).items():
        assert got[i] == (left if removed else texts[i])
    mixed = stages["mixing"](spark, cut, SF_DIR)
    tokens = stages["bpe"](spark, mixed, SF_DIR).collect()
    assert len(tokens) == mixed.count()
    assert all(r.decoded == got[r.doc_id] for r in tokens)
