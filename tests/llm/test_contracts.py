"""The registered queries of the first operators against plain Python over the driver's documents."""

import hashlib
import os
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from seqlog.llm.queries import QUERIES
from test_operators import link_classes, removed_by_brute_force

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text or "" for r in rows}


def answers(spark, name):
    got = QUERIES[name](spark, SF_DIR).collect()
    rows = {r["doc_id"]: r for r in got}
    assert len(rows) == len(got)
    return rows


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def library(name):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def test_near_dedup(spark, texts):
    sets = {}
    for i, text in texts.items():
        words = text.encode().lower().split()
        sets[i] = {tuple(words[k : k + 3]) for k in range(max(1, len(words) - 2))} if words else set()
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    ]
    classes = link_classes(links, sets)
    got = answers(spark, "op1_near_dedup")
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {
        i: (len(s), classes[i], classes[i] == i) for i, s in sets.items()
    }
    assert links


def test_bpe(spark, texts):
    tokenizer = library("byte_bpe_50k.json")
    for i, r in answers(spark, "op2_bpe").items():
        ids = tokenizer.encode(texts[i], add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), digest(",".join(map(str, ids))), digest(decoded))


def test_substring_dedup(spark, texts):
    expected = removed_by_brute_force(sorted(texts.items()))
    got = answers(spark, "op4_substring_dedup")
    assert set(got) == set(texts)
    for i, (n_words, n_removed, kept) in expected.items():
        assert (got[i].n_words, got[i].n_removed, got[i].kept_sha256) == (n_words, n_removed, digest(kept))
    assert any(r.n_removed for r in got.values())


def test_sharding(spark, texts):
    got = answers(spark, "op6_sharding")
    assert set(got) == set(texts)
    slots = {}
    for i, r in got.items():
        data = texts[i].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(slots) == set(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(s) for s in slots.values()]
    assert max(sizes) - min(sizes) <= 1


def test_token_counts(spark, texts):
    tokenizer = library("word_bpe_49k.json")
    got = answers(spark, "op9_token_counts")
    assert set(got) == set(texts)
    for i, r in got.items():
        n = len(tokenizer.encode(texts[i], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[i].encode()), n, n > 2048)


def test_fingerprints(spark, texts):
    got = answers(spark, "op10_fingerprints")
    order = sorted(texts, reverse=True)
    prints = {}
    for i, following in zip(order, order[1:] + order[:1], strict=True):
        text, other = texts[i], texts[following]
        k = len(text) // 3
        edited = text[: len(text) - k] + other[:k]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), digest(edited))
        for near, one, two in (
            (r.near_edited, r.fingerprint, r.edited_fingerprint),
            (r.near_next, r.fingerprint, got[following].fingerprint),
        ):
            differing = (int(one, 16) ^ int(two, 16)).bit_count()
            assert near == pytest.approx(1 - differing / (4 * len(one)))
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        assert prints.setdefault(edited, r.edited_fingerprint) == r.edited_fingerprint


def test_toxicity(spark, texts):
    got = answers(spark, "op5_toxicity")
    assert set(got) == set(texts)
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
