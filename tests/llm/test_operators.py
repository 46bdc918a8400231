"""Every operator against a brute-force version, on texts with nulls, ties, repeats and clashing names."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from seqlog.llm import bpe, fingerprints, mixing, near_dedup, sharding, substrings, toxicity, top_k
from seqlog.llm import token_counts, url_filter
from seqlog.llm.common import min_labels
from seqlog.llm.tokenizer_file import loaded, read_tokenizer

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " ", "one", "one two", "One TWO", "a <|endoftext|> b", "<<|endoftext|>><|startoftext|>",
    "!" * 30_000 + "<|endoftext|>", "x" * 20_000, "I'll 'S don't''s １２ ½²漢字👍🏽 ‍", "a\x1cb\x85c　d\xa0 e",
    "İstanbul ΣΑΣ ſ K Å é ﬁ", "\n\n \t x\x0b\x0cy  ",
]


def texts():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6)))
    base = [" ".join(word() for _ in range(rng.randint(3, 160))) for _ in range(40)]
    out = list(ODD)
    for text in base:
        out.append(text)
        words = text.split()
        for edits in (0, 1, 2, 6):
            copy = list(words)
            for _ in range(edits):
                copy[rng.randrange(len(copy))] = word()
            out.append("  ".join(copy).upper() if edits == 1 else " ".join(copy))
        cut = rng.randrange(len(words))
        out.append(" ".join(words[cut:] + [word() for _ in range(30)] + words[: cut // 2]))
        out.append(" ".join(words * 3))
    rng.shuffle(out)
    return out


@pytest.fixture(scope="module")
def rows():
    return [(i * 3 - 50, text) for i, text in enumerate(texts())]


@pytest.fixture(scope="module")
def docs(spark, rows):
    """Extra columns named like results of the operators."""
    schema = "doc_id long, text string, n_tokens string, kept string, score string, label int, source string"
    return spark.createDataFrame(
        [(i, t, "x", "y", "z", 1, None if i % 7 == 0 else f"s{i % 3}") for i, t in rows], schema
    ).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def link_classes(links, ids):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    return {i: find(i) for i in ids}


def test_near_duplicates_equal_all_pairs(rows, docs, empty):
    sets = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        sets[i] = {tuple(words[k : k + 3]) for k in range(max(1, len(words) - 2))} if words else set()
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    ]
    expected = link_classes(links, sets)
    got = near_dedup.near_duplicates(docs).collect()
    assert len(links) > 50
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got} == {
        (i, len(sets[i]), expected[i], expected[i] == i) for i in sets
    }
    assert near_dedup.near_duplicates(empty).count() == 0


def test_near_duplicates_in_blocks(spark, rows, docs, monkeypatch):
    whole = sorted(map(tuple, near_dedup.near_duplicates(docs).collect()))
    monkeypatch.setattr(near_dedup, "KEY_BLOCK", 2)
    monkeypatch.setattr(near_dedup, "TEXT_BLOCK", 2)
    assert sorted(map(tuple, near_dedup.near_duplicates(docs).collect())) == whole


def test_near_duplicates_null_and_repeated_ids(spark):
    frame = spark.createDataFrame([(None, "a b c d"), (1, "a b c d"), (1, "a b c d"), (2, "a b c d")], "doc_id long, text string")
    got = sorted(map(tuple, near_dedup.near_duplicates(frame).collect()), key=repr)
    assert got == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (None, 2, None, True)]


def test_chunk_keys_hold_every_pair_within_the_radius():
    rng = np.random.default_rng(5)
    for _ in range(300):
        one = rng.integers(0, 1 << 16, (1, near_dedup.POSITIONS)).astype(np.uint16)
        other = one.copy()
        places = rng.choice(near_dedup.POSITIONS, near_dedup.RADIUS, replace=False)
        other[0, places] ^= 1
        assert (near_dedup.chunk_keys(one) == near_dedup.chunk_keys(other)).any()


def test_positions_keep_the_miss_chance_at_every_threshold():
    assert (near_dedup.POSITIONS, near_dedup.RADIUS) == (32, 15)
    assert near_dedup.positions_for(80) == 48
    for percent in (60, 70, 80, 85, 95, 100):
        assert near_dedup.miss(near_dedup.positions_for(percent), percent) <= near_dedup.MISS


def test_labels_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(5, 5)]
    got = {r.id: r.label for r in min_labels(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}


def test_bpe_equals_the_library_and_round_trips(rows, docs, empty):
    tokenizer = loaded(read_tokenizer(BYTE_BPE))
    got = {r.doc_id: r for r in bpe.decode(bpe.encode(docs, BYTE_BPE), BYTE_BPE).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        assert list(got[i].ids) == tokenizer.encode(text or "", add_special_tokens=False).ids
        assert got[i].decoded == (text or "")
    assert bpe.encode(empty, BYTE_BPE).count() == 0


def test_bpe_blanks_before_special_strings(spark):
    blanks = ["\n", "\n\n", "\n\n\n\n", "  ", " \n \t\n", "\t\t ", "\u3000\xa0 ", "\r\n\r\n"]
    made = [f"{head}{b}<|endoftext|>{tail}" for b in blanks for head in ("", "a", "a.") for tail in ("", "b", f"{b}c")]
    frame = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    tokenizer = loaded(read_tokenizer(BYTE_BPE))
    got = {r.doc_id: list(r.ids) for r in bpe.encode(frame, BYTE_BPE).collect()}
    assert got == {i: tokenizer.encode(t, add_special_tokens=False).ids for i, t in enumerate(made)}
    assert got[made.index("a\n\n<|endoftext|>b")] == [64, 628, 50256, 65]


def test_decoding_of_arbitrary_ids(spark):
    ids = [[220, 10, 50256, -1, 99999], [], None, [127, 236, 50000]]
    frame = spark.createDataFrame([(1, x) for x in ids], "doc_id long, ids array<int>")
    got = [r.decoded for r in bpe.decode(frame, BYTE_BPE).collect()]
    tokenizer = loaded(read_tokenizer(BYTE_BPE))
    known = [[i for i in x or [] if 0 <= i < 50257] for x in ids]
    assert sorted(got) == sorted(tokenizer.decode(x, skip_special_tokens=False) for x in known)


def test_token_counts_equal_the_library(rows, docs, empty):
    tokenizer = loaded(read_tokenizer(WORD_BPE))
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(docs, WORD_BPE).collect()}
    assert got == {
        i: (len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in rows
    }
    assert token_counts.count_tokens(empty, WORD_BPE).count() == 0


def test_whole_tokens_are_proven():
    content = read_tokenizer(WORD_BPE)
    whole = token_counts.proven_whole(content)
    encoded = loaded(content).encode_batch(whole[:5000], add_special_tokens=False)
    assert len(whole) > 20_000 and all(len(e.ids) == 1 for e in encoded)


def removed_by_brute_force(rows):
    first, out = {}, {}
    for i, text in sorted(rows):
        words = (text or "").encode().split()
        gone = set()
        for k in range(len(words) - 19):
            if first.setdefault(tuple(words[k : k + 20]), (i, k)) != (i, k):
                gone.update(range(k, k + 20))
        out[i] = (len(words), len(gone), b" ".join(w for k, w in enumerate(words) if k not in gone).decode())
    return out


def test_repeated_passages_equal_brute_force(rows, docs, empty):
    expected = removed_by_brute_force(rows)
    assert sum(n for _, n, _ in expected.values()) > 1000
    for sizes in (substrings.Sizes(), substrings.Sizes(block=5_000, bucket=100, merged=300)):
        found = substrings.remove_repeats(docs, sizes=sizes).collect()
        assert len(found) == len(expected)
        assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in found} == expected
    assert substrings.remove_repeats(empty).count() == 0


def test_automaton_locates_every_occurrence_of_a_phrase():
    text = " ".join(f"w{k % 31}" for k in range(200))
    words = substrings.Words.split([text, "short", None, text])
    _, times, places = words.phrases()
    assert times.max() > 1 and not words.located(places[:0]).any()
    wanted = text.split()[places[0] : places[0] + substrings.PHRASE]
    parts = [*text.split(), "short", *text.split()]
    expected = [parts[k : k + substrings.PHRASE] == wanted for k in range(len(parts))]
    assert words.located(places[:1])[:-1].tolist() == expected and sum(expected) == times[0]


def test_rows_that_share_an_id(spark):
    """They do not cover each other, whichever block they are in; a larger id loses its words."""
    text = " ".join(f"x{k}" for k in range(25))
    rows = [(1, text), (1, text), (2, text), (None, text), (None, text), (3, text + " " + text)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for sizes in (substrings.Sizes(), substrings.Sizes(block=1)):
        got = sorted((r.doc_id or 9, r.n_removed) for r in substrings.remove_repeats(frame, sizes=sizes).collect())
        assert got == [(1, 0), (1, 0), (2, 25), (3, 50), (9, 25), (9, 25)]


def test_untouched_texts_and_carried_column(spark):
    frame = spark.createDataFrame([(1, " a  b ", "p"), (None, None, None)], "doc_id long, text string, c string")
    got = {r.doc_id: (r.kept, r.carried) for r in substrings.remove_repeats(frame, carry="c", untouched=True).collect()}
    assert got == {1: (" a  b ", "p"), None: (None, None)}


def test_clause_grammar():
    lexicon = toxicity.Lexicon(toxicity.Grammar({"moron": 4.0}, {"lowe": 2.0}))
    value = lambda text: toxicity.text_value(text, lexicon)
    assert value("what a moron") == 4.0
    assert value("you are a moron") == 4.0 * toxicity.TARGETED
    assert value("he is not a moron") == 4.0 * toxicity.NEGATED
    assert value("she said moron") == 4.0 * toxicity.REPORTED
    assert value("loweish thing") == 2.0
    assert value("kill the lights") == 0.0
    assert value("i will kill you") > 0.0
    assert value("moron. moron") == 6.0
    assert value("") == 0.0


def test_toxicity_learns_from_labels_and_keeps_rows(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows = [(i, " ".join([word() for _ in range(30)] + (["zorkface"] if i % 3 == 0 else [])), int(i % 3 == 0), "old") for i in range(600)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int, score string")
    labels = frame.select("doc_id", "toxic").union(spark.createDataFrame([(None, 1), (5, None)], "doc_id long, toxic int"))
    grammar = toxicity.fit(frame, labels)
    got = toxicity.score(frame.select("doc_id", "text", "score").union(spark.createDataFrame([(None, None, "s")], "doc_id long, text string, score string")), grammar).collect()
    assert len(got) == 601
    assert all(r.predicted == int(r.doc_id % 3 == 0) for r in got if r.doc_id is not None)
    assert [r.predicted for r in got if r.doc_id is None] == [0]
    assert toxicity.fit(frame, labels.limit(0)) == toxicity.Grammar()


def test_held_out_rows_do_not_reach_the_fit(spark):
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    frame = spark.createDataFrame([(i, f"badword number{i}") for i in held], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in held], "doc_id long, toxic int")
    assert toxicity.fit(frame, labels) == toxicity.Grammar()


def test_shards_are_level_and_gapless(docs, rows, empty):
    frame = docs.select("doc_id", "text")
    for bucket_bytes in (1 << 24, 2_000):
        got, _ = sharding.shard_rows(frame, bucket_bytes=bucket_bytes)
        slots = defaultdict(list)
        collected = got.collect()
        for r in collected:
            slots[r.shard].append(r.slot)
        assert sorted((r.doc_id, r.text or "") for r in collected) == sorted((i, t or "") for i, t in rows)
        assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1 and len(slots) == 8
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    order = [r.doc_id for r in sorted(collected, key=lambda r: (r.shard, r.slot))]
    assert order != sorted(order)
    assert sharding.shard_rows(empty.select("doc_id", "text"))[0].count() == 0
    named, _ = sharding.shard_rows(docs.withColumn("slot", F.lit(1)).withColumn("Shard", F.lit("s")))
    assert set(named.columns) == {*docs.columns, "slot", "Shard", "shard_", "slot_"}
    assert {(r.Shard, r.slot) for r in named.collect()} == {("s", 1)} and named.count() == len(rows)


def test_shards_do_not_depend_on_partitions(spark):
    same = [(None, None, "x")] * 300 + [(7, "copy", "y")] * 200 + [(7, "copy", "z")] * 100
    frame = spark.createDataFrame([(i, f"text {i}" * (i % 9), "o") for i in range(400)] + same, "doc_id long, text string, tag string")

    def placed(df):
        return sorted(map(tuple, sharding.shard_rows(df, bucket_bytes=1_000)[0].select("shard", "slot", "doc_id", "text", "tag").collect()), key=repr)

    first = placed(frame.repartition(4))
    assert placed(frame.repartition(7).orderBy("tag")) == first
    assert sorted(r[2:] for r in first if r[2] is None) == [(None, None, "x")] * 300
    # Equal rows are scattered: no shard of eight takes many more than its share.
    assert max(Counter(r[0] for r in first if r[4] == "x").values()) < 75


def test_shards_with_several_buckets_a_partition(spark, monkeypatch):
    monkeypatch.setattr(sharding, "PARTITIONS", 3)
    frame = spark.createDataFrame([(i, "t" * (i % 50)) for i in range(500)], "doc_id long, text string")
    got = [sorted(map(tuple, sharding.shard_rows(frame.repartition(n), bucket_bytes=500)[0].select("shard", "slot", "doc_id").collect())) for n in (2, 5)]
    assert got[0] == got[1]
    assert [r[:2] for r in got[0]] == [(shard, slot) for shard in range(8) for slot in range(63 - shard % 2)]
    assert sorted(r[2] for r in got[0]) == list(range(500))


def test_mixing_rates_and_stability(spark, docs, empty):
    frame = spark.range(30_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 == 0, None).otherwise(F.when(F.col("id") % 10 < 7, "a").otherwise("b")).alias("source"))
    targets = spark.createDataFrame([("a", 18_000, 1.0), ("b", 9_000, 2.0), (None, 3_000, 3.0)], "source string, n long, weight double")
    counts = Counter(r.source for r in mixing.mix(frame, targets).select("source").collect())
    for source, share in (("a", 5_000), ("b", 10_000), (None, 15_000)):
        assert abs(counts[source] - share) < 5 * share**0.5 * 2
    again = mixing.mix(frame.repartition(3), targets).groupBy("doc_id").count().collect()
    first = mixing.mix(frame, targets).groupBy("doc_id").count().collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))
    assert set(mixing.mix(docs).columns) == {*docs.columns, "copy", "copies", "order_key"}
    assert mixing.mix(empty).count() == 0


def test_mixing_keeps_columns_of_its_own_names(spark, docs):
    clashing = docs.withColumns({"copy": F.lit("mine"), "Copies": F.lit(-1), "order_key": F.lit(None).cast("int"), "_source": F.lit("s"), "_row": F.lit(3)})
    got = mixing.mix(clashing)
    assert set(got.columns) == {*clashing.columns, "copy_", "copies_", "order_key_"}
    assert {(r["copy"], r.Copies, r.order_key, r["_source"], r["_row"]) for r in got.collect()} == {("mine", -1, None, "s", 3)}
    plain = mixing.mix(docs)
    key = lambda name: [(r.doc_id, r[f"copy{name}"], r[f"copies{name}"], r[f"order_key{name}"]) for r in (got if name else plain).collect()]
    assert sorted(key("_"), key=repr) == sorted(key(""), key=repr)


def test_first_stage_keeps_columns_of_the_score(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows = [(i, " ".join([word() for _ in range(30)] + (["zorkface"] if i % 3 == 0 else [])), "old", i, None) for i in range(600)]
    frame = spark.createDataFrame([*rows, (None, None, "old", None, None)], "doc_id long, text string, score string, value long, predicted int")
    spark.createDataFrame([(r[0], int(r[0] % 3 == 0)) for r in rows], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = corpus_pipeline.drop_toxic(spark, frame, str(tmp_path))
    assert kept.schema == frame.schema
    assert sorted(map(repr, kept.collect())) == sorted(repr(r) for r in frame.collect() if r.doc_id is None or r.doc_id % 3)


def brute_top_k(rows, every, k):
    vectors = {i: np.floor(1024 * np.array(v, float)).astype(int) for i, v in rows}
    out = set()
    for q in vectors:
        if q % every == 0:
            scored = sorted((-int(vectors[q] @ vectors[i]), i) for i in vectors if i != q)[:k]
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)}
    return out


def test_top_k_is_exact_with_ties_and_odd_rows(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(400)]
    rows += [(400 + i, [0.5, 0.5, -0.5, 0.25]) for i in range(200)]
    odd = [(700, None), (800, [1.0, None, 0.0, 0.0]), (900, [float("nan"), 0.0, 0.0, 0.0]), (None, [1.0] * 4), (901, [1.0])]
    frame = spark.createDataFrame(rows + odd + rows[:5], "vec_id long, embedding array<float>")
    exact = [(i, np.array(v, np.float32).tolist()) for i, v in rows]
    monkeypatch.setattr(top_k, "BLOCK", 32)
    monkeypatch.setattr(top_k, "SHARE", 2)
    assert {tuple(r) for r in top_k.top_k(frame).collect()} == brute_top_k(exact, 100, 10)
    assert {tuple(r) for r in top_k.top_k(frame.where("vec_id < 4")).collect()} == brute_top_k(exact[:4], 100, 10)
    assert top_k.top_k(frame.limit(0)).count() == 0


def test_top_k_of_large_components(spark):
    """Products beyond 2^53 are exact, sums may leave 64 bits on the way, and a score beyond them is refused."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=8) * rng.choice([1.0, 3e3, 9e4])]) for i in range(600)]
    # Two products above 2^62 and two below -2^62 add up to little.
    swing = [2_097_151.0] * 4
    rows += [(700, swing + [0.0] * 4), (701, [a * b for a, b in zip(swing, (1, 1, -1, -1))] + [0.0] * 4)]
    short = [(i, [1.0]) for i in range(2_000, 2_300)]
    frame = spark.createDataFrame(rows + short, "vec_id long, embedding array<double>")
    assert {tuple(r) for r in top_k.top_k(frame).collect()} == brute_top_k(rows, 100, 10)
    beyond = spark.createDataFrame([(0, [2e6] * 4), (1, [2e6] * 4)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="beyond 64 bits"):
        top_k.top_k(beyond).collect()


def test_edits_and_equal_fingerprints(rows, docs, empty):
    got = {r.doc_id: r for r in fingerprints.compare_edits(docs).collect()}
    order = sorted(rows, reverse=True)
    assert len(got) == len(rows)
    by_text = defaultdict(set)
    for (i, text), (_, following) in zip(order, order[1:] + order[:1], strict=True):
        text, following = text or "", following or ""
        k = len(text) // 3
        edited = text[: len(text) - k] + following[:k]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        by_text[text].add(got[i].fingerprint)
        by_text[edited].add(got[i].edited_fingerprint)
    assert all(len(prints) == 1 for prints in by_text.values())
    assert fingerprints.compare_edits(empty).count() == 0


def test_near_fingerprints_equal_brute_force(spark):
    rng = random.Random(4)
    prints = [(rng.getrandbits(64) - (1 << 63), rng.getrandbits(64) - (1 << 63)) for _ in range(60)]
    for a, b in prints[:40]:
        flips = rng.sample(range(128), rng.randint(0, 5))
        x = ((a & ((1 << 64) - 1)) | ((b & ((1 << 64) - 1)) << 64)) ^ sum(1 << f for f in flips)
        prints.append(tuple(v - (1 << 64) if v >> 63 else v for v in (x & ((1 << 64) - 1), x >> 64)))
    apart = lambda p, q: sum(bin((x ^ y) & ((1 << 64) - 1)).count("1") for x, y in zip(p, q, strict=True))
    distinct = set(prints)
    expected = {(*p, *q) for p in distinct for q in distinct if p < q and apart(p, q) <= 3}
    frame = spark.createDataFrame(prints, "fp0 long, fp1 long")
    assert {tuple(r) for r in fingerprints.near_pairs(frame).collect()} == expected
    assert {tuple(r) for r in fingerprints.with_near(frame).collect()} == {e[:2] for e in expected} | {e[2:] for e in expected}


def test_near_classes_equal_brute_force(spark, monkeypatch):
    """Chains, equal fingerprints, a crowded block key, repeated and null ids; keys cut in blocks too."""
    rng, mask = random.Random(6), (1 << 64) - 1
    wide = [rng.getrandbits(128) for _ in range(25)]
    for _ in range(60):
        wide.append(rng.choice(wide) ^ sum(1 << f for f in rng.sample(range(128), rng.randint(0, 4))))
    wide += [wide[0] ^ (1 << f) for f in range(20)]
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    ids = [None if k % 9 == 0 else 200 - k // 2 for k in range(len(wide))]
    rows = [(i, signed(x & mask), signed(x >> 64)) for i, x in zip(ids, wide, strict=True)]
    near = lambda x, y: bin(x ^ y).count("1") <= 3
    classes = link_classes([(x, y) for x in wide for y in wide if x < y and near(x, y)], set(wide))
    expected = {}
    for x, (_, fp0, fp1) in zip(wide, rows, strict=True):
        members = [i for i, y in zip(ids, wide, strict=True) if classes[y] == classes[x] and i is not None]
        links = sum(near(x, y) for y in wide) - 1
        if links:
            expected[fp0, fp1] = (min(members, default=None), links)
    frame = spark.createDataFrame(rows, "doc_id long, fp0 long, fp1 long").repartition(3)
    for block in (128, 4):
        monkeypatch.setattr(fingerprints, "KEY_BLOCK", block)
        got = fingerprints.near_classes(frame).collect()
        assert len(got) == len(expected)
        assert {(r.fp0, r.fp1): (r.near_class, r.n_links) for r in got} == expected
    assert fingerprints.near_classes(frame.limit(0)).count() == 0


def test_urls(spark):
    pages = [
        (1, "https://A.com/x?y", None), (2, "http://example.com/en/a", ""), (3, "https://www.example.com/en/", ""),
        (4, "https://x.net/es/1#t", ' <a href="https://y.org/q">'), (5, "http://x.net/de/", None), (6, None, None),
        (7, "nourl", ""), (8, "https://com", ""), (9, "https://y.org/", '<a href=//good.com/>'), (9, "https://y.org/", ""),
        (10, "https://z.org/", "<a HREF='http://x.net/es/'>"), (None, "https://notcom/", ""),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(frame).collect()}
    assert {
        (1, "a.com", "/x", "com/", "allow"), (2, "example.com", "/en/a", "example.com/en/", "block"),
        (3, "www.example.com", "/en/", "www.example.com/en/", "allow"), (4, "x.net", "/es/1", "net/es/", "block"),
        (5, "x.net", "/de/", None, "block"), (6, "", "", None, "allow"), (7, "", "", None, "allow"),
        (8, "com", "", None, "allow"), (10, "z.org", "/", None, "block"), (None, "notcom", "/", None, "allow"),
    } <= got
    assert url_filter.filter_urls(frame.limit(0)).count() == 0
