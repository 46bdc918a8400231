"""Repeated passages across documents, located by Aho-Corasick automata.

Windows of WINDOW words are what counts as repeated. Each window is represented by one phrase of PHRASE
words, the one with the smallest hash among those it holds; equal windows hold equal phrases, and
neighbouring windows mostly share theirs, so a phrase stands for several words of text. Documents are
gathered in blocks of a few MB, written once as a dictionary and numbers: texts are split in that pass
only, and later ones hash each distinct word of a block once.

1. Every block hands on the distinct phrases that represent its windows. They meet in buckets by hash;
   what recurs anywhere is confirmed, and blocks learn which of theirs that are.
2. The confirmed phrases are sharded by block: each compiles an automaton of the phrases that can occur
   in it, as large as the block at most, and streams all its documents through it, which locates every
   occurrence. Windows are taken from the places located, nowhere else; those that repeat an
   earlier one of the block are marked, and distinct ones are handed on with their smallest id.
3. They meet in buckets by hash, where the smallest id of each window is found; blocks learn which of
   theirs stand in a smaller id elsewhere, and drop the words that these or the marked ones cover.

What is shuffled is one packed row per block and bucket. A phrase or window has one element per block,
however often it occurs there, so a passage of a third of all documents is spread over the blocks. A
bucket's task holds some 40 bytes per block for each of its windows, at most those of about `Sizes.merged`
elements and one bucket.

Windows are equal if 128 bits of their hashes are. Phrases are compared by 64 bits when they are
confirmed: a chance pair there costs time, not words.

A null or empty text has no words and nothing is removed. Fewer words than a window are never removed.
Equal texts of different ids: the smallest id keeps its words. Rows that share an id do not cover each
other; a null id counts as larger than any. A very long text makes a block of its own and must fit in a
task's memory. `carry` names a string column that is handed through; no other column is read, so names
cannot clash. An empty table gives no rows.
"""

import random
from collections import defaultdict
from collections.abc import Iterator
from functools import cached_property
from itertools import count
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from seqlog.llm.common import arrow_rows, drop_written, frugal, frugal_pair, mixed, table, written
from seqlog.llm.packing import (
    all_unpacked,
    arrow_schema,
    bucket_of,
    packed,
    packed_texts,
    runs,
    unpacked,
    unpacked_texts,
    whole_buckets,
)

WINDOW, PHRASE = 20, 8
LAST_ID = np.iinfo(np.int64).max


class Sizes(NamedTuple):
    """How the work is cut; the result does not depend on it."""

    #: Characters of a block's texts.
    block: int = 4 << 20
    #: Elements that share a bucket, and that a task merges at once.
    bucket: int = 1 << 18
    merged: int = 1 << 20


#: ids, sizes (words) of `docs` documents; codes of all words in the dictionary of `distinct` words.
BLOCK = (
    "block bigint, docs bigint, words bigint, ids binary, sizes binary, codes binary, dictionary binary, "
    "texts binary, carried binary"
)
PHRASES = "block bigint, bucket bigint, n bigint, start bigint, phrases binary, times binary"
CONFIRMED = "block bigint, n bigint, at binary"
#: A block's windows for one bucket (`low`, `high`, `ids`), or all its located windows: gaps between their
#: starts, numbers of equal ones, and bits that mark those which repeat one of the block.
LOCATED = (
    "block bigint, bucket bigint, n bigint, start bigint, low binary, high binary, ids binary, "
    "gaps binary, numbers binary, marked binary"
)
CLEANED = "doc_id bigint, n_words bigint, n_removed bigint, kept string, carried string"
BASE = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    powers[:1] = 1
    return np.multiply.accumulate(powers)


def sliding(words: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every run of `size` word hashes: a polynomial, from differences of its prefix sums."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * _powers(BASE, len(words)), out=sums[1:])
    return mixed((sums[size:] - sums[:n]) * _powers(pow(BASE, -1, 1 << 64), n))


def smallest(hashes: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest of every `width` consecutive hashes, the leftmost of equals."""
    n = len(hashes) - width + 1
    least, place = hashes[:n].copy(), np.zeros(n, np.int64)
    for k in range(1, width):
        smaller = hashes[k : k + n] < least
        least[smaller] = hashes[k : k + n][smaller]
        place[smaller] = k
    return place + np.arange(n)


class Words:
    """A block's words, laid end to end: their numbers, the dictionary, and sizes of the documents."""

    def __init__(self, codes: np.ndarray, dictionary: list[bytes], sizes: np.ndarray):
        self.codes, self.dictionary = codes, dictionary
        self.ends = np.cumsum(sizes, dtype=np.int64)
        self.starts = self.ends - sizes
        windows = np.maximum(sizes - WINDOW + 1, 0).astype(np.int64)
        self.document = np.repeat(np.arange(len(sizes)), windows)
        #: Where the windows begin.
        self.first = np.arange(windows.sum()) + np.repeat(self.starts - (np.cumsum(windows) - windows), windows)

    @classmethod
    def split(cls, texts: list[str | None]) -> "Words":
        known: defaultdict[bytes, int] = defaultdict(count().__next__)
        place, codes, sizes = known.__getitem__, [], []
        for text in texts:
            words = (text or "").encode("utf-8").split()
            codes.extend(map(place, words))
            sizes.append(len(words))
        return cls(np.array(codes, np.int32), list(known), np.array(sizes, np.int32))

    @classmethod
    def of_block(cls, row: dict) -> "Words":
        sizes = unpacked(row["sizes"], row["docs"], np.int32)
        return cls(unpacked(row["codes"], row["words"], np.int32), unpacked_texts(row["dictionary"]), sizes)

    @cached_property
    def hashes(self) -> np.ndarray:
        """128 bits of every distinct word, in two halves."""
        digests = b"".join(map(xxh3_128_digest, self.dictionary))
        return np.frombuffer(digests, "<u8").astype(np.uint64).reshape(-1, 2)

    def runs(self, size: int, half: int) -> np.ndarray:
        return sliding(self.hashes[:, half][self.codes], size)

    @cached_property
    def represented(self) -> np.ndarray:
        """For each window, where the phrase begins that represents it."""
        if not len(self.first):
            return np.empty(0, np.int64)
        return smallest(self.runs(PHRASE, 0), WINDOW - PHRASE + 1)[self.first]

    def phrases(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct phrases that represent a window, in order of hash, how often, and a place of each."""
        if not len(self.first):
            return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        places = np.unique(self.represented)
        phrases, at, times = np.unique(self.runs(PHRASE, 0)[places], return_index=True, return_counts=True)
        return phrases, times, places[at]

    def letters(self) -> tuple[str, int]:
        """Every word as so many letters of a small alphabet.

        Nodes then have few children, which the automaton searches one by one. First letters are
        from an alphabet of their own, so a phrase is only found where a word begins.
        """
        width = max(1, -(-len(self.dictionary).bit_length() // 5))
        digits = np.empty((len(self.codes), width), "<u4")
        for k in range(width):
            digits[:, k] = ((self.codes >> (5 * k)) & 31) + (0x200 if k else 0x100)
        return digits.tobytes().decode("utf-32-le"), width

    def located(self, places: np.ndarray) -> np.ndarray:
        """For every word, whether one of the phrases that stand at `places` begins there.

        The phrases are compiled into an automaton, and all documents are streamed through it.
        """
        begun = np.zeros(len(self.codes) + 1, bool)
        if not len(places):
            return begun
        letters, width = self.letters()
        automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for place in (places.astype(np.int64) * width).tolist():
            automaton.add_word(letters[place : place + PHRASE * width])
        automaton.make_automaton()
        for start, end in zip(self.starts.tolist(), self.ends.tolist(), strict=True):
            if end - start >= WINDOW:
                # A slice of its own: the automaton copies what it is given.
                last = [at for at, _ in automaton.iter(letters[start * width : end * width])]
                begun[(np.array(last, np.int64) + 1) // width - PHRASE + start] = True
        return begun


def _block(rows: list[tuple], keep_texts: bool) -> dict:
    rows.sort(key=lambda row: LAST_ID if row[0] is None else row[0])
    ids, texts, carried = map(list, zip(*rows, strict=True))
    words = Words.split(texts)
    return {
        "block": random.getrandbits(63), "docs": len(ids), "words": len(words.codes),
        "ids": packed(np.array([LAST_ID if i is None else i for i in ids], np.int64)),
        "sizes": packed((words.ends - words.starts).astype(np.int32)), "codes": packed(words.codes),
        "dictionary": packed_texts(words.dictionary, pa.binary()),
        "texts": packed_texts(texts) if keep_texts else None, "carried": packed_texts(carried),
    }


def _blocks(characters: int, keep_texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                rows.append(row)
                held += len(row[1] or "") + len(row[2] or "")
                if held >= characters:
                    yield pa.RecordBatch.from_pylist([_block(rows, keep_texts)], arrow_schema(BLOCK))
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist([_block(rows, keep_texts)], arrow_schema(BLOCK))

    return run


def _deal_phrases(buckets: int):
    """The phrases that represent a block's windows, by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (row for batch in batches for row in batch.to_pylist()):
            phrases, times, _ = Words.of_block(row).phrases()
            bucket, times = bucket_of(phrases, buckets), np.minimum(times, 2).astype(np.uint8)
            dealt = [
                {
                    "block": row["block"], "bucket": int(bucket[start]), "n": end - start, "start": start,
                    "phrases": packed(phrases[start:end]), "times": packed(times[start:end]),
                }
                for start, end in runs(bucket)
            ]
            yield pa.RecordBatch.from_pylist(dealt, arrow_schema(PHRASES))

    return run


def _answers(rows: pa.Table, chosen: np.ndarray) -> pa.RecordBatch:
    """For each block, which of its own elements are the chosen ones of the merged rows."""
    sizes = rows.column("n").to_numpy()
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(row)) + (rows.column("start").to_numpy() - (np.cumsum(sizes) - sizes))[row]
    mine = np.flatnonzero(chosen)
    block = rows.column("block").to_numpy()[row[mine]]
    order = np.argsort(block, kind="stable")
    block, at = block[order], at[mine[order]].astype(np.int32)
    answers = [
        {"block": int(block[start]), "n": end - start, "at": packed(at[start:end])} for start, end in runs(block)
    ]
    return pa.RecordBatch.from_pylist(answers, arrow_schema(CONFIRMED))


def _confirm(merged: int):
    """Phrases that recur in any block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_buckets(batches, merged):
            sizes = rows.column("n").to_pylist()
            phrases = all_unpacked(rows.column("phrases"), sizes, np.uint64)
            times = all_unpacked(rows.column("times"), sizes, np.uint8)
            _, number = np.unique(phrases, return_inverse=True)
            yield _answers(rows, np.bincount(number, weights=times)[number] > 1)

    return run


def _first_elsewhere(merged: int):
    """Windows that stand in a smaller id of another block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_buckets(batches, merged):
            sizes = rows.column("n").to_pylist()
            low, high = (all_unpacked(rows.column(c), sizes, np.uint64) for c in ("low", "high"))
            ids = all_unpacked(rows.column("ids"), sizes, np.int64)
            order = np.lexsort((ids, high, low))
            new = np.ones(len(order), bool)
            new[1:] = (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1])
            first = ids[order][np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
            later = np.empty(len(order), bool)
            later[order] = ids[order] > first
            yield _answers(rows, later)

    return run


def _locate(block: pa.Table, confirmed: pa.Table, buckets: int) -> pa.Table:
    """A block's windows around located phrases: by bucket for the others, and for itself."""
    if not (block.num_rows and confirmed.num_rows):
        return pa.Table.from_pylist([], arrow_schema(LOCATED))
    held = block.to_pylist()[0]
    words, ids = Words.of_block(held), unpacked(held["ids"], held["docs"], np.int64)
    known = all_unpacked(confirmed.column("at"), confirmed.column("n").to_pylist(), np.int32)
    begun = words.located(words.phrases()[2][known])
    found = begun[words.represented]
    first, document = words.first[found], words.document[found]
    low, high = (words.runs(WINDOW, half)[first] for half in (0, 1))
    # Documents are in order of id and windows in order of place, so the first of equals is the earliest.
    order = np.lexsort((high, low))
    new = np.ones(len(order), bool)
    new[1:] = (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1])
    leader = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    again = np.zeros(len(order), bool)
    again[1:] = ~new[1:] & (document[order][1:] == document[order][:-1])
    marked = np.zeros(len(order), bool)
    marked[order] = again | (ids[document[order]] > ids[document[leader]])
    number = np.empty(len(order), np.int32)
    number[order] = np.cumsum(new) - 1
    distinct = order[new]
    low, high, owner = low[distinct], high[distinct], ids[document[distinct]]
    bucket = bucket_of(low, buckets)
    rows = [
        {
            "block": held["block"], "bucket": int(bucket[start]), "n": end - start, "start": start,
            "low": packed(low[start:end]), "high": packed(high[start:end]), "ids": packed(owner[start:end]),
        }
        for start, end in runs(bucket)
    ]
    gaps = np.diff(first, prepend=0).astype(np.int32)
    rows.append(
        {
            "block": held["block"], "n": len(first), "gaps": packed(gaps), "numbers": packed(number),
            "marked": packed(np.packbits(marked)),
        }
    )
    return pa.Table.from_pylist(rows, arrow_schema(LOCATED))


def _covered(words: int, told: pa.Table) -> np.ndarray:
    """For every word of a block, whether a repeated window covers it."""
    change = np.zeros(words + 1, np.int64)
    for row in told.select(["n", "gaps", "numbers", "marked"]).to_pylist():
        if row["gaps"] is None:
            continue
        n = row["n"]
        first = np.cumsum(unpacked(row["gaps"], n, np.int32), dtype=np.int64)
        number = unpacked(row["numbers"], n, np.int32)
        repeated = np.unpackbits(unpacked(row["marked"], -(-n // 8), np.uint8), count=n).astype(bool)
        elsewhere = np.zeros(int(number.max(initial=-1)) + 1, bool)
        for answer in told.select(["n", "at"]).to_pylist():
            if answer["at"] is not None:
                elsewhere[unpacked(answer["at"], answer["n"], np.int32)] = True
        repeated |= elsewhere[number]
        change[first[repeated]] += 1  # a window begins once at a word
        change[np.minimum(first[repeated] + WINDOW, words)] -= 1
    return np.cumsum(change)[:-1] > 0


def _clean(block: pa.Table, told: pa.Table, untouched: bool) -> pa.Table:
    """The block's documents without the words that repeated windows cover.

    `untouched` leaves a text as it was where nothing is removed.
    """
    rows = []
    if block.num_rows:
        held = block.to_pylist()[0]
        words, ids = Words.of_block(held), unpacked(held["ids"], held["docs"], np.int64).tolist()
        gone, kept = _covered(held["words"], told), np.array(words.dictionary, object)[words.codes]
        texts = unpacked_texts(held["texts"]) if untouched else [None] * len(ids)
        for i, text, carried, start, end in zip(
            ids, texts, unpacked_texts(held["carried"]), words.starts.tolist(), words.ends.tolist(), strict=True
        ):
            left = ~gone[start:end]
            removed = end - start - int(np.count_nonzero(left))
            if removed or not untouched:
                text = b" ".join(kept[start:end][left].tolist()).decode("utf-8")
            rows.append((None if i == LAST_ID else i, end - start, removed, text, carried))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    names = ["doc_id", "n_words", "n_removed", "kept", "carried"]
    return pa.table({n: pa.array([r[k] for r in rows], kinds[k]) for k, n in enumerate(names)})


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: str | None = None,
    untouched: bool = False, sizes: Sizes = Sizes(),
) -> DataFrame:
    """doc_id, n_words, n_removed, kept (words left, joined by blanks) and the carried column.

    With `untouched`, `kept` is the text as it was where nothing is removed.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        (F.col(carry) if carry else F.lit(None)).cast("string").alias("carried"),
    )
    with arrow_rows(spark, 1_000):
        blocks, _ = written(rows.mapInArrow(frugal(_blocks(sizes.block, untouched)), BLOCK), "text-blocks")
    buckets = -(-(blocks.agg(F.sum("words")).first()[0] or 0) // sizes.bucket) or 1

    def answered(dealt: DataFrame, merge, label: str) -> tuple[DataFrame, str]:
        with arrow_rows(spark, 500):
            together = dealt.repartition("bucket").sortWithinPartitions("bucket")
            return written(together.mapInArrow(frugal(merge(sizes.merged)), CONFIRMED), label)

    with arrow_rows(spark, 1):
        dealt, dealt_path = written(
            blocks.select("block", "docs", "words", "sizes", "codes", "dictionary").mapInArrow(
                frugal(_deal_phrases(buckets)), PHRASES
            ),
            "phrases",
        )
    confirmed, confirmed_path = answered(dealt, _confirm, "confirmed-phrases")
    drop_written(spark, dealt_path)
    numbers = blocks.select("block", "docs", "words", "ids", "sizes", "codes", "dictionary")
    located, located_path = written(
        numbers.groupBy("block")
        .cogroup(confirmed.withColumnRenamed("block", "to").groupBy("to"))
        .applyInArrow(frugal_pair(lambda block, phrases: _locate(block, phrases, buckets)), LOCATED),
        "located-windows",
    )
    drop_written(spark, confirmed_path)
    by_bucket = located.where("bucket IS NOT NULL").select("block", "bucket", "n", "start", "low", "high", "ids")
    elsewhere, elsewhere_path = answered(by_bucket, _first_elsewhere, "repeated-elsewhere")
    own = located.where("bucket IS NULL").select(F.col("block").alias("to"), "n", "gaps", "numbers", "marked")
    told, _ = written(
        own.unionByName(elsewhere.withColumnRenamed("block", "to"), allowMissingColumns=True), "repeated-windows"
    )
    drop_written(spark, located_path, elsewhere_path)
    return (
        blocks.select("block", "docs", "words", "ids", "sizes", "codes", "dictionary", "texts", "carried")
        .groupBy("block")
        .cogroup(told.groupBy("to"))
        .applyInArrow(frugal_pair(lambda block, repeated: _clean(block, repeated, untouched)), CLEANED)
    )


def op4_substring_dedup(spark, sf_dir) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )
