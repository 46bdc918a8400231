"""Byte-level BPE over a table of distinct words, and the way back.

Encoding: Spark splits every text into pre-tokens. Texts are gathered in blocks (one Arrow batch
each); a block keeps its words as positions in its own dictionary. The dictionaries are cut by a
hash of the word and the pieces shuffled by it, packed, so all copies of a word meet in one task,
which holds that share of the table of distinct words and merges each once. Ids go back the same
way and every block looks them up by position. Shuffled are packed dictionaries and ids, never texts
or one row per word; blocks are a bucketed table and stay where they are; a frequent word occurs once in a block, so it is no hot key.

Decoding: ids are joined with the id-to-piece table. That table is the vocabulary, a fixed size
whatever the corpus, so the join is a lookup in a broadcast copy, by position.

A null text counts as empty and has no ids. Special strings in a text become their own ids, as the
library does by default. Rows are independent: repeated or null ids give as many rows. Other columns
of the input are not read.
"""

import random
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqlog.llm.common import arrow_rows, frugal, frugal_pair, mixed, shuffles_removed, table
from seqlog.llm.tokenizer_file import (
    loaded,
    model_ids,
    piece_bytes,
    read_tokenizer,
    special_pattern,
    special_strings,
)
from seqlog.plans.staging import scratch_path

#: Documents of a block: a few MB of text, so that a task's memory does not depend on the corpus.
BLOCK_DOCS = 2_000
#: Documents whose decoded texts are held at a time.
DECODED_DOCS = 500
#: Words a task remembers at a time; beyond it the memory starts afresh.
REMEMBERED = 200_000
BLOCK = "block bigint, doc_ids array<bigint>, n_words array<bigint>, codes binary, dictionary array<binary>"
ENCODED = "doc_id bigint, ids array<int>"


def pre_token_pattern(content: str) -> str:
    """Contractions, letters, digits, other signs, blanks; special strings stand for themselves.

    Letters come first, as most pre-tokens are such; special strings begin with a sign. Possessive
    where a run of signs must stop before a special string: that form needs no stack,
    however long the run is. Blanks before a special string stay whole, as
    the text that the model sees ends there; before other words the last blank is left to the word.
    """
    special, gap = special_pattern(content), r"\p{IsWhite_Space}"
    signs = rf"[^{gap}\p{{L}}\p{{N}}]"
    return (
        rf" ?\p{{L}}+|{special}|'s|'t|'re|'ve|'m|'ll|'d| ?\p{{N}}+| ?(?:(?!{special}){signs})++"
        rf"|{gap}++(?={special})|{gap}+(?!\P{{IsWhite_Space}})|{gap}+"
    )


def _packed(*parts: np.ndarray | bytes) -> bytes:
    """First the number of entries, then the parts, compressed; the size in front."""
    raw = b"".join(part if isinstance(part, bytes) else part.tobytes() for part in parts)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def _shares(words: pa.StringArray, shares: int) -> np.ndarray:
    """Which share of the table of distinct words each word belongs to."""
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset :][: len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].astype(np.uint64)
    starts, lengths = (offsets[:-1] - offsets[0]).astype(np.int64), np.diff(offsets)
    place = np.arange(len(data)) - np.repeat(starts, lengths)
    power = np.cumprod(np.full(256, 0x9E3779B97F4A7C15, np.uint64))
    return (mixed(np.add.reduceat(data * power[place & 255], starts)) % np.uint64(shares)).astype(np.int64)


def _dictionary(words: pa.StringArray, shares: int) -> tuple[list[bytes | None], np.ndarray]:
    """Packed words of every share, and each word's position when shares follow one another."""
    share = _shares(words, shares)
    order = np.argsort(share, kind="stable")
    bounds = np.searchsorted(share[order], np.arange(shares + 1))
    arranged = words.take(pa.array(order))
    offsets = np.frombuffer(arranged.buffers()[1], np.int32)[: len(words) + 1]
    data = arranged.buffers()[2].to_pybytes() if len(words) else b""
    packed: list[bytes | None] = []
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        lengths = np.diff(offsets[low : high + 1]).astype(np.int32)
        part = data[offsets[low] : offsets[high]]
        packed.append(_packed(np.int32(high - low), lengths, part) if high > low else None)
    position = np.empty(len(words), np.int32)
    position[order] = np.arange(len(words), dtype=np.int32)
    return packed, position


def _words(packed: bytes) -> list[str]:
    raw = _unpacked(packed)
    (n,) = np.frombuffer(raw, np.int32, 1)
    ends = np.cumsum(np.frombuffer(raw, np.int32, n, 4)).tolist()
    text = raw[4 + 4 * int(n) :]
    return [text[a:b].decode("utf-8") for a, b in zip([0, *ends], ends, strict=False)]


def _narrow(values: np.ndarray) -> np.ndarray:
    """Whole numbers from zero on in the smallest type that holds them."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


def _packed_ids(ids: list[list[int]]) -> bytes:
    counts = _narrow(np.fromiter(map(len, ids), np.int64, len(ids)))
    flat = _narrow(np.fromiter((i for each in ids for i in each), np.int64, int(counts.sum(dtype=np.int64))))
    return _packed(np.array([len(ids), counts.itemsize, flat.itemsize], np.int32), counts, flat)


def _ids(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Number of ids of each word, and all ids."""
    raw = _unpacked(packed)
    n, count_size, id_size = np.frombuffer(raw, np.int32, 3).tolist()
    counts = np.frombuffer(raw, f"u{count_size}", n, 12)
    return counts.astype(np.int64), np.frombuffer(raw, f"u{id_size}", -1, 12 + n * count_size).astype(np.int32)


def _packed_codes(codes: np.ndarray) -> bytes:
    """The first bytes of all codes, then the second ones, and so on: each kind packs well."""
    return _packed(np.ascontiguousarray(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T))


def _codes(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(_unpacked(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _restored(blocks: pa.Table, shares: pa.Table) -> pa.Table:
    """Ids of every document of one block."""
    parts = [_ids(p) for p in shares.sort_by("share").column("ids").to_pylist()]
    lengths = np.concatenate([np.empty(0, np.int64), *(p[0] for p in parts)])
    values = np.concatenate([np.empty(0, np.int32), *(p[1] for p in parts)])
    starts = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
    block = {name: blocks.column(name)[0] for name in ("doc_ids", "n_words", "codes")}
    codes = _codes(block["codes"].as_py())
    sizes = lengths[codes]
    ends = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    # Where each id of the block stands among the ids of the distinct words.
    places = np.repeat(starts[:-1][codes] - ends[:-1], sizes)
    places += np.arange(ends[-1])
    words = np.concatenate(([0], np.cumsum(block["n_words"].values.to_numpy())))
    return pa.table(
        {
            "doc_id": block["doc_ids"].values,
            "ids": pa.ListArray.from_arrays(pa.array(ends[words], pa.int32()), pa.array(values[places])),
        }
    )


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array<int>) of every row."""
    spark = docs.sparkSession
    content = read_tokenizer(path)
    shared = spark.sparkContext.broadcast(content)
    shares = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            words = batch.column(1)
            coded = words.flatten().dictionary_encode()
            packed, position = _dictionary(coded.dictionary, shares)
            codes = position[coded.indices.to_numpy(zero_copy_only=False)]
            one = lambda values, kind: pa.ListArray.from_arrays(
                pa.array([0, len(values)], pa.int32()), values.cast(kind)
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([random.getrandbits(63)], pa.int64()),
                    one(batch.column(0), pa.int64()),
                    one(words.value_lengths(), pa.int64()),
                    pa.array([_packed_codes(codes)], pa.binary()),
                    pa.array([packed], pa.list_(pa.binary())),
                ],
                names=["block", "doc_ids", "n_words", "codes", "dictionary"],
            )

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = loaded(shared.value)
        known = {word: [number] for word, number in special_strings(shared.value).items()}
        for batch in batches:
            packed = []
            for data in batch.column(2).to_pylist():
                if len(known) > REMEMBERED:
                    known = {word: [n] for word, n in special_strings(shared.value).items()}
                ids = []
                for word in _words(data):
                    if word not in known:
                        known[word] = model_ids(tokenizer, word)
                    ids.append(known[word])
                packed.append(_packed_ids(ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(packed, pa.binary())],
                names=["at", "share", "ids"],
            )

    split = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.regexp_extract_all(
            F.coalesce(F.col(text_col), F.lit("")), F.lit(pre_token_pattern(content)), F.lit(0)
        ).alias("words"),
    )
    # Bucketed by block, so that only ids travel to the blocks and the blocks stay where they are.
    name, path = f"bpe_blocks_{random.getrandbits(63):x}", scratch_path(spark, "bpe-blocks")
    with arrow_rows(spark, BLOCK_DOCS), shuffles_removed(spark):
        split.mapInArrow(frugal(blocks_of), BLOCK).write.bucketBy(shares, "block").option(
            "path", path
        ).saveAsTable(name)
    blocks = spark.table(name)
    shares_of_words = (
        blocks.select("block", F.posexplode("dictionary").alias("share", "words"))
        .where("words is not null")
        .repartition("share")
        .mapInArrow(frugal(merged), "at bigint, share int, ids binary")
    )
    return (
        blocks.select("block", "doc_ids", "n_words", "codes")
        .groupBy("block")
        .cogroup(shares_of_words.groupBy("at"))
        .applyInArrow(frugal_pair(_restored), ENCODED)
    )


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, ids and decoded text of every row; ids that the vocabulary lacks give nothing."""
    content = read_tokenizer(path)
    pieces = encoded.sparkSession.sparkContext.broadcast(
        [piece or b"" for piece in piece_bytes(content)]
    )

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = pa.array(pieces.value, pa.binary())
        for whole in batches:
            for start in range(0, whole.num_rows, DECODED_DOCS):
                batch = whole.slice(start, DECODED_DOCS)
                ids = batch.column(1)
                flat = ids.flatten()
                inside = pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(piece)))
                each = pc.fill_null(piece.take(pc.if_else(inside, flat, None)), b"")
                sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy()
                ends = np.concatenate(([0], np.cumsum(sizes)))
                joined_pieces = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), each), b"")
                texts = [text.decode("utf-8", "replace") for text in joined_pieces.to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), ids, pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"]
                )

    return encoded.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids")
    ).mapInArrow(frugal(joined), "doc_id bigint, ids array<int>, decoded string")


def op2_bpe(spark, sf_dir) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    decoded = decode(encode(table(spark, sf_dir, "documents"), path), path)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
