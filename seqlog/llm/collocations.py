"""Phrase collocations by stripes: each prefix keys a counter of the words that follow it.

Texts are lower-cased (A-Z), cut at punctuation and line ends into pieces, and pieces into words. A
phrase is `size` consecutive words of a piece; its count takes every occurrence, overlaps included.

Words are gathered in blocks of one language, a few MB each, and written once as numbers. Then, for
sizes 1 to `longest`, every block yields stripes: per prefix (a phrase of one word less) the counts of
what extends it, and of occurrences that nothing frequent extends. An extension is named by its suffix,
the phrase without its first word, which holds the next word and is frequent itself if the whole is:
so only frequent phrases are ever extended, and none that reaches `least` is missed. Spark brings the
stripes of a prefix together, where they are added element by element. One merged stripe tells

- its extensions that reach `least`, each with a new id; blocks that sent one get it back, and look
  for phrases one word longer there;
- the prefix's total, which is the count of the prefix (for the empty prefix: all words);
- the largest extension, against which the prefix is held for subsumption.

Ids stand for words throughout, so nothing is decided by a hash. A frequent prefix's stripe is cut by
suffix into shards of about `Sizes.shard` occurrences. Stripes are dealt into buckets by prefix and shard, that
of no words into buckets by word; what a block has for a bucket travels as one row of packed numbers, so
the rows do not grow with the number of prefixes, and buckets are merged as they stream in. No task holds a
prefix's whole counter. However often a phrase occurs in a block, the block sends one element for it, so a merge holds
some 30 bytes per block for the commonest phrase (with blocks of 8 MB that is 0.4 GB at 100 TB; larger
blocks make it less).

A score needs the counts of a phrase's beginnings (the totals of its prefixes) and of its ends (the
counts of its suffixes); both lists are one element longer than those of the prefix and the suffix.
Scores are whole numbers, exact as decimals of 38 digits (counts up to some 10^11 occurrences).

Null and empty texts have no words. A null language is read as `und`; any other string, the empty one
too, is a language. Ids are not read: repeated rows count as often as they stand. Very long texts go
whole into one block; a text must fit in a task's memory. Ties of a rank go by count, then by phrase in
order of UTF-8 bytes. Only the text and the language are read, so no other column's name can clash. An
empty table gives an empty result, as do languages without a phrase that reaches `least`.
"""

import random
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import count
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqlog.llm.common import arrow_rows, drop_written, frugal, frugal_pair, mixed, table, written
from seqlog.llm.packing import all_unpacked, arrow_schema, packed, unpacked, whole_buckets

LONGEST, LEAST, BEST = 5, 100, 2_000
#: The language of texts that name none.
UNKNOWN = "und"
NOTHING = -1


class Sizes(NamedTuple):
    """How the work is cut; the result does not depend on it."""

    #: Characters of a block's texts, and of all blocks that a task fills at a time.
    block: int = 8 << 20
    held: int = 16 << 20
    #: Occurrences of a prefix that share a shard of its stripe, and of all words that share a bucket.
    shard: int = 1 << 18
    #: Stripe elements that a task merges at once, beyond those of the last bucket.
    merged: int = 1 << 20
    #: Candidates that are ranked in one task before the best of all tasks meet.
    ranked: int = 1 << 20


ENDS = b".,;:!?\n\x0b\x0c\r"
#: Upper case to lower case, ends of pieces to full stops.
LETTERS = bytes(ord(".") if c in ENDS else c + 32 if 65 <= c <= 90 else c for c in range(256))

BLOCKS = "block bigint, lang string, words bigint, n bigint, codes binary, dictionary array<string>, counts binary"
#: What a block has of the empty prefix for one bucket: words, their counts and their places in its dictionary.
WORDS = "block bigint, bucket bigint, n bigint, lang string, words array<string>, counts binary, at binary"
#: State of a block (codes), or its stripes for one bucket: `sizes` suffixes for each of the prefixes.
STRIPES = (
    "block bigint, n bigint, codes binary, bucket bigint, start bigint, stripes bigint, "
    "prefixes binary, sizes binary, suffixes binary, counts binary"
)
#: A merged stripe (total, most), its frequent extensions (id, times), and what goes back to a block.
MERGES = (
    "kind string, prefix bigint, suffix bigint, lang string, word string, id bigint, times bigint, "
    "total bigint, most bigint, block bigint, n bigint, at binary, ids binary, shards binary"
)


def words_of(text: str) -> list[bytes]:
    """Words of a text in order, with a full stop at each end of a piece."""
    return text.encode("utf-8").translate(LETTERS).replace(b".", b" . ").split()


def without_gaps(codes: np.ndarray) -> np.ndarray:
    """Each run of NOTHING as a single one, none at the ends."""
    gone = codes == NOTHING
    keep = ~gone
    keep[1:] |= gone[1:] & ~gone[:-1]
    codes = codes[keep]
    return codes[1:] if len(codes) and codes[0] == NOTHING else codes


def _block(lang: str, texts: list[str]) -> pa.RecordBatch:
    known: defaultdict[bytes, int] = defaultdict(count().__next__)
    place, codes = known.__getitem__, []
    place(b".")
    for text in texts:
        codes.extend(map(place, words_of(text)))
        codes.append(0)
    numbers = without_gaps(np.array(codes, np.int32) - 1)
    counts = np.bincount(numbers[numbers >= 0], minlength=len(known) - 1)
    row = {
        "block": random.getrandbits(63), "lang": lang, "words": int(counts.sum()), "n": len(numbers),
        "codes": packed(numbers), "dictionary": [word.decode("utf-8") for word in list(known)[1:]],
        "counts": packed(counts.astype(np.int64)),
    }
    return pa.RecordBatch.from_pylist([row], arrow_schema(BLOCKS))


def _blocks(sizes: Sizes):
    """Blocks of one language each; where many languages are open, the fullest is closed first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: defaultdict[str, list[str]] = defaultdict(list)
        held: defaultdict[str, int] = defaultdict(int)
        of_all = 0
        for batch in batches:
            for lang, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                texts[lang].append(text)
                held[lang] += len(text)
                of_all += len(text)
                if held[lang] < sizes.block:
                    if of_all < sizes.held:
                        continue
                    lang = max(held, key=held.get)
                of_all -= held.pop(lang)
                yield _block(lang, texts.pop(lang))
        for lang in list(texts):
            yield _block(lang, texts.pop(lang))

    return run


def extensions(
    cur: np.ndarray, ids: np.ndarray, shards: np.ndarray, buckets: int
) -> tuple[np.ndarray, Iterator[dict]]:
    """A block's phrases one word longer, and its stripes by bucket.

    `cur` has each position's phrase as a place in `ids` and `shards` (those of its stripe), or NOTHING.
    Phrases one word longer are numbered by bucket, prefix and suffix, so the elements of a bucket's row
    are numbered from `start` on. Occurrences without a frequent neighbour count under the suffix NOTHING.
    """
    at = np.nonzero(cur >= 0)[0]
    if not len(at):
        return np.empty(0, np.int32), iter(())
    follows = np.full(len(cur), NOTHING, cur.dtype)
    follows[:-1] = cur[1:]
    width = len(ids) + 1
    pairs, number, counts = np.unique(
        cur[at].astype(np.int64) * width + follows[at] + 1, return_inverse=True, return_counts=True
    )
    prefix, suffix = pairs // width, pairs % width - 1
    suffix_id = np.where(suffix >= 0, ids[suffix], NOTHING)
    shard = np.where(suffix >= 0, mixed(suffix_id.view(np.uint64)) % shards[prefix].astype(np.uint64), 0)
    bucket = (mixed(ids[prefix].view(np.uint64) + shard.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((suffix_id, ids[prefix], bucket))
    numbers = np.empty(len(order), np.int32)
    numbers[order] = np.arange(len(order), dtype=np.int32)
    longer = np.full(len(cur), NOTHING, np.int32)
    longer[at] = np.where(suffix[number] >= 0, numbers[number], NOTHING)
    bucket, prefix_id, suffix_id, counts = bucket[order], ids[prefix][order], suffix_id[order], counts[order]

    def rows() -> Iterator[dict]:
        edges = [0, *(np.nonzero(np.diff(bucket))[0] + 1).tolist(), len(bucket)]
        for start, end in zip(edges, edges[1:], strict=False):
            prefixes, sizes = np.unique(prefix_id[start:end], return_counts=True)
            yield {
                "n": end - start, "bucket": int(bucket[start]), "start": start, "stripes": len(prefixes),
                "prefixes": packed(prefixes), "sizes": packed(sizes.astype(np.int32)),
                "suffixes": packed(suffix_id[start:end]), "counts": packed(counts[start:end].astype(np.int32)),
            }

    return without_gaps(longer), rows()


def _stripes(block: pa.Table, found: pa.Table, buckets: int, last: bool) -> pa.Table:
    """A block's stripes of the next size, from its state and the ids of its frequent phrases."""
    rows = []
    if block.num_rows and found.num_rows:
        codes = unpacked(block.column("codes")[0].as_py(), block.column("n")[0].as_py(), np.int32)
        sizes = found.column("n").to_pylist()
        at = all_unpacked(found.column("at"), sizes, np.int32)
        ids = all_unpacked(found.column("ids"), sizes, np.int64)
        shards = all_unpacked(found.column("shards"), sizes, np.int32)
        # The frequent phrases alone, numbered anew.
        places = np.full(max(int(codes.max(initial=0)), int(at.max())) + 1, NOTHING, np.int32)
        places[at] = np.arange(len(at), dtype=np.int32)
        longer, stripes = extensions(without_gaps(np.where(codes >= 0, places[codes], NOTHING)), ids, shards, buckets)
        rows = list(stripes)
        if not last and len(longer):
            rows.append({"n": len(longer), "codes": packed(longer)})
        number = block.column("block")[0].as_py()
        rows = [row | {"block": number} for row in rows]
    return pa.Table.from_pylist(rows, arrow_schema(STRIPES))


def _word_stripes(buckets: int):
    """The stripe of the empty prefix in a block's language, by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, lang, words, n, *_, dictionary, counts in (
            row.values() for batch in batches for row in batch.to_pylist()
        ):
            bucket = np.fromiter((crc32(w.encode("utf-8")) % buckets for w in dictionary), np.int64, len(dictionary))
            order = np.argsort(bucket, kind="stable").astype(np.int32)
            counts = unpacked(counts, len(dictionary), np.int64)
            edges = np.nonzero(np.diff(bucket[order]))[0] + 1
            rows = [
                {
                    "block": block, "bucket": int(bucket[at[0]]), "n": len(at), "lang": lang,
                    "words": [dictionary[i] for i in at.tolist()], "counts": packed(counts[at]), "at": packed(at),
                }
                for at in np.split(order, edges) if len(at)
            ]
            yield pa.RecordBatch.from_pylist(rows, arrow_schema(WORDS))

    return run


class Elements:
    """Elements of many blocks' stripes: prefix and suffix as places among the distinct ones, and counts."""

    def __init__(self, rows: pa.Table, words: bool):
        sizes = rows.column("n").to_pylist()
        self.blocks, self.row = rows.column("block").to_numpy(), np.repeat(np.arange(len(sizes)), sizes)
        if words:
            self.counts = all_unpacked(rows.column("counts"), sizes, np.int64)
            self.at = all_unpacked(rows.column("at"), sizes, np.int32)
            of_row, self.prefixes = _numbered(rows.column("lang").combine_chunks())
            self.prefix = of_row[self.row]
            self.suffix, self.suffixes = _numbered(rows.column("words").combine_chunks().flatten())
            self.other = np.zeros(len(self.suffixes), bool)
        else:
            self.counts = all_unpacked(rows.column("counts"), sizes, np.int32).astype(np.int64)
            begins = np.cumsum(sizes) - sizes
            start = rows.column("start").to_numpy()
            self.at = (np.arange(len(self.row)) + (start - begins)[self.row]).astype(np.int32)
            stripes = rows.column("stripes").to_pylist()
            lengths = all_unpacked(rows.column("sizes"), stripes, np.int32)
            of_stripe, self.prefixes = _numbered(pa.array(all_unpacked(rows.column("prefixes"), stripes, np.int64)))
            self.prefix = np.repeat(of_stripe, lengths)
            self.suffix, self.suffixes = _numbered(pa.array(all_unpacked(rows.column("suffixes"), sizes, np.int64)))
            self.other = self.suffixes.to_numpy() == NOTHING


def _numbered(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    coded = values.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def _merged(rows: pa.Table, least: int, next_id: int, words: bool, deliver: bool, shard: int) -> pa.Table:
    """Stripes added up: totals, frequent extensions, and what the blocks get back."""
    found = Elements(rows, words)
    keys, key_of = np.unique(found.prefix * len(found.suffixes) + found.suffix, return_inverse=True)
    sums = np.zeros(len(keys), np.int64)
    np.add.at(sums, key_of, found.counts)
    prefix, suffix = keys // len(found.suffixes), keys % len(found.suffixes)
    named = ~found.other[suffix]
    total, most = np.zeros(len(found.prefixes), np.int64), np.zeros(len(found.prefixes), np.int64)
    np.add.at(total, prefix, sums)
    np.maximum.at(most, prefix, np.where(named, sums, 0))
    frequent = np.nonzero((sums >= least) & named)[0]
    ids = np.full(len(keys), NOTHING, np.int64)
    ids[frequent] = next_id + np.arange(len(frequent))
    of_prefix, of_suffix = ("lang", "word") if words else ("prefix", "suffix")
    tables = [
        pa.table(
            {"kind": pa.array(["stripe"] * len(total)), of_prefix: found.prefixes, "total": total, "most": most}
        ),
        pa.table(
            {
                "kind": pa.array(["phrase"] * len(frequent), pa.string()),
                of_prefix: found.prefixes.take(pa.array(prefix[frequent])),
                of_suffix: found.suffixes.take(pa.array(suffix[frequent])),
                "id": ids[frequent],
                "times": sums[frequent],
            }
        ),
    ]
    if deliver:
        mine = np.nonzero(ids[key_of] >= 0)[0]
        mine = mine[np.argsort(found.blocks[found.row[mine]], kind="stable")]
        block, key = found.blocks[found.row[mine]], key_of[mine]
        shards = (-(-sums // shard)).astype(np.int32)
        deliveries = []
        for part in np.split(np.arange(len(mine)), np.nonzero(np.diff(block))[0] + 1):
            if len(part):
                deliveries.append(
                    {
                        "kind": "delivery", "block": int(block[part[0]]), "n": len(part),
                        "at": packed(found.at[mine[part]]), "ids": packed(ids[key[part]]),
                        "shards": packed(shards[key[part]]),
                    }
                )
        tables.append(pa.Table.from_pylist(deliveries, arrow_schema(MERGES)))
    return pa.concat_tables(tables, promote_options="default")


def _merge(least: int, words: bool, deliver: bool, sizes: Sizes):
    schema = arrow_schema(MERGES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_id = TaskContext.get().partitionId() << 40
        for rows in whole_buckets(batches, sizes.merged):
            merged = _merged(rows, least, next_id, words, deliver, sizes.shard)
            next_id += merged.num_rows - merged.column("id").null_count
            columns = [
                merged.column(f.name).cast(f.type) if f.name in merged.column_names
                else pa.nulls(merged.num_rows, f.type)
                for f in schema
            ]
            yield from pa.table(columns, schema=schema).to_batches(max_chunksize=4_096)

    return run


def _levels(docs: DataFrame, text: Column, lang: Column, longest: int, least: int, sizes: Sizes):
    """Written merges per size, and the paths of everything written."""
    spark, paths = docs.sparkSession, []

    def keep(df: DataFrame, label: str) -> DataFrame:
        read, path = written(df, label)
        paths.append(path)
        return read

    def merge(stripes: DataFrame, words: bool, deliver: bool, label: str) -> DataFrame:
        dealt = stripes.repartition("bucket").sortWithinPartitions("bucket")
        with arrow_rows(spark, 500):
            return keep(dealt.mapInArrow(frugal(_merge(least, words, deliver, sizes)), MERGES), label)

    rows = docs.select(F.coalesce(lang.cast("string"), F.lit(UNKNOWN)).alias("lang"), text.cast("string").alias("text"))
    blocks, blocks_path = written(rows.where("text <> ''").mapInArrow(frugal(_blocks(sizes)), BLOCKS), "word-blocks")
    total = blocks.agg(F.sum("words")).first()[0] or 0
    buckets = -(-total // sizes.shard) or 1
    with arrow_rows(spark, 1):
        stripes, stripes_path = written(blocks.mapInArrow(frugal(_word_stripes(buckets)), WORDS), "word-stripes")
    merges = [merge(stripes, True, longest > 1, "words")]
    drop_written(spark, stripes_path)
    states, states_path = blocks.select("block", "n", "codes"), blocks_path
    for size in range(2, longest + 1):
        deliveries = merges[-1].where("kind = 'delivery'").select(F.col("block").alias("to"), "n", "at", "ids", "shards")

        def join(block: pa.Table, found: pa.Table, last: bool = size == longest) -> pa.Table:
            return _stripes(block, found, buckets, last)

        both, both_path = written(
            states.groupBy("block").cogroup(deliveries.groupBy("to")).applyInArrow(frugal_pair(join), STRIPES),
            f"stripes-{size}",
        )
        drop_written(spark, states_path)
        merges.append(merge(both.where("bucket IS NOT NULL").drop("codes"), False, size < longest, f"phrases-{size}"))
        states, states_path = both.where("codes IS NOT NULL").select("block", "n", "codes"), both_path
    drop_written(spark, states_path)
    return merges, paths


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST,
    least: int = LEAST, best: int | None = BEST, sizes: Sizes = Sizes(),
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's `best` collocations (None: all).

    A phrase of 2 to `longest` words that occurs `a` >= `least` times is a candidate. Cut after its
    first k words it scores floor(1000 a n / (l r)), where l and r are the counts of the two parts and n
    that of all words; the lowest cut stands, of equals the first. Candidates with a longer one around
    them that occurs as often are dropped.
    """
    if longest < 2 or least < 1:
        raise ValueError("a collocation has two words at least, and occurs")
    merges, paths = _levels(docs, F.col(text_col), F.col(lang_col), longest, least, sizes)
    totals = merges[0].where("kind = 'stripe'").groupBy("lang").agg(F.sum("total").alias("n"))
    phrases = merges[0].where("kind = 'phrase'").select(
        "id", "lang", F.array("word").alias("words"), "times", F.expr("array()").cast("array<bigint>").alias("ls"),
        F.expr("array()").cast("array<bigint>").alias("rs"),
    )
    candidates = []
    for merge in merges[1:]:
        found = merge.where("kind = 'phrase'").select("id", "prefix", "suffix", "times")
        stripes = (
            merge.where("kind = 'stripe'").groupBy("prefix").agg(F.sum("total").alias("total"), F.max("most").alias("most"))
        )
        # What surrounds the phrases of the size before: extensions to the right, and to the left.
        left = found.groupBy("suffix").agg(F.max("times").alias("leftmost"))
        if candidates:
            candidates[-1] = (
                candidates[-1].join(stripes.select(F.col("prefix").alias("id"), "most"), "id", "left")
                .join(left.withColumnRenamed("suffix", "id"), "id", "left")
                .where("coalesce(greatest(most, leftmost), 0) < times")
                .drop("most", "leftmost")
            )
        before = phrases.select(F.col("id").alias("prefix"), "lang", "words", "ls").join(
            stripes.select("prefix", "total"), "prefix"
        )
        after = phrases.select(
            F.col("id").alias("suffix"), F.col("times").alias("rest"), F.col("rs").alias("rests"),
            F.element_at("words", -1).alias("word"),
        )
        grown = found.join(before, "prefix").join(after, "suffix").select(
            "id",
            "lang",
            F.concat("words", F.array("word")).alias("words"),
            "times",
            F.concat("ls", F.array("total")).alias("ls"),
            F.concat(F.array("rest"), F.col("rests")).alias("rs"),
        )
        phrases, path = written(grown, "phrases")
        paths.append(path)
        candidates.append(phrases)
    # Every cut is floored before they are compared, as equal floors go to the first cut.
    exact = lambda c: c.cast("decimal(38,0)")
    cuts = F.transform(
        F.arrays_zip("ls", "rs"),
        lambda cut, k: F.struct(
            F.call_function("div", exact(F.col("times")) * F.col("n") * 1000, exact(cut["ls"]) * cut["rs"]).alias("score"),
            k.alias("k"), cut["ls"].alias("l"), cut["rs"].alias("r"),
        ),
    )
    scored = (
        reduce(DataFrame.unionByName, candidates)
        .join(F.broadcast(totals) if totals.limit(100_001).count() <= 100_000 else totals, "lang")
        .withColumn("cut", F.array_min(cuts))
        .select(
            "lang", F.array_join("words", " ").alias("phrase"), F.col("times").alias("a"), "cut.l", "cut.r", "n",
            "cut.score",
        )
    )
    scored, _ = written(scored, "collocations")
    drop_written(docs.sparkSession, *paths)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    if best is not None:
        # The best of hashed shares first, so that a language with most phrases is cut among tasks.
        shares = -(-scored.count() // sizes.ranked) or 1
        share = F.pmod(F.xxhash64("phrase"), F.lit(shares))
        few = Window.partitionBy("lang", share).orderBy(*order)
        scored = scored.withColumn("_of_share", F.row_number().over(few)).where(F.col("_of_share") <= best)
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    if best is not None:
        ranked = ranked.where(F.col("rank") <= best)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark, sf_dir) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP13_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, [x FOR x IN regexp_split_to_array(piece, '[\\x20\\x09]+') IF x <> ''] AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM words GROUP BY lang),
runs AS (
  SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
  FROM words, range(1, 6) AS sizes(k) WHERE len(w) >= k),
counted AS (SELECT lang, k, phrase, count(*) AS a FROM runs GROUP BY ALL HAVING count(*) >= 100),
grams AS (SELECT *, string_split(phrase, ' ') AS w FROM counted),
cuts AS (SELECT lang, k, phrase, a, w, unnest(range(1, k)) AS c FROM grams WHERE k >= 2),
scored AS (
  SELECT x.lang, x.k, x.phrase, x.a, x.c, p.a AS l, q.a AS r, n, 1000 * x.a::HUGEINT * n // (p.a::HUGEINT * q.a) AS score
  FROM cuts x JOIN totals USING (lang)
  JOIN counted p ON p.lang = x.lang AND p.phrase = array_to_string(x.w[1:x.c], ' ')
  JOIN counted q ON q.lang = x.lang AND q.phrase = array_to_string(x.w[x.c + 1:], ' ')
  QUALIFY row_number() OVER (PARTITION BY x.lang, x.phrase ORDER BY score, x.c) = 1),
around AS (
  SELECT lang, unnest([array_to_string(w[1:k - 1], ' '), array_to_string(w[2:], ' ')]) AS phrase, a FROM grams WHERE k >= 3),
longer AS (SELECT lang, phrase, max(a) AS most FROM around GROUP BY ALL),
kept AS (SELECT s.* FROM scored s LEFT JOIN longer USING (lang, phrase) WHERE coalesce(most, 0) < s.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""
