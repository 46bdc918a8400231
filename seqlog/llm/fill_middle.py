"""Fill-in-middle transformation over a wavelet matrix of character classes.

A text's units are its runs of ASCII letters and its other characters, one by one. Three classes tell
where units begin: other characters, first letters of a run, further letters. A wavelet matrix over
the classes answers how many characters of a class stand before a place (rank); other characters and
first letters together count the units begun there, and bisection on that count finds where the unit
of a cut begins. The texts of an Arrow batch share matrices of some two million characters; a text is
never split between two.

Documents are independent: one narrow pass, no shuffle, one result per row, repeated rows included. A
null text counts as empty and an empty one has no units and stays plain; a text that holds one of the
markers stays plain, so that `restored` is exact. The draws come from a hash of the id, so equal ids
draw alike; a null id draws as the empty string. Very long texts are cut like any other; a text must
fit in a task's memory, some 30 bytes a character. Only the id and the text are read, so no other
column's name can clash. Empty tables give empty results.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqlog.llm.common import frugal, table

# The markers before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Percent of the documents that are transformed, and of those, that begin with their suffix.
CHANGED, SUFFIX_FIRST = 90, 20
#: Character classes.
OTHER, FIRST, FURTHER = 0, 1, 2
#: Bytes of text that share a wavelet matrix.
SHARED_BYTES = 1 << 21
RESULT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


class Bits:
    """A bit vector with the number of ones before every place, counted per 64 bits."""

    def __init__(self, bits: np.ndarray):
        words = np.zeros(len(bits) // 64 + 1, np.uint64)
        packed = np.packbits(bits, bitorder="little")
        words.view(np.uint8)[: len(packed)] = packed
        self.words = words
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))

    def ones(self, places: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        block, inside = places >> 6, (places & 63).astype(np.uint64)
        low = self.words[block] & ((np.uint64(1) << inside) - np.uint64(1))
        return self.before[block] + np.bitwise_count(low)


class WaveletMatrix:
    """Ranks of small symbols: one bit vector per binary digit, the highest first.

    Each level sorts the symbols of the level before by their digit, zeros first, keeping their order.
    """

    def __init__(self, symbols: np.ndarray, digits: int):
        self.levels = []
        for digit in reversed(range(digits)):
            bits = (symbols >> digit & 1).astype(bool)
            self.levels.append((digit, Bits(bits), len(bits) - int(np.count_nonzero(bits))))
            symbols = np.concatenate((symbols[~bits], symbols[bits]))

    def rank(self, symbol: int, places: np.ndarray) -> np.ndarray:
        """How often `symbol` stands before each place."""
        first, last = np.zeros(1, np.int64), places
        for digit, bits, zeros in self.levels:
            if symbol >> digit & 1:
                first, last = zeros + bits.ones(first), zeros + bits.ones(last)
            else:
                first, last = first - bits.ones(first), last - bits.ones(last)
        return last - first


class Units:
    """The units of texts that are laid end to end, document by document."""

    def __init__(self, texts: list[str]):
        joined = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        self.ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        self.starts = np.concatenate(([0], self.ends[:-1])).astype(np.int64)
        lower = joined | 32
        letter = (lower >= ord("a")) & (lower <= ord("z"))
        follows = np.zeros(len(letter), bool)
        follows[1:] = letter[:-1]
        follows[self.starts[self.starts < len(letter)]] = False  # a run ends with its document
        self.matrix = WaveletMatrix(np.where(letter, np.where(follows, FURTHER, FIRST), OTHER).astype(np.uint8), 2)
        self.counts = self.begun(self.ends) - self.begun(self.starts)

    def begun(self, places: np.ndarray) -> np.ndarray:
        """Units that begin before each place."""
        return self.matrix.rank(OTHER, places) + self.matrix.rank(FIRST, places)

    def cuts(self, units: np.ndarray) -> np.ndarray:
        """Characters of each document's first `units` units, by bisection on the units begun."""
        wanted = self.begun(self.starts) + units
        low, high = self.starts.copy(), self.ends.copy()
        # The largest place before which no more than the wanted units begin.
        while (low < high).any():
            middle = (low + high + 1) // 2
            fits = self.begun(middle) <= wanted
            low, high = np.where(fits, middle, low), np.where(fits, high, middle - 1)
        return low - self.starts


def _groups(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with SHARED_BYTES of text together at most; a longer text stands alone."""
    start = held = 0
    for i, size in enumerate(pc.binary_length(batch.column("text")).to_pylist()):
        if held and held + (size or 0) > SHARED_BYTES:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size or 0
    if start < batch.num_rows:
        yield batch.slice(start)


def arranged(text: str, cut: int, end: int, suffix_first: bool) -> str:
    prefix, middle, suffix = text[:cut], text[cut:end], text[end:]
    if suffix_first:
        return f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def _transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in (part for batch in batches for part in _groups(batch)):
        texts = [text or "" for text in rows.column("text").to_pylist()]
        h1, h2, h3, h4 = (rows.column(f"h{k}").to_numpy() for k in (1, 2, 3, 4))
        units = Units(texts)
        first, second = h1 % (units.counts + 1), h2 % (units.counts + 1)
        cuts = units.cuts(np.minimum(first, second))
        ends = units.cuts(np.maximum(first, second))
        plain = np.array([not t or any(m in t for m in (PREFIX, SUFFIX, MIDDLE)) for t in texts], bool)
        plain |= h3 % 100 >= CHANGED
        spm = h4 % 100 < SUFFIX_FIRST
        output = [
            text if as_is else arranged(text, cut, end, suffix_first)
            for text, as_is, cut, end, suffix_first in zip(
                texts, plain.tolist(), cuts.tolist(), ends.tolist(), spm.tolist(), strict=True
            )
        ]
        yield pa.RecordBatch.from_arrays(
            [
                rows.column("doc_id"),
                pa.array(units.counts),
                pa.array(np.where(plain, "plain", np.where(spm, "spm", "psm")).tolist(), pa.string()),
                pa.array(cuts, mask=plain),
                pa.array(ends - cuts, mask=plain),
                pa.array(output, pa.string()),
            ],
            names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
        )


def draws(seed: int, id_col: Column) -> list[Column]:
    """h1 to h4: the first 8-digit groups of a hash of seed and id, as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return [
        F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)
    ]


def fill_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1) -> DataFrame:
    """doc_id, n (units), form (plain, psm or spm), prefix_chars, middle_chars and the output text."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        *draws(seed, F.col(id_col)),
    )
    return rows.mapInArrow(frugal(_transform), RESULT)


def restored(output: Column, form: Column) -> Column:
    """The text that an output of a known form was made of.

    An output that is not plain holds each marker once: the text had none, and a marker cannot arise
    where a part meets a marker, as it begins and ends with characters that it holds once only.
    """
    parts = F.split(output, "<[PSM]>", -1)
    first = F.when(form == "spm", parts[2]).otherwise(parts[1])
    last = F.when(form == "spm", parts[1]).otherwise(parts[2])
    return F.when(form == "plain", output).otherwise(F.concat(first, parts[3], last))


def op11_fill_middle(spark, sf_dir) -> DataFrame:
    made = fill_middle(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


OP11_SQL = """
WITH draws AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u
  FROM documents),
numbers AS (
  SELECT doc_id, text, u, len(u) AS n,
         ('0x' || substr(h, 1, 8))::BIGINT % (len(u) + 1) AS a, ('0x' || substr(h, 9, 8))::BIGINT % (len(u) + 1) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
              WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM draws),
parts AS (
  SELECT doc_id, text, n, form, array_to_string(u[1:least(a, b)], '') AS prefix,
         array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS middle,
         array_to_string(u[greatest(a, b) + 1:], '') AS suffix
  FROM numbers)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
