"""Token counts by whole-token shortcut.

Offline, every vocabulary string is run through the merges alone; those that come back as the one
token they name are proven whole. A pre-token among them counts one without any merge; only the
rest is merged. Counting reads each text once, in one narrow pass without a shuffle.

Null and empty texts have no tokens. Special strings count one each wherever they stand in a raw
text, as the library does by default. Rows are independent, so repeated ids, null ids and extra
columns change nothing; the result has one row per input row.
"""

import unicodedata
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqlog.llm.common import table
from seqlog.llm.tokenizer_file import (
    letter_bytes,
    loaded,
    model_ids,
    read_tokenizer,
    special_pattern,
    spelled,
)

SUFFIX = "</w>"
#: Pre-tokens of the word vocabulary, as its file states them; white space is Unicode's property.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"
#: Words whose merges a worker remembers at a time; beyond it the memory starts afresh.
REMEMBERED = 500_000


def proven_whole(content: str) -> list[str]:
    """Pre-tokens that the merges alone turn into exactly one token, bounded by the vocabulary."""
    tokenizer, back = loaded(content), letter_bytes()
    pre_token = regex.compile(PRE_TOKENS)
    proven = []
    for piece, number in tokenizer.get_vocab(with_added_tokens=False).items():
        stem = piece.removesuffix(SUFFIX)
        if stem == piece or not all(c in back for c in stem):
            continue
        try:
            word = bytes(back[c] for c in stem).decode("utf-8")
        except UnicodeDecodeError:
            continue  # part of a character: never a pre-token
        if pre_token.fullmatch(word) and model_ids(tokenizer, word) == [number]:
            proven.append(word)
    return sorted(proven)


class Counter:
    """Tokens of texts; lives in a Python worker."""

    def __init__(self, content: str, whole: list[str]):
        self.tokenizer, self.whole = loaded(content), frozenset(whole)
        self.special = regex.compile(special_pattern(content))
        self.pre_tokens = regex.compile(PRE_TOKENS).findall
        self.accented = regex.compile("[^\x00-˿]").search
        self.merged: dict[str, int] = {}

    def normal(self, text: str) -> str:
        """Composed and lower case; the library itself does it where combining marks may occur."""
        if self.accented(text):
            return self.tokenizer.normalizer.normalize_str(text)
        return unicodedata.normalize("NFC", text).lower()

    def count(self, text: str) -> tuple[int, int]:
        """All tokens, and those that needed merges."""
        parts = self.special.split(text)
        total, by_merges = len(parts) - 1, 0
        for part in parts:
            words = self.pre_tokens(self.normal(part))
            rest = [w for w in words if w not in self.whole]
            total += len(words) - len(rest)
            if rest:
                tokens = sum(map(self.merges, rest))
                total += tokens
                by_merges += tokens
        return total, by_merges

    def merges(self, word: str) -> int:
        known = self.merged.get(word)
        if known is None:
            if len(self.merged) >= REMEMBERED:
                self.merged.clear()
            known = self.merged[word] = len(self.tokenizer.model.tokenize(spelled(word)))
        return known


def count_tokens(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and n_merged (tokens that needed merges) of every row."""
    content = read_tokenizer(path)
    shared = docs.sparkSession.sparkContext.broadcast((content, proven_whole(content)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(*shared.value)
        for batch in batches:
            texts = [text or "" for text in batch.column(1).to_pylist()]
            counts = [counter.count(text) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(text.encode("utf-8")) for text in texts], pa.int64()),
                    pa.array([c[0] for c in counts], pa.int64()),
                    pa.array([c[1] for c in counts], pa.int64()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "n_merged"],
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col)).mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long, n_merged long"
    )


#: Largest context that a document fits in whole.
LIMIT = 2048


def op9_token_counts(spark, sf_dir) -> DataFrame:
    counted = count_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > LIMIT)
