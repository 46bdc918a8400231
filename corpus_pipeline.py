"""From raw documents to token ids: five stages, each written and read again as the next one's input."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqlog.llm import toxicity
from seqlog.llm.bpe import decode, encode
from seqlog.llm.common import table
from seqlog.llm.mixing import mix
from seqlog.llm.near_dedup import near_duplicates
from seqlog.llm.substrings import remove_repeats
from seqlog.plans.staging import scratch_path

TOKENIZER = "byte_bpe_50k.json"
#: Near copies share at least so many percent of their runs of so many words.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the clause grammar, fitted to the labels, does not call toxic, with all their columns."""
    grammar = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    # A document's own columns stand apart from those of the score.
    apart = docs.select(F.col("text").alias("_text"), F.struct("*").alias("_doc"))
    return toxicity.score(apart, grammar, "_text").where("predicted = 0").select("_doc.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of every group of near copies; documents without id stay."""
    kept = near_duplicates(docs, NEAR_WORDS, percent=NEAR_PERCENT).where("kept")
    kept = kept.select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["_kept"]), "left_semi")


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a smaller id holds too; the other texts as they were.

    From here on documents have the columns of the documents table alone.
    """
    carried = docs.withColumn("_carried", F.to_json(F.struct("lang", "source")))
    cleaned = remove_repeats(carried, carry="_carried", untouched=True)
    fields = F.from_json("carried", "lang string, source string")
    return cleaned.select(
        "doc_id",
        F.col("kept").alias("text"),
        fields["lang"].alias("lang"),
        fields["source"].alias("source"),
        F.length("kept").cast("long").alias("n_chars"),
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the flattened source weights, in random order."""
    return mix(docs).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the text that they decode to."""
    path = public_tokenizers.path(TOKENIZER)
    decoded = decode(encode(docs, path), path)
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("mixing", mix_sources),
    ("bpe", tokenize),
]

#: A grammar fitted to labels and byte-pair merges are beyond SQL; tests/llm has brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        result = stage(spark, docs, sf_dir)
        result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
    return docs
