"""Toxicity by a weighted finite-state grammar over clauses.

A first transducer turns words into the grammar's symbols: insult, threat, target, negation, reported
speech, or anything else. Which words are insults, and how strongly, is learned from labelled rows: whole
words and word beginnings whose odds of standing in a toxic row are high beyond doubt. A second one
reads a clause from left to right; its states are what it has met so far. Insults and threats carry their
learned weight, raised when a target is near, lowered within a negation's reach and in reported speech. A
clause's value is the best path's weight, a document's is the sum over its clauses with falling shares,
so one plain insult decides and repetition adds little. A logistic curve fitted to the same labelled
rows turns it into a score.

Fitting reads at most `max_toxic` and `max_clean` labelled rows outside the held-out fold, chosen by a
hash of their id; word counts run in Spark, and what comes to the driver is the lexicon (at most
`max_entries` entries) and one number per fitted row. Scoring is one narrow pass over all texts.

Null and empty texts get the base score. Labels that are null are no labels; a document with several labels
is toxic if any says so. Without labelled rows of both kinds the lexicon is empty and every score is
the same. Repeated ids and extra columns change nothing; one result row per input row.
"""

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqlog.llm.common import frugal, give_back, run_hashes, table, word_hashes

#: Words of the grammar besides the learned insults, in four languages (fixed values of this grammar).
TARGETS = frozenset("you your yours u du dich dir dein deine ihr tu te toi ton ta vous votre usted tú ti tus eres".split())
NEGATIONS = frozenset("not no never neither isn't aren't wasn't don't nicht kein keine nie pas jamais ni nunca jamás".split())
REPORTING = frozenset("said says say called reported quote quoted wrote claims sagte schrieb zitiert dit écrit cité dijo escribió citó".split())
THREATS = frozenset("kill hurt destroy beat crush töten schlagen tuer frapper matar golpear".split())
#: Words after a negation that it reaches, and words around a target that it marks.
REACH = 3
#: What context does to a weight.
NEGATED, REPORTED, TARGETED = 0.7, 0.85, 1.25
THREAT_WEIGHT = 0.5
#: Least likelihood ratio (twice the log) of a learned entry.
SURE = 32.0
#: Letters of a word's beginning that may become an entry.
STEMS = range(4, 9)
#: Texts whose entries are held at a time.
ENTRY_DOCS = 250
CLAUSE_END = re.compile(r"[.!?;:,\n]+")
WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)


@dataclass(frozen=True)
class Grammar:
    """Learned weights of words and of beginnings, and the curve from clause value to score."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    slope: float = 0.0
    intercept: float = -2.0

    def score(self, value: float) -> float:
        return 1.0 / (1.0 + math.exp(-max(-40.0, min(40.0, self.intercept + self.slope * value))))


class Lexicon(dict):
    """Word transducer: symbol and weight of a lower-case word, worked out once per word."""

    def __init__(self, grammar: Grammar, size: int = 100_000):
        super().__init__()
        self.grammar, self.size = grammar, size

    def __missing__(self, word: str) -> tuple[int, float]:
        weight = self.grammar.words.get(word, 0.0)
        for length in STEMS:
            if length > len(word):
                break
            weight = max(weight, self.grammar.stems.get(word[:length], 0.0))
        if weight > 0:
            found = (INSULT, weight)
        elif word in THREATS:
            found = (THREAT, THREAT_WEIGHT)
        elif word in TARGETS:
            found = (TARGET, 0.0)
        elif word in NEGATIONS:
            found = (NEGATION, 0.0)
        elif word in REPORTING:
            found = (REPORT, 0.0)
        else:
            found = (OTHER, 0.0)
        if len(self) >= self.size:
            self.clear()
        self[word] = found
        return found


def clause_value(symbols: list[tuple[int, float]]) -> float:
    """Best weight that the clause transducer emits on its way through one clause.

    A state is (words left in a negation's reach, reported, words left around a target, a weight
    still waiting for a target); threats need a target, insults do not.
    """
    reach = near = 0
    reported = False
    best = waiting = 0.0
    for symbol, weight in symbols:
        if symbol == NEGATION:
            reach = REACH + 1
        elif symbol == REPORT:
            reported = True
        elif symbol == TARGET:
            near = REACH + 1
            best, waiting = max(best, waiting * TARGETED), 0.0
        elif symbol != OTHER:
            value = weight * (NEGATED if reach else 1.0) * (REPORTED if reported else 1.0)
            if near:
                value *= TARGETED
            else:
                waiting = max(waiting, value)
            if symbol == INSULT or near:
                best = max(best, value)
        reach, near = max(0, reach - 1), max(0, near - 1)
    return best


def text_value(text: str, lexicon: Lexicon) -> float:
    """Sum of the clause values, largest first, each counting half of the one before."""
    values = []
    for clause in CLAUSE_END.split(text.lower()):
        symbols = [lexicon[word] for word in WORD.findall(clause)]
        if any(s in (INSULT, THREAT) for s, _ in symbols):
            values.append(clause_value(symbols))
    return sum(math.ldexp(v, -i) for i, v in enumerate(sorted(values, reverse=True)))


def _entries_of(text: str) -> tuple[int, list[str]]:
    """Smallest hash of three consecutive words, and the distinct words and (with a star) beginnings."""
    words = WORD.findall(text.lower())
    if not words:
        return 0, []
    hashes = word_hashes([w.encode() for w in words])
    runs = run_hashes(hashes, min(3, len(words)))
    distinct = set(words)
    stems = {f"{w[:n]}*" for w in distinct for n in STEMS if n <= len(w)}
    return int(runs.min() >> np.uint64(1)), sorted(distinct | stems)


def _with_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # Entries take far more room than the texts: a few texts at a time.
    for batch in (b.slice(at, ENTRY_DOCS) for b in batches for at in range(0, b.num_rows, ENTRY_DOCS)):
        found = [_entries_of(text) for text in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array([run for run, _ in found], pa.int64()),
                pa.array([entries for _, entries in found], pa.list_(pa.string())),
            ],
            names=["toxic", "text", "run", "entries"],
        )


def _lexicon(sample: DataFrame, toxic: int, clean: int, max_entries: int) -> list[tuple[str, float]]:
    """(entry, weight): log odds of entries that chance does not explain.

    The likelihood ratio G must pass `SURE`, which millions of candidates leave to chance less
    than once, and most rows that hold the entry must be toxic.
    """
    counts = (
        sample.select("toxic", F.explode("entries").alias("entry"))
        .groupBy("entry")
        .agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    )
    odds = F.log((F.col("t") + 0.5) / (toxic + 1.0)) - F.log((F.col("c") + 0.5) / (clean + 1.0))
    t, c, share = F.col("t"), F.col("c"), toxic / (toxic + clean)
    part = lambda n, of: F.when(n > 0, n * F.log(n / ((t + c) * of))).otherwise(0.0)
    sure = (
        counts.where("t > 2 * c AND t >= 3")
        .where(2 * (part(t, share) + part(c, 1 - share)) > SURE)
        .withColumn("odds", odds)
        .orderBy(F.desc("odds"), F.desc("t"), "entry")
        .limit(max_entries)
    )
    return [(r.entry, min(r.odds, 8.0)) for r in sure.collect()]


def _curve(values: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve: Newton's method with halved steps.

    A prior on the slope keeps it finite where a value separates the kinds without error.
    """
    x = np.column_stack([values, np.ones(len(values))])
    pull = np.array([1.0, 1e-3])

    def loss(beta):
        z = x @ beta
        return np.sum(np.logaddexp(0, z) - toxic * z) + 0.5 * np.sum(pull * beta**2)

    beta = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (toxic - p) - pull * beta
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pull), gradient)
        while loss(beta + step) > loss(beta) and np.abs(step).max() > 1e-9:
            step = step / 2
        beta = beta + step
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def held_out(id_col: str = "doc_id"):
    """The fold that no label is learned from."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def fit(
    docs: DataFrame, labels: DataFrame, max_toxic: int = 3_000, max_clean: int = 9_000,
    max_entries: int = 2_000, id_col: str = "doc_id", text_col: str = "text",
) -> Grammar:
    marked = (
        labels.where("toxic IS NOT NULL")
        .select(F.col(id_col).alias("_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("_id").isNotNull() & ~held_out("_id"))
        .groupBy("_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    chosen = marked.where("toxic = 1").orderBy(F.xxhash64("_id"), "_id").limit(max_toxic).union(
        marked.where("toxic = 0").orderBy(F.xxhash64("_id"), "_id").limit(max_clean)
    )
    # At most max_toxic + max_clean rows of two numbers: a proven bound.
    sample = docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("text")).join(
        F.broadcast(chosen), "_id"
    )
    # One row of those whose smallest hash of three words agrees: copies of one text would otherwise
    # make all its words look toxic or clean.
    sample = (
        sample.select("toxic", "text")
        .mapInArrow(frugal(_with_entries), "toxic int, text string, run long, entries array<string>")
        .dropDuplicates(["toxic", "run"])
        .cache()
    )
    try:
        rows = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
        if len(rows) < 2:
            return Grammar()
        entries = _lexicon(sample, rows[1], rows[0], max_entries)
        words = {e: w for e, w in entries if not e.endswith("*")}
        stems = {e[:-1]: w for e, w in entries if e.endswith("*")}
        value = clause_values(Grammar(words, stems), docs.sparkSession)("text")
        values = sample.select("toxic", value.alias("value")).collect()
    finally:
        sample.unpersist()
    x = np.array([r.value for r in values])
    slope, intercept = _curve(x, np.array([r.toxic for r in values], float))
    return Grammar(words, stems, max(0.0, slope), intercept)


def clause_values(grammar: Grammar, spark):
    """A column function: the value of every text's clauses."""
    shared = spark.sparkContext.broadcast(grammar)

    @F.arrow_udf("double")
    def value(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lexicon = Lexicon(shared.value)
        try:
            for texts in batches:
                # A few texts at a time are Python objects.
                few = (texts.slice(at, ENTRY_DOCS).to_pylist() for at in range(0, len(texts), ENTRY_DOCS))
                yield pa.array([text_value(t or "", lexicon) for part in few for t in part], pa.float64())
        finally:
            lexicon.clear()
            give_back()

    return value


def score(docs: DataFrame, grammar: Grammar, text_col: str = "text") -> DataFrame:
    """`docs` with value (of its clauses), score and predicted; columns of these names are replaced."""
    value = clause_values(grammar, docs.sparkSession)(F.coalesce(F.col(text_col), F.lit("")))
    exponent = F.lit(grammar.intercept) + F.lit(grammar.slope) * F.col("value")
    bounded = F.greatest(F.lit(-40.0), F.least(F.lit(40.0), exponent))
    scored = docs.withColumn("value", value).withColumn("score", 1.0 / (1.0 + F.exp(-bounded)))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op5_toxicity(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    grammar = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs.select("doc_id", "text"), grammar).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted", "value"
    )
