"""Near-duplicate classes by MinHash signatures and a multi-index Hamming join.

A document's set is its distinct shingles of `size` words. Equal sets are one class; only class
representatives go on. A signature has so many minimum hashes as the threshold asks for (`positions`), of
which BITS bits are kept, and the distance of two signatures is the number of positions that differ.
Positions are cut into chunks; with a distance of at most the radius some chunk has at most ERRORS errors (pigeonhole), so for every chunk all
ways to leave out ERRORS positions are enumerated, and the rest is a key. Every pair within the radius
shares a key, without exception; a pair at the similarity threshold, whichever it is, is farther apart than
the radius with a probability of some 3 in a million.

Signatures that share a key meet in a task, which links those within the radius. It hands on a spanning
forest, never pairs. Connected signatures are a cluster: every candidate pair lies within one. Then the
cluster's texts meet, their full sets are compared, and again only a spanning forest of confirmed links
goes on. Keys and clusters of many members are cut into blocks, and every two blocks meet in a task of
their own, so no group is ever in one task as a whole. Confirmed links and classes give the components.

Null and empty texts, and texts without words, have an empty set and are linked with nothing. Rows that
share an id are one document for `component_id` and `kept`; null ids take no part: their component is null and
they are kept. Only id and text are read. An empty table gives no rows.
"""

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqlog.llm.common import (
    arrow_rows,
    coded,
    drop_written,
    frugal,
    min_labels,
    mixed,
    run_hashes,
    table,
    word_hashes,
    written,
)

SHINGLE = 3
#: Links need 100 * common shingles >= PERCENT * shingles of both. Both values are those of op1.
PERCENT = 85
BITS, CHUNK, ERRORS = 16, 4, 1
#: Largest probability that a pair at the threshold is farther apart than the radius.
MISS = 3.6e-6


def radius(positions: int) -> int:
    """The largest distance for which pigeonhole holds: one error more in every chunk is one too many."""
    return (positions // CHUNK) * (ERRORS + 1) - 1


def miss(positions: int, percent: float) -> float:
    """Probability that more positions than the radius differ in a pair at the threshold."""
    same = percent / 100
    return sum(
        math.comb(positions, k) * (1 - same) ** k * same ** (positions - k)
        for k in range(radius(positions) + 1, positions + 1)
    )


def positions_for(percent: float) -> int:
    """The fewest positions, in whole chunks, with a miss chance of MISS at most."""
    # Nearer to a radius of half the positions, signatures would have hundreds of them and more.
    if not 60 <= percent <= 100:
        raise ValueError("percent must be from 60 to 100")
    return next(n for n in itertools.count(CHUNK, CHUNK) if miss(n, percent) <= MISS)


POSITIONS = positions_for(PERCENT)
RADIUS = radius(POSITIONS)
#: Members of a key, and texts of a cluster, that are compared with each other in one task.
KEY_BLOCK, TEXT_BLOCK = 4_096, 512
#: Documents whose words are held at a time while they are signed.
SIGNED_DOCS = 500
#: Rows that small groups are packed together for.
PACK = 20_000
SIGNED = "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, signature binary, keys array<bigint>"


def shingles(words: list[bytes], size: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of `size` words; of the whole sequence if it is shorter."""
    return np.unique(run_hashes(word_hashes(words), min(size, len(words)))) if words else np.empty(0, np.uint64)


def _multipliers(positions: int) -> tuple[np.ndarray, np.ndarray]:
    numbers = mixed(np.arange(1, 2 * positions + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return numbers[:positions] | np.uint64(1), numbers[positions:]


def signature(hashes: np.ndarray, positions: int = POSITIONS) -> np.ndarray:
    factors, terms = _multipliers(positions)
    least = np.array([(hashes * a + b).min() for a, b in zip(factors, terms, strict=True)], np.uint64)
    return (mixed(least) >> np.uint64(64 - BITS)).astype(np.uint16)


def chunk_keys(signatures: np.ndarray) -> np.ndarray:
    """Keys of every signature: each chunk with each choice of ERRORS positions left out."""
    keys = []
    for chunk in range(signatures.shape[1] // CHUNK):
        for kept in itertools.combinations(range(CHUNK), CHUNK - ERRORS):
            key = np.full(len(signatures), len(keys) + 1, np.uint64)
            for place in kept:
                key = mixed(key * np.uint64(1 << BITS) + signatures[:, chunk * CHUNK + place])
            keys.append(key)
    return np.stack(keys, axis=1).view(np.int64)


def _signer(size: int, positions: int):
    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            codes, hashes, sizes = coded(texts, lower=True)
            words, ends = hashes[codes], np.cumsum(sizes)
            counts, sets, signatures = [], [], []
            for n, end in zip(sizes.tolist(), ends.tolist(), strict=True):
                found = np.unique(run_hashes(words[end - n : end], min(size, n))) if n else np.empty(0, np.uint64)
                counts.append(len(found))
                sets.append((mixed(found).sum(), mixed(found ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum()))
                signatures.append(signature(found, positions) if n else np.zeros(positions, np.uint16))
            stacked = np.array(signatures, np.uint16).reshape(-1, positions)
            keys = chunk_keys(stacked)
            two = np.array(sets, np.uint64).reshape(-1, 2).view(np.int64)
            offsets = np.arange(len(texts) + 1, dtype=np.int32) * keys.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(counts, pa.int64()),
                    pa.array(np.ascontiguousarray(two[:, 0])),
                    pa.array(np.ascontiguousarray(two[:, 1])),
                    pa.array([s.tobytes() for s in stacked], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel())),
                ],
                names=["doc_id", "n_shingles", "set_a", "set_b", "signature", "keys"],
            )

    return signed


class Forest:
    """Smallest member of every set of linked places, as a table of edges at the end."""

    def __init__(self, size: int):
        self.label = np.arange(size)

    def link(self, place: int, others: np.ndarray) -> None:
        labels = np.unique(self.label[np.append(others, place)])
        if len(labels) > 1:
            self.label[np.isin(self.label, labels)] = labels[0]

    def edges(self, ids: np.ndarray) -> np.ndarray:
        """(id, id) pairs that connect what is linked."""
        linked = np.flatnonzero(self.label != np.arange(len(ids)))
        return np.stack([ids[linked], ids[self.label[linked]]], axis=1)


def _edge_table(found: list[np.ndarray]) -> pa.Table:
    both = np.concatenate([np.empty((0, 2), np.int64), *found])
    return pa.table({"a": pa.array(np.ascontiguousarray(both[:, 0])), "b": pa.array(np.ascontiguousarray(both[:, 1]))})


def _groups(*columns: np.ndarray) -> Iterator[np.ndarray]:
    """Places of equal values, group by group, for groups of two and more."""
    order = np.lexsort(columns)
    change = np.zeros(len(order), bool)
    change[:1] = True
    for column in columns:
        change[1:] |= column[order][1:] != column[order][:-1]
    starts = np.flatnonzero(change)
    for low, high in zip(starts, np.append(starts[1:], len(order)), strict=True):
        if high - low > 1:
            yield order[low:high]


def _linker(percent: float, positions: int):
    def near(group: pa.Table) -> pa.Table:
        """Spanning forest of the signatures within the radius, for each key."""
        ids, sizes = group.column("rep").to_numpy(), group.column("n_shingles").to_numpy()
        signatures = np.frombuffer(b"".join(group.column("signature").to_pylist()), np.uint16).reshape(-1, positions)
        found = []
        for places in _groups(group.column("key").to_numpy(), group.column("pair").to_numpy()):
            forest, own, n = Forest(len(places)), signatures[places], sizes[places]
            for i in range(len(places) - 1):
                later = slice(i + 1, None)
                close = (own[later] != own[i]).sum(axis=1) <= radius(positions)
                close &= 100 * np.minimum(n[later], n[i]) >= percent * np.maximum(n[later], n[i])
                if close.any():
                    forest.link(i, np.flatnonzero(close) + i + 1)
            found.append(forest.edges(ids[places]))
        return _edge_table(found)

    return near


def _confirmer(size: int, percent: float):
    def confirmed(group: pa.Table) -> pa.Table:
        """Spanning forest of the texts whose full sets are similar enough, for each cluster."""
        ids = group.column("rep").to_numpy()
        sets = [shingles((t or "").encode("utf-8").lower().split(), size) for t in group.column("text").to_pylist()]
        found = []
        for places in _groups(group.column("cluster").to_numpy(), group.column("pair").to_numpy()):
            n = np.array([len(sets[p]) for p in places])
            every = np.concatenate([sets[p] for p in places])
            owner = np.repeat(np.arange(len(places)), n)
            order = np.argsort(every, kind="stable")
            values, owner = every[order], owner[order]
            starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.empty(0, int)
            distinct, lengths = values[starts], np.diff(np.append(starts, len(values)))
            forest = Forest(len(places))
            for i in range(len(places) - 1):
                at = np.searchsorted(distinct, sets[places[i]])
                total = lengths[at]
                jump = np.repeat(starts[at] - (np.cumsum(total) - total), total)
                common = np.bincount(owner[np.arange(total.sum()) + jump], minlength=len(places))
                linked = np.flatnonzero(100 * common >= percent * (n + n[i] - common))
                linked = linked[linked > i]
                if len(linked):
                    forest.link(i, linked)
            found.append(forest.edges(ids[places]))
        return _edge_table(found)

    return confirmed


def _in_blocks(rows: DataFrame, group: str, count: str, block: int, packs: int) -> DataFrame:
    """`rows` with `pair` and `task`: groups of up to `block` members packed, larger ones block by block.

    A member of a larger group goes to one task for each block of the group, its own included.
    """
    n = F.ceil(F.col(count) / block).cast("int")
    mine = F.pmod(F.xxhash64("rep"), F.col("_n")).cast("int")
    paired = (
        rows.withColumn("_n", n)
        .withColumn("_mine", mine)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
        .withColumn(
            "pair",
            F.when(F.col("_n") == 1, F.lit(0).cast("long")).otherwise(
                F.least("_mine", "_other").cast("long") * F.col("_n") + F.greatest("_mine", "_other")
            ),
        )
    )
    task = F.when(F.col("_n") == 1, F.pmod(F.xxhash64(group), F.lit(packs)).cast("long")).otherwise(
        F.xxhash64(group, "pair")
    )
    return paired.withColumn("task", task).drop("_n", "_mine", "_other", count)


def near_duplicates(
    docs: DataFrame,
    size: int = SHINGLE,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: float = PERCENT,
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row; links share `percent` of their shingles."""
    spark, positions = docs.sparkSession, positions_for(percent)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    with arrow_rows(spark, SIGNED_DOCS):
        signed, _ = written(rows.mapInArrow(frugal(_signer(size, positions)), SIGNED), "signatures")
    # Equal sets: one representative, the smallest id, to which the others are linked.
    full = signed.where("doc_id IS NOT NULL AND n_shingles > 0")
    copies = full.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep"))
    classed = full.join(copies, ["set_a", "set_b"])
    keyed = (
        classed.where("doc_id = rep")
        .select("rep", "n_shingles", "signature", "keys")
        .dropDuplicates(["rep", "signature"])
    )
    reps, reps_path = written(keyed, "representatives")
    entries = reps.select(F.explode("keys").alias("key"), "rep")
    shared_keys = entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    met, met_path = written(entries.join(shared_keys, "key"), "shared-keys")
    packs = max(1, -(-met.count() // PACK))
    members = met.join(reps.select("rep", "n_shingles", "signature"), "rep")
    near = (
        _in_blocks(members, "key", "n", KEY_BLOCK, packs)
        .select("task", "key", "pair", "rep", "n_shingles", "signature")
        .groupBy("task")
        .applyInArrow(_linker(percent, positions), "a bigint, b bigint")
    )
    clusters = min_labels(near).withColumnRenamed("id", "rep").withColumnRenamed("label", "cluster")
    sizes = clusters.groupBy("cluster").agg(F.count("*").alias("n"))
    sized, sized_path = written(clusters.join(sizes, "cluster"), "clusters")
    drop_written(spark, met_path, reps_path)
    # Texts of clustered representatives; the set decides where rows share an id.
    texts = rows.join(sized, F.col("doc_id") == F.col("rep")).select("cluster", "rep", "n", "text")
    packs = max(1, -(-sized.count() // (PACK // 10)))
    links = (
        _in_blocks(texts, "cluster", "n", TEXT_BLOCK, packs)
        .select("task", "cluster", "pair", "rep", "text")
        .groupBy("task")
        .applyInArrow(_confirmer(size, percent), "a bigint, b bigint")
    )
    same = classed.where("doc_id > rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    labels = min_labels(links.union(same))
    drop_written(spark, sized_path)
    component = F.least("doc_id", F.coalesce("label", "doc_id"))
    return (
        signed.select("doc_id", "n_shingles")
        .join(labels, F.col("doc_id") == F.col("id"), "left")
        .select(
            "doc_id",
            "n_shingles",
            component.alias("component_id"),
            F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
        )
    )


def op1_near_dedup(spark, sf_dir) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
