"""Exact top-k by integer inner product over a pivot-distance index.

Every vector is keyed by its nearest pivot and its distance to it. Sorted by that key, vectors are cut
into annuli: packed blocks of one pivot, each with its range of distances and its largest norm. A query
first looks through the annulus it lies in, which gives it a score to beat. For every pivot the triangle
inequality then limits how far from the query's own distance a better vector can lie: with q.x equal to
(|q|^2 + |x|^2 - |q - x|^2) / 2 and |q - x| at least | d(q, p) - d(x, p) |, only annuli whose range of
distances reaches into that interval are met, the others are skipped without being read. Products are
taken of whole blocks, and the best k of each block go on.

Pivots are fitted on a bounded sample of rows in the order of a hash; every row is indexed, and the
answer does not depend on the pivots. Queries and blocks meet on (pivot, band of distance), a block's
queries are cut into shares, so neither a frequent vector nor many queries meet in one task.

Vectors that are null, hold null or non-finite components, or have another length than the table's
commonest (the longer one of two as common) take no part; nor do rows without id. Rows equal in id and
vector count once. Fewer than k candidates give fewer rows; an empty table gives none. Components are
32-bit and scores 64-bit whole numbers, all exact; a table that needs larger ones is refused.
"""

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqlog.llm.common import table, written

SCALE = 1024.0
#: Rows that pivots are chosen from, and pivots.
SAMPLE, PIVOTS = 4_096, 64
#: Vectors of a block, and queries that one task multiplies with it at a time.
BLOCK, SHARE = 1_024, 4_096
#: Bands of distance per pivot by which queries and annuli meet.
BANDS = 64
KEYED = "pivot int, distance double, vec_id long, vector binary"
PACKED = "block long, pivot int, low double, high double, norm double, ids binary, vectors binary"
QUERIES = "query_id long, vector binary, least long, norm double"
#: Part of any norm or distance that rounding can be off by.
SLACK = 1e-5
#: In place of a score that 64 bits cannot hold, and of none; sizes from which a score may be too large.
BEYOND, NONE, TOO_LARGE = -(1 << 63), 1 - (1 << 63), float(1 << 63) * (1 - SLACK)


def integers(vectors: list) -> np.ndarray:
    return np.floor(SCALE * np.asarray(vectors, np.float64))


def _usable(vector, length: int) -> bool:
    return (
        vector is not None
        and len(vector) == length
        and all(x is not None for x in vector)
        and bool(np.isfinite(np.asarray(vector, np.float64)).all())
    )


def fit_pivots(rows: DataFrame, id_col: str, vector_col: str) -> np.ndarray:
    """Far-apart vectors of the sample, moved to the middle of their neighbours."""
    usable = rows.select(F.col(id_col).alias("i"), F.col(vector_col).cast("array<double>").alias("v")).where(
        "i IS NOT NULL AND size(v) > 0 AND NOT exists(v, x -> x IS NULL OR isnan(x) OR abs(x) = double('inf'))"
    )
    commonest = usable.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    if not commonest:
        return np.empty((0, 0))
    of_length = usable.where(F.size("v") == commonest["n"])
    sample = of_length.orderBy(F.xxhash64("i"), "i").limit(SAMPLE).collect()
    points = np.unique(integers([r.v for r in sample]), axis=0)
    chosen, gap = [0], _distances(points, points[:1])[:, 0]
    while len(chosen) < PIVOTS and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, _distances(points, points[chosen[-1:]])[:, 0])
    pivots = points[chosen]
    for _ in range(5):
        near = _distances(points, pivots).argmin(axis=1)
        pivots = np.array([points[near == p].mean(axis=0) if (near == p).any() else pivots[p] for p in range(len(pivots))])
    return pivots


def _distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (points**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2 * points @ pivots.T
    return np.sqrt(np.maximum(squares, 0))


def _matrix(data: bytes, length: int) -> np.ndarray:
    return np.frombuffer(data, np.int32).reshape(-1, length).astype(np.float64)


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products as 64-bit integers, BEYOND where they do not fit."""
    rough = left @ right.T
    largest = np.abs(left).max(initial=0) * np.abs(right).max(initial=0) * left.shape[-1]
    if largest < 1 << 53:
        return rough.astype(np.int64)
    # Sums that leave 64 bits on the way come back, if their end is within.
    exact = left.astype(np.int64) @ right.astype(np.int64).T
    return np.where(np.abs(rough) < TOO_LARGE, exact, BEYOND)


def _kept(scores: np.ndarray) -> np.ndarray:
    if (scores == BEYOND).any():
        raise ValueError("a score is beyond 64 bits")
    return scores


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: highest score, then smallest id."""
    if len(scores) > 4 * k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= cut)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))[:k]]


def build_index(rows: DataFrame, pivots: np.ndarray, id_col: str, vector_col: str) -> DataFrame:
    """Packed annuli, one row per block, as a written table."""
    length = pivots.shape[1]

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [
                (i, v) for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                if i is not None and _usable(v, length)
            ]
            if not pairs:
                continue
            points = integers([v for _, v in pairs])
            if points.min() < -(1 << 31) or points.max() >= 1 << 31:
                raise ValueError("a component is beyond 32 bits")
            distances = _distances(points, pivots)
            near = distances.argmin(axis=1)
            # Whole numbers of a fine unit, so that equal vectors have equal distances on any machine.
            own = np.round(distances[np.arange(len(near)), near], 6)
            vectors = [row.tobytes() for row in points.astype(np.int32)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(near, pa.int32()),
                    pa.array(own, pa.float64()),
                    pa.array([i for i, _ in pairs], pa.int64()),
                    pa.array(vectors, pa.binary()),
                ],
                names=["pivot", "distance", "vec_id", "vector"],
            )

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def block() -> pa.RecordBatch:
            vectors = b"".join(row[3] for row in held)
            norm = float((_matrix(vectors, length) ** 2).sum(1).max())
            values = [random.getrandbits(63), held[0][0], held[0][1], held[-1][1], norm]
            ids = np.array([row[2] for row in held], np.int64).tobytes()
            names = ["block", "pivot", "low", "high", "norm", "ids", "vectors"]
            kinds = [pa.int64(), pa.int32(), *[pa.float64()] * 3, pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip([*values, ids, vectors], kinds, strict=True)], names=names
            )

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held and held[-1] == row:
                    continue
                if held and (held[-1][0] != row[0] or len(held) == BLOCK):
                    yield block()
                    held = []
                held.append(row)
        if held:
            yield block()

    keyed_rows = rows.select(F.col(id_col).cast("long"), F.col(vector_col).cast("array<double>")).mapInArrow(
        keyed, KEYED
    )
    order = ["pivot", "distance", "vec_id", "vector"]
    annuli = keyed_rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(packed, PACKED)
    return written(annuli, "annuli")[0]


def top_k(
    rows: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id and score for the queries: rows whose id is divisible by `every`."""
    spark = rows.sparkSession
    pivots = fit_pivots(rows, id_col, vector_col)
    if not len(pivots):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    length = pivots.shape[1]
    blocks = build_index(rows, pivots, id_col, vector_col)
    # One row per pivot: at most PIVOTS.
    reach = {
        r.pivot: (r.low, r.high, r.norm)
        for r in blocks.groupBy("pivot").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.max("norm").alias("norm")).collect()
    }

    size = np.sqrt((pivots**2).sum(1))

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Queries with the k-th best score within their own annulus."""
        for batch in batches:
            for ids, vectors in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids, points = np.frombuffer(ids, np.int64), _matrix(vectors, length)
                places = np.flatnonzero(ids % every == 0)
                least = []
                for place in places:
                    scores = _kept(_products(points[ids != ids[place]], points[place]))
                    least.append(int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else NONE)
                chosen = points[places]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[places], pa.int64()),
                        pa.array([row.tobytes() for row in chosen.astype(np.int32)], pa.binary()),
                        pa.array(least, pa.int64()),
                        pa.array((chosen**2).sum(1), pa.float64()),
                    ],
                    names=["query_id", "vector", "least", "norm"],
                )

    def bands(low: float, high: float, pivot: int) -> tuple[int, int]:
        start, end, _ = reach[pivot]
        width = max((end - start) / BANDS, 1e-6)
        return int(max(0, (low - start) // width)), int(min(BANDS, (high - start) // width))

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For every pivot the bands that a better vector can lie in."""
        for batch in batches:
            out: list[tuple] = []
            columns = [c.to_pylist() for c in batch.columns]
            for query, vector, least, norm in zip(*columns, strict=True):
                distances = _distances(_matrix(vector, length), pivots)[0]
                for pivot, (low, high, largest) in reach.items():
                    # A difference of squares can be off by a share of their sum, a distance by its root.
                    margin = SLACK * (1 + norm**0.5 + largest**0.5 + size[pivot])
                    square = norm + largest - 2.0 * least
                    radius = np.inf if least == NONE else max(square, 0) ** 0.5 + 2 * margin
                    nearest, farthest = distances[pivot] - radius, distances[pivot] + radius
                    if farthest < low or nearest > high or square < -(margin**2):
                        continue
                    first, last = bands(max(nearest, low), min(farthest, high), pivot)
                    out += [(query, vector, least, pivot, band, first) for band in range(first, last + 1)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row[i] for row in out], kind)
                    for i, kind in enumerate((pa.int64(), pa.binary(), pa.int64(), *[pa.int32()] * 3))
                ],
                names=["query_id", "vector", "least", "pivot", "band", "first"],
            )

    def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for block, pivot, low, high in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                first, last = bands(low, high, pivot)
                out += [(block, pivot, band, first) for band in range(first, last + 1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[i] for row in out], kind) for i, kind in enumerate((pa.int64(), *[pa.int32()] * 3))],
                names=["block", "pivot", "band", "first_held"],
            )

    def multiplied(pairs: pa.Table, block: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if pairs.num_rows and block.num_rows:
            ids = np.frombuffer(block.column("ids")[0].as_py(), np.int64)
            points = _matrix(block.column("vectors")[0].as_py(), length)
            queries = pairs.column("query_id").to_numpy()
            least = pairs.column("least").to_numpy()
            scores = _products(_matrix(b"".join(pairs.column("vector").to_pylist()), length), points)
            scores[queries[:, None] == ids[None, :]] = NONE
            for query, bound, row in zip(queries, least, _kept(scores), strict=True):
                for place in _best(row, ids, k):
                    if row[place] >= bound and row[place] != NONE:
                        found.append((int(query), int(ids[place]), int(row[place])))
        return pa.table(
            {name: pa.array([f[i] for f in found], pa.int64()) for i, name in enumerate(("query_id", "vec_id", "score"))}
        )

    queries, _ = written(blocks.select("ids", "vectors").mapInArrow(asked, QUERIES), "queries")
    shares = max(1, -(-queries.count() // SHARE))
    routes = queries.mapInArrow(routed, "query_id long, vector binary, least long, pivot int, band int, first int")
    places = blocks.select("block", "pivot", "low", "high").mapInArrow(banded, "block long, pivot int, band int, first_held int")
    # Both sides grow with the table, so neither is broadcast. A query and a block that share several
    # bands meet in the first of them.
    pairs = (
        routes.join(places.hint("merge"), ["pivot", "band"])
        .where(F.col("band") == F.greatest("first", "first_held"))
        .select("query_id", "vector", "least", F.col("block").alias("at"), F.pmod(F.xxhash64("query_id"), F.lit(shares)).cast("int").alias("part"))
    )
    shared = blocks.select("block", "ids", "vectors", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"))
    scored = (
        pairs.groupBy("at", "part")
        .cogroup(shared.groupBy("block", "share"))
        .applyInArrow(multiplied, "query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        scored.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op8_top_k(spark, sf_dir) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


OP8_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
           FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
SELECT query_id, CAST(place AS INT) AS rank, vec_id, score FROM ranked WHERE place <= 10"""
