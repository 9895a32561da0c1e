"""Nearest neighbours by inner product: inverted lists scanned with an adaptive number of dimensions."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline.sources.scratch import written

MAX_LISTS = 4096
PER_LIST = 4096  # vectors a list is meant to hold
SAMPLE_PER_LIST, LEAST_SAMPLE = 32, 4096  # vectors that the lists' centres are fitted on: at most MAX_LISTS * SAMPLE_PER_LIST
TARGET = 0.97  # share of a sample query's true neighbours in the sample that the lists it looks into must hold
SAMPLE_QUERIES = 512
LEAST_LISTS = 4
CHUNK = 4096  # vectors of a list scanned by one task at a time
BLOCK = 16  # rotated dimensions added between two tests
CONFIDENCE = 2.1  # of the test that abandons a candidate, in standard deviations of the partial distance
_FIRST, _STRIDE = 512, 2048  # candidates looked at before the limit is set, and at a time after that


@dataclass
class Index:
    """What tasks need: the rotation, the bound that turns inner products into distances, list centres and sizes."""

    rotation: np.ndarray
    bound: float
    centres: np.ndarray
    sizes: np.ndarray
    k: int
    probed: int = LEAST_LISTS

    def turned(self, x: np.ndarray, query: bool) -> np.ndarray:
        """With one more coordinate, squared distances rank as inner products do; then rotated."""
        x = x.astype(np.float64)
        extra = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.bound - (x * x).sum(axis=1), 0))
        return np.column_stack([x, extra]) @ self.rotation

    def to_centres(self, turned: np.ndarray) -> np.ndarray:
        return (self.centres**2).sum(axis=1) - 2 * turned @ self.centres.T

    def lists_of(self, turned: np.ndarray) -> np.ndarray:
        return np.concatenate([self.to_centres(turned[i : i + 1024]).argmin(axis=1) for i in range(0, len(turned), 1024)])

    def probes(self, turned: np.ndarray) -> list[np.ndarray]:
        """The nearest lists of each query: the fitted number, and as many as hold enough vectors."""
        out, least = [], max(LEAST_LISTS, self.probed)
        for row in self.to_centres(turned):
            order = np.argsort(row, kind="stable")
            enough = int(np.searchsorted(np.cumsum(self.sizes[order]), 4 * (self.k + 1))) + 1
            out.append(order[: max(least, enough)])
        return out


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f4").reshape(-1, dims) if len(column) else np.zeros((0, dims), "<f4")


def fit_centres(x: np.ndarray, lists: int, rounds: int = 10, seed: int = 5) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[np.sort(rng.choice(len(x), lists, replace=False))].copy()
    for _ in range(rounds):
        near = np.concatenate([((centres**2).sum(1) - 2 * x[i : i + 2048] @ centres.T).argmin(1) for i in range(0, len(x), 2048)])
        counts = np.bincount(near, minlength=lists)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def squared(blocks: list[np.ndarray]) -> list[np.ndarray]:
    return [(b**2).sum(axis=1) for b in blocks]


def scan(blocks: list[np.ndarray], query: np.ndarray, k: int, squares: list[np.ndarray] | None = None) -> np.ndarray:
    """Candidates that may be among the k nearest: each keeps adding blocks of rotated dimensions until its partial
    distance, scaled to all dimensions, tells with confidence that it is beyond the k-th found so far. ``squares`` are the
    squared lengths by block. Survivors are gathered once they are few; while most survive, whole runs are cheaper."""
    squares = squared(blocks) if squares is None else squares
    dims, n = sum(b.shape[1] for b in blocks), len(blocks[0])
    parts = np.split(query, np.cumsum([b.shape[1] for b in blocks])[:-1])
    kept, dist, limit, slack = np.zeros(0, np.int64), np.zeros(0), np.inf, 1e-9 * float(query @ query)  # for rounding
    for low, high in zip([0, *range(_FIRST, n, _STRIDE)], [*range(_FIRST, n, _STRIDE), n]):
        alive: slice | np.ndarray = slice(low, high)
        partial, near, done = np.zeros(high - low), None, 0
        for block, square, q in zip(blocks, squares, parts):
            partial = partial + square[alive] - 2 * (block[alive] @ q) + q @ q
            done += len(q)
            bound = limit * ((1 + CONFIDENCE / done**0.5) ** 2 * done / dims if done < dims else 1) * (1 + 1e-9) + slack
            inside = partial <= bound
            near = inside if near is None else near & inside
            if 3 * np.count_nonzero(near) < len(near) or done == dims:
                alive = (np.arange(low, high) if isinstance(alive, slice) else alive)[near]
                partial, near = partial[near], None
                if not len(alive):
                    break
        if len(alive):
            kept, dist = np.concatenate([kept, alive]), np.concatenate([dist, partial])
            if len(dist) > k:
                limit = np.partition(dist, k - 1)[k - 1]
                inside = dist <= limit * (1 + 1e-9) + slack
                kept, dist = kept[inside], dist[inside]
    return kept


def _placed(vectors: DataFrame, index: Index, dims: int, query: bool) -> DataFrame:
    """(list, key, vec): each candidate in its list, or each query once per list it looks into."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 2048):
                part = batch.slice(low, 2048)
                turned = index.turned(_matrix(part.column("vec"), dims), query)
                if query:
                    lists = index.probes(turned)
                    rows = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
                    lists = np.concatenate(lists)
                else:
                    rows, lists = np.arange(len(turned)), index.lists_of(turned)
                taken = part.take(pa.array(rows))
                columns = [pa.array(lists.astype(np.int32)), taken.column("key"), taken.column("vec")]
                yield pa.RecordBatch.from_arrays(columns, names=["list", "key", "vec"])

    return vectors.select("key", "vec").mapInArrow(run, "list int, key long, vec binary")


def _scanned(batches: Iterator[pa.RecordBatch], index: Index, dims: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (list, chunk, kind): the chunk's candidates first, then the queries that look into it, which
    pass through in batches. Emits each query's best candidates of the chunk with exact scores."""
    place, keys, vecs, blocks, squares = None, [], [], None, None
    width = index.k + 1
    for batch in batches:
        if not batch.num_rows:
            continue
        lists, chunks, kinds = (batch.column(c).to_numpy() for c in ("list", "chunk", "kind"))
        cuts = np.flatnonzero((np.diff(lists) != 0) | (np.diff(chunks) != 0) | (np.diff(kinds) != 0)) + 1
        rows = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]]
        for a, b in zip([0, *cuts], [*cuts, len(lists)]):
            if place != (lists[a], chunks[a]):
                place, keys, vecs, blocks = (lists[a], chunks[a]), [], [], None
            key, vec = batch.column("key").to_numpy()[a:b], _matrix(batch.column("vec").slice(a, b - a), dims)
            if kinds[a] == 0:
                keys.append(key), vecs.append(vec)
                continue
            if not keys:
                continue
            if blocks is None:
                own, all_keys = np.concatenate(vecs), np.concatenate(keys)
                turned = index.turned(own, False)
                blocks = [np.ascontiguousarray(turned[:, i : i + BLOCK]) for i in range(0, turned.shape[1], BLOCK)]
                squares = squared(blocks)
                own = own.astype(np.float64)
            for q, v, t in zip(key, vec.astype(np.float64), index.turned(vec, True)):
                near = scan(blocks, t, width, squares)
                score = (own[near] * v).sum(axis=1)
                order = np.lexsort((all_keys[near], -score))
                if len(order) > width:  # ties at the border stay; ids decide later
                    order = order[: int(np.searchsorted(-score[order], -score[order[width - 1]], side="right"))]
                rows[0].append(np.full(len(order), q)), rows[1].append(all_keys[near][order]), rows[2].append(score[order])
        columns = [pa.array(np.concatenate(r)) for r in rows]
        yield pa.RecordBatch.from_arrays(columns, names=["query", "key", "score"])


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the k vectors of largest inner product, its own id left out.

    Scores are double-precision products of the vectors as given; ties go to the smaller id. Which vectors are
    found is approximate (see TARGET), what is returned of them exact. Null, zero or non-finite vectors, those with a
    null part, of another than the most common length or without an id take no part, neither as candidates nor as
    queries. Rows that repeat id and vector count once; an empty table gives no rows.

    Equal vectors are searched once and stand for their k + 1 smallest ids, the most any query can use, so a vector held by
    a third of all rows costs one candidate and one query. Lists larger than CHUNK are cut and scanned by
    several tasks; the queries of a list pass through each of them in batches.
    """

    def usable(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<float>").alias("e")).where("id is not null")
        finite = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        return rows.where(finite & F.exists("e", lambda x: x != 0))

    valid = usable(vectors)
    common = valid.groupBy(F.size("e").alias("n")).count().orderBy(F.desc("count"), "n").first()
    schema = "query_id long, rank int, vec_id long, score double"
    spark = vectors.sparkSession
    if common is None:
        return spark.createDataFrame([], schema)
    dims = common.n
    pack = F.pandas_udf("binary")(_packed)
    ranked = valid.where(F.size("e") == dims).distinct()
    ranked = ranked.withColumn("at", F.row_number().over(Window.partitionBy("e").orderBy("id"))).where(F.col("at") <= k + 1)
    grouped = ranked.groupBy("e").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    distinct = written(grouped.select(F.xxhash64("e").alias("key"), pack("e").alias("vec"), "ids", _square("e").alias("square")), "vectors")
    asked = usable(queries).where(F.size("e") == dims).select("id", F.xxhash64("e").alias("query")).distinct()
    asked = written(asked, "queries")

    count, bound = distinct.agg(F.count("*"), F.max("square")).first()
    lists = int(min(MAX_LISTS, max(1, round(count / PER_LIST))))
    size = max(LEAST_SAMPLE, SAMPLE_PER_LIST * lists)
    share = min(1.0, size / count)
    taken = sorted(distinct.where(F.shiftrightunsigned(F.xxhash64("key"), 11) / float(1 << 53) < share).select("key", "vec").collect())
    if len(taken) < lists:  # a few vectors only
        taken = sorted(distinct.select("key", "vec").limit(size).collect())
    index = _fitted(np.frombuffer(b"".join(bytes(r.vec) for r in taken), "<f4").reshape(-1, dims), lists, bound * (1 + 1e-6), k)
    placed = written(_placed(distinct, index, dims, False), "lists")
    index.sizes[:] = 0
    for r in placed.groupBy("list").count().collect():  # one row per list
        index.sizes[r.list] = r["count"]
    chunks = F.array(*[F.lit(int(max(1, -(-n // CHUNK)))) for n in index.sizes])
    own = placed.withColumn("chunk", F.pmod(F.hash("key"), F.get(chunks, "list"))).withColumn("kind", F.lit(0))
    distinct_queries = distinct.join(asked.select(F.col("query").alias("key")).distinct(), "key", "left_semi")
    looking = _placed(distinct_queries, index, dims, True)
    looking = looking.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.get(chunks, "list") - 1))).withColumn("kind", F.lit(1))
    both = own.unionByName(looking).repartition("list", "chunk").sortWithinPartitions("list", "chunk", "kind")
    found = both.mapInArrow(lambda it: _scanned(it, index, dims), "query long, key long, score double")

    named = found.join(distinct.select("key", "ids"), "key").select("query", "score", F.explode("ids").alias("vec_id"))
    nearest = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = named.withColumn("at", F.row_number().over(nearest)).where(F.col("at") <= k + 1)
    best = best.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("at", "vec_id", "score"))).alias("best"))
    answered = asked.join(best, "query").select(
        F.col("id").alias("query_id"), F.posexplode(F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("id")), 1, k)).alias("at", "b")
    )
    return answered.select("query_id", (F.col("at") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"), F.col("b.score").alias("score"))


def _packed(column):
    return column.map(lambda x: np.asarray(x, "<f4").tobytes())


def _square(column: str):
    return F.aggregate(column, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))


def _fitted(sample: np.ndarray, lists: int, bound: float, k: int, seed: int = 11) -> Index:
    rng = np.random.default_rng(seed)
    rotation, r = np.linalg.qr(rng.normal(size=(sample.shape[1] + 1,) * 2))
    index = Index(rotation * np.sign(np.diag(r)), bound, np.zeros((1, 1)), np.zeros(lists, np.int64), k)
    turned = index.turned(sample, False)
    index.centres = fit_centres(turned, lists)
    index.probed = _lists_needed(index, sample.astype(np.float64), turned)
    return index


def _lists_needed(index: Index, sample: np.ndarray, turned: np.ndarray) -> int:
    """How many of the nearest lists hold TARGET of the true neighbours, measured inside the sample. Data in clusters
    needs few, data without structure many; a sample is sparser than the table, so this errs to more."""
    own = index.lists_of(turned)
    at = np.linspace(0, len(sample) - 1, min(SAMPLE_QUERIES, len(sample))).astype(int)
    order = np.argsort(index.to_centres(index.turned(sample[at], True)), axis=1)
    ranks = np.argsort(order, axis=1)
    score = sample[at] @ sample.T
    score[np.arange(len(at)), at] = -np.inf
    near = np.argsort(-score, axis=1)[:, : max(1, min(index.k, len(sample) - 1))]
    found = np.sort(np.take_along_axis(ranks, own[near], axis=1).ravel())
    return int(found[min(len(found) - 1, int(TARGET * len(found)))]) + 1
