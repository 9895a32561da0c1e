"""Ranked lexical search: exact inner products of sparse vectors, found by ball trees with centroid-radius bounds."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm.common import keep_batches_small, small_batches, utf8
from wattline.sources.scratch import written

BLOCK_CHARS = 100_000  # item text held by one pass over the documents
TREE = 1024  # documents of one tree
LEAF = 8
GROUPS = 1024  # of terms, each with a radius of its own
_SLACK = 1e-10  # share that bounds and squared radii are widened by; sums of thousands of doubles err by a share of 1e-12
_TOGETHER = 128  # documents scored at once at most
_TEXT_BYTES = 8 << 20
# signs between terms: everything but ASCII letters and digits and bytes beyond ASCII
_BETWEEN = bytes(b for b in range(128) if not chr(b).isalnum())
_SPACED = bytes.maketrans(_BETWEEN, b" " * len(_BETWEEN))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8: maximal runs of ASCII letters and digits and signs beyond ASCII, A-Z lower-cased."""
    return text.lower().translate(_SPACED).split()


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


# ---- ball trees ------------------------------------------------------------


@dataclass
class _Tree:
    """Balls over the rows of a matrix. Node i covers order[low[i]:high[i]]; child[i] is its first child, the second follows; 0 for
    leaves. A ball has one centre and a radius in each group of columns."""

    order: np.ndarray
    low: list[int]
    high: list[int]
    child: list[int]
    centres: np.ndarray
    radii: np.ndarray


def grow(rows: np.ndarray, starts: np.ndarray, leaf: int = LEAF) -> _Tree:
    """A ball tree: a ball is split between two far rows, each row going to the nearer one, until it holds ``leaf`` rows or
    only equal ones. ``starts`` are the first columns of the groups. Radii are rounded up beyond any error of their computation."""
    count, width = rows.shape
    at_row, column = np.nonzero(rows)  # the entries, row by row
    entry = rows[at_row, column].astype(np.float64)
    upto = np.concatenate([[0], np.cumsum(np.bincount(at_row, minlength=count))])
    group = np.repeat(np.arange(len(starts)), np.diff([*starts, width]))[column]
    squares = np.bincount(at_row, entry**2, count)
    order = np.arange(count)
    low, high, child, centres, radii = [0], [count], [0], [], []
    node = 0
    while node < len(low):
        a, b = low[node], high[node]
        mine, m = order[a:b], b - a
        sizes = upto[mine + 1] - upto[mine]
        own = np.repeat(np.arange(m), sizes)  # which of the ball's rows each of its entries belongs to
        at = np.arange(len(own)) + np.repeat(upto[mine] - np.cumsum(sizes) + sizes, sizes)
        columns, entries = column[at], entry[at]
        centre = np.bincount(columns, entries, width) / m
        # squared distance to the centre by row and group: entries change the centre's own share
        bins = own * len(starts) + group[at]
        change = np.bincount(bins, entries * (entries - 2 * centre[columns]), m * len(starts)).reshape(m, -1)
        longest = np.bincount(bins, entries**2, m * len(starts)).reshape(m, -1).max(axis=0)
        share = np.add.reduceat(centre**2, starts)
        centres.append(centre)
        radii.append(np.sqrt(np.maximum(change.max(axis=0) + share, 0) + (longest + share) * _SLACK))
        if m > leaf:

            def gaps(row: int) -> np.ndarray:
                point = rows[mine[row]]
                return squares[mine] - 2 * np.bincount(own, entries * point[columns], m) + squares[mine[row]]

            to_one = gaps(int(change.sum(axis=1).argmax()))
            second = gaps(int(to_one.argmax())) < to_one
            cut = a + int((~second).sum())
            if a < cut < b:
                order[a:b] = np.concatenate([mine[~second], mine[second]])
                child[node] = len(low)
                low += [a, cut]
                high += [cut, b]
                child += [0, 0]
        node += 1
    return _Tree(order, low, high, child, np.array(centres), np.array(radii))


def groups(holding: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of the terms by falling frequency, and the starts of at most ``most`` groups of neighbours that are held about equally
    often together; frequent terms stand alone."""
    order = np.argsort(-holding, kind="stable")
    upto = np.cumsum(holding[order])
    group = (upto - 1) * most // max(int(upto[-1]), 1)
    return order, np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))


class Best:
    """The k best (score, id) of each query so far; of equal scores the smaller id is better, a missing id the smallest."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.heaps: list[list[tuple[int, int]]] = [[] for _ in range(queries)]  # (score, -id), worst first

    def floor(self, query: int) -> int:
        """A score under this cannot get in any more."""
        heap = self.heaps[query]
        return heap[0][0] if len(heap) == self.k else 1

    def offer(self, query: int, score: int, key: int) -> None:
        heap = self.heaps[query]
        if len(heap) < self.k:
            heapq.heappush(heap, (score, -key))
        elif (score, -key) > heap[0]:
            heapq.heapreplace(heap, (score, -key))


_NO_ID = -(1 << 63)


class Queries:
    """Items over their own terms: for each the places of its different terms and how often it holds them. The columns of the
    documents' vectors are the terms in the order ``columns``, in groups from ``starts`` on."""

    def __init__(self, items: list[list[int]], weights: np.ndarray, holding: np.ndarray):
        self.columns, self.starts = groups(holding, GROUPS)
        self.weights = weights[self.columns]
        column = np.argsort(self.columns)
        self.places, self.times = [], []
        self.dense = np.zeros((len(items), len(weights)))
        for i, item in enumerate(items):
            places, times = np.unique(column[np.array(item, np.int64)], return_counts=True)
            self.places.append(places)
            self.times.append(times.astype(np.int64))
            self.dense[i, places] = times
        self.lengths = np.sqrt(np.add.reduceat(self.dense**2, self.starts, axis=1))


def search_tree(values: np.ndarray, keys: list[int], queries: Queries, best: Best, leaf: int = LEAF) -> int:
    """Offer every query the documents of one tree that can still be among its best; returns the documents scored.

    ``values`` holds a document per row, its whole numbers per term. Vectors are weighted values, so a query's score is the inner
    product with its term counts: at most that with a ball's centre plus, over the groups of terms, the query's length times the
    ball's radius there. A subtree goes unseen when this bound, rounded up beyond the error of its computation, is under the
    query's worst. Balls are taken best first; leaves are scored in whole numbers, a few at a time.
    """
    weighted = values[:, queries.columns] * queries.weights
    tree = grow(weighted.astype(np.float64), queries.starts, leaf)
    # all terms are at least 0, so the sum's error is a small share of it
    bounds = (queries.dense @ tree.centres.T + queries.lengths @ tree.radii.T) * (1 + _SLACK) + 1
    scored = 0
    for q, (places, times) in enumerate(zip(queries.places, queries.times)):
        reach = bounds[q].tolist()
        open_balls, together = [(-reach[0], 0)], leaf
        while True:
            floor, rows = best.floor(q), []
            while open_balls and len(rows) < together and -open_balls[0][0] >= floor:
                node = heapq.heappop(open_balls)[1]
                if first := tree.child[node]:
                    heapq.heappush(open_balls, (-reach[first], first))
                    heapq.heappush(open_balls, (-reach[first + 1], first + 1))
                else:
                    rows += tree.order[tree.low[node] : tree.high[node]].tolist()
            if not rows:
                break
            at = np.array(rows)
            scores = weighted[at[:, None], places] @ times
            scored += len(rows)
            together = min(2 * together, _TOGETHER)
            for i in np.flatnonzero(scores >= floor).tolist():
                best.offer(q, int(scores[i]), keys[rows[i]])
    return scored


# ---- on Spark --------------------------------------------------------------


def item_blocks(items: DataFrame, item_id: str, text: str, block_chars: int) -> Iterator[list[tuple[int | None, bytes]]]:
    """The items in blocks of about ``block_chars`` bytes, one at a time on the driver; a row is an item, also if it repeats another."""
    rows = items.select(F.col(item_id).cast("long").alias("i"), F.col(text).cast("string").cast("binary").alias("t")).where("length(t) > 0")
    rows = written(rows.withColumn("u", F.monotonically_increasing_id()), "items")
    total = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = max(1, -(-total // block_chars))
    for k in range(blocks):
        yield [(r.i, bytes(r.t)) for r in rows.where(F.pmod(F.xxhash64("u"), F.lit(blocks)) == k).orderBy("u").collect()]


def search(
    docs: DataFrame, items: DataFrame, k: int = 20, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents with the highest score above 0 for each item, equal scores by ascending doc_id.

    A term's weight is floor(1000 ln((2N + 2) / (2df + 1))), N the documents with a term, df those holding it. A document's score sums over
    the item's terms, repeats included, weight * ((10^9 tf) div (1000 tf + 12 m)) with m = 75 + (25 n N) div L, n its terms and L those of all.
    All but the logarithm is in whole numbers.

    Null and empty texts have no terms; such items give no rows. Repeated rows and rows without id are documents and items of their
    own; a missing doc_id comes first among equal scores. An empty table gives no rows.

    Items go through in blocks of a bounded size, each against all documents: one pass counts the block's terms in every document, a second one
    grows a ball tree over every ``TREE`` documents and searches it, carrying each item's best from tree to tree, so that a task sends at
    most ``k`` rows per item. Nothing else is shuffled, so a hot source or a frequent term costs no more.
    """
    spark = docs.sparkSession
    keep_batches_small(spark)
    picked = docs.select(F.col(doc_id).cast("long").alias("d"), F.col(text).cast("string").alias("t"))
    schema = "item_id long, rank int, doc_id long, score long"
    found = None
    for block in item_blocks(items, item_id, item_text, block_chars):
        names: dict[bytes, int] = {}
        queries = [(i, [names.setdefault(t, len(names)) for t in terms(body)]) for i, body in block]
        queries = [(i, q) for i, q in queries if q]
        if not queries:
            continue
        part = _search_block(picked, queries, names, k)
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], schema) if found is None else found


def _search_block(picked: DataFrame, queries: list[tuple[int | None, list[int]]], names: dict[bytes, int], k: int) -> DataFrame:
    spark = picked.sparkSession
    sent_names = spark.sparkContext.broadcast(names)  # at most a block's text

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent_names.value
        for batch in small_batches(batches, "t", _TEXT_BYTES):
            lengths, places, times = [], [], []
            for body in utf8(batch.column("t")):
                words = terms(body)
                lengths.append(len(words))
                at = np.fromiter((p for p in map(known.get, words) if p is not None), np.int32)
                counts = np.bincount(at)
                held = np.flatnonzero(counts)
                places.append(held.astype(np.int32))
                times.append(counts[held])
            columns = [batch.column("d"), pa.array(lengths, pa.int64()), pa.array(places, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["d", "n", "places", "times"])

    counted = written(picked.mapInArrow(count, "d long, n long, places array<int>, times array<long>"), "terms")
    documents, length = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = np.zeros(len(names), np.int64)
    for row in counted.select(F.explode("places").alias("p")).groupBy("p").agg(F.count("*").alias("df")).collect():  # a row per term of the block
        holding[row.p] = row.df
    weights = np.array([weight(documents, int(df)) for df in holding], np.int64)
    sent = spark.sparkContext.broadcast(([q for _, q in queries], weights, holding))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights, holding = sent.value
        asked, best = Queries(items, weights, holding), Best(len(items), k)
        keys: list[int] = []
        rows = np.zeros((TREE, len(weights)), np.int64)
        for batch in batches:
            each = zip(*(batch.column(c).to_pylist() for c in ("d", "n")), batch.column("places"), batch.column("times"))
            for doc, n, places, times in each:
                tf = times.values.to_numpy()
                m = 75 + 25 * n * documents // length
                rows[len(keys), places.values.to_numpy()] = 1_000_000_000 * tf // (1000 * tf + 12 * m)
                keys.append(_NO_ID if doc is None else doc)
                if len(keys) == TREE:
                    search_tree(rows, keys, asked, best)
                    rows[:] = 0
                    keys = []
        if keys:
            search_tree(rows[: len(keys)], keys, asked, best)
        out = [(q, None if key == -_NO_ID else -key, score) for q, heap in enumerate(best.heaps) for score, key in heap]
        columns = list(zip(*out)) if out else [()] * 3
        kinds = (pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["q", "doc_id", "score"])

    best = counted.where("size(places) > 0").mapInArrow(find, "q int, doc_id long, score long")
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_first())
    top = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    ids = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(queries)], "q int, item_id long")
    return top.join(F.broadcast(ids), "q").select("item_id", "rank", "doc_id", "score")
