"""Token ids of documents packed into windows: repeat counts of length combinations by non-negative least squares."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm.common import keep_batches_small, small_batches, strings
from wattline.llm.tokenfiles import Encoder
from wattline.sources.scratch import written

WINDOW = 1024
_BATCH = 4 << 20  # bytes of text or ids worked on at a time
_JOINING = 128  # combinations that join the solution at once
_ROUNDS = 60
_GAIN = 0.01  # a round that lowers the squared error by a smaller share is the last

# ---- combinations and their repeat counts ----------------------------------


def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """All pairs and triples of these lengths (ascending, under ``window``) that fill a window, one per row, a pair with 0 in
    front. There are at most window / 2 pairs and window squared / 12 triples."""
    there = np.zeros(window + 1, bool)
    there[lengths] = True
    low = lengths[lengths <= window // 2]
    pairs = low[there[window - low]]
    found = [np.stack([np.zeros_like(pairs), pairs, window - pairs], 1)]
    for a in lengths[lengths <= window // 3]:
        b = lengths[(lengths >= a) & (lengths <= (window - a) // 2)]
        b = b[there[window - a - b]]
        found.append(np.stack([np.full_like(b, a), b, window - a - b], 1))
    return np.concatenate(found)


def solve(columns: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """x >= 0 that makes the lengths used by x repeats of each combination closest to the histogram ``wanted`` (by length, entry 0
    unused), in least squares.

    Active sets: the combinations with the largest gradient join, the set is solved exactly, combinations whose count falls
    below zero leave it, until the squared error stops falling. So hardly more counts than lengths are above zero.
    """
    size = len(wanted)
    x = np.zeros(len(columns))
    if not len(columns):
        return x
    target = wanted.astype(float)
    target[0] = 0

    def used(counts: np.ndarray) -> np.ndarray:
        out = np.zeros(size)
        for k in range(3):
            out += np.bincount(columns[:, k], counts, size)
        out[0] = 0
        return out

    passive, best = np.zeros(0, np.int64), float(target @ target)
    rest = target
    for _ in range(_ROUNDS):
        gain = rest[columns].sum(axis=1)
        gain[passive] = 0
        join = np.argsort(-gain, kind="stable")[:_JOINING]
        join = join[gain[join] > 1e-9 * (1 + target.max())]
        if not len(join):
            break
        passive = np.concatenate([passive, join])
        while len(passive):
            dense = np.zeros((size, len(passive)))
            for k in range(3):
                np.add.at(dense, (columns[passive, k], np.arange(len(passive))), 1)
            dense[0] = 0
            gram = dense.T @ dense
            gram[np.diag_indices_from(gram)] += 1e-9
            free = np.linalg.solve(gram, dense.T @ target)
            if (free >= 0).all():
                break
            passive = passive[free > 0]
        tried = np.zeros(len(columns))
        if len(passive):
            tried[passive] = free
        rest = target - used(tried)
        error = float(rest @ rest)
        if error >= best * (1 - _GAIN):
            break
        x, best = tried, error
    return x


@dataclass(frozen=True)
class Run:
    """Pieces alike: of the rests of length ``rest`` with numbers from ``first``, ``count`` in all, the ids [start, start + length)
    go to sequences from ``sequence`` on, one each, at ``offset``."""

    rest: int
    first: int
    count: int
    start: int
    length: int
    sequence: int
    offset: int


class _Stock:
    """Rests not yet packed, by length, as runs of (rest, start, first, count); a cut piece goes back as a shorter one."""

    def __init__(self, histogram: np.ndarray):
        self.left = histogram.astype(object)
        self.runs: list[list[list[int]]] = [[] for _ in histogram]
        for length, count in enumerate(histogram.tolist()):
            if length and count:
                self.runs[length].append([length, 0, 0, count])

    def take(self, length: int, count: int) -> list[tuple[int, int, int, int]]:
        """The next ``count`` pieces of this length."""
        self.left[length] -= count
        out, runs = [], self.runs[length]
        while count:
            rest, start, first, there = runs[-1]
            n = min(there, count)
            out.append((rest, start, first, n))
            runs[-1][2:] = [first + n, there - n]
            if there == n:
                runs.pop()
            count -= n
        return out

    def put(self, length: int, run: tuple[int, int, int, int]) -> None:
        self.left[length] += run[3]
        self.runs[length].append(list(run))


def plan(histogram: np.ndarray, window: int = WINDOW) -> tuple[list[Run], int]:
    """How rests of less than a window are packed, given the number of rests of each length (entry 0 unused): runs, and the number of
    sequences. Size and time depend on the window, not on the numbers.

    Combinations of two or three lengths that fill a window are repeated by the rounded least-squares counts. What is left is
    packed greedily: the longest rest, then the longest that fit; a gap that no whole rest fits is filled by a piece cut
    from a longer one. So every sequence but the last is full.
    """
    stock, runs, sequence = _Stock(histogram), [], 0

    def place(lengths: list[int], cut: tuple[int, int] | None, times: int) -> None:
        nonlocal sequence
        offset = 0
        for length in lengths:
            at = sequence
            for rest, start, first, n in stock.take(length, times):
                runs.append(Run(rest, first, n, start, length, at, offset))
                at += n
            offset += length
        if cut:
            length, part = cut
            at = sequence
            for rest, start, first, n in stock.take(length, times):
                runs.append(Run(rest, first, n, start, part, at, offset))
                stock.put(length - part, (rest, start + part, first, n))
                at += n
        sequence += times

    columns = combinations(np.flatnonzero(histogram), window)
    counts = solve(columns, histogram)
    chosen = np.flatnonzero(counts >= 0.5)
    for j in chosen[np.argsort(-counts[chosen], kind="stable")]:
        lengths = [int(v) for v in columns[j] if v]
        fits = min(stock.left[v] // lengths.count(v) for v in lengths)
        times = min(int(np.rint(counts[j])), int(fits))
        if times:
            place(lengths, None, times)

    while True:
        there = [v for v in range(window - 1, 0, -1) if stock.left[v]]  # longest first
        if not there:
            return runs, sequence
        lengths: list[int] = []
        gap, cut = window, None
        for v in there:
            while v <= gap and stock.left[v] > lengths.count(v):
                lengths.append(v)
                gap -= v
        if gap:
            longer = next((v for v in there if v > gap and stock.left[v] > lengths.count(v)), None)
            cut = (longer, gap) if longer else None
        uses = {v: lengths.count(v) + (cut is not None and cut[0] == v) for v in {*lengths, *([cut[0]] if cut else [])}}
        place(lengths, cut, int(min(stock.left[v] // n for v, n in uses.items())))


class _Places:
    """The runs of a plan, found by rest and number."""

    def __init__(self, runs: list[Run], window: int):
        by_rest: list[list[Run]] = [[] for _ in range(window)]
        for run in runs:
            by_rest[run.rest].append(run)
        self.breaks: list[np.ndarray] = []
        self.parts: list[list[list[Run]]] = []
        for mine in by_rest:
            breaks = sorted({b for r in mine for b in (r.first, r.first + r.count)})
            at = {b: i for i, b in enumerate(breaks)}
            parts: list[list[Run]] = [[] for _ in breaks]
            for run in sorted(mine, key=lambda r: r.start):
                for i in range(at[run.first], at[run.first + run.count]):
                    parts[i].append(run)
            self.breaks.append(np.array(breaks, np.int64))
            self.parts.append(parts)

    def of(self, rest: int, number: int) -> list[tuple[int, int, int, int]]:
        """(start, length, sequence, offset) of the pieces of one rest."""
        i = int(np.searchsorted(self.breaks[rest], number, side="right")) - 1
        return [(r.start, r.length, r.sequence + number - r.first, r.offset) for r in self.parts[rest][i]]


# ---- on Spark --------------------------------------------------------------


@cache
def _encoder(path: str) -> Encoder:
    return Encoder(path, names_are_text=False)  # as the library encodes by default


def encoded(docs: DataFrame, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc_id, part, n, full, rest, number, ids): the ids of each text and then ``end_id`` as little-endian 32-bit integers, n of them; full is
    the number of whole windows of the rows before it in its part, rest the ids beyond its own whole windows, number
    counts the rows before it in its part with the same rest. Written as it is computed, so a part is what one task wrote."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, full, seen = _encoder(tokenizer), TaskContext.get().partitionId(), 0, np.zeros(window, np.int64)
        for batch in small_batches(batches, "t", _BATCH):
            ids = [x + end for x in encoder.encode(strings(batch.column("t")))]
            n = np.array([len(x) // 4 for x in ids], np.int64)
            whole, rest = n // window, n % window
            fulls = full + np.cumsum(whole) - whole
            full += int(whole.sum())
            numbers = np.zeros(len(n), np.int64)
            for i, r in enumerate(rest.tolist()):
                numbers[i] = seen[r]
                seen[r] += 1
            columns = [batch.column("d"), pa.array(np.full(len(n), part, np.int64)), pa.array(n), pa.array(fulls), pa.array(rest), pa.array(numbers), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "n", "full", "rest", "number", "ids"])

    keep_batches_small(docs.sparkSession)
    picked = docs.select(F.col(doc_id).cast("long").alias("d"), F.col(text).cast("string").alias("t"))
    return written(picked.mapInArrow(run, "doc_id long, part long, n long, full long, rest long, number long, ids binary"), "encoded")


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int = 0, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, digests: bool = False
) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset): the ids of every text, closed by ``end_id``, packed into sequences of
    ``window`` ids, all of which but one are full; one row per piece. With ``digests`` ids_crc32 (of the ids as little-endian 32-bit
    integers) in place of ids. start counts the document's ids before the piece, offset the ids before it in its sequence.

    A document's whole windows are sequences of their own; its rest of less than a window is packed by ``plan`` from the histogram of rests,
    one number per length, which is all that reaches the driver. Null and empty texts hold the end id only. Repeated rows and rows
    without id are documents of their own. An empty table gives no rows. Sequence ids are gapless from 0.

    A task numbers its rests of each length as it encodes, so a length that a third of all documents share needs no group: a rest's number in all is
    its number in its part and the sum over the parts before.
    """
    coded = encoded(docs, tokenizer, end_id, doc_id, text, window)
    spark = docs.sparkSession
    counted = written(coded.groupBy("part", "rest").agg(F.count("*").alias("c"), F.sum(F.expr(f"n div {window}")).alias("w")), "counted")
    histogram = np.zeros(window, np.int64)
    for row in counted.where("rest > 0").groupBy("rest").agg(F.sum("c").alias("c")).collect():  # fewer rows than a window has ids
        histogram[row.rest] = row.c
    runs, used = plan(histogram, window)

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per written part
    fulls = counted.groupBy("part").agg(F.sum("w").alias("w")).select("part", F.coalesce(F.sum("w").over(before), F.lit(0)).alias("full_base"))
    numbers = counted.select("part", "rest", F.coalesce(F.sum("c").over(before.partitionBy("rest")), F.lit(0)).alias("base"))
    # a number per length and part: what a task needs to number its part's rests among all
    bases = numbers.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("rest", "base"))).alias("bases"))
    bases = written(bases.join(fulls, "part"), "bases")
    plan_sent = spark.sparkContext.broadcast(runs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = _Places(plan_sent.value, window)
        for batch in small_batches(batches, "ids", _BATCH):
            rows, ids_out = [], []
            at = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "first", "rest", "at", "ids")))
            for doc, n, first, rest, number, ids in at:
                pieces = [(w * window, window, used + first + w, 0) for w in range(n // window)]
                if rest:
                    whole = n - rest
                    pieces += [(whole + s, length, sequence, offset) for s, length, sequence, offset in places.of(rest, number)]
                for start, length, sequence, offset in pieces:
                    rows.append((doc, start, length, n, sequence, offset))
                    ids_out.append(ids[4 * start : 4 * (start + length)])
            columns = list(zip(*rows)) if rows else [()] * 6
            doc, start, length, n, sequence, offset = (pa.array(c, pa.int64()) for c in columns)
            if digests:
                last = pa.array([zlib.crc32(x) for x in ids_out], pa.int64())
            else:
                last = pa.array([np.frombuffer(x, "<u4").astype(np.int64) for x in ids_out], pa.list_(pa.int64()))
            names = ["doc_id", "start", "length", "ids_crc32" if digests else "ids", "doc_tokens", "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([doc, start, length, last, n, sequence, offset], names=names)

    numbered = coded.join(bases, "part").select(
        "doc_id", "n", (F.col("full") + F.col("full_base")).alias("first"), "rest", (F.col("number") + F.col("bases")[F.col("rest")]).alias("at"), "ids"
    )
    ids_type = "ids_crc32 long" if digests else "ids array<long>"
    return numbered.mapInArrow(run, f"doc_id long, start long, length long, {ids_type}, doc_tokens long, sequence_id long, offset long")
