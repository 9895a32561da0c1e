"""Benchmark passages in documents, found by pigeonhole pieces and verified with bit-parallel edit distance."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import keep_batches_small, small_batches, strings

RATE = 0.1  # edits allowed per character of a test item
BLOCK_CHARS = 4_000_000  # test-item characters held by one pass over the documents


def normal(text: str) -> str:
    """Lower case, white space runs as one space, trimmed."""
    return " ".join(text.lower().split())


def places(text: str) -> list[int]:
    """For each character of ``normal(text)`` and its end, the place in ``text`` it comes from."""
    out, gap = [], -1
    for i, c in enumerate(text):
        if c.isspace():
            gap = i if gap < 0 else gap
            continue
        if gap >= 0 and out:
            out.append(gap)
        gap = -1
        out += [i] * len(c.lower())
    return [*out, len(text.rstrip())]


class Masks:
    """A pattern's match masks for the bit-parallel recurrence."""

    def __init__(self, pattern: str):
        self.size, self.masks = len(pattern), {}
        for i, c in enumerate(pattern):
            self.masks[c] = self.masks.get(c, 0) | 1 << i

    def best(self, text: str, budget: int) -> tuple[int, int] | None:
        """(distance, end) of the best place at which some piece of ``text`` ends within ``budget`` edits of the
        pattern, the earliest of the best; None if there is none."""
        size, masks = self.size, self.masks
        full, top = (1 << size) - 1, 1 << size - 1
        up, down, score, found = full, 0, size, None
        for at, c in enumerate(text):
            same = masks.get(c, 0)
            diagonal = (((same & up) + up) ^ up) | same | down
            rise, fall = down | ~(diagonal | up) & full, up & diagonal
            if rise & top:
                score += 1
            elif fall & top:
                score -= 1
            rise, fall = rise << 1 & full, fall << 1 & full  # no carry into row one: the text may start anywhere
            up, down = fall | ~(diagonal | rise) & full, rise & diagonal
            if score <= budget:
                found, budget = (score, at + 1), score - 1
                if not score:
                    break
        return found


@dataclass
class Node:
    """A part of an item and the edits allowed in it; one of two halves always fits half the budget."""

    start: int
    masks: Masks
    budget: int
    parent: Node | None


class Matcher:
    """Items cut, by halving the error budget, into budget + 1 pieces; a hit of a piece climbs back to the item
    and is given up at the first larger part that does not fit its own budget."""

    def __init__(self, items: list[tuple[int, str]], rate: float = RATE):
        self.items, pieces = [(i, normal(t)) for i, t in items if t], {}
        for number, (_, text) in enumerate(self.items):
            if text:
                self._cut(text, 0, len(text), min(int(rate * len(text)), len(text) - 1), None, number, pieces)
        self.automaton = ahocorasick.Automaton()
        for piece, places_ in pieces.items():
            self.automaton.add_word(piece, (len(piece), places_))
        if pieces:
            self.automaton.make_automaton()
        self.empty = not pieces

    def _cut(self, text, start, end, budget, parent, number, pieces) -> None:
        node = Node(start, Masks(text[start:end]), budget, parent)
        if not budget:
            pieces.setdefault(text[start:end], []).append((number, node))
            return
        left = (budget - 1) // 2
        right = budget - 1 - left
        middle = start + max(left + 1, min(end - start - right - 1, round((end - start) * (left + 1) / (budget + 1))))
        self._cut(text, start, middle, left, node, number, pieces)
        self._cut(text, middle, end, right, node, number, pieces)

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item_id, start, end, distance) in the normalised text, one row per separate region of an item."""
        if self.empty or not text:
            return []
        done: dict[int, list[tuple[int, int, int]]] = {}
        for last, (length, owners) in self.automaton.iter(text):
            hit = last + 1 - length
            for number, leaf in owners:
                node, fits, origin = leaf, None, hit - leaf.start
                regions = done.get(number, ())
                if any(a <= hit and last < b for a, b, _ in regions):
                    continue
                fits = (0, last + 1)
                while node.parent and fits:
                    node = node.parent
                    low = max(0, origin + node.start - node.budget)
                    high = origin + node.start + node.masks.size + node.budget
                    fits = node.masks.best(text[low:high], node.budget)
                    if fits:
                        fits = (fits[0], low + fits[1])
                if fits:
                    start = self._start(self.items[number][1], text, fits[1], fits[0])
                    done.setdefault(number, []).append((start, fits[1], fits[0]))
        return [(self.items[n][0], *r) for n, regions in done.items() for r in _separate(regions)]

    def any(self, text: str) -> bool:
        return bool(self.find(text))

    @staticmethod
    def _start(item: str, text: str, end: int, distance: int) -> int:
        """Where the match ends when read backwards from its end."""
        back = text[max(0, end - len(item) - distance) : end][::-1]
        # anchored at the end: of all starts within the distance, the one nearest to the item's length
        return max(0, end - _anchored(item[::-1], back, distance))


def _anchored(pattern: str, text: str, distance: int) -> int:
    """Length of the prefix of ``text`` at the given edit distance from the whole pattern (the nearest in length)."""
    row = list(range(len(text) + 1))
    for i, c in enumerate(pattern, 1):
        before, row = row, [i] + [0] * len(text)
        low, high = max(1, i - distance), min(len(text), i + distance)
        if low > 1:
            row[low - 1] = distance + 1
        for j in range(low, high + 1):
            row[j] = min(before[j - 1] + (c != text[j - 1]), before[j] + 1, row[j - 1] + 1)
        if high < len(text):
            row[high + 1] = distance + 1
    size = len(pattern)
    ends = [j for j in range(max(0, size - distance), len(text) + 1) if row[j] <= distance]
    return min(ends, key=lambda j: (row[j], abs(j - size), j), default=min(size, len(text)))


def _separate(regions: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of overlapping regions the one with the least distance, then the first."""
    kept: list[tuple[int, int, int]] = []
    for a, b, d in sorted(regions, key=lambda r: (r[2], r[0], r[1])):
        if all(b <= x or y <= a for x, y, _ in kept):
            kept.append((a, b, d))
    return sorted(kept)


def item_blocks(items: DataFrame, item_id: str, text: str, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The test items in blocks of about ``block_chars`` characters, one at a time on the driver."""
    rows = items.select(F.col(item_id).cast("long").alias("i"), F.col(text).cast("string").alias("t")).where("length(t) > 0")
    total = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = max(1, -(-total // block_chars))
    for k in range(blocks):
        yield [(r.i, r.t) for r in rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k).distinct().orderBy("i", "t").collect()]


def matches(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    rate: float = RATE, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(doc_id, item_id, start, end, distance): where a document holds a test item within ``rate`` edits per
    character of the item, letter case and white space aside; start and end count code points of the text.

    One row per separate place; of overlapping ones of an item the closest. Null or empty texts and items match
    nothing, repeated rows give repeated matches, empty tables none. Items go through in blocks of a bounded
    size, each against all documents, so nothing is shuffled and a hot source or a popular item costs no more.
    """
    keep_batches_small(docs.sparkSession)
    schema = "doc_id long, item_id long, start int, end int, distance int"
    picked = docs.select(F.col(doc_id).cast("long").alias("d"), F.col(text).cast("string").alias("t"))
    found = None
    for block in item_blocks(items, item_id, item_text, block_chars):

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(block, rate)
            for batch in small_batches(batches, "t", 8 << 20):
                rows = []
                for d, t in zip(batch.column("d").to_pylist(), strings(batch.column("t"))):
                    if hits := matcher.find(normal(t)):
                        at = places(t)
                        rows += [(d, i, at[a], at[b - 1] + 1, e) for i, a, b, e in hits]
                columns = list(zip(*rows)) if rows else [()] * 5
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
                names = ["doc_id", "item_id", "start", "end", "distance"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        part = picked.mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    return found


def clean(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", rate: float = RATE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The documents, all columns as they are, that hold no test item."""
    keep_batches_small(docs.sparkSession)
    schema = docs.schema
    for block in item_blocks(items, item_id, item_text, block_chars):

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(block, rate)
            for batch in small_batches(batches, text, 8 << 20):
                yield batch.filter(pa.array([not matcher.any(normal(t)) for t in strings(batch.column(text))], pa.bool_()))

        docs = docs.mapInArrow(run, schema)
    return docs
