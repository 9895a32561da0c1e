"""Bytes covered by strings that occur twice, by suffix sorting of the neighbourhoods of shared anchors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import keep_batches_small, row_key, small_batches, utf8
from wattline.sources.scratch import written

LENGTH = 200  # bytes of a repeated string
ANCHOR = 64  # bytes of an anchor: of all anchors inside a string the one with the least hash stands for it
_BLOCK = 1 << 20


class _Group:
    """Suffixes with the same Lyndon prefix as far as it is known. Members that moved on stay listed, but
    are no longer of ``size`` nor owned."""

    __slots__ = ("members", "size", "above", "below", "done", "at")

    def __init__(self, members: list[int]):
        self.members, self.size, self.above, self.below, self.done, self.at = members, len(members), None, None, False, 0


def suffix_array(symbols: list[int]) -> list[int]:
    """Start places of the suffixes in ascending order (a prefix of another comes first).

    Groups of suffixes, first by symbol, are taken from the highest down. Each member points to the last place before
    it in a lower group (places between were taken already, so their own pointers are followed). Members of
    a lower group that are pointed to move to a new group just above it, the higher the more often, since their Lyndon
    prefix goes on with that many copies of the group's. In the end every group's order follows from one pass
    upwards through the sorted suffixes along the same pointers; no symbols are renamed and nothing recurs.
    """
    n = len(symbols)
    by_symbol: dict[int, list[int]] = {}
    for i, s in enumerate(symbols):
        by_symbol.setdefault(s, []).append(i)
    bottom = _Group([n])  # the end of the text, lower than any symbol
    top, group = bottom, [bottom] * (n + 1)
    for s in sorted(by_symbol):
        fresh = _Group(by_symbol[s])
        fresh.below, top.above = top, fresh
        top = fresh
        for i in fresh.members:
            group[i] = fresh
    previous = [-1] * (n + 1)
    current = top
    while current is not bottom:
        current.done = True  # also while it is being taken: its own members are not lower than itself
        times: dict[int, int] = {}
        for i in current.members:  # in ascending order
            if group[i] is not current:
                continue
            p = i - 1
            while p >= 0 and group[p].done:
                p = previous[p]
            previous[i] = p
            if p >= 0:
                times[p] = times.get(p, 0) + 1
        if times:
            levels: dict[int, dict[int, list[int]]] = {}
            for p, count in times.items():
                levels.setdefault(count, {}).setdefault(id(group[p]), []).append(p)
            for count in sorted(levels, reverse=True):
                for moved in levels[count].values():
                    old = group[moved[0]]
                    moved.sort()
                    if len(moved) == old.size:
                        continue
                    fresh = _Group(moved)
                    old.size -= len(moved)
                    fresh.above, fresh.below = old.above, old
                    old.above.below = fresh
                    old.above = fresh
                    for i in moved:
                        group[i] = fresh
        current = current.below
    at, walk = 0, bottom
    while walk is not None:
        walk.at = at
        at += walk.size
        walk = walk.above
    order, placed = [-1] * (n + 1), [False] * (n + 1)
    order[0], placed[n] = n, True
    for k in range(n + 1):
        s = order[k] - 1
        while s >= 0 and not placed[s]:
            order[group[s].at], placed[s] = s, True
            group[s].at += 1
            s = previous[s]
    return order[1:]


def common_prefixes(symbols: list[int], order: list[int]) -> list[int]:
    """Symbols that each suffix in order shares with the one before it (0 for the first)."""
    n, rank, out, held = len(symbols), [0] * len(symbols), [0] * len(symbols), 0
    for r, i in enumerate(order):
        rank[i] = r
    for i in range(n):
        if not rank[i]:
            held = 0
            continue
        j = order[rank[i] - 1]
        while i + held < n and j + held < n and symbols[i + held] == symbols[j + held]:
            held += 1
        out[rank[i]] = held
        held = max(0, held - 1)
    return out


def _cuts(parts: list[bytes]) -> tuple[list[int], list[int]]:
    """For strings read from their start: all lengths at which two of them part, and for each string the longest that it
    shares with any other."""
    order = sorted(range(len(parts)), key=parts.__getitem__)
    most, lengths = [0] * len(parts), set()
    for i, j in zip(order, order[1:]):
        a, b = parts[i], parts[j]
        low, high = 0, min(len(a), len(b))
        while low < high:
            middle = (low + high + 1) // 2
            if a[:middle] == b[:middle]:
                low = middle
            else:
                high = middle - 1
        lengths.add(low)
        most[i], most[j] = max(most[i], low), max(most[j], low)
    return sorted(lengths), most


def shared_spans(contexts: list[tuple[int, bytes]], length: int = LENGTH, anchor: int = ANCHOR) -> list[list[tuple[int, int]]]:
    """For each neighbourhood (place of the anchor in it, bytes) of one anchor, the stretches of at least ``length`` bytes
    that another one holds too, as offsets from the anchor.

    Between two lengths at which any of them part, neighbourhoods agree or not as a whole, so each such stretch
    is one symbol; what lies beyond all that is shared is left out. The suffixes of all neighbourhoods are sorted
    together, and what a suffix shares with its neighbours in that order is the most it shares with any.
    """
    lefts, rights = [d[:at][::-1] for at, d in contexts], [d[at + anchor :] for at, d in contexts]
    (left_cuts, left_most), (right_cuts, right_most) = _cuts(lefts), _cuts(rights)
    kinds: dict[bytes, int] = {}
    texts: dict[tuple, list[int]] = {}
    for n, (left, right, lm, rm) in enumerate(zip(lefts, rights, left_most, right_most)):
        bounds = [0, *(c for c in left_cuts if 0 < c <= lm)]
        pieces = [left[a:b][::-1] for a, b in zip(bounds, bounds[1:])][::-1]
        bounds = [0, *(c for c in right_cuts if 0 < c <= rm)]
        after = [right[a:b] for a, b in zip(bounds, bounds[1:])]
        sizes = (*map(len, pieces), anchor, *map(len, after))
        if sum(sizes) >= length:
            # symbol 0 is the anchor, which all have
            key = (*(kinds.setdefault(p, len(kinds) + 1) for p in pieces), 0, *(kinds.setdefault(p, len(kinds) + 1) for p in after))
            texts.setdefault((key, sizes, lm), []).append(n)
    symbols, weights, starts = [], [], []
    for mark, (key, sizes, _) in enumerate(texts):
        starts.append(len(symbols))
        symbols += [*key, len(kinds) + 1 + mark]  # a separator of its own ends each
        weights += [*sizes, 0]
    found: list[list[tuple[int, int]]] = [[] for _ in contexts]
    if not symbols:
        return found
    order = suffix_array(symbols)
    common = common_prefixes(symbols, order)
    cover = np.concatenate([[0], np.cumsum(weights)])
    best = [0] * len(symbols)
    for r, i in enumerate(order):
        best[i] = max(common[r], common[r + 1] if r + 1 < len(order) else 0)
    for start, ((key, sizes, lm), owners) in zip(starts, texts.items()):
        first, spans = int(cover[start]) + sum(sizes[: key.index(0)]), []
        if len(owners) > 1:
            spans.append((-sum(sizes[: key.index(0)]), int(sum(sizes)) - sum(sizes[: key.index(0)])))
        else:
            for i in range(start, start + len(key)):
                a, b = int(cover[i]), int(cover[i + best[i]])
                if b - a >= length:
                    spans.append((a - first, b - first))
        for n in owners:
            found[n] = _merged(spans)
    return found


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def anchors(data: bytes, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of the anchors that stand for all strings of ``length`` bytes: of the ``anchor``-byte strings inside
    each the one with the least hash, the first on ties. Equal strings have equal anchors at the same place."""
    window = length - anchor + 1
    hashes, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for low in range(0, len(data) - length + 1, _BLOCK):
        block = np.frombuffer(data[low : low + _BLOCK + length - 1], np.uint8).astype(np.uint64)
        mixed, size = (block + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15), 1
        mixed ^= mixed >> np.uint64(29)
        while size < anchor:  # the hash of twice as many bytes from two halves
            mixed = mixed[:-size] * np.uint64(0xBF58476D1CE4E5B9) + mixed[size:]
            mixed ^= mixed >> np.uint64(31)
            mixed *= np.uint64(0x94D049BB133111EB)
            size *= 2
        least, size = mixed, 1
        while 2 * size <= window:
            least, size = np.minimum(least[:-size], least[size:]), 2 * size
        count = len(mixed) - window + 1
        least = np.minimum(least[:count], least[window - size : window - size + count])
        # a place is an anchor if it holds the least of some window, and no earlier place of the window does
        last = np.flatnonzero(np.concatenate([least[1:] != least[:-1], [True]]))  # where runs of equal minima end
        runs = np.concatenate([[0], last[:-1] + 1])
        found = []
        for a, b in zip(runs.tolist(), last.tolist()):
            at = a + int((mixed[a : a + window] == least[a]).argmax())
            found.append(at)
            while at < b:  # equal anchors may follow each other inside one run of windows
                more = mixed[at + 1 : b + window] == least[a]
                step = int(more.argmax())
                if not more[step]:
                    break
                at += 1 + step
                found.append(at)
        at = np.unique(np.array(found, np.int64))
        hashes.append(mixed[at].view(np.int64)), places.append(at + low)
    return np.concatenate(hashes), np.concatenate(places)


def _anchor_rows(batches: Iterator[pa.RecordBatch], length: int, anchor: int) -> Iterator[pa.RecordBatch]:
    """Anchors with a hash of the bytes around them, within reach of a string that holds them."""
    reach = length - anchor
    for batch in small_batches(batches, "t", 4 << 20):
        hashes, places, keys, around, left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [], [], []
        for k, data in zip(batch.column("k").to_pylist(), utf8(batch.column("t"))):
            h, p = anchors(data, length, anchor)
            hashes.append(h), places.append(p), keys.append(np.full(len(h), k, np.int64))
            for at in p.tolist():
                low, high = max(0, at - reach), min(len(data), at + length)
                around.append(xxhash.xxh64_intdigest(data[low:high], at - low))
                left.append(at - low), right.append(high - at)
        columns = [pa.array(np.concatenate(c)) for c in (hashes, keys, places)]
        columns += [pa.array(np.array(around, np.uint64).view(np.int64)), pa.array(left, pa.int32()), pa.array(right, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, names=["h", "k", "p", "c", "l", "r"])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "t", 16 << 20):
        rows = [batch.column(c).to_pylist() for c in ("p", "l", "r")]
        data = [t[p - l : p + r] for t, p, l, r in zip(utf8(batch.column("t")), *rows)]
        yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("c"), batch.column("l"), pa.array(data, pa.binary())], names=["h", "c", "l", "data"])


def _compared(batches: Iterator[pa.RecordBatch], length: int, anchor: int) -> Iterator[pa.RecordBatch]:
    """Shared stretches of each anchor's different neighbourhoods; rows come sorted by anchor."""

    def out(rows: list) -> list:
        found = shared_spans([(l, data) for _, _, l, data in rows], length, anchor)
        return [(h, c, a, b) for (h, c, _, _), spans in zip(rows, found) for a, b in spans]

    held: list = []
    for batch in batches:
        done = []
        for row in zip(*(batch.column(c).to_pylist() for c in ("h", "c", "l", "data"))):
            if held and held[0][0] != row[0]:
                done += out(held)
                held = []
            held.append(row)
        yield _span_batch(done)
    yield _span_batch(out(held) if held else [])


def _span_batch(rows: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 4
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["h", "c", "a", "b"])


def _cut_rows(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "t", 16 << 20):
        sizes, gone, runs, kept, spans = [], [], [], [], []
        for data, found in zip(utf8(batch.column("t")), batch.column("spans").to_pylist()):
            merged = _merged([(s["a"], s["b"]) for s in found or ()])
            parts, at = [], 0
            for a, b in merged:
                parts.append(data[at:a])
                at = b
            rest = b"".join([*parts, data[at:]])
            sizes.append(len(data)), gone.append(len(data) - len(rest)), runs.append(len(merged))
            kept.append(rest if with_text else hashlib.sha256(rest).hexdigest()), spans.append([{"start": a, "end": b} for a, b in merged])
        columns = [batch.column("d"), *(pa.array(c, pa.int64()) for c in (sizes, gone, runs))]
        if with_text:
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            columns += [pa.array(kept, pa.binary()), pa.array(spans, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "spans"])
        else:
            yield pa.RecordBatch.from_arrays([*columns, pa.array(kept, pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, anchor: int = ANCHOR, digests: bool = False
) -> DataFrame:
    """Every text without the bytes that lie in a string of ``length`` bytes which starts anywhere else too:
    (doc_id, n_bytes, n_removed, n_spans, kept, spans), or with ``digests`` kept_sha256 in place of the last two.

    Texts are UTF-8 bytes and matches never cross texts; what is left may not be UTF-8, so ``kept`` is binary. Rows
    that repeat id and text count as often as they occur; null texts are empty; an empty table gives no rows.

    Every such string holds an anchor, and equal strings the same at the same place, so only anchors that occur twice
    matter. Equal neighbourhoods of an anchor are counted, not listed: a neighbourhood that occurs twice is
    repeated as a whole, and only the different ones of an anchor (at most ``2 * length`` bytes each) are sorted.
    """
    keep_batches_small(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("d"), F.col(text).cast("string").alias("t")).withColumn("k", row_key("d", "t"))
    found = rows.where(F.octet_length("t") >= length).select("k", "t").mapInArrow(
        lambda it: _anchor_rows(it, length, anchor), "h long, k long, p long, c long, l int, r int"
    )
    found = written(found, "anchors")
    # counts combine before their shuffle, and the join may split an anchor that very many texts share
    twice = found.groupBy("h").agg(F.count("*").alias("n"), (F.min("c") != F.max("c")).alias("differ")).where("n > 1")
    hits = written(found.join(twice.select("h", "differ").hint("merge"), "h"), "hits")
    kinds = hits.groupBy("h", "c").agg(F.count("*").alias("n"), F.first("differ").alias("differ"), F.min(F.struct("k", "p", "l", "r")).alias("one"))
    kinds = written(kinds.select("h", "c", "n", "differ", "one.*"), "neighbourhoods")
    some = kinds.where("differ").select("h", "c", "k", "p", "l", "r")
    texts = rows.select("k", "t").join(some.select("k").distinct(), "k", "left_semi").dropDuplicates(["k"])
    fetched = texts.join(some, "k").mapInArrow(_contexts, "h long, c long, l int, data binary")
    fetched = fetched.repartition("h").sortWithinPartitions("h", "c")
    part = fetched.mapInArrow(lambda it: _compared(it, length, anchor), "h long, c long, a int, b int")
    whole = kinds.where(F.col("n") > 1).select("h", "c", (-F.col("l")).alias("a"), F.col("r").alias("b")).where(F.col("b") - F.col("a") >= length)
    repeated = written(part.union(whole), "repeated")
    spans = hits.join(repeated, ["h", "c"]).select("k", (F.col("p") + F.col("a")).alias("a"), (F.col("p") + F.col("b")).alias("b"))
    spans = spans.groupBy("k").agg(F.collect_set(F.struct("a", "b")).alias("spans"))  # bounded by the text
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, " + (
        "kept_sha256 string" if digests else "kept binary, spans array<struct<start:long,end:long>>"
    )
    return rows.join(spans, "k", "left").select("d", "t", "spans").mapInArrow(lambda it: _cut_rows(it, not digests), schema)
