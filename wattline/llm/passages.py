"""Repeated passages, also fuzzy ones: shared word seeds, collinear chains, alignment of each chain."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import keep_batches_small, row_key, small_batches, utf8
from wattline.sources.scratch import written

SHINGLE = 5  # words of a seed
MIN_WORDS = 50
SIMILARITY = 0.8
LEAST_SPAN = SHINGLE + 3  # words that a chain's seeds span at least: as many as cross a border of two pieces
GAP_COST = 0.04  # per word skipped on either side; a seed is worth SHINGLE
BUCKET_BITS = 6  # seeds and ties are shuffled in so many bits' buckets, each of cells that a task holds one at a time
CELL = 3_000_000  # seeds of a cell, about
WORD_BYTES = 6  # of a text per seed, about
BLOCK_BYTES = 16 << 20  # of the texts whose seeds are packed together
MARGIN = 64  # words beside a chain that the alignment may extend into
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93], np.uint64)
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def seeds(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of the seeds of a text, one per place."""
    count = len(words) - SHINGLE + 1
    if count < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    each = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    mixed = np.zeros(count, np.uint64)
    for j in range(SHINGLE):
        mixed += each[j : j + count] * _MIX[j]
    mixed ^= mixed >> np.uint64(32)
    mixed *= _MIX[0]
    mixed ^= mixed >> np.uint64(29)
    return mixed.view(np.int64), np.arange(count)


def _packed(*columns: np.ndarray) -> bytes:
    """Columns byte by byte, each byte's plane compressed for itself: high bytes that say little take little room."""
    codec, parts = pa.Codec("zstd", 1), []
    for column in columns:
        planes = np.ascontiguousarray(column.view(np.uint8).reshape(len(column), column.itemsize).T)
        data = [codec.compress(plane.tobytes(), asbytes=True) for plane in planes]
        parts += [np.array([len(column), *map(len, data)], np.uint32).tobytes(), *data]
    return b"".join(parts)


def _unpacked(data: bytes, *kinds: type) -> list[np.ndarray]:
    codec, columns, at = pa.Codec("zstd", 1), [], 0
    for kind in map(np.dtype, kinds):
        n, *sizes = np.frombuffer(data, np.uint32, 1 + kind.itemsize, at).tolist()
        at += 4 * (1 + kind.itemsize)
        planes = np.empty((kind.itemsize, n), np.uint8)
        for plane, size in zip(planes, sizes):
            plane[:] = np.frombuffer(codec.decompress(data[at : at + size], n), np.uint8)
            at += size
        columns.append(np.ascontiguousarray(planes.T).view(kind).ravel())
    return columns


def _by_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[int, bytes]]]]:
    """(cell, its (block, data)) of rows that come sorted by cell within their bucket."""
    cell, held = None, []
    for batch in batches:
        for c, block, data in zip(*(batch.column(x).to_pylist() for x in ("cell", "block", "data"))):
            if c != cell and held:
                yield cell, held
                held = []
            cell = c
            held.append((block, data))
    if held:
        yield cell, held


def _cell_rows(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 4
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["bucket", "cell", "block", "data"])


def _cuts(cells: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(cell, start, end) of each run of equal numbers."""
    bounds = np.concatenate([[0], np.flatnonzero(cells[1:] != cells[:-1]) + 1, [len(cells)]])
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if a < b:
            yield int(cells[a]), a, b


def _seed_blocks(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """The seeds of a block of texts, sorted and packed by cell, the first ``bits`` bits of their hash. Each bucket of cells also gets the
    keys of the texts that its seeds name by number."""
    keys: list[int] = []
    hashes: list[np.ndarray] = []
    size = 0

    def block() -> pa.RecordBatch:
        h, counts = np.concatenate(hashes).view(np.uint64), np.array([len(x) for x in hashes])
        doc = np.repeat(np.arange(len(counts), dtype=np.uint32), counts)
        place = (np.arange(len(h)) - np.repeat(np.cumsum(counts) - counts, counts)).astype(np.uint32)
        order = np.argsort(h)
        h, doc, place = h[order], doc[order], place[order]
        rows = []
        for bucket, a, b in _cuts(h >> np.uint64(64 - BUCKET_BITS)):
            there, doc[a:b] = np.unique(doc[a:b], return_inverse=True)
            names = np.array(keys, np.int64)[there].tobytes()
            number = xxhash.xxh64_intdigest(names) - (1 << 63)  # equal numbers name equal keys
            rows.append((bucket, -1, number, names))
            for cell, c, d in _cuts(h[a:b] >> np.uint64(64 - bits)):
                c, d = a + c, a + d
                rows.append((bucket, cell, number, _packed(np.diff(h[c:d], prepend=np.uint64(0)), doc[c:d], place[c:d])))
        return _cell_rows(rows)

    for batch in batches:
        for part in small_batches([batch], "t", 4 << 20):
            for k, t in zip(part.column("k").to_pylist(), utf8(part.column("t"))):
                keys.append(k)
                hashes.append(seeds(t.lower().split())[0])
                size += len(t)
            if size >= BLOCK_BYTES:
                yield block()
                keys, hashes, size = [], [], 0
    if keys:
        yield block()


def _ties(h: np.ndarray, k: np.ndarray, p: np.ndarray) -> np.ndarray:
    """(text, earlier text, place, earlier place) of seeds: across texts each is tied to the first text that has it, inside a text to its first
    place in the text. Across texts it is also tied to the text before it, as the first may hold a part of the passage only."""
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    order = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]
    h, k, p = h[order], k[order], p[order]
    order = np.lexsort((p, k, h))
    h, k, p = h[order], k[order], p[order]
    new = np.ones((2, len(h)), bool)  # another seed, another seed or text
    new[0, 1:] = h[1:] != h[:-1]
    new[1, 1:] = new[0, 1:] | (k[1:] != k[:-1])
    repeats = ~new[1]
    repeats[1:] &= p[1:] == p[:-1]  # rows that repeat are one document
    at = np.arange(len(h))
    first, own = (np.maximum.accumulate(np.where(n, at, 0)) for n in new)
    later = at[~new[1] & ~repeats]
    pairs = [np.stack([later, own[later]])]
    heads = at[new[1]]
    other = ~new[0][heads]
    pairs.append(np.stack([heads[other], first[heads[other]]]))
    before = np.concatenate([[0], heads])[:-1][: len(heads)]
    other &= before != first[heads]
    pairs.append(np.stack([heads[other], before[other]]))
    a, b = np.concatenate(pairs, axis=1)
    return np.stack([k[a], k[b], p[a].astype(np.int64), p[b].astype(np.int64)])


def _tie_blocks(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Ties of each cell's seeds, packed by the cell of their pair of texts. A cell is held whole; all places of one seed lie in one."""
    names: dict[int, np.ndarray] = {}
    held: list[np.ndarray] = []

    def block() -> pa.RecordBatch:
        k, rk, p, rp = np.concatenate(held, axis=1)
        held.clear()
        mixed = (k.view(np.uint64) ^ (rk.view(np.uint64) * _MIX[1])) * _MIX[0]
        order = np.lexsort((p, rk, k, mixed))
        k, rk, p, rp, mixed = k[order], rk[order], p[order], rp[order], mixed[order]
        rows = []
        for cell, a, b in _cuts(mixed >> np.uint64(64 - bits)):
            starts = np.concatenate([[a], a + 1 + np.flatnonzero((k[a + 1 : b] != k[a : b - 1]) | (rk[a + 1 : b] != rk[a : b - 1]))])
            counts = np.diff(np.append(starts, b)).astype(np.uint32)
            data = _packed(k[starts], rk[starts], counts, p[a:b].astype(np.uint32), (rp[a:b] - p[a:b]).astype(np.int32))
            rows.append((cell >> bits - BUCKET_BITS, cell, 0, data))
        return _cell_rows(rows)

    for cell, rows in _by_cell(batches):
        if cell < 0:
            names = {number: np.frombuffer(data, np.int64) for number, data in rows}
            continue
        parts = []
        for number, data in rows:
            steps, doc, place = _unpacked(data, np.uint64, np.uint32, np.uint32)
            parts.append((np.cumsum(steps), names[number][doc], place))
        held.append(_ties(*map(np.concatenate, zip(*parts))))
        if sum(t.shape[1] for t in held) > CELL // 2:
            yield block()
    if sum(t.shape[1] for t in held):
        yield block()


def chains(places: np.ndarray, sources: np.ndarray) -> list[tuple[list[int], list[int]]]:
    """Collinear chains of the matches (place, source) of one pair of documents, best first.

    A chain's score is SHINGLE per match (less where seeds overlap) minus GAP_COST per word between matches on
    either side. As the cost adds up by coordinates, the best predecessor is a prefix maximum over the source
    places, kept in a Fenwick tree. Every match belongs to one chain at most.
    """
    order = np.lexsort((sources, places))
    at, src = places[order].tolist(), sources[order].tolist()
    ranks = np.unique(sources, return_inverse=True)[1][order].tolist()
    n, size = len(at), max(ranks) + 1
    tree: list[tuple[float, int]] = [(-1e18, -1)] * (size + 1)
    score, back, pending = [0.0] * n, [-1] * n, []
    for i in range(n):
        if pending and at[pending[0]] < at[i]:  # matches at one place never follow each other
            for q in pending:
                value, j = (score[q] + GAP_COST * (at[q] + src[q]), q), ranks[q] + 1
                while j <= size:
                    if tree[j] < value:
                        tree[j] = value
                    j += j & -j
            pending = []
        best, j = (-1e18, -1), ranks[i]
        while j:
            if tree[j] > best:
                best = tree[j]
            j -= j & -j
        score[i] = float(SHINGLE)
        if best[1] >= 0:
            q = best[1]
            gain = min(SHINGLE, at[i] - at[q], src[i] - src[q]) + best[0] - GAP_COST * (at[i] + src[i])
            if gain > score[i]:
                score[i], back[i] = gain, q
        pending.append(i)
    found, used = [], [False] * n
    for i in sorted(range(n), key=lambda i: -score[i]):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = back[i]
        if chain:
            found.append(([at[j] for j in chain[::-1]], [src[j] for j in chain[::-1]]))
    return found


def _one_chain(table: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """For each match of sorted pairs, whether it surely follows the match before it: both places grow, and the match gains more than the gap
    costs. Where that holds for all of a pair, its only chain is all of it, as scores grow from match to match."""
    steps = np.diff(table[2:], axis=1)
    gain = np.minimum(SHINGLE, steps.min(axis=0, initial=SHINGLE)) - GAP_COST * steps.sum(axis=0)
    return ((steps > 0).all(axis=0) & (gain > 1e-6)) | (pair[1:] != pair[:-1])


def _chain_rows(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Chains of each pair; a pair's matches lie in one cell and are bounded by its documents."""

    def out(table: np.ndarray) -> pa.RecordBatch:
        rows = [[], [], [], []]
        new = np.concatenate([[True], (table[:2, 1:] != table[:2, :-1]).any(axis=0)])
        follows = np.concatenate([[True], _one_chain(table, np.cumsum(new))])
        bounds = np.append(np.flatnonzero(new), table.shape[1])
        simple = np.logical_and.reduceat(follows, bounds[:-1])
        long = (np.diff(bounds) > 1) & (np.maximum.reduceat(table[2], bounds[:-1]) - np.minimum.reduceat(table[2], bounds[:-1]) + SHINGLE >= least)
        for n in np.flatnonzero(long).tolist():
            a, b = bounds[n], bounds[n + 1]
            places, sources = table[2, a:b], table[3, a:b]
            for at, src in [(places.tolist(), sources.tolist())] if simple[n] else chains(places, sources):
                if at[-1] - at[0] + SHINGLE >= least:
                    for column, value in zip(rows, (int(table[0, a]), int(table[1, a]), at, src)):
                        column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, kinds)], names=["k", "rk", "at", "src"])

    for _, rows in _by_cell(batches):
        parts = []
        for _, data in rows:
            k, rk, counts, p, ahead = _unpacked(data, np.int64, np.int64, np.uint32, np.uint32, np.int32)
            parts.append(np.stack([np.repeat(k, counts), np.repeat(rk, counts), p.astype(np.int64), p.astype(np.int64) + ahead]))
        table = np.concatenate(parts, axis=1)
        yield out(table[:, np.lexsort((table[3], table[2], table[1], table[0]))])


def distance(a: list, b: list) -> int:
    """Edit distance of two word lists, bit-parallel."""
    if not a or not b:
        return len(a) + len(b)
    masks: dict = {}
    for i, w in enumerate(a):
        masks[w] = masks.get(w, 0) | 1 << i
    full, top, score = (1 << len(a)) - 1, 1 << len(a) - 1, len(a)
    up, down = full, 0
    for w in b:
        same = masks.get(w, 0)
        diagonal = (((same & up) + up) ^ up) | same | down
        rise, fall = down | ~(diagonal | up) & full, up & diagonal
        score += bool(rise & top) - bool(fall & top)
        rise, fall = (rise << 1 | 1) & full, fall << 1 & full
        up, down = fall | ~(diagonal | rise) & full, rise & diagonal
    return score


@dataclass
class Run:
    """Equal words own[start:end] == source[src : src + end - start]; ``before`` are the edits since the last run."""

    start: int
    end: int
    src: int
    before: int = 0


def _beyond(own: list, source: list, i: int, j: int, step: int) -> Run | None:
    """The next run of at least three equal words past a short difference, forwards or backwards."""
    best = None
    for skip in range(1, 7):
        for a in range(skip + 1):
            for b in {skip, a} if a == skip else {skip}:
                for x, y in ((a, b), (b, a)):
                    k = 0
                    while 0 <= i + step * (x + k) < len(own) and 0 <= j + step * (y + k) < len(source) and own[i + step * (x + k)] == source[j + step * (y + k)]:
                        k += 1
                    if k >= 3 and (best is None or k > best[2]):
                        best = (x, y, k)
        if best:
            x, y, k = best
            low, src = (i + x, j + y) if step > 0 else (i - x - k + 1, j - y - k + 1)
            skipped = (own[i : i + x], source[j : j + y]) if step > 0 else (own[i - x + 1 : i + 1], source[j - y + 1 : j + 1])
            return Run(low, low + k, src, distance(*skipped))
    return None


def align(own: list, source: list, at: list[int], src: list[int]) -> list[Run]:
    """Runs of equal words along a chain of seeds, with the edits between them, extended at both ends."""
    runs: list[Run] = []
    i = j = None
    for a, b in zip(at, src):
        if runs and (a < i or b < j):
            continue  # inside what the last run has covered
        edits = distance(own[i:a], source[j:b]) if runs else 0
        end = a
        while end < len(own) and b + end - a < len(source) and own[end] == source[b + end - a]:
            end += 1
        if end > a:
            runs.append(Run(a, end, b, edits))
            i, j = end, b + end - a
    if not runs:
        return []
    while True:  # backwards from the first run
        first = runs[0]
        while first.start and first.src and own[first.start - 1] == source[first.src - 1]:
            first.start, first.src = first.start - 1, first.src - 1
        more = _beyond(own, source, first.start - 1, first.src - 1, -1)
        if not more:
            break
        first.before, more.before = more.before, 0
        runs.insert(0, more)
    while True:  # forwards from the last
        last = runs[-1]
        more = _beyond(own, source, last.end, last.src + last.end - last.start, 1)
        if not more:
            break
        runs.append(more)
    return runs


def similar_spans(runs: list[Run], least_words: int, similarity: float) -> list[tuple[int, int, int, int, float]]:
    """(start, end, source start, source end, similarity) of the longest stretches that pass, cut at the costliest gap."""
    if not runs:
        return []
    start, end = runs[0].start, runs[-1].end
    src, stop = runs[0].src, runs[-1].src + runs[-1].end - runs[-1].start
    if end - start < least_words:
        return []
    edits = sum(r.before for r in runs[1:])
    share = 1 - edits / max(end - start, stop - src)
    if share >= similarity:
        return [(start, end, src, stop, share)]
    cut = max(range(1, len(runs)), key=lambda n: runs[n].before)
    return similar_spans(runs[:cut], least_words, similarity) + similar_spans(runs[cut:], least_words, similarity)


def repeated_passages(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_words: int = MIN_WORDS, similarity: float = SIMILARITY
) -> DataFrame:
    """Passages that an other place holds too: one row per document and source,
    (doc_id, start, end, source_doc_id, source_start, source_end, similarity, doc_key), places in words.

    Words are split at white space, letter case of A-Z aside. Every occurrence but the first (in an arbitrary fixed
    order of documents) is reported, with the first as its source, or where a text repeats its own words with its first
    place in the text: seeds are tied to two earlier occurrences at most, so ties grow with the text, never with pairs of
    copies. Seeds and ties are shuffled packed, by block of texts; a task holds one cell of them at a time, a seed's places all in one.
    Exact copies of a whole text report the whole text. Rows that
    repeat both id and text count as one document; null or short texts have no passages; an empty table none.
    doc_key is the hash of id and text, for joining the result back to rows with repeated or null ids.
    """
    keep_batches_small(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("d"), F.col(text).cast("string").alias("t"))
    rows = rows.where("length(t) > 0").withColumn("k", row_key("d", "t"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    bits = BUCKET_BITS + max(0, size // (WORD_BYTES * CELL << BUCKET_BITS)).bit_length()  # cells of a bucket grow with the table
    schema, order = "bucket int, cell long, block long, data binary", ("bucket", "cell")
    found = rows.select("k", "t").mapInArrow(lambda it: _seed_blocks(it, bits), schema).repartition("bucket").sortWithinPartitions(*order)
    tied = found.mapInArrow(lambda it: _tie_blocks(it, bits), schema).repartition("bucket").sortWithinPartitions(*order)
    least = min(LEAST_SPAN, least_words)  # the rest of the passage may be tied to other texts, the alignment finds it
    chained = written(tied.mapInArrow(lambda it: _chain_rows(it, least), "k long, rk long, at array<int>, src array<int>"), "chains")
    # only the texts that chains touch move on; of equal rows one is enough
    touched = chained.select("k").union(chained.select("rk")).distinct()
    texts = written(rows.join(touched, "k", "left_semi").dropDuplicates(["k"]), "texts")
    own = texts.join(chained, "k").mapInArrow(_own_words, "ok long, od long, k long, low int, words string, at array<int>, src array<int>")
    schema = "doc_id long, start int, end int, source_doc_id long, source_start int, source_end int, similarity double, doc_key long"
    # the source is k here too, so that both joins read one shuffle of the texts
    aligned = own.join(texts, "k").mapInArrow(lambda it: _aligned(it, least_words, similarity), f"{schema}, source_key long").distinct()
    sorted_spans = aligned.repartition("doc_key").sortWithinPartitions("doc_key", "source_key", "start", F.desc("end"), "source_start", "source_end")
    return sorted_spans.mapInArrow(_uncovered, schema)


def _own_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words around each chain in place of the whole text."""
    for batch in small_batches(batches, "t", 4 << 20):
        at = batch.column("at").to_pylist()
        lows, words, last, split = [], [], None, []
        for k, t, a in zip(batch.column("k").to_pylist(), utf8(batch.column("t")), at):
            if k != last:
                last, split = k, t.lower().split()
            lows.append(max(0, a[0] - MARGIN))
            words.append(b" ".join(split[lows[-1] : a[-1] + SHINGLE + MARGIN]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("k"), batch.column("d"), batch.column("rk"), pa.array(lows, pa.int32()), pa.array(words, pa.binary()).cast(pa.string()), batch.column("at"), batch.column("src")],
            names=["ok", "od", "k", "low", "words", "at", "src"],
        )


def _aligned(batches: Iterator[pa.RecordBatch], least_words: int, similarity: float) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.int64()]
    names = ["doc_id", "start", "end", "source_doc_id", "source_start", "source_end", "similarity", "doc_key", "source_key"]
    for batch in small_batches(batches, "t", 4 << 20):
        rows, last, split = [], None, []
        data = [batch.column(c).to_pylist() for c in ("ok", "od", "k", "d", "low", "at", "src")]
        for k, d, rk, rd, low, at, src, words, text in zip(*data, utf8(batch.column("words")), utf8(batch.column("t"))):
            if rk != last:
                last, split = rk, text.lower().split()
            base = max(0, src[0] - MARGIN)
            source = split[base : src[-1] + SHINGLE + MARGIN]
            runs = align(words.split(), source, [a - low for a in at], [s - base for s in src])
            for a, b, x, y, share in similar_spans(runs, least_words, similarity):
                rows.append((d, a + low, b + low, rd, x + base, y + base, share, k, rk))
        columns = list(zip(*rows)) if rows else [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)


def _uncovered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leaves out a span that lies inside one with an earlier source; rows come sorted by document and source."""
    last, starts, ends = None, np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        kept = []
        for k, a, b in zip(*(batch.column(c).to_pylist() for c in ("doc_key", "start", "end"))):
            if k != last:
                last, starts, ends = k, np.zeros(0, np.int64), np.zeros(0, np.int64)
            kept.append(not bool(((starts <= a) & (ends >= b)).any()))
            if kept[-1]:
                starts, ends = np.append(starts, a), np.append(ends, b)
        yield batch.drop_columns(["source_key"]).filter(pa.array(kept, pa.bool_()))


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words in ``spans`` and the white space after each removed stretch."""
    gone = set()
    for a, b in spans:
        gone.update(range(a, b))
    words = list(_WORD.finditer(text))
    kept, at = [], 0
    n = 0
    while n < len(words):
        if n not in gone:
            n += 1
            continue
        stop = n
        while stop < len(words) and stop in gone:
            stop += 1
        kept.append(text[at : words[n].start()])
        at = words[stop].start() if stop < len(words) else len(text)
        n = stop
    return "".join([*kept, text[at:]])


def without_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_words: int = MIN_WORDS, similarity: float = SIMILARITY
) -> DataFrame:
    """The documents, same columns, without their repeated passages; one that holds nothing else goes.

    A text without such a passage is returned exactly as it is. Repeated rows (same id and text) are cut alike.
    """
    found = repeated_passages(docs, doc_id, text, least_words, similarity)
    spans = found.groupBy("doc_key").agg(F.collect_set(F.struct("start", "end")).alias("doc_spans"))  # at most one per chain of a text
    names, position = docs.columns, docs.columns.index(text)
    renamed = docs.toDF(*[f"c{i}" for i in range(len(names))])
    joined = renamed.withColumn("doc_key", row_key(f"c{names.index(doc_id)}", f"c{position}")).join(spans, "doc_key", "left")
    column = f"c{position}"

    @F.pandas_udf("string")
    def cut(texts, spans):
        return texts.combine(spans, lambda t, s: t if t is None or s is None else cut_words(t, [(r["start"], r["end"]) for r in s]))

    done = joined.withColumn(column, cut(column, "doc_spans"))
    return done.where(F.col("doc_spans").isNull() | (F.length(F.trim(column)) > 0)).drop("doc_key", "doc_spans").toDF(*names)
