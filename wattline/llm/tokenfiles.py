"""Token ids in compressed files: adaptive context mixing with a range coder, in independent checked blocks."""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattline.llm.common import keep_batches_small, small_batches, strings
from wattline.sources.scratch import scratch_path

BLOCK = 2048  # ids coded from a fresh start
MAGIC = b"WTK1"
HEADER = 17  # bytes before the first block
_ROW_BYTES = 16 << 20  # text of one row of a file, at least one document
_LANES = 4096  # blocks coded abreast
_CACHED = 1_000_000  # different words whose ids a worker keeps
_LINES = 1000  # unseen words given to the library as one text
_ONE = re.compile(r"[ \n]?\S+")
_SIGNS = ".,;:!?*&%#@$()[]{}+-=/\"<>|~^"
# before a space or line feed that stands alone between signs
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")

# ---- the coder ------------------------------------------------------------
# An id is one of 2 + classes symbols: what followed the last two ids last time (order 2), what followed the last id
# (order 1), or a new value of a size class, whose place in the class is coded evenly. The symbol's distribution adds
# the adaptive counts kept for the order-2 prediction's record, the order-1 prediction's, and the last size class
# (order 0), so the context with more evidence weighs more.
# Class c holds the values of c binary digits; a file body has as many classes as its largest id needs.
_SLOTS = 1024
_CONFIDENT = 7
_LIMIT = 1024  # a record's counts are halved when one gets beyond this
_STEP = 24
_LOW32 = np.uint64((1 << 32) - 1)


class _Blocks:
    """The model's state for many blocks abreast; coder and decoder step it alike."""

    def __init__(self, lanes: int, classes: int):
        kind = np.int32 if classes <= 32 else np.int64
        self.lanes = np.arange(lanes)
        self.base = self.lanes * _SLOTS
        self.guess = np.full((2, lanes * _SLOTS), -1, kind)
        self.trust = np.zeros((2, lanes * _SLOTS), np.int8)
        self.width, self.symbols = 2 * (_CONFIDENT + 1) + classes, 2 + classes
        self.records = [np.ones((lanes * self.width, self.symbols), np.int16) for _ in range(3)]
        self.flat = [r.reshape(-1) for r in self.records]
        self.first_row = self.lanes * self.width
        self.last = np.zeros((2, lanes), np.int64)  # the id before, and the one before that
        self.size = np.zeros(lanes, np.int64)

    def predict(self, n: int) -> None:
        """Predictions and mixed counts for the first n lanes."""
        base, one, two, row = self.base[:n], self.last[0, :n], self.last[1, :n], self.first_row[:n]
        mixed = one * 40503
        self.slots = (base + (mixed + two * 60493 + 7919 >> 3) % _SLOTS, base + (mixed >> 2) % _SLOTS)
        self.second, self.first = self.guess[0].take(self.slots[0]), self.guess[1].take(self.slots[1])
        self.trusted = self.trust[0].take(self.slots[0]), self.trust[1].take(self.slots[1])
        row = row + (self.second == self.first)
        self.rows = (row + 2 * self.trusted[0], row + 2 * self.trusted[1], self.first_row[:n] + (2 * (_CONFIDENT + 1) + self.size[:n]))
        self.counts = self.records[0].take(self.rows[0], axis=0)
        self.counts += self.records[1].take(self.rows[1], axis=0)
        self.counts += self.records[2].take(self.rows[2], axis=0)
        self.upper = np.cumsum(self.counts, axis=1, dtype=np.int32)

    def learn(self, n: int, ids: np.ndarray, symbols: np.ndarray) -> None:
        for table, flat, rows in zip(self.records, self.flat, self.rows):
            at = rows * self.symbols + symbols
            count = flat.take(at) + np.int16(_STEP)
            flat[at] = count
            if count.max() > _LIMIT:
                full = rows[count > _LIMIT]
                table[full] = (table[full] + 1) >> 1
        for guess, trust, slots, was, trusted in zip(self.guess, self.trust, self.slots, (self.second, self.first), self.trusted):
            trust[slots] = np.where(was == ids, np.minimum(trusted + 1, _CONFIDENT), trusted >> 1)
            guess[slots] = ids
        self.size[:n] = size_class(ids)
        self.last[1, :n] = self.last[0, :n]
        self.last[0, :n] = ids


def size_class(ids: np.ndarray) -> np.ndarray:
    """Binary digits of each id."""
    return np.frexp(ids.astype(np.float64))[1].astype(np.int64)


class _Writer:
    """A carry-less range coder per lane: 64-bit low and range, 16-bit words out."""

    def __init__(self, lanes: int, cap: int):
        self.low, self.range = np.zeros(lanes, np.uint64), np.full(lanes, 2**64 - 1, np.uint64)
        self.words, self.at = np.zeros((lanes, cap), np.uint16), np.zeros(lanes, np.int64)

    def code(self, on, start: np.ndarray, width: np.ndarray, total: np.ndarray) -> None:
        """Narrow the lanes ``on`` to [start, start + width) of total."""
        low, span = self.low[on], self.range[on] // total
        low += start * span
        span = span * width
        lanes = np.arange(len(self.low))[on]
        while True:
            alike = (low ^ (low + span)) >> np.uint64(48) == 0
            small = ~alike & (span < np.uint64(1 << 32))
            move = alike | small
            if not move.any():
                break
            if small.any():
                span[small] = (np.uint64(0) - low[small]) & _LOW32
            who = lanes[move]
            self.words[who, self.at[who]] = (low[move] >> np.uint64(48)).astype(np.uint16)
            self.at[who] += 1
            low[move] <<= np.uint64(16)
            span[move] <<= np.uint64(16)
        self.low[on], self.range[on] = low, span

    def finish(self) -> list[bytes]:
        out = []
        for lane in range(len(self.low)):
            tail = np.array([int(self.low[lane]) >> s & 0xFFFF for s in (48, 32, 16, 0)], np.uint16)
            out.append(np.concatenate([self.words[lane, : self.at[lane]], tail]).astype("<u2").tobytes())
        return out


class _Reader:
    def __init__(self, payloads: list[bytes]):
        longest = max(map(len, payloads)) // 2 + 8
        self.words = np.zeros((len(payloads), longest), np.uint64)
        for lane, p in enumerate(payloads):
            self.words[lane, : len(p) // 2] = np.frombuffer(p, "<u2")
        self.low, self.range = np.zeros(len(payloads), np.uint64), np.full(len(payloads), 2**64 - 1, np.uint64)
        w = self.words
        self.value = w[:, 0] << np.uint64(48) | w[:, 1] << np.uint64(32) | w[:, 2] << np.uint64(16) | w[:, 3]
        self.at = np.full(len(payloads), 4)

    def place(self, on, total: np.ndarray) -> np.ndarray:
        self.span = self.range[on] // total
        return np.minimum((self.value[on] - self.low[on]) // self.span, total - np.uint64(1))

    def take(self, on, start: np.ndarray, width: np.ndarray) -> None:
        low, span, value = self.low[on] + start * self.span, self.span * width, self.value[on]
        lanes = np.arange(len(self.low))[on]
        while True:
            alike = (low ^ (low + span)) >> np.uint64(48) == 0
            small = ~alike & (span < np.uint64(1 << 32))
            move = alike | small
            if not move.any():
                break
            if small.any():
                span[small] = (np.uint64(0) - low[small]) & _LOW32
            who = lanes[move]
            value[move] = value[move] << np.uint64(16) | self.words[who, np.minimum(self.at[who], self.words.shape[1] - 1)]
            self.at[who] += 1
            low[move] <<= np.uint64(16)
            span[move] <<= np.uint64(16)
        self.low[on], self.range[on], self.value[on] = low, span, value


def _symbol_range(model: _Blocks, n: int, symbols: np.ndarray):
    lanes = np.arange(n)
    width = model.counts[lanes, symbols]
    return (model.upper[lanes, symbols] - width).astype(np.uint64), width.astype(np.uint64), model.upper[:, -1].astype(np.uint64)


def _coded(blocks: list[np.ndarray], classes: int) -> list[bytes]:
    """Payloads of blocks in descending order of length."""
    lengths = np.array([len(b) for b in blocks])
    ids = np.zeros((len(blocks), int(lengths[0])), np.int64)
    for lane, b in enumerate(blocks):
        ids[lane, : len(b)] = b
    model, out = _Blocks(len(blocks), classes), _Writer(len(blocks), 4 * int(lengths[0]) + 8)
    for t in range(ids.shape[1]):
        n = int(np.searchsorted(-lengths, -t, side="left"))
        now = ids[:n, t]
        model.predict(n)
        size = size_class(now)
        symbols = np.where(now == model.second, 0, np.where(now == model.first, 1, 2 + size))
        out.code(slice(0, n), *_symbol_range(model, n, symbols))
        fresh = np.flatnonzero((symbols > 3))  # classes 0 and 1 hold one value each
        if len(fresh):
            half = np.uint64(1) << (size[fresh] - 1).astype(np.uint64)
            out.code(fresh, now[fresh].astype(np.uint64) - half, np.ones(len(fresh), np.uint64), half)
        model.learn(n, now, symbols)
    return out.finish()


def _decoded(payloads: list[bytes], lengths: np.ndarray, classes: int) -> np.ndarray:
    """Ids (lanes, longest) of payloads in descending order of length."""
    model, source = _Blocks(len(payloads), classes), _Reader(payloads)
    ids = np.zeros((len(payloads), int(lengths[0])), np.int64)
    for t in range(ids.shape[1]):
        n = int(np.searchsorted(-lengths, -t, side="left"))
        model.predict(n)
        place = source.place(slice(0, n), model.upper[:, -1].astype(np.uint64)).astype(np.int64)
        symbols = (model.upper <= place[:, None]).sum(axis=1)
        source.take(slice(0, n), *_symbol_range(model, n, symbols)[:2])
        now = np.where(symbols == 0, model.second, np.where(symbols == 1, model.first, symbols == 3)).astype(np.int64)
        fresh = np.flatnonzero(symbols > 3)
        if len(fresh):
            half = np.uint64(1) << (symbols[fresh] - 3).astype(np.uint64)
            rest = source.place(fresh, half)
            source.take(fresh, rest, np.ones(len(fresh), np.uint64))
            now[fresh] = (rest + half).astype(np.int64)
        ids[:n, t] = now
        model.learn(n, now, symbols)
    return ids


def pack(ids: np.ndarray, block: int = BLOCK) -> bytes:
    """Ids (unsigned, 32 bits) as a file body: a header with the numbers of ids, blocks and size classes, then per block its count, the crc32 of its ids, the length and
    crc32 of its payload, and the payload."""
    cut = [ids[i : i + block] for i in range(0, len(ids), block)]
    classes = int(ids.max()).bit_length() + 1 if len(ids) else 1
    order = sorted(range(len(cut)), key=lambda i: -len(cut[i]))
    payloads: list[bytes] = [b""] * len(cut)
    for low in range(0, len(order), _LANES):
        part = order[low : low + _LANES]
        for i, p in zip(part, _coded([cut[i] for i in part], classes)):
            payloads[i] = p
    out = [MAGIC, struct.pack("<QIB", len(ids), len(cut), classes)]
    for b, p in zip(cut, payloads):
        out += [struct.pack("<IIII", len(b), zlib.crc32(b.astype("<u4").tobytes()), len(p), zlib.crc32(p)), p]
    return b"".join(out)


def unpack(body: bytes) -> np.ndarray:
    """The ids of a file body; any damaged block is an error."""
    if body[:4] != MAGIC:
        raise ValueError("not a token file")
    total, count, classes = struct.unpack_from("<QIB", body, 4)
    at, heads, payloads = HEADER, [], []
    for _ in range(count):
        head = struct.unpack_from("<IIII", body, at)
        payload = body[at + 16 : at + 16 + head[2]]
        if len(payload) != head[2] or zlib.crc32(payload) != head[3]:
            raise ValueError("damaged block")
        heads.append(head), payloads.append(payload)
        at += 16 + head[2]
    order = sorted(range(count), key=lambda i: -heads[i][0])
    blocks: list[np.ndarray] = [np.zeros(0, "<u4")] * count
    for low in range(0, count, _LANES):
        part = order[low : low + _LANES]
        ids = _decoded([payloads[i] for i in part], np.array([heads[i][0] for i in part]), classes)
        for lane, i in enumerate(part):
            blocks[i] = ids[lane, : heads[i][0]].astype("<u4")
            if zlib.crc32(blocks[i].tobytes()) != heads[i][1]:
                raise ValueError("damaged block")
    out = np.concatenate(blocks) if blocks else np.zeros(0, "<u4")
    if len(out) != total:
        raise ValueError("ids are missing")
    return out


# ---- encoding texts -------------------------------------------------------


class Encoder:
    """Byte-level ids of texts by the tokenizers library, which sees each different word once.

    No token of such a model spans from a sign to the white space after it, so a text can be cut before every space or
    line feed that stands alone between two signs. Unseen words go to the library many at a time, a line each. Texts that
    hold the name of an added token go to the library whole, which gives the token's id, or with ``names_are_text`` the
    ids of its letters.
    """

    def __init__(self, path: str, names_are_text: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = names_are_text
        names = [] if names_are_text else [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.names = re.compile("|".join(map(re.escape, names))) if names else None
        self.feed = self._plain("\n")
        self.by_line = len(self.feed) == 4  # a line feed is one token, which tells lines apart
        self.cache: dict[str, bytes] = {}

    def _plain(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, words: list[str]) -> None:
        """Put the ids of these different words into the cache. Letters and the signs behind them are two stretches
        whatever stands around them, so such a word is put together from both."""
        cache, lines, later = self.cache, [], []
        for word in words:
            if not (self.by_line and _ONE.fullmatch(word)):
                cache[word] = self._plain(word)
                continue
            letters = word.rstrip(_SIGNS)
            if len(letters) < len(word) and letters.lstrip(" \n").isalpha():
                later.append((word, letters, word[len(letters) :]))
            else:
                lines.append(word)
        known = set(lines)
        lines += {w for _, *both in later for w in both if w not in cache and w not in known}
        packs = [lines[i : i + _LINES] for i in range(0, len(lines), _LINES)]
        texts = ["\n".join([w[1:] if w[0] == "\n" else w for w in p]) for p in packs]
        feed = int.from_bytes(self.feed, "little")
        for pack_, found in zip(packs, self.library.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            raw, ends = ids.tobytes(), [*(4 * np.flatnonzero(ids == feed)).tolist(), 4 * len(ids)]
            start = 0
            for word, end in zip(pack_, ends):
                cache[word] = self.feed + raw[start:end] if word[0] == "\n" else raw[start:end]
                start = end + 4
        for word, letters, signs in later:
            cache[word] = cache[letters] + cache[signs]

    def _words(self, text: str) -> list[str]:
        """The text cut before every space or line feed that stands alone between signs."""
        # single spaces and line feeds between signs are the only white space: the quick way, by a sign the text lacks
        if "\0" in text or " ".join(text.split()) != text.replace("\n", " "):
            return _CUT.split(text)
        return text.replace("\n", " \n").replace(" ", "\0 ").replace(" \n", "\n").split("\0")

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        if len(self.cache) > _CACHED:
            self.cache.clear()
        known, found, open_, fresh = self.cache.get, [], [], set()
        for text in texts:
            if self.names and self.names.search(text):
                found.append([self._plain(text)])
                continue
            words = self._words(text) if text else []
            found.append(list(map(known, words)))
            if None in found[-1]:
                missing = [i for i, x in enumerate(found[-1]) if x is None]
                open_.append((found[-1], missing, [words[i] for i in missing]))
                fresh.update(open_[-1][2])
        self._learn(list(fresh))
        for ids, missing, words in open_:
            for i, word in zip(missing, words):
                ids[i] = self.cache[word]
        return [b"".join(x) for x in found]


@cache
def _encoder(path: str) -> Encoder:
    return Encoder(path, names_are_text=False)  # as the library encodes by default


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode every text and write the ids in ascending order of doc_id (nulls first, then by text) to files at ``path``.

    Each file row holds whole documents: part (files follow each other by part), first (ids of the part before the row), doc_ids, counts
    (ids per document, the end id included) and body (see ``pack``). Null texts are empty and hold the end id only.
    """
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, first = _encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in small_batches(batches, "t", _ROW_BYTES):
            ids = [x + end for x in encoder.encode(strings(batch.column("t")))]
            counts = [len(x) // 4 for x in ids]
            body = pack(np.frombuffer(b"".join(ids), "<u4"))
            columns = [pa.array([part]), pa.array([first]), pa.array([batch.column("d").to_pylist()], pa.list_(pa.int64()))]
            columns += [pa.array([counts], pa.list_(pa.int64())), pa.array([body], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "first", "doc_ids", "counts", "body"])
            first += sum(counts)
        _encoder(tokenizer).cache.clear()  # the worker process lives on and may do other work next

    keep_batches_small(docs.sparkSession)
    picked = docs.select(F.col(doc_id).cast("long").alias("d"), F.col(text).cast("string").alias("t"))
    ordered = picked.repartitionByRange("d").sortWithinPartitions("d", "t")
    coded = ordered.mapInArrow(run, "part long, first long, doc_ids array<long>, counts array<long>, body binary")
    coded.write.option("compression", "none").option("parquet.block.size", 64 << 20).parquet(path)


def read_ids(spark: SparkSession, path: str, digests: bool = False) -> DataFrame:
    """Documents of the files at ``path``: (doc_id, start, n_tokens, ids), or with ``digests`` ids_crc32 (of the ids as
    little-endian 32-bit integers) in place of ids. start counts the ids of all documents before."""
    files = spark.read.parquet(path)
    sizes = files.groupBy("part").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    # one row per written part: a running sum over as many rows as there are files
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = sizes.select("part", before.alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "body", 1):  # row by row
            ids, docs = unpack(batch.column("body")[0].as_py()), batch.column("doc_ids")[0].as_py()
            counts = np.array(batch.column("counts")[0].as_py(), np.int64)
            ends = np.cumsum(counts)
            each = [ids[b - n : b] for b, n in zip(ends, counts)]
            if digests:
                last = pa.array([zlib.crc32(x.tobytes()) for x in each], pa.int64())
            else:
                last = pa.array([x.astype(np.int64) for x in each], pa.list_(pa.int64()))
            start = pa.array(ends - counts + batch.column("first")[0].as_py())
            part = pa.array(np.full(len(counts), batch.column("part")[0].as_py()))
            yield pa.RecordBatch.from_arrays([part, pa.array(docs, pa.int64()), start, pa.array(counts), last], names=["part", "doc_id", "at", "n_tokens", "ids"])

    read = files.mapInArrow(run, f"part long, doc_id long, at long, n_tokens long, ids {'long' if digests else 'array<long>'}")
    start = (F.col("base") + F.col("at")).alias("start")
    return read.join(bases, "part").select("doc_id", start, "n_tokens", F.col("ids").alias("ids_crc32" if digests else "ids"))


def round_trip(docs: DataFrame, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write all texts as id files in the shared folder and return what the files hold, one row per input row."""
    path = scratch_path(docs.sparkSession, "token-files")
    write_ids(docs, path, tokenizer, end_id, doc_id, text)
    return read_ids(docs.sparkSession, path, digests=True)
