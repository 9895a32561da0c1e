"""Phrases whose words keep company: counts in tries of burstable hash containers, spilled as sorted runs and merged by prefix."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm.common import keep_batches_small, small_batches
from wattline.sources.scratch import written

MIN_COUNT = 100
LONGEST = 5
TOP = 2000
BITS = 26  # a filter of known phrases has two to the power of this many bits
_TEXT_BYTES = 4 << 20
_BURST = 2048  # entries at which a container becomes a node with a container per next word
_HELD = 1_600_000  # entries a task holds before subtrees are spilled
_VOCABULARY = 1_000_000  # different words a task knows of a language before it starts anew
_PARTS = 1 << 16  # prefix partitions are dealt to shuffle partitions by these numbers
_BREAK = b"\xff"  # between pieces; no byte of UTF-8
_PLAIN = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", _BREAK * 10 + b" ")
_MIX = 0x9E3779B97F4A7C15
_ALL = (1 << 64) - 1


def words_of(texts: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """The words of these texts in UTF-8, A-Z lower-cased, with a break wherever a piece ends: places in a list of the
    different ones, and that list."""
    spaced = b"\n".join(texts).lower().translate(_PLAIN).replace(_BREAK, b" " + _BREAK + b" ")
    coded = pc.split_pattern(pa.array([spaced], pa.large_binary()), " ").values.dictionary_encode()
    places, different = coded.indices.to_numpy(), coded.dictionary.to_pylist()
    if b"" in different:  # between spaces that follow each other
        places = places[places != different.index(b"")]
    return places, different


# ---- the trie ---------------------------------------------------------------


class Trie:
    """Counts of rows of ``width`` word ids. Under each first word stands a container, a hash from the other ids to a count; one that
    grows beyond ``burst`` entries becomes a node with a container for each next word, and so on."""

    def __init__(self, width: int, burst: int = _BURST):
        self.width, self.burst = width, burst
        self.root: dict = {}
        self.sizes: dict[int, int] = {}  # entries under each first word
        self.entries = 0

    def add(self, rows: np.ndarray) -> None:
        """Count these rows, ids in ``width`` columns."""
        self._add(self.root, rows, self.width - 1, True)

    def _add(self, node: dict, rows: np.ndarray, rest: int, top: bool = False) -> int:
        rows = rows[np.argsort(rows[:, 0], kind="stable")]
        heads = rows[:, 0]
        starts = np.flatnonzero(np.concatenate([[True], heads[1:] != heads[:-1]])) if len(rows) else np.zeros(0, np.int64)
        keys = np.ascontiguousarray(rows[:, 1:], dtype=">u4").view(f"V{4 * rest}").ravel().tolist() if rest else [b""] * len(rows)
        fresh = 0
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(rows)]):
            head = int(heads[a])
            child = node.get(head)
            if type(child) is dict:
                grown = self._add(child, rows[a:b, 1:], rest - 1)
            else:
                if child is None:
                    child = node[head] = Counter()
                before = len(child)
                child.update(keys[a:b])
                grown = len(child) - before
                if rest > 1 and len(child) > self.burst:
                    node[head] = self._burst(child)
            fresh += grown
            if top:
                self.sizes[head] = self.sizes.get(head, 0) + grown
                self.entries += grown
        return fresh

    @staticmethod
    def _burst(container: Counter) -> dict:
        node: dict = {}
        for key, n in container.items():
            node.setdefault(int.from_bytes(key[:4], "big"), Counter())[key[4:]] = n
        return node

    def spill(self, keep: int, chunk: int = 50_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Take out whole subtrees, the largest first, until ``keep`` entries stay: (rows, counts) of some subtrees at a time, in
        ascending order of ids."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        taken = 0
        for head in sorted(self.sizes, key=lambda h: -self.sizes[h]):
            if self.entries <= keep:
                break
            size = self.sizes.pop(head)
            self.entries -= size
            taken += size
            self._collect(self.root.pop(head), (head,), found)
            if taken >= chunk:
                yield self._run(found)
                found, taken = [], 0
        if found:
            yield self._run(found)

    @staticmethod
    def _run(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        rows, counts = np.concatenate([r for r, _ in found]), np.concatenate([n for _, n in found])
        order = np.lexsort(rows.T[::-1])
        return rows[order], counts[order]

    def _collect(self, node: dict, before: tuple[int, ...], out: list[tuple[np.ndarray, np.ndarray]]) -> None:
        if type(node) is dict:
            for head, child in node.items():
                self._collect(child, (*before, head), out)
            return
        rows = np.empty((len(node), self.width), np.int64)
        rows[:, : len(before)] = before
        rows[:, len(before) :] = np.frombuffer(b"".join(node), ">u4").reshape(len(node), -1)
        out.append((rows, np.fromiter(node.values(), np.int64, len(node))))


# ---- filters of known phrases -------------------------------------------------


def _seed(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode())


def _spots(lang: str, hashes: list[np.ndarray]) -> np.ndarray:
    """Where phrases stand in a filter, given the hashes of their first words, second words and so on."""
    state = np.full(len(hashes[0]), _seed(lang), np.uint64)
    for h in hashes:
        state = (state ^ h) * np.uint64(_MIX)
        state ^= state >> np.uint64(29)
    return state >> np.uint64(64 - BITS)


def _filter(found: DataFrame) -> bytes:
    """A bitmap in which every phrase of ``found`` has its bit set, so it is never missed; others may share one. Its size
    does not depend on the number of phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spots = []
            for lang, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist()):
                hashes = [np.array([xxhash.xxh64_intdigest(w)], np.uint64) for w in phrase.encode().split(b" ")]
                spots.append(int(_spots(lang, hashes)[0]))
            at = np.array(spots, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 15), pa.array(at & 32767)], names=["bucket", "bit"])

    bits = found.select("lang", "phrase").mapInArrow(run, "bucket long, bit long")
    out = bytearray(1 << BITS - 3)
    for row in bits.groupBy("bucket").agg(F.expr("bitmap_construct_agg(bit)").alias("bits")).collect():  # 8 MB at most
        out[row.bucket << 12 : row.bucket + 1 << 12] = row.bits
    return bytes(out)


class _Vocabulary(dict):
    """Ids of a language's words that the filter knows, as they are met, and -1 for others, which are not kept."""

    def __init__(self, lang: str, known: np.ndarray):
        super().__init__({_BREAK: -1})
        self.lang, self.known, self.words, self.hashes = lang, known, [], []
        self.seed = _seed(lang)

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        state = (self.seed ^ h) * _MIX & _ALL
        spot = (state ^ state >> 29) >> 64 - BITS
        if not self.known[spot >> 3] >> (spot & 7) & 1:
            return -1
        self[word] = found = len(self.words)
        self.words.append(word)
        self.hashes.append(h)
        return found


def _pairs(ids: np.ndarray, vocabulary: _Vocabulary, known: np.ndarray | None) -> np.ndarray:
    """At which places two known words stand side by side, if given a filter also as a pair that it knows."""
    good = (ids[:-1] >= 0) & (ids[1:] >= 0)
    if known is not None:
        at = np.flatnonzero(good)
        hashes = np.array(vocabulary.hashes or [0], np.uint64)
        spots = _spots(vocabulary.lang, [hashes[ids[at]], hashes[ids[at + 1]]])
        good[at] = (known[spots >> np.uint64(3)] >> (spots & np.uint64(7)).astype(np.uint8)) & 1
    return good


# ---- on Spark -----------------------------------------------------------------


def _by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    for batch in small_batches(batches, "t", _TEXT_BYTES):
        texts: dict[str, list[bytes]] = {}
        for lang, body in zip(batch.column("lang").to_pylist(), batch.column("t").cast(pa.large_binary()).to_pylist()):
            if body:
                texts.setdefault(lang, []).append(body)
        yield from texts.items()


def _rows(lang: str, phrases: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    langs = pa.array([lang], pa.string()).take(pa.array(np.zeros(len(phrases), np.int32)))
    return pa.RecordBatch.from_arrays([langs, phrases.cast(pa.string()), pa.array(counts, pa.int64())], names=["lang", "phrase", "c"])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted runs of word counts; the empty phrase counts all words."""
    held: dict[str, Counter] = {}

    def spill() -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            counts[b""] = sum(counts.values())
            found = sorted(counts.items())
            yield _rows(lang, pa.array([w for w, _ in found], pa.binary()), np.array([n for _, n in found], np.int64))
        held.clear()

    for lang, texts in _by_lang(batches):
        counts = held.setdefault(lang, Counter())
        places, different = words_of(texts)
        for word, n in zip(different, np.bincount(places, minlength=len(different)).tolist()):
            if n and word != _BREAK:
                counts[word] += n
        if sum(map(len, held.values())) > _HELD:
            yield from spill()
    yield from spill()


def _counter(widths: range, words: Broadcast, pairs: Broadcast | None):
    """Counts phrases of these numbers of words by tries, in sorted runs of whole subtrees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_words = np.frombuffer(words.value, np.uint8)
        known_pairs = None if pairs is None else np.frombuffer(pairs.value, np.uint8)
        held: dict[str, tuple[_Vocabulary, list[Trie]]] = {}

        def spill(lang: str, trie: Trie, keep: int) -> Iterator[pa.RecordBatch]:
            names = pa.array(held[lang][0].words, pa.binary())
            for rows, counts in trie.spill(keep):
                columns = [names.take(pa.array(rows[:, j])) for j in range(trie.width)]
                yield _rows(lang, pc.binary_join_element_wise(*columns, b" "), counts)

        for lang, texts in _by_lang(batches):
            if lang not in held:
                held[lang] = _Vocabulary(lang, known_words), [Trie(w) for w in widths]
            vocabulary, tries = held[lang]
            places, different = words_of(texts)
            ids = np.array([vocabulary[w] if w else -1 for w in different], np.int64)[places]
            good = _pairs(ids, vocabulary, known_pairs)
            for trie in tries:
                reach = trie.width - 1  # a phrase is as many pairs
                whole = np.ones(max(len(good) - reach + 1, 0), bool)
                for j in range(reach):
                    whole &= good[j : j + len(whole)]
                at = np.flatnonzero(whole)
                trie.add(np.stack([ids[at + j] for j in range(trie.width)], 1))
            if len(vocabulary) > _VOCABULARY:
                for trie in tries:
                    yield from spill(lang, trie, 0)
                del held[lang]
            while sum(t.entries for _, tries in held.values() for t in tries) > _HELD:
                lang_, trie = max(((x, t) for x, (_, tries) in held.items() for t in tries), key=lambda x: x[1].entries)
                yield from spill(lang_, trie, trie.entries // 2)
        for lang, (_, tries) in held.items():
            for trie in tries:
                yield from spill(lang, trie, 0)

    return run


def _merged(runs: DataFrame, min_count: int) -> DataFrame:
    """The runs' counts added up per prefix partition, phrases under ``min_count`` dropped. A prefix is all words but the last (a word is its
    own); each is dealt to 8 partitions by its last word, so that the continuations of a hot one are not one task's."""
    prefix = F.regexp_replace("phrase", " [^ ]*$", "")
    # a small number in place of the hash itself, which would be a third of a shuffled row
    part = F.pmod(F.xxhash64("lang", prefix, F.pmod(F.xxhash64("phrase"), F.lit(8))), F.lit(_PARTS)).cast("int")
    merged = runs.withColumn("part", part).repartition("part").groupBy("part", "lang", "phrase").agg(F.sum("c").alias("c"))
    return merged.where(F.col("c") >= min_count).select("lang", "phrase", "c")


def phrase_counts(
    docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, longest: int = LONGEST
) -> DataFrame:
    """(lang, phrase, c): all words and phrases of up to ``longest`` words that occur ``min_count`` times or more in their language, and, as the
    empty phrase, each language's number of word occurrences.

    Three passes: words, pairs, longer phrases. A phrase that occurs often enough consists of words, and of pairs, that do, so a pass counts
    only where a bounded filter of the pass before lets all of them through; the filter never turns a known one away, and
    what it lets through by chance is counted and dropped.
    """
    spark = docs.sparkSession
    keep_batches_small(spark)
    picked = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("t"))

    def counted(counter, label: str) -> DataFrame:
        return written(_merged(picked.mapInArrow(counter, "lang string, phrase string, c long"), min_count), label)

    # a total under min_count is not missed: no phrase can then be frequent enough
    found = counted(_count_words, "words")
    words = spark.sparkContext.broadcast(_filter(found.where("phrase <> ''")))
    pairs = counted(_counter(range(2, 3), words, None), "pairs")
    found = found.unionByName(pairs)
    if longest > 2:
        known = spark.sparkContext.broadcast(_filter(pairs))
        found = found.unionByName(counted(_counter(range(3, longest + 1), words, known), "phrases"))
    return found


def quotient(a: Column, n: Column, parts: Column) -> Column:
    """floor(1000 a n / parts) in whole numbers of up to 38 digits; ``parts`` is such a number."""
    product = a.cast("decimal(18,0)") * n.cast("decimal(16,0)") * F.lit(1000).cast("decimal(4,0)")
    return F.call_function("div", product, parts)


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, longest: int = LONGEST, top: int = TOP
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 to ``longest`` words by score, then a, then phrase.

    a is how often the phrase occurs within pieces, overlaps included, at least ``min_count``; n counts all words of the language. Cut after its first
    k words, its parts occur l and r times; the score is floor(1000 a n / (l r)) of the lowest-scoring cut, the first of equal ones. Phrases
    that lie in a longer one as frequent as themselves are dropped.

    Null languages are ``und``, null and empty texts hold no word, repeated rows count each, an empty table gives no rows.
    """
    counts = phrase_counts(docs, text, lang, min_count, longest)
    parts = F.split("phrase", " ")
    size = F.size("w")
    total = counts.where("phrase = ''").select("lang", F.col("c").alias("n"))
    wide = counts.where("contains(phrase, ' ')").withColumn("w", parts)
    joined = wide.join(total, "lang").select("lang", "phrase", "w", F.col("c").alias("a"), "n")

    def words(first: Column, many: Column) -> Column:
        return F.array_join(F.slice("w", first, many), " ")

    cuts = joined.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    cuts = cuts.select("lang", "phrase", "a", "n", "k", words(F.lit(1), F.col("k")).alias("first"), words(F.col("k") + 1, size - F.col("k")).alias("rest"))
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("c").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("c").alias("r"))
    known = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    score = quotient(F.col("a"), F.col("n"), F.col("l").cast("decimal(19,0)") * F.col("r").cast("decimal(19,0)"))
    scored = known.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    inner = F.flatten(
        F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(F.sequence(F.lit(1), size - m + 1), lambda s: words(s, m)))
    )
    held = wide.where(size > 2).select("lang", F.explode(inner).alias("phrase"), F.col("c").alias("a")).distinct()
    kept = scored.join(held, ["lang", "phrase", "a"], "left_anti")

    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
