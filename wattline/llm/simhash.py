"""SimHash near-duplicates through one-wildcard segment signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import keep_batches_small, row_key, small_batches, utf8
from wattline.llm.components import components
from wattline.sources.scratch import written

SEED = 42
BITS = 64
DISTANCE = 4
_PIECE = 1 << 16


def fingerprint(text: bytes, shingle: int = 4, seed: int = SEED) -> int:
    """Majority bits over the XXH64 values of all word shingles; no words give zero."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    count = max(1, len(words) - shingle + 1)
    if count == 1:
        return xxhash.xxh64_intdigest(joined, seed)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:count].tolist()
    ends = ends[shingle - 1 :].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for i in range(0, count, _PIECE):
        values = [digest(joined[a:b], seed) for a, b in zip(starts[i : i + _PIECE], ends[i : i + _PIECE])]
        octets = np.array(values, np.uint64).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4) -> DataFrame:
    """(doc_id, key, fp) for every row; key is a hash of id and text, fp the fingerprint as a signed long. Null text
    counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "t", 8 << 20):
            values = np.array([fingerprint(t, shingle) for t in utf8(batch.column("t"))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("d"), batch.column("k"), pa.array(values)], names=["doc_id", "key", "fp"])

    keep_batches_small(docs.sparkSession)
    picked = docs.select(F.col(doc_id).cast("long").alias("d"), row_key(doc_id, text).alias("k"), F.col(text).cast("string").alias("t"))
    return picked.mapInArrow(run, "doc_id long, key long, fp long")


def _segments(distance: int) -> list[tuple[int, int]]:
    """(start, width) of the fewest segments of which one must differ by at most one bit."""
    n = distance // 2 + 1
    bounds = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(bounds, bounds[1:])]


def _signatures(distance: int):
    """Per segment and bit: the segment with that bit blanked, tagged with the bit's place."""
    parts = []
    for start, width in _segments(distance):
        segment = F.shiftrightunsigned("fp", start).bitwiseAND(F.lit((1 << width) - 1))
        for bit in range(width):
            blanked = segment.bitwiseAND(F.lit(((1 << width) - 1) ^ (1 << bit)))
            parts.append(F.shiftleft(F.lit(start + bit).cast("long"), 40).bitwiseOR(blanked))
    return F.explode(F.array(*parts))


def _spanning(values: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Enough true links to connect what is connected inside one signature group.

    All are held against the first; only those it does not reach are held against every other, so a
    dense group of near copies costs one pass and never lists its pairs.
    """
    links, group = [], np.arange(len(values))
    near = np.bitwise_count(values ^ values[0]) <= distance
    for i in np.flatnonzero(near)[1:]:
        links.append((values[0], values[i]))
    group[near] = 0
    for i in np.flatnonzero(~near):
        hits = np.flatnonzero(np.bitwise_count(values ^ values[i]) <= distance)
        others, first = np.unique(group[hits], return_index=True)
        for g, at in zip(others, hits[first]):
            if g != group[i]:
                links.append((values[i], values[at]))
                group[group == g] = group[i]
    return links


def _linked_runs(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Verified links inside each run of equal signatures; rows arrive sorted by signature."""

    def out(keys: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        change = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        starts = np.concatenate([[0], change])
        sizes = np.diff(np.concatenate([starts, [len(keys)]]))
        pairs = starts[sizes == 2]
        pairs = pairs[np.bitwise_count(values[pairs] ^ values[pairs + 1]) <= distance]
        found = [np.stack([values[pairs], values[pairs + 1]], axis=1)]
        for start, size in zip(starts[sizes > 2], sizes[sizes > 2]):
            if links := _spanning(values[start : start + size], distance):
                found.append(np.array(links, np.uint64))
        links = np.unique(np.concatenate(found), axis=0).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], names=["a", "b"])

    keys, values = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    for batch in batches:
        keys = np.concatenate([keys, batch.column("sig").to_numpy()])
        values = np.concatenate([values, batch.column("fp").to_numpy().view(np.uint64)])
        open_run = np.searchsorted(keys, keys[-1]) if len(keys) else 0
        if open_run:
            yield out(keys[:open_run], values[:open_run])
            keys, values = keys[open_run:], values[open_run:]
    if len(keys):
        yield out(keys, values)


def links(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links (a, b) between different fingerprints (fp) that connect all within ``distance`` bits.

    Two fingerprints that differ in at most ``distance`` bits agree, up to one bit, on one of
    ``distance // 2 + 1`` segments, so both carry the signature that blanks this bit. Signatures meet by
    equality; a group holds different fingerprints only, copies were collapsed before.
    """
    signed = distinct.select(_signatures(distance).alias("sig"), "fp")
    grouped = signed.repartition("sig").sortWithinPartitions("sig", "fp")
    return grouped.mapInArrow(lambda it: _linked_runs(it, distance), "a long, b long").distinct()


def _groups(prints: DataFrame, distance: int) -> DataFrame:
    """(fp, root) for every different fingerprint; root names its component."""
    distinct = written(prints.select("fp").distinct(), "distinct")
    roots = components(links(distinct, distance)).withColumnRenamed("node", "fp")
    return distinct.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, distance: int = DISTANCE
) -> DataFrame:
    """(doc_id, fingerprint as 16 hex digits, component_id) for every row.

    component_id is the smallest doc_id reachable over links of at most ``distance`` differing bits, itself
    included. Null or wordless texts have fingerprint zero and are linked like any other; a repeated row is
    returned once per row; a component of null ids only has a null component_id; an empty table gives none.
    """
    prints = written(fingerprints(docs, doc_id, text, shingle).drop("key"), "fingerprints")
    groups = written(_groups(prints, distance), "groups")
    # ids first shrink to one per fingerprint, then to one per component: a hot group is combined before each shuffle
    per_print = prints.groupBy("fp").agg(F.min("doc_id").alias("least")).join(groups, "fp")
    least = per_print.groupBy("root").agg(F.min("least").alias("component_id"))
    named = groups.join(least, "root").select("fp", "component_id")
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(named, "fp").select("doc_id", shown.alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, distance: int = DISTANCE) -> DataFrame:
    """The documents, same columns, one of each component: the one with the smallest id (null ids last, then by a
    hash of the text). Rows that repeat id and text are one document."""
    prints = written(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key"))
    per_print = prints.groupBy("fp").agg(first.alias("first")).join(_groups(prints, distance), "fp")
    kept = per_print.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.key").alias("key"))
    places = {name: f"c{i}" for i, name in enumerate(docs.columns)}  # no name of the documents can clash
    keyed = docs.toDF(*places.values()).withColumn("key", row_key(places[doc_id], places[text]))
    return keyed.join(kept, "key", "left_semi").dropDuplicates(["key"]).drop("key").toDF(*places)
