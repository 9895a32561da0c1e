import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from wattline.llm import packing
from wattline.llm.queries import op11_packing

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


def brute_combinations(lengths, window):
    there = sorted(set(lengths))
    pairs = {(0, a, b) for a in there for b in there if a <= b and a + b == window}
    return pairs | {(a, b, c) for a in there for b in there for c in there if a <= b <= c and a + b + c == window}


def test_combinations_are_all_pairs_and_triples():
    rng = np.random.default_rng(0)
    for window in (8, 16, 32):
        for _ in range(20):
            lengths = np.unique(rng.integers(1, window, rng.integers(0, window)))
            got = packing.combinations(lengths, window)
            assert len(got) == len({tuple(r) for r in got.tolist()})
            assert {tuple(r) for r in got.tolist()} == brute_combinations(lengths.tolist(), window)


def error_of(columns, counts, histogram):
    used = np.zeros(len(histogram))
    for column, n in zip(columns, counts):
        for v in column:
            used[v] += n
    used[0] = 0
    return float(((histogram - used) ** 2).sum())


def test_counts_come_close_to_the_best_least_squares():
    rng = np.random.default_rng(1)
    for _ in range(10):
        histogram = np.concatenate([[0], rng.integers(0, 50, 31)])
        columns = packing.combinations(np.flatnonzero(histogram), 32)
        counts = packing.solve(columns, histogram)
        assert (counts >= 0).all()
        # projected gradient until it stands still
        dense = np.zeros((32, len(columns)))
        for j, column in enumerate(columns):
            for v in column:
                dense[v, j] += 1
        dense[0] = 0
        x, step = np.zeros(len(columns)), 1 / np.linalg.norm(dense, 2) ** 2
        for _ in range(20_000):
            x = np.maximum(x + step * dense.T @ (histogram - dense @ x), 0)
        best = float(((histogram - dense @ x) ** 2).sum())
        assert error_of(columns, counts, histogram) <= best + 0.05 * float((histogram**2).sum())


def test_plan_uses_every_rest_once_and_fills_all_windows_but_one():
    rng = np.random.default_rng(2)
    cases = [np.zeros(64, np.int64) for _ in range(3)]
    cases[1][40], cases[2][63] = 1000, 7
    cases += [np.concatenate([[0], rng.poisson(m, 63)]) for m in (0.3, 2, 40)]
    cases.append(np.where(np.arange(64) % 2 == 0, 10**9, 0) * (np.arange(64) > 0))
    for histogram in cases:
        runs, sequences = packing.plan(histogram, 64)
        total = int((histogram * np.arange(64)).sum())
        assert sequences == -(-total // 64)
        if histogram.sum() > 10_000:
            assert sum(r.count * r.length for r in runs) == total
            continue
        filled, taken = {}, {}
        for r in runs:
            for i in range(r.count):
                filled.setdefault(r.sequence + i, []).append((r.offset, r.length))
                taken.setdefault((r.rest, r.first + i), []).append((r.start, r.length))
        for pieces in filled.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
            assert at <= 64
        assert sorted(filled) == list(range(sequences)) and sum(sum(n for _, n in p) < 64 for p in filled.values()) <= 1
        assert len(taken) == histogram.sum()
        for (rest, _), pieces in taken.items():
            at = 0
            for start, length in sorted(pieces):
                assert start == at and length > 0
                at += length
            assert at == rest


def check(rows, docs, library, end_id=0, window=packing.WINDOW):
    """Pieces of a document follow each other gaplessly with the ids of the library; sequences are gapless and full but for one."""
    ids = sorted([*library.encode(t or "", add_special_tokens=False).ids, end_id] for _, t in docs)
    by_doc, by_sequence = {}, {}
    for r in rows:
        assert 1 <= r.length <= window
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    total = sum(map(len, ids))
    assert sorted(by_sequence) == list(range(len(by_sequence))) and len(by_sequence) == -(-total // window) if total else not rows
    assert sum(r.length for r in rows) == total
    known = {}
    for d, t in docs:
        known.setdefault(d, []).append([*library.encode(t or "", add_special_tokens=False).ids, end_id])
    assert set(by_doc) == set(known)
    for d, pieces in by_doc.items():
        want = []
        for each in known[d]:
            cuts = {(r.start, r.length) for r in pieces if r.doc_tokens == len(each)}
            assert cuts
        if len(known[d]) == 1:
            want, at = np.array(known[d][0], "<u4"), 0
            for r in sorted(pieces, key=lambda r: r.start):
                assert r.start == at and r.doc_tokens == len(want)
                assert r.ids_crc32 == zlib.crc32(want[at : at + r.length].tobytes())
                at += r.length
            assert at == len(want)


def test_documents_and_odd_rows(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    odd = [(None, "no id"), (-5, None), (-4, ""), (-3, " \n"), (-2, "word " * 30_000), (-1, "a b"), (-1, "a b"), (-1, "b"), (10**12, "<|endoftext|> é")]
    rows = [tuple(r) for r in docs.collect()] + odd
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    frame = frame.selectExpr("*", "1 as part", "'x' as d", "2 as t", "3 as n", "4 as ids", "5 as rest", "6 as bases")
    got = packing.pack_documents(frame, TOKENIZER, digests=True)
    assert got.columns == NAMES
    check(got.collect(), rows, library)


def test_many_documents_of_one_length(spark, library):
    """A length that most documents share is numbered without a group: every piece has a place of its own."""
    rows = [(i, "word " * 700) for i in range(3000)] + [(10_000 + i, "word " * (i + 1)) for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    check(packing.pack_documents(frame, TOKENIZER, digests=True).collect(), rows, library)


def test_ids_themselves_and_another_window(spark, library):
    rows = [(1, "one two three four five six seven eight nine ten " * 3), (2, None), (3, "b c")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = packing.pack_documents(frame, TOKENIZER, end_id=7, window=8).collect()
    for d, t in rows:
        pieces = sorted((r for r in got if r.doc_id == d), key=lambda r: r.start)
        assert [i for r in pieces for i in r.ids] == [*library.encode(t or "").ids, 7]


def test_empty_table(spark):
    got = packing.pack_documents(spark.createDataFrame([], "doc_id long, text string"), TOKENIZER, digests=True)
    assert got.columns == NAMES and got.count() == 0


def test_query(spark, library):
    folder = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    check(op11_packing(spark, folder).collect(), docs, library)
