import hashlib
import random
from collections import Counter

import pytest

from wattline.llm import suffixes as sx

SCHEMA = "doc_id long, text string, k int, a int, h int"


def test_suffix_array_against_sorting():
    random.seed(0)
    for _ in range(4000):
        kinds = random.choice([1, 2, 3, 5])
        s = [random.randrange(kinds) for _ in range(random.randint(0, 16))]
        order = sorted(range(len(s)), key=lambda i: s[i:])
        assert sx.suffix_array(s) == order
        common = [0] * len(s)
        for r in range(1, len(s)):
            a, b = s[order[r - 1] :], s[order[r] :]
            while common[r] < min(len(a), len(b)) and a[common[r]] == b[common[r]]:
                common[r] += 1
        assert sx.common_prefixes(s, order) == common
    for s in ([0] * 900, [i % 7 for i in range(900)], [random.randrange(3) for _ in range(3000)]):
        assert sx.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def plain(texts, length):
    """(bytes, removed, runs, hash of the rest) of each text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        rest = bytes(c for c, g in zip(d, gone) if not g)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(d), sum(gone), runs, hashlib.sha256(rest).hexdigest()))
    return out


def check(spark, rows, length, anchor):
    frame = spark.createDataFrame([(d, t, 1, 2, 3) for d, t in rows], SCHEMA).repartition(5)
    got = [tuple(r) for r in sx.remove_repeats(frame, length=length, anchor=anchor, digests=True).collect()]
    want = [(d, *x) for (d, _), x in zip(rows, plain([t for _, t in rows], length))]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("length,anchor,signs", [(12, 4, "ab"), (20, 8, "abcé"), (40, 16, "abcdefgh"), (20, 8, "a")])
def test_against_brute_force(spark, length, anchor, signs):
    random.seed(length + len(signs))
    base = ["".join(random.choice(signs) for _ in range(random.randint(20, 160))) for _ in range(6)]
    rows = []
    for i in range(60):
        text = list(random.choice(base)[random.randint(0, 20) :] + random.choice(base)[random.randint(0, 20) :])
        for _ in range(random.randint(0, 3)):
            if text:
                text[random.randrange(len(text))] = random.choice(["", "x", "ab"])
        rows.append((i, "".join(text)))
    check(spark, rows, length, anchor)


def test_odd_rows(spark):
    passage = "".join(random.Random(1).choice("abcdefg ") for _ in range(230))
    long = "".join(random.Random(2).choice("abcdefghij ") for _ in range(20_000))
    rows = [
        (1, None), (2, ""), (3, "short"), (4, passage), (5, "x" + passage[:199]), (6, "y" + passage[20:] + "z"), (None, passage),
        (7, "é" * 150), (8, "é" * 300), (9, long), (9, long), (10, "q" + long[500:9000]), (11, passage + "--" + passage),
    ]
    check(spark, rows, 200, 64)


def test_hot_passage(spark):
    passage = "".join(random.Random(3).choice("abcdefg ") for _ in range(260))
    rng = random.Random(4)
    rows = [(i, "".join(rng.choice("abcdefg ") for _ in range(90)) + passage + "".join(rng.choice("abcdefg ") for _ in range(90))) for i in range(400)]
    check(spark, rows, 200, 64)


def test_spans_and_rest(spark):
    passage = "".join(random.Random(5).choice("abcdefg ") for _ in range(210))
    frame = spark.createDataFrame([(1, "AAA" + passage + "BBB", 1, 2, 3), (2, passage, 1, 2, 3)], SCHEMA)
    rows = {r.doc_id: r for r in sx.remove_repeats(frame).collect()}
    assert bytes(rows[1].kept) == b"AAABBB" and [tuple(s) for s in rows[1].spans] == [(3, 213)] and rows[2].n_removed == 210


def test_empty_table(spark):
    assert sx.remove_repeats(spark.createDataFrame([], SCHEMA), digests=True).count() == 0


def test_documents_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    check(spark, [tuple(r) for r in docs], 200, 64)
