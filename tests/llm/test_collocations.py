import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattline.llm import collocations as co
from wattline.llm.queries import ORACLES, op13_collocations

LOWER = {c: c + 32 for c in range(65, 91)}


def brute(docs, min_count=100, top=2000):
    """By the definition, in Python's whole numbers."""
    counts, totals = {}, Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        c = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 6):
                c.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, c in counts.items():
        candidates = {p: a for p, a in c.items() if len(p) > 1 and a >= min_count}
        rows = []
        for p, a in candidates.items():
            inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            if any(len(q) > len(p) and 100 * f >= 100 * a and inside(q) for q, f in candidates.items()):
                continue
            n = totals[lang]
            score, _, l, r = min((1000 * a * n // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), l, r, n))
        rows.sort()
        out += [(lang, i + 1, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r, n) in enumerate(rows[:top])]
    return out


def test_words():
    rng = np.random.default_rng(0)
    for _ in range(2000):
        text = "".join(rng.choice(list("abZÉé日 \t.,;:!?\n\x0b\r\x0c\0\x1c'"), rng.integers(0, 25)))
        want = []
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text.translate(LOWER)):
            want += [*re.findall(r"[^\x20\x09]+", piece), None]
        places, different = co.words_of([text.encode()])
        got = [None if different[i] == b"\xff" else different[i].decode() for i in places]
        assert got == want[:-1]


@pytest.mark.parametrize("burst", [1, 3, 1000])
def test_trie_counts_and_spills_whole_subtrees(burst):
    rng = np.random.default_rng(burst)
    for width in (2, 3, 5):
        trie, want, got, firsts = co.Trie(width, burst), Counter(), Counter(), []
        for _ in range(6):
            rows = rng.zipf(1.5, (rng.integers(0, 300), width)) % 40
            trie.add(rows)
            want.update(map(tuple, rows.tolist()))
            assert trie.entries == sum(trie.sizes.values())
            for found, counts in trie.spill(trie.entries // 2):
                assert found.tolist() == sorted(found.tolist())
                firsts += set(found[:, 0].tolist())
                assert not set(found[:, 0].tolist()) & set(trie.root)  # whole subtrees
                got.update(dict(zip(map(tuple, found.tolist()), counts.tolist())))
        for found, counts in trie.spill(0):
            got.update(dict(zip(map(tuple, found.tolist()), counts.tolist())))
        assert got == want and not trie.entries and not trie.root and firsts


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def made(seed, docs=400):
    rng = np.random.default_rng(seed)
    common = ["New York city", "in spite of the", "a b a b a", "über Öl", "so so so"]
    out = []
    for _ in range(docs):
        words = [common[i] if i < len(common) else f"w{i % 23}" for i in rng.integers(0, 40, rng.integers(0, 60))]
        joined = "".join(w + rng.choice([" ", " ", " ", ", ", "\t", ".\n"]) for w in words)
        out.append(([None, "en", "und", "de"][rng.integers(0, 4)], joined))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_counting_by_the_definition(spark, seed, monkeypatch):
    monkeypatch.setattr(co, "_HELD", 300)  # spills often (in the driver's own functions only)
    rows = made(seed) + [(None, None), ("en", ""), ("xx", " .. \n"), ("", "one two " * 60), ("zz", "long run " * 20_000)]
    rows += [("en", "the same row again and again")] * 120
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(6).selectExpr("*", "1 as c", "2 as t", "'x' as phrase", "3 as rank")
    for min_count, top in ((20, 2000), (100, 3)):
        assert rows_of(co.collocations(frame, min_count=min_count, top=top)) == sorted(brute(rows, min_count, top), key=str)


def test_small_memory_gives_the_same(spark):
    """Tries that spill after every batch and words that are forgotten change nothing."""
    rows = made(3, 200)
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    batches = [b.select(["lang", "t"]) for b in frame.selectExpr("coalesce(lang, 'und') lang", "text t").toArrow().to_batches(10)]
    full = bytes([255]) * (1 << co.BITS - 3)
    sent = type("Sent", (), {"value": full})()
    results = []
    for held, known in ((10**6, 10**6), (5, 10)):
        co._HELD, co._VOCABULARY = held, known
        got = Counter()
        for out in co._counter(range(2, 5), sent, sent)(iter(batches)):
            for lang, phrase, n in zip(*(out.column(c).to_pylist() for c in ("lang", "phrase", "c"))):
                got[lang, phrase] += n
        results.append(got)
    co._HELD, co._VOCABULARY = 1_600_000, 1_000_000
    assert results[0] == results[1] and results[0]


def test_scores_beyond_64_bits(spark):
    rows = [(10**13, 9 * 10**12, 10**13, 10**13), (123456789012, 9999999999999, 123456789013, 1234567890123), (100, 100, 100, 100)]
    frame = spark.createDataFrame(rows, "a long, n long, l long, r long")
    parts = F.col("l").cast("decimal(19,0)") * F.col("r").cast("decimal(19,0)")
    got = frame.select("*", co.quotient(F.col("a"), F.col("n"), parts).alias("s")).collect()
    assert all(r.s == 1000 * r.a * r.n // (r.l * r.r) for r in got)


def test_empty_tables(spark):
    for rows in ([], [("en", None)], [("en", "few words only")]):
        got = co.collocations(spark.createDataFrame(rows, "lang string, text string"))
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and got.count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("lang", "text").collect()]
    assert rows_of(op13_collocations(spark, folder)) == sorted(brute(docs), key=str)
    assert "op13_collocations" in ORACLES
