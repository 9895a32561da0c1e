import math
import re
from collections import Counter

import numpy as np
import pytest

from wattline.llm import lexical
from wattline.llm.queries import op12_lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=20):
    """Every item against every document, in whole numbers."""
    counts = [(d, Counter(plain_terms(t))) for d, t in docs]
    n_docs = sum(1 for _, c in counts if c)
    length = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        found = []
        for d, c in counts:
            n = sum(c.values())
            if not n:
                continue
            m = 75 + (25 * n * n_docs) // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in plain_terms(text))
            if score > 0:
                found.append((-score, d is not None, d or 0, d))
        found.sort(key=lambda f: f[:3])
        out += [(item, rank + 1, d, -s) for rank, (s, _, _, d) in enumerate(found[:k])]
    return out


def test_terms():
    rng = np.random.default_rng(0)
    for _ in range(2000):
        text = "".join(rng.choice(list("aZ09 _-.\0\n@[`{\x7fÉé日´ª\x85 "), rng.integers(0, 15)))
        assert [t.decode() for t in lexical.terms(text.encode())] == plain_terms(text)


def test_trees_find_the_best_and_leave_documents_unseen():
    rng = np.random.default_rng(1)
    weights = rng.integers(0, 9000, 300)
    values = np.zeros((1000, 300), np.int64)
    for i in range(1000):
        held = rng.choice(300, 20, replace=False) // (1 + i % 5) + 40 * (i % 5)
        values[i, held] = rng.integers(1, 1_000_000, 20)
    values[500:520] = values[0]  # equal rows
    items = [rng.choice(300, 12).tolist() for _ in range(30)] + [[3, 3, 3], [7]]
    queries, best = lexical.Queries(items, weights, np.arange(300)), lexical.Best(len(items), 20)
    scored = lexical.search_tree(values[:400], list(range(400)), queries, best)
    scored += lexical.search_tree(values[400:], list(range(400, 1000)), queries, best)
    assert scored < 1000 * len(items)
    for i, item in enumerate(items):
        scores = (values[:, item] * weights[item]).sum(axis=1)
        want = sorted(((-s, d) for d, s in enumerate(scores.tolist()) if s > 0))[:20]
        assert sorted((-s, -key) for s, key in best.heaps[i]) == want


def test_balls_hold_their_rows():
    rng = np.random.default_rng(2)
    for scale in (1, 1e10):
        rows = rng.integers(0, 4, (300, 40)) * scale
        starts = np.array([0, 1, 7, 30])
        tree = lexical.grow(rows, starts, 4)
        leaves = []
        for i in range(len(tree.low)):
            inside = rows[tree.order[tree.low[i] : tree.high[i]]]
            gaps = np.sqrt(np.add.reduceat((inside.astype(np.longdouble) - tree.centres[i]) ** 2, starts, axis=1))
            assert (gaps <= tree.radii[i]).all()
            if not tree.child[i]:
                leaves += tree.order[tree.low[i] : tree.high[i]].tolist()
        assert sorted(leaves) == list(range(300))


def test_far_apart_groups_are_pruned():
    values = np.zeros((1024, 64), np.int64)
    values[np.arange(1024), np.arange(1024) % 64] = 500_000 + np.arange(1024) // 64
    queries, best = lexical.Queries([[5]], np.full(64, 3000), np.full(64, 16)), lexical.Best(1, 4)
    assert lexical.search_tree(values, list(range(1024)), queries, best) < 200
    assert sorted(-key for _, key in best.heaps[0]) == [5 + 64 * i for i in range(12, 16)]


ODD_DOCS = [(None, "word one"), (None, "word one"), (-1, None), (-2, ""), (-3, " .,;\n"), (5, "word one two"), (5, "word one two"), (6, "Word, WORD! word"), (7, "é " * 30_000 + "one"), (8, "no such")]
ODD_ITEMS = [(1, "word one word"), (1, "word one word"), (None, "two é"), (3, None), (4, ""), (5, "zzz"), (6, "ONE")]


@pytest.mark.parametrize("block_chars", [100_000, 5])
def test_odd_rows(spark, block_chars):
    docs = spark.createDataFrame(ODD_DOCS, "doc_id long, text string").repartition(4)
    docs = docs.selectExpr("*", "1 as d", "2 as t", "3 as n", "'x' as places", "4 as item_id", "5 as q")
    items = spark.createDataFrame(ODD_ITEMS, "item_id long, text string").selectExpr("*", "1 as i", "2 as t", "3 as u", "9 as doc_id")
    got = lexical.search(docs, items, block_chars=block_chars)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute(ODD_DOCS, ODD_ITEMS), key=str)


def test_few_wanted_and_many_ties(spark):
    rows = [(i, f"same words here {'extra ' * (i % 3)}") for i in range(3000)]
    items = [(1, "same"), (2, "extra here")]
    got = lexical.search(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), spark.createDataFrame(items, "item_id long, text string"), k=7)
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows, items, 7))


def test_empty_tables(spark):
    none, some = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "doc_id long, text string")
    items = some.withColumnRenamed("doc_id", "item_id")
    assert lexical.search(none, items).count() == 0
    assert lexical.search(some, items.where("false")).count() == 0
    assert lexical.search(some.selectExpr("doc_id", "cast(null as string) as text"), items).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    assert sorted(map(tuple, op12_lexical(spark, folder).collect())) == sorted(brute(docs, items))
