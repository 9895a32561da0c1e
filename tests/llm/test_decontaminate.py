import random

import pytest

from wattline.llm import decontaminate as dc

DOCS = "doc_id long, text string, item_id int, start int, t int"
ITEMS = "item_id long, text string, doc_id int"


def plain_best(pattern, text):
    """Least edit distance of the pattern to any piece of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        before, row = row, [i]
        for j, t in enumerate(text, 1):
            row.append(min(before[j - 1] + (c != t), before[j] + 1, row[j - 1] + 1))
    return min(row)


def edited(text, edits):
    text = list(text)
    for _ in range(edits):
        at = random.randrange(len(text))
        kind = random.randrange(3)
        text[at : at + (kind != 0)] = [random.choice("abcdxyz ")] if kind < 2 else []
    return "".join(text)


@pytest.mark.parametrize("rate", [0.0, 0.05, 0.1, 0.2])
def test_finds_exactly_what_brute_force_finds(rate):
    random.seed(int(rate * 100))
    words = ["the", "of", "and", "to", "with", "then", "thin", "sand", "lot", "flow"]
    items = [(i, " ".join(random.choice(words) for _ in range(random.randint(3, 14)))) for i in range(25)]
    matcher = dc.Matcher(items, rate)
    hits = 0
    for _ in range(60):
        body = " ".join(random.choice(words) for _ in range(40))
        item = random.choice(items)[1]
        text = dc.normal(f"{body} {edited(item, random.randint(0, int(rate * len(item)) + 2))} {body[::-1]}")
        got = {i for i, *_ in matcher.find(text)}
        want = {i for i, t in items if plain_best(dc.normal(t), text) <= int(rate * len(dc.normal(t)))}
        assert got == want
        for i, a, b, d in matcher.find(text):
            assert plain_best(dc.normal(dict(items)[i]), text[a:b]) == d
        hits += len(got)
    assert hits


def test_spans_point_into_the_original_text(spark):
    docs = spark.createDataFrame(
        [(1, "Intro  text.\nThe QUICK brown\tfox jumps over it  today.", 1, 2, 3), (2, None, 1, 2, 3), (3, "", 1, 2, 3), (None, "the quick brown fox jumps over it", 1, 2, 3),
         (5, "İ the quick brown fox jumps over it", 1, 2, 3), (6, "filler " * 60_000 + "the quick brown fox jumps over it", 1, 2, 3),
         (7, "nothing here", 1, 2, 3), (8, "the quick brown fox jumps over it", 1, 2, 3), (8, "the quick brown fox jumps over it", 1, 2, 3)],
        DOCS,
    )
    items = spark.createDataFrame([(10, "the quick brown fox jumps over it", 1), (11, None, 1), (12, " ", 1), (10, "the quick brown fox jumps over it", 1), (13, "The quick  brown fox jumps over it", 0)], ITEMS)
    found = dc.matches(docs, items).collect()
    assert {r.item_id for r in found} == {10, 13}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert sorted(str(r.doc_id) for r in found if r.item_id == 10) == ["1", "5", "6", "8", "8", "None"]
    for r in found:
        assert dc.normal(texts[r.doc_id][r.start : r.end]) == "the quick brown fox jumps over it" and r.distance == 0
    kept = dc.clean(docs, items)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {2, 3, 7}


def test_blocks_of_items_give_the_same(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    one = sorted(map(tuple, dc.matches(docs, items).collect()))
    many = sorted(map(tuple, dc.matches(docs, items, block_chars=2000).collect()))
    assert one == many


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "a b", 1, 1, 1)], DOCS)
    assert dc.matches(docs, items).count() == 0 and dc.matches(some, items).count() == 0
    assert dc.clean(some, items).count() == 1
