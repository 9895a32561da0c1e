import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from wattline.llm import simhash

SCHEMA = "doc_id long, text string, sig int, fp string, a int, root int"


def plain_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    values = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def plain_components(prints, distance=4):
    """prints: list of (doc_id, value); the smallest id reachable for each row."""
    group = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i][1] ^ prints[j][1]).count("1") <= distance and group[i] != group[j]:
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    ids = {}
    for g, (d, _) in zip(group, prints):
        if d is not None:
            ids[g] = min(ids.get(g, d), d)
    return [ids.get(g) for g in group]


def rows(spark, texts):
    return spark.createDataFrame([(d, t, 1, "x", 2, 3) for d, t in texts], SCHEMA)


def check(spark, texts):
    prints = [(d, plain_print(t)) for d, t in texts]
    want = sorted(((d, f"{p:016x}", c) for (d, p), c in zip(prints, plain_components(prints))), key=str)
    got = sorted((tuple(r) for r in simhash.near_duplicates(rows(spark, texts)).collect()), key=str)
    assert got == want


def test_odd_rows(spark):
    long = " ".join(f"w{i % 977}" for i in range(70_000))
    check(spark, [
        (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "One\x0btwo THREE"), (5, "One two three"), (None, "lost row here now"),
        (7, "ÀB c d e f"), (8, "àb c d e f"), (9, "Àb C d e f"), (10, long), (11, long + " tail"), (12, "a b c d"), (12, "a b c d"),
        (None, None),
    ])


def test_one_of_each_group_stays(spark):
    texts = [(5, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (9, "other words are here now"), (9, "other words are here now"), (None, None),
             (None, "quite a different text again"), (9, "the same id with other words")]
    df = rows(spark, texts)
    kept = simhash.one_per_group(df)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(3, "a b c d e f"), (9, "other words are here now"), (None, None), (None, "quite a different text again"), (9, "the same id with other words")], key=str
    )
    assert simhash.one_per_group(df.where("false")).count() == 0


def test_empty_table(spark):
    frame = simhash.near_duplicates(rows(spark, [(1, "a")]).where("false"))
    assert frame.columns == ["doc_id", "fingerprint", "component_id"] and frame.count() == 0


def test_documents_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    check(spark, [tuple(r) for r in docs.collect()])


@pytest.mark.parametrize("spread", [2, 6])
def test_links_connect_the_same_as_all_pairs(spark, spread):
    random.seed(spread)
    values = []
    for _ in range(12):  # chains and clouds of near values around a few centres
        centre = random.getrandbits(64)
        for _ in range(30):
            value = centre
            for bit in random.sample(range(64), random.randint(0, spread)):
                value ^= 1 << bit
            values.append(value)
    values = sorted(set(values))
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(v,) for v in signed], "fp long").repartition(5)
    got = {(a, b) for a, b in simhash.links(frame).collect()}
    assert all(bin((a ^ b) & (1 << 64) - 1).count("1") <= 4 for a, b in got)
    roots = {r.node: r.root for r in simhash.components(simhash.links(frame)).collect()}
    want = plain_components(list(zip(signed, values)))
    assert [roots.get(v, v) for v in signed] == want


def test_long_chain_is_one_component(spark):
    from wattline.llm.components import components

    links = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = components(links).collect()
    assert len(got) == 201 and {r.root for r in got} == {0}
