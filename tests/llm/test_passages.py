import random

import numpy as np
import pyarrow as pa

from wattline.llm import passages as ps

SCHEMA = "doc_id long, text string, k int, start int, doc_key int"


def plain_chain_score(matches):
    best = []
    for i, (a, b) in enumerate(matches):
        top = float(ps.SHINGLE)
        for j, (x, y) in enumerate(matches[:i]):
            if x < a and y < b:
                top = max(top, best[j] + min(ps.SHINGLE, a - x, b - y) - ps.GAP_COST * (a + b - x - y))
        best.append(top)
    return max(best)


def score(at, src):
    total = float(ps.SHINGLE)
    for i in range(1, len(at)):
        a, b = at[i] - at[i - 1], src[i] - src[i - 1]
        total += min(ps.SHINGLE, a, b) - ps.GAP_COST * (a + b)
    return total


def test_chains_equal_plain_dynamic_programming():
    """Where seeds do not overlap the tree finds the best chain exactly."""
    random.seed(1)
    for _ in range(200):
        matches = sorted({(5 * random.randrange(40), 5 * random.randrange(40)) for _ in range(random.randint(1, 40))})
        found = ps.chains(np.array([m[0] for m in matches]), np.array([m[1] for m in matches]))
        assert abs(score(*found[0]) - plain_chain_score(matches)) < 1e-9
        assert sorted(m for at, src in found for m in zip(at, src)) == matches
        assert all(a < b for at, src in found for c in (at, src) for a, b in zip(c, c[1:]))


def test_distance_equals_plain():
    random.seed(2)
    for _ in range(300):
        a, b = ([random.choice("abc") for _ in range(random.randint(0, 9))] for _ in range(2))
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row = row, [i]
            for j, y in enumerate(b, 1):
                row.append(min(before[j - 1] + (x != y), before[j] + 1, row[j - 1] + 1))
        assert ps.distance(a, b) == row[-1]


def words(n, seed):
    rng = random.Random(seed)
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


def changed(text, every):
    return [("X" + w if i % every == every - 1 else w) for i, w in enumerate(text)]


def documents():
    exact, fuzzy, short = words(60, "e"), words(90, "f"), words(30, "s")
    whole = words(120, "w")
    return {
        1: words(80, 1) + exact + words(40, 2),
        2: words(20, 3) + exact + words(70, 4),
        3: exact,
        4: words(50, 5) + fuzzy + words(10, 6),
        5: words(15, 7) + changed(fuzzy, 10) + words(33, 8),
        6: words(15, 9) + short + words(33, 10),
        7: words(5, 11) + short + words(3, 12),
        8: words(200, 13),
        9: whole, 10: whole, 11: whole, 12: words(9, 14) + words(55, "r") + words(20, 15) + words(55, "r"),
    }


def frame(spark, docs, more=()):
    return spark.createDataFrame([(i, " ".join(t), 1, 2, 3) for i, t in docs.items()] + [(i, t, 1, 2, 3) for i, t in more], SCHEMA).repartition(4)


def test_planted_passages(spark):
    docs = documents()
    found = ps.repeated_passages(frame(spark, docs)).collect()
    groups = [{1, 2, 3}, {4, 5}, {9, 10, 11}, {12}]
    for r in found:
        assert any({r.doc_id, r.source_doc_id} <= g for g in groups)
        assert r.end - r.start >= 50 and r.similarity >= 0.8
    for g in groups:  # all but one are reported, tied to that one
        reported = {r.doc_id for r in found if r.doc_id in g}
        assert len(g) == 1 or (len(reported) == len(g) - 1 and {r.source_doc_id for r in found if r.doc_id in g} == g - reported)
    assert {r.doc_id for r in found} & {6, 7, 8} == set()
    for r in found:
        own, source = docs[r.doc_id][r.start : r.end], docs[r.source_doc_id][r.source_start : r.source_end]
        assert ps.distance(own, source) <= 0.2 * max(len(own), len(source)) + 1e-9
    exact = [r for r in found if r.doc_id in {1, 2}]
    assert exact and all(docs[r.doc_id][r.start : r.end] == words(60, "e") for r in exact if r.source_doc_id in {1, 2, 3})


def test_removal_leaves_other_text_alone(spark):
    docs = documents()
    df = frame(spark, docs, [(20, None), (21, ""), (22, "a\n\n b"), (None, " ".join(docs[8][:30])), (8, " ".join(docs[8]))])
    kept = ps.without_repeats(df)
    assert kept.columns == df.columns
    rows = kept.collect()
    by_id = {r.doc_id: r.text for r in rows}
    assert by_id[6] == " ".join(docs[6]) and by_id[22] == "a\n\n b" and by_id[20] is None and None in by_id
    assert sum(r.doc_id == 8 for r in rows) == 2  # rows that repeat are one document
    joined = " ".join(t or "" for t in by_id.values()).split()
    assert joined.count(words(60, "e")[30]) == 1 and joined.count(words(120, "w")[60]) == 1
    assert len({9, 10, 11} & set(by_id)) == 1  # nothing left of the other two


def test_hot_passage_and_long_text(spark):
    passage = words(70, "hot")
    docs = {i: words(30, f"a{i}") + passage + words(30, f"b{i}") for i in range(300)}
    docs[1000] = words(60_000, "long") + passage
    found = ps.repeated_passages(frame(spark, docs)).collect()
    assert len({r.doc_id for r in found}) == 300 and len({r.source_doc_id for r in found}) == 1
    assert all(r.end - r.start == 70 for r in found)


def test_cut_words():
    assert ps.cut_words("a  b\nc d", [(1, 3)]) == "a  d"
    assert ps.cut_words(" a b", [(0, 2)]) == " "
    assert ps.cut_words("a b c", [(2, 3)]) == "a b "
    assert ps.cut_words("a b c", [(0, 1), (1, 2)]) == "c"


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert ps.repeated_passages(empty).count() == 0 and ps.without_repeats(empty).count() == 0


def share_found(spark, docs, wanted):
    """Share of the spans (text, start, end) of which 50 words or more are reported from either of its two texts."""
    found = ps.repeated_passages(frame(spark, docs)).collect()
    for r in found:
        own, source = docs[r.doc_id][r.start : r.end], docs[r.source_doc_id][r.source_start : r.source_end]
        assert r.end - r.start >= 50 and ps.distance(own, source) <= 0.2 * max(len(own), len(source)) + 1e-9
    seen = {(r.doc_id, r.source_doc_id) for r in found}
    return sum((a, b) in seen or (b, a) in seen for a, b in wanted) / len(wanted)


def test_fuzzy_passages_of_few_words(spark):
    """Random one-word changes inside the passage; by construction every pair is a passage of similarity 0.8 or more."""
    for edits, least in ((0.1, 0.97), (0.15, 0.95), (0.19, 0.92)):
        docs, wanted = {}, []
        for n in range(200):
            rng = random.Random(f"{edits}-{n}")
            passage = words(rng.choice([52, 56, 60]), f"{edits}p{n}")
            copy = list(passage)
            for at in rng.sample(range(3, len(copy) - 3), int(edits * len(copy))):
                copy[at] = f"x{rng.randrange(10**6)}"
            docs[2 * n] = words(20, f"{edits}a{n}") + passage + words(20, f"{edits}b{n}")
            docs[2 * n + 1] = words(20, f"{edits}c{n}") + copy + words(20, f"{edits}d{n}")
            wanted.append((2 * n, 2 * n + 1))
        share = share_found(spark, docs, wanted)
        print("edits", edits, "found", share)
        assert share >= least


def test_passages_of_known_pieces(spark):
    """Two texts share a passage of which other texts hold pieces under 50 words."""
    for lengths, own in (((45,), 15), ((45,), 20), ((45, 45), 0), ((45, 45, 45), 0)):
        docs, wanted = {}, []
        for n in range(100):
            pieces = [words(m, f"{lengths}{own}{n}-{i}") for i, m in enumerate(lengths)]
            passage, tag = sum(pieces, []) + words(own, f"{lengths}{own}own{n}"), f"{lengths}{own}{n}"
            for i, piece in enumerate(pieces):
                for j in range(3):
                    docs[10_000 + len(docs)] = words(20, f"{tag}e{i}{j}") + piece + words(20, f"{tag}f{i}{j}")
            for i in (2 * n, 2 * n + 1):
                docs[i] = words(20, f"{tag}g{i}") + passage + words(20, f"{tag}h{i}")
            wanted.append((2 * n, 2 * n + 1))
        share = share_found(spark, docs, wanted)
        print("pieces", lengths, own, "found", share)
        assert share == 1


def _blocks(texts, bits):
    rows = pa.RecordBatch.from_arrays([pa.array([k for k, _ in texts]), pa.array([t for _, t in texts])], names=["k", "t"])
    found = [x for b in ps._seed_blocks(iter([rows]), bits) for x in b.to_pylist()]
    found.sort(key=lambda r: (r["bucket"], r["cell"]))
    return found, pa.Table.from_pylist(found, schema=pa.schema({"bucket": pa.int32(), "cell": pa.int64(), "block": pa.int64(), "data": pa.binary()}))


def test_seeds_take_little_room():
    """A row of its own per seed took 18 bytes in the shuffle."""
    rng = random.Random(4)
    texts = [(rng.randrange(-(1 << 63), 1 << 63), " ".join(str(rng.randrange(50000)) for _ in range(500))) for _ in range(3000)]
    found, _ = _blocks(texts, ps.BUCKET_BITS)
    assert sum(len(r["data"]) for r in found) < 11 * 496 * 3000


def test_ties_equal_plain():
    """Repeated rows, seeds that recur in a text and cells of more than one bucket width, against one dictionary of all seeds."""
    rng = random.Random(5)
    texts = [(rng.randrange(-(1 << 63), 1 << 63), " ".join(rng.choice("abc") for _ in range(rng.randrange(60)))) for _ in range(40)]
    texts += texts[:5]
    places = {}
    for k, t in texts:
        words = t.split()
        for p in range(len(words) - ps.SHINGLE + 1):
            places.setdefault(tuple(words[p : p + ps.SHINGLE]), {}).setdefault(k, set()).add(p)
    wanted = set()
    for of_texts in places.values():
        order = sorted(of_texts)
        for n, k in enumerate(order):
            first, *later = sorted(of_texts[k])
            wanted |= {(k, k, p, first) for p in later}
            wanted |= {(k, order[m], first, min(of_texts[order[m]])) for m in ({0, n - 1} if n else ())}
    for bits in (ps.BUCKET_BITS, ps.BUCKET_BITS + 3):
        ties = []
        for batch in ps._tie_blocks(iter(_blocks(texts, bits)[1].to_batches(max_chunksize=7)), bits):
            for row in batch.to_pylist():
                k, rk, counts, p, ahead = ps._unpacked(row["data"], np.int64, np.int64, np.uint32, np.uint32, np.int32)
                ties += zip(np.repeat(k, counts).tolist(), np.repeat(rk, counts).tolist(), p.tolist(), (p + ahead).tolist())
        assert len(ties) == len(set(ties)) and set(ties) == wanted


def test_simple_pairs_need_no_tree():
    """Where every match is known to follow the one before, the tree finds that one chain too."""
    rng, simple = random.Random(6), 0
    for _ in range(500):
        at, src = (np.cumsum([rng.choice((1, 1, 2, 5, 30, 61)) for _ in range(12)]) for _ in range(2))
        src = at + 7 if rng.random() < 0.7 else src
        if ps._one_chain(np.stack([at * 0, at * 0, at, src]), np.ones(12)).all():
            simple += 1
            assert ps.chains(at, src) == [(at.tolist(), src.tolist())]
    assert simple > 50
