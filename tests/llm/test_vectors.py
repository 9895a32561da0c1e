import numpy as np
import pytest

from wattline.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, key int, at int, query int, label int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, 2, 3, 4) for i, v in rows], SCHEMA)


def plain(rows, queries, k):
    ok = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v) and (i, tuple(v)) not in ok:
            ok[(i, tuple(v))] = np.array(v, np.float32).astype(np.float64)
    out = {}
    for (i, _), q in ok.items():
        if i in queries:
            ranked = sorted((-float((v * q).sum()), j) for (j, _), v in ok.items() if j != i)
            out[i] = [(j, -s) for s, j in ranked[:k]]
    return out


def found(result):
    out = {}
    for r in result.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / max(1, len(want[q])) for q in want])


def test_small_table_is_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=7).round(2).tolist()) for i in range(60)]
    rows += [(100, None), (101, [0.0] * 7), (102, [1, None, 2, 3, 4, 5, 6]), (103, [float("nan")] * 7), (104, [float("inf")] + [1.0] * 6), (105, [1.0, 2.0]), (None, [1.0] * 7)]
    rows += [(200 + i, [0.5] * 7) for i in range(30)] + [(0, rows[0][1])]
    df = frame(spark, rows)
    got = found(vectors.search(df, df.where("vec_id % 5 = 0"), k=6))
    usable = [r for r in rows if r[0] != 105]
    want = plain(usable, {i for i, _ in usable if i is not None and i % 5 == 0}, 6)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], atol=1e-12)


def test_fewer_candidates_than_asked(spark):
    df = frame(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 1.0])])
    assert {q: len(v) for q, v in found(vectors.search(df, df, k=20)).items()} == {0: 2, 1: 2, 2: 2}
    one = frame(spark, [(0, [1.0, 0.0])])
    assert vectors.search(one, one).count() == 0


def test_empty_table(spark):
    empty = frame(spark, [])
    assert vectors.search(empty, empty).count() == 0 and vectors.search(empty, empty).columns == ["query_id", "rank", "vec_id", "score"]


@pytest.mark.parametrize("hot", [False, True])
def test_recall(spark, hot):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    rows = [(r.vec_id, list(r.embedding)) for r in table.collect()]
    if hot:
        rows += [(10_000 + i, rows[3][1]) for i in range(1000)]
    df = frame(spark, rows)
    got = found(vectors.search(df, df.where("vec_id % 20 = 0"), k=20))
    want = plain(rows, {i for i, _ in rows if i % 20 == 0}, 20)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    assert recall(got, want) >= 0.9


def test_scan_keeps_the_nearest():
    """On a list scanned at once, abandoning candidates early loses next to nothing."""
    rng = np.random.default_rng(2)
    x, lost = rng.normal(size=(3000, 65)), 0
    for _ in range(20):
        q = rng.normal(size=65)
        kept = vectors.scan([x[:, i : i + vectors.BLOCK] for i in range(0, 65, vectors.BLOCK)], q, 21)
        near = np.argsort(((x - q) ** 2).sum(axis=1))[:21]
        lost += len(set(near) - set(kept))
    assert lost <= 0.02 * 20 * 21
