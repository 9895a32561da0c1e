import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattline.llm import hmm
from wattline.llm.common import crc_part

SCHEMA = "doc_id long, text string, row int, train int, codes int"


def plain_base(rows, held):
    """doc_id -> n_tokens, n_known, N, base score."""
    counts = Counter()
    for d, t in rows:
        if not held(d):
            counts.update([*(t or "").encode().lower().split(), None])
    n, v = sum(counts.values()), len(counts)
    out = []
    for d, t in rows:
        tokens = [*(t or "").encode().lower().split(), None]
        out.append((d, held(d), len(tokens), sum(counts[w] > 0 for w in tokens), n, sum(log10((counts[w] + 1) / (n + v + 1)) for w in tokens)))
    return out


def held_out(d):
    return zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2


def check(spark, rows):
    frame = spark.createDataFrame([(d, t, 1, 2, 3) for d, t in rows], SCHEMA).repartition(4)
    got = sorted(hmm.score_texts(frame, crc_part("doc_id", 7) == 2).collect(), key=lambda r: (str(r.doc_id), r.n_tokens, r.base_score))
    want = sorted(plain_base(rows, held_out), key=lambda r: (str(r[0]), r[2], r[5]))
    assert [tuple(g)[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g.base_score for g in got], [w[5] for w in want], rtol=1e-9)
    assert all(np.isfinite(g.score) and g.score < 0 for g in got)
    return got


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = check(spark, [tuple(r) for r in docs.collect()])
    held = [g for g in got if g.held_out]
    assert sum(g.score for g in held) > sum(g.base_score for g in held)


def test_odd_rows(spark):
    check(spark, [(1, None), (2, ""), (3, "A b\x0bB"), (None, "x y"), (5, "x " * 9000), (5, "x " * 9000), (6, "À à"), (9, "new words only"), (10, "a b"), (16, "a c")])


def test_words_of_all_training_texts_are_counted(spark, monkeypatch):
    docs = spark.range(12_000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("A b"), F.concat(F.lit("w"), F.col("id") % 4_000), F.lit("b")).alias("text"))
    counts = hmm.word_counts(docs.union(docs.where("doc_id = 7")), F.col("doc_id") != 5, "text")
    want = Counter({b"a": 12_000, b"b": 24_000} | {b"w%d" % i: 3 for i in range(4_000)} | {b"w5": 2, b"w7": 4})
    assert Counter({bytes(r.w): r.c for r in counts.collect()}) == want
    monkeypatch.setattr(hmm, "FREQUENT", 5)
    words, rest = hmm.frequent_words(counts)
    assert words == [b"b", b"a", b"w7", b"w0", b"w1"]
    assert {bytes(r.w) for r in rest.collect()} == set(want) - set(words)


def test_every_training_text_is_learned_from(spark):
    sequences = [[1 + i % 3, 4, 0] for i in range(40)]
    frame = spark.createDataFrame([(i, i != 3, bytearray(np.array(s, "<u2").tobytes())) for i, s in enumerate(sequences)], "row long, train boolean, codes binary")
    overall = np.full(hmm.CLASSES, 1 / hmm.CLASSES)
    parts = [hmm._expected(frame.where(F.pmod(F.xxhash64("row"), F.lit(4)) == i), hmm.random_model(overall)) for i in range(4)]
    whole = hmm.Counts.zero()
    hmm.expect(hmm.random_model(overall), [np.array(s) for i, s in enumerate(sequences) if i != 3], whole)
    assert np.allclose(sum(parts, hmm.Counts.zero()).emit, whole.emit, rtol=1e-3, atol=1e-4) and abs(whole.emit.sum() - 3 * 39) < 1e-2
    model = hmm.learn(frame, overall)
    assert np.isfinite(model.emit).all() and np.allclose(model.move.sum(axis=1), 1)


def test_nothing_to_learn_from(spark):
    held = next(d for d in range(100) if held_out(d))
    check(spark, [(held, "a b"), (held, None)])
    assert hmm.score_texts(spark.createDataFrame([], SCHEMA), F.lit(False)).count() == 0


def model(seed):
    rng = np.random.default_rng(seed)
    overall = rng.dirichlet(np.ones(hmm.CLASSES))
    emit = rng.dirichlet(np.ones(hmm.CLASSES), hmm.STATES).T
    return hmm.Model(rng.dirichlet(np.ones(hmm.STATES)), rng.dirichlet(np.ones(hmm.STATES), hmm.STATES), emit / overall[:, None], overall)


def plain_forward(m, s):
    a, total = m.start * m.emit[s[0]] * m.overall[s[0]], 0.0
    for x in s[1:]:
        total += np.log10(a.sum())
        a = (a / a.sum()) @ m.move * m.emit[x] * m.overall[x]
    return total + np.log10(a.sum())


def test_pieces_give_the_exact_likelihood():
    rng, m = np.random.default_rng(5), model(1)
    sequences = [rng.integers(0, hmm.CLASSES, n) for n in (1, 2, hmm.SEGMENT, hmm.SEGMENT + 1, 1500, 3)]
    assert np.allclose(hmm.log10_likelihoods(m, sequences), [plain_forward(m, s) for s in sequences], rtol=1e-10)


def test_expected_counts_equal_plain_forward_backward():
    rng, m = np.random.default_rng(6), model(2)
    sequences = [rng.integers(0, 40, n) for n in (1, 2, 30, 17)]
    counts = hmm.Counts.zero()
    hmm.expect(m, sequences, counts)
    start, move, emit = np.zeros(hmm.STATES), np.zeros((hmm.STATES,) * 2), np.zeros((hmm.CLASSES, hmm.STATES))
    for s in sequences:
        alpha = [m.start * m.emit[s[0]]]
        for x in s[1:]:
            alpha.append(alpha[-1] @ m.move * m.emit[x])
        beta = [np.ones(hmm.STATES)]
        for x in s[:0:-1]:
            beta.insert(0, m.move @ (m.emit[x] * beta[0]))
        whole = alpha[-1].sum()
        for t, x in enumerate(s):
            emit[x] += alpha[t] * beta[t] / whole
            if t:
                move += np.outer(alpha[t - 1], m.emit[x] * beta[t]) * m.move / whole
        start += alpha[0] * beta[0] / whole
    for a, b in ((counts.start, start), (counts.move, move), (counts.emit, emit)):
        assert np.allclose(a, b, rtol=2e-3, atol=1e-4)


def test_rounds_raise_the_likelihood():
    rng = np.random.default_rng(7)
    sequences = [np.concatenate([rng.integers(20 * (k % 2), 20 * (k % 2) + 20, 15) for k in range(6)]) for _ in range(40)]
    counts = np.bincount(np.concatenate(sequences), minlength=hmm.CLASSES)
    overall = (counts + 1.0) / (counts + 1.0).sum()
    m, last = hmm.first_model(sequences, overall), -np.inf
    for _ in range(3):
        c = hmm.Counts.zero()
        hmm.expect(m, sequences, c)
        m = hmm.maximise(c, overall)
        now = sum(hmm.log10_likelihoods(m, sequences))
        assert now >= last - 1
        last = now


@pytest.mark.parametrize("word", [b"abc", b"\xc3\xa9"])
def test_word_classes_agree_with_spark(spark, word):
    frame = spark.createDataFrame([(bytearray(word),)], "w binary")
    assert frame.select(F.crc32("w") % hmm.BUCKETS).first()[0] + 1 + hmm.FREQUENT == hmm._bucket(word)
