"""A hidden Markov language model: Baum-Welch over all training text, exact scaled likelihoods."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import keep_batches_small, small_batches, utf8
from wattline.sources.scratch import written

STATES = 8
FREQUENT = 49_151  # words with a class of their own: the most frequent ones of all training texts
BUCKETS = 16_384  # classes shared by all other words, by a hash of the word
CLASSES = 1 + FREQUENT + BUCKETS  # class 0 is the end of a text; all fit two bytes
PARTS = 8  # of the training texts; the first rounds take one part each, in turn
START_ROUNDS, ROUNDS = 8, 2
SEGMENT = 256  # tokens of a training sequence, and of a piece of the exact forward pass
PRIOR = 8.0  # weight of the words' overall frequencies in each state's emissions
_LANES = 1024
_COUNTED = 200_000  # different words a task counts before it hands them on


@dataclass
class Model:
    start: np.ndarray  # (states,)
    move: np.ndarray  # (states, states)
    emit: np.ndarray  # (classes, states): probability of a class in a state over its overall probability
    overall: np.ndarray  # (classes,)


def _segments(sequences: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Batches of (segments (n, SEGMENT), their lengths, the sequence each belongs to)."""
    rows, lengths, owner = [], [], []
    for i, s in enumerate(sequences):
        for at in range(0, len(s), SEGMENT):
            piece = s[at : at + SEGMENT]
            rows.append(piece), lengths.append(len(piece)), owner.append(i)
    for at in range(0, len(rows), _LANES):
        part = rows[at : at + _LANES]
        out = np.zeros((len(part), SEGMENT), np.int64)
        for k, piece in enumerate(part):
            out[k, : len(piece)] = piece
        yield out, np.array(lengths[at : at + _LANES]), np.array(owner[at : at + _LANES])


@dataclass
class Counts:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    @staticmethod
    def zero() -> Counts:
        return Counts(np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((CLASSES, STATES)))

    def __add__(self, other: Counts) -> Counts:
        return Counts(self.start + other.start, self.move + other.move, self.emit + other.emit)


def expect(model: Model, sequences: list[np.ndarray], counts: Counts) -> None:
    """Add the expected counts of the sequences: scaled forward and backward passes, many segments abreast."""
    move, emit = model.move.astype(np.float32), model.emit.astype(np.float32)
    for tokens, lengths, _ in _segments(sequences):
        order = np.argsort(-lengths, kind="stable")  # longest first: those still running at a step are a prefix
        tokens, lengths = tokens[order], lengths[order]
        running = [int(np.searchsorted(-lengths, -t, side="left")) for t in range(SEGMENT)]
        steps = int(lengths[0])
        alpha = np.zeros((steps, len(tokens), STATES), np.float32)
        scale = np.ones((steps, len(tokens)), np.float32)
        for t in range(steps):
            n = running[t]
            now = (model.start.astype(np.float32) if t == 0 else alpha[t - 1, :n] @ move) * emit[tokens[:n, t]]
            scale[t, :n] = now.sum(axis=1)
            alpha[t, :n] = now / scale[t, :n, None]
        beta = np.ones((len(tokens), STATES), np.float32)
        for t in range(steps - 1, -1, -1):
            n = running[t]
            gamma = alpha[t, :n] * beta[:n]
            gamma /= gamma.sum(axis=1, keepdims=True)
            if t:
                seen = emit[tokens[:n, t]] * beta[:n] / scale[t, :n, None]
                counts.move += model.move * (alpha[t - 1, :n].T.astype(np.float64) @ seen)
                beta[:n] = seen @ move.T
            else:
                counts.start += gamma.sum(axis=0)
            alpha[t, :n] = gamma  # t - 1 is still needed as alpha, t no longer
        flat = np.concatenate([tokens[: running[t], t] for t in range(steps)])
        gammas = np.concatenate([alpha[t, : running[t]] for t in range(steps)])
        for s in range(STATES):
            counts.emit[:, s] += np.bincount(flat, weights=gammas[:, s], minlength=CLASSES)


def maximise(counts: Counts, overall: np.ndarray) -> Model:
    start = counts.start + 0.1
    move = counts.move + 0.1
    emit = counts.emit + PRIOR * overall[:, None] * CLASSES / 1000
    emit /= emit.sum(axis=0, keepdims=True)
    return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / overall[:, None], overall)


def random_model(overall: np.ndarray, seed: int = 3) -> Model:
    """Random, slow-moving states."""
    rng = np.random.default_rng(seed)
    move = np.full((STATES, STATES), 0.1 / (STATES - 1))
    np.fill_diagonal(move, 0.9)
    emit = overall[:, None] * np.exp(0.7 * rng.normal(size=(CLASSES, STATES)))
    emit /= emit.sum(axis=0, keepdims=True)
    return Model(np.full(STATES, 1 / STATES), move, emit / overall[:, None], overall)


def first_model(sequences: list[np.ndarray], overall: np.ndarray, seed: int = 3) -> Model:
    """A few rounds over the sequences from random states."""
    model = random_model(overall, seed)
    for _ in range(START_ROUNDS):
        counts = Counts.zero()
        expect(model, sequences, counts)
        model = maximise(counts, overall)
    return model


def log10_likelihoods(model: Model, sequences: list[np.ndarray]) -> list[float]:
    """Exact log10 probability of each class sequence, relative to nothing: all parts included.

    The forward recursion is run on pieces of equal length from every state at once, so a piece becomes a scaled
    matrix, and the matrices of a text are multiplied in order: the same product as step by step.
    """
    out = np.zeros(len(sequences))
    state = np.tile(model.start, (len(sequences), 1))
    fresh = np.ones(len(sequences), bool)
    log_overall = np.log10(model.overall)
    for tokens, lengths, owner in _segments(sequences):
        n = len(tokens)
        # (lanes, from, to): the first token of a piece is entered through a move, except in a text's first piece
        lanes = np.tile(np.eye(STATES), (n, 1, 1))
        shift = np.zeros(n)
        for t in range(int(lengths.max())):
            on = lengths > t
            every = bool(on.all())
            part = lanes if every else lanes[on]
            column = tokens[:, t] if every else tokens[on, t]
            part = (part.reshape(-1, STATES) @ model.move).reshape(-1, STATES, STATES) if t else part
            part = part * model.emit[column][:, None, :]
            if t % 16 == 15:
                top = part.max(axis=(1, 2))
                part = part / top[:, None, None]
                if every:
                    shift += np.log10(top)
                else:
                    shift[on] += np.log10(top)
            if every:
                lanes = part
            else:
                lanes[on] = part
        mask = np.arange(SEGMENT)[None, :] < lengths[:, None]
        shift += (log_overall[tokens] * mask).sum(axis=1)
        for lane, i, extra in zip(lanes, owner, shift):
            now = state[i] if fresh[i] else state[i] @ model.move
            fresh[i] = False
            now = now @ lane
            total = now.sum()
            out[i] += np.log10(total) + extra
            state[i] = now / total
    return out.tolist()


def _bucket(word: bytes) -> int:
    return 1 + FREQUENT + zlib.crc32(word) % BUCKETS


def word_counts(docs: DataFrame, train: Column, text: str) -> DataFrame:
    """(w, c): every word of the training texts and how often it occurs in them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(seen: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["w", "c"])

        seen = Counter()
        for batch in small_batches(batches, "t", 2 << 20):
            for t in utf8(batch.column("t")):
                seen.update(t.lower().split())
            if len(seen) > _COUNTED:
                yield counted(seen)
                seen = Counter()
        yield counted(seen)

    return docs.where(train).select(F.col(text).cast("string").alias("t")).mapInArrow(count, "w binary, c long").groupBy("w").agg(F.sum("c").alias("c"))


def frequent_words(counts: DataFrame) -> tuple[list[bytes], DataFrame]:
    """The FREQUENT most frequent words of (w, c), equal ones by their bytes, and the counts of all other words."""
    top = counts.orderBy(F.desc("c"), "w").limit(FREQUENT).collect()
    if len(top) < FREQUENT:
        return [bytes(r.w) for r in top], counts.where(F.lit(False))
    least, last = F.lit(top[-1].c), F.lit(bytearray(top[-1].w))
    return [bytes(r.w) for r in top], counts.where((F.col("c") < least) | (F.col("c") == least) & (F.col("w") > last))


def _coded(docs: DataFrame, words: list[bytes], doc_id: str, text: str, train: Column) -> DataFrame:
    """Each text as classes, with the words that share classes listed by count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {w: i + 1 for i, w in enumerate(words)}.get
        for batch in small_batches(batches, "t", 8 << 20):
            codes, rare, times = [], [], []
            for t in utf8(batch.column("t")):
                split = t.lower().split()
                ids = list(map(number, split))
                seen = Counter(w for w, i in zip(split, ids) if i is None)
                place = {w: _bucket(w) for w in seen}
                codes.append(np.array([place[w] if i is None else i for w, i in zip(split, ids)] + [0], "<u2").tobytes())
                rare.append(list(seen)), times.append(list(seen.values()))
            arrays = [batch.column("row"), batch.column("d"), batch.column("train"), pa.array(codes, pa.binary())]
            arrays += [pa.array(rare, pa.list_(pa.binary())), pa.array(times, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "doc_id", "train", "codes", "words", "times"])

    picked = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("d"), F.coalesce(train, F.lit(True)).alias("train"),
        F.col(text).cast("string").alias("t"),
    )
    return picked.mapInArrow(run, "row long, doc_id long, train boolean, codes binary, words array<binary>, times array<long>")


def _sequences(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(x, "<u2").astype(np.int64) for x in batch.column("codes").to_pylist()]


def _pieces(batches: Iterator[pa.RecordBatch], most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    yield from small_batches(batches, "codes", most)


def _class_counts(coded: DataFrame) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES, np.int64)
        for batch in _pieces(batches):
            total += np.bincount(np.concatenate(_sequences(batch)), minlength=CLASSES)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(total[there])], names=["c", "n"])

    out = np.zeros(CLASSES, np.int64)
    for r in coded.where("train").select("codes").mapInArrow(run, "c int, n long").groupBy("c").agg(F.sum("n").alias("n")).toLocalIterator():
        out[r.c] = r.n
    return out


def _expected(coded: DataFrame, model: Model) -> Counts:
    """Expected counts over all training texts: summed inside tasks, then across them by class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts.zero()
        for batch in _pieces(batches):
            expect(model, _sequences(batch), counts)
        table = np.concatenate([counts.emit, counts.move, counts.start[None, :]])
        there = np.flatnonzero(table.any(axis=1))
        values = [pa.array(table[there, s]) for s in range(STATES)]
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), *values], names=["c", *(f"s{s}" for s in range(STATES))])

    columns = [f"s{s}" for s in range(STATES)]
    each = coded.where("train").select("codes").mapInArrow(run, "c int, " + ", ".join(f"{c} double" for c in columns))
    table = np.zeros((CLASSES + STATES + 1, STATES))
    for r in each.groupBy("c").agg(*[F.sum(c).alias(c) for c in columns]).toLocalIterator():
        table[r.c] = [r[c] for c in columns]
    return Counts(table[-1], table[CLASSES:-1], table[:CLASSES])


def learn(coded: DataFrame, overall: np.ndarray) -> Model:
    """Baum-Welch over all training texts. The first rounds take a part of the texts each, in turn; the model is made of
    the latest counts of every part, so that no text is left out, and each text moves it early. Whole rounds follow."""
    model, latest = random_model(overall), [Counts.zero()] * PARTS
    tasks = -(-coded.rdd.getNumPartitions() // PARTS)  # each task hands on counts of all classes, so a part takes fewer tasks
    for i in range(START_ROUNDS):
        part = coded.where(F.pmod(F.xxhash64("row"), F.lit(PARTS)) == i % PARTS)
        latest[i % PARTS] = _expected(part.coalesce(max(1, tasks)), model)
        known = sum(latest, Counts.zero())
        model = maximise(known, overall) if known.start.any() else model
    for _ in range(ROUNDS):
        model = maximise(_expected(coded, model), overall)
    return model


def score_texts(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every text, null as empty.

    The model learns from the rows where ``held_out`` is false (null counts as false). Tokens are the words between
    white space, A-Z in lower case, then one end token. base_score is the add-one unigram log10 probability. score is
    that of a hidden Markov model over word classes: frequent words are classes of their own, all others share
    BUCKETS classes and are told apart by their add-one share in the class, where one more part is left for unseen
    words. Repeated rows are scored alike (and learned from as often as they occur); with nothing to learn from,
    both scores are those of unseen words only; an empty table gives no rows.
    """
    keep_batches_small(docs.sparkSession)
    train = ~F.coalesce(held_out, F.lit(False))
    words, known = frequent_words(written(word_counts(docs, train, text), "words"))
    coded = written(_coded(docs, words, doc_id, text, train), "coded")
    counts = _class_counts(coded)
    overall = (counts + 1.0) / (counts.sum() + CLASSES)

    # counts of the words that share classes; they are listed once per text and word
    rare = coded.select("row", "train", F.explode(F.arrays_zip("words", "times")).alias("x")).select(
        "row", "train", F.col("x.words").alias("w"), F.col("x.times").alias("n")
    )
    # not joined by a broadcast: the number of words grows with the text
    hits = rare.join(known.hint("merge"), "w")
    sums = hits.groupBy("row").agg(F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("rare_log"), F.sum("n").alias("rare_known"))
    per_class = written(known.groupBy((F.crc32("w") % BUCKETS).cast("int").alias("b")).agg(F.count("*").alias("types"), F.sum("c").alias("c")), "classes")
    types = np.zeros(BUCKETS, np.int64)
    shares = np.ones(BUCKETS)
    for r in per_class.collect():  # at most BUCKETS rows
        types[r.b], shares[r.b] = r.types, r.c + r.types + 1.0
    n_train = int(counts.sum())
    n_types = int(types.sum() + (counts[1 : 1 + FREQUENT] > 0).sum() + (counts[0] > 0))

    model = learn(coded, overall) if n_train else maximise(Counts.zero(), overall)

    base_log = np.zeros(CLASSES)
    base_log[: 1 + FREQUENT] = np.log10(counts[: 1 + FREQUENT] + 1.0)
    own_known = np.zeros(CLASSES, bool)
    own_known[: 1 + FREQUENT] = counts[: 1 + FREQUENT] > 0
    inside = np.zeros(CLASSES)
    inside[1 + FREQUENT :] = -np.log10(shares)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            sequences = _sequences(batch)
            likely = log10_likelihoods(model, sequences)
            columns = [
                batch.column("row"), batch.column("doc_id"), batch.column("train"), pa.array([len(s) for s in sequences], pa.int64()),
                pa.array([int(own_known[s].sum()) for s in sequences], pa.int64()), pa.array([float(base_log[s].sum()) for s in sequences], pa.float64()),
                pa.array([v + float(inside[s].sum()) for v, s in zip(likely, sequences)], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "train", "n_tokens", "known", "base_log", "likely"])

    schema = "row long, doc_id long, train boolean, n_tokens long, known long, base_log double, likely double"
    scored = coded.select("row", "doc_id", "train", "codes").mapInArrow(run, schema).join(sums, "row", "left")
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    return scored.select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base_log") + rare_log - F.col("n_tokens") * F.log10(F.lit(float(n_train + n_types + 1)))).alias("base_score"),
        (F.col("likely") + rare_log).alias("score"),
    )
