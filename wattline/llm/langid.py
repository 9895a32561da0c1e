"""Language identification with a small byte convolutional network, trained and applied in numpy."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import keep_batches_small, small_batches, utf8

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 8
PER_LANGUAGE = 500  # labelled documents per language used for fitting: the documented bound of the sample
PER_DOCUMENT = 4  # windows taken from each of them
UNKNOWN = "und"
_TAIL = max(WIDTHS) - 1
_ASCII_LETTER, _ANY_LETTER = re.compile(rb"[A-Za-z]"), re.compile(r"[^\W\d_]")


def has_letter(text: bytes) -> bool:
    return bool(_ASCII_LETTER.search(text)) or bool(_ANY_LETTER.search(text.decode()))


def windows(text: bytes) -> np.ndarray:
    """All windows of a text, (n, WINDOW + tail): fixed length, the last one padded with zero bytes, each
    followed by the bytes that a filter at its last place reaches."""
    n = max(1, -(-len(text) // WINDOW))
    padded = np.zeros(n * WINDOW + _TAIL, np.uint8)
    padded[: len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW + _TAIL)[::WINDOW]


@dataclass
class Net:
    labels: list[str]
    embed: np.ndarray  # (256, EMBED)
    filters: dict[int, np.ndarray]  # width -> (width, EMBED, FILTERS)
    bias: np.ndarray  # (filters of all widths,)
    dense: np.ndarray  # (filters of all widths, labels)
    out: np.ndarray  # (labels,)

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The convolutions as sums of rows: by the pair at a place, the byte two places on, the pair there."""
        each = {w: [self.embed @ self.filters[w][j] for j in range(w)] for w in WIDTHS}
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, FILTERS)
        first = np.empty((65536, FILTERS * len(WIDTHS)), np.float32)
        for k, w in enumerate(WIDTHS):  # width by width: all at once would take three times the room while they are made
            first[:, k * FILTERS : (k + 1) * FILTERS] = pair(*each[w][:2])
        return first, each[3][2].astype(np.float32), pair(*each[4][2:]).astype(np.float32)

    def scorer(self):
        """A function from windows to class probabilities."""
        first, third, second = self.tables()

        def score(x: np.ndarray) -> np.ndarray:
            out = []
            for at in range(0, len(x), 256):
                part = x[at : at + 256]
                pairs = part[:, :-1].astype(np.int32) * 256 + part[:, 1:]
                conv = first[pairs[:, :WINDOW]]
                conv[:, :, FILTERS : 2 * FILTERS] += third[part[:, 2 : WINDOW + 2]]
                conv[:, :, 2 * FILTERS :] += second[pairs[:, 2 : WINDOW + 2]]
                pooled = np.maximum(conv.max(axis=1) + self.bias, 0)
                logits = pooled @ self.dense + self.out
                logits = np.exp(logits - logits.max(axis=1, keepdims=True))
                out.append(logits / logits.sum(axis=1, keepdims=True))
            return np.concatenate(out)

        return score


def fit(x: np.ndarray, y: np.ndarray, labels: list[str], epochs: int = 8, batch: int = 256, rate: float = 0.01, seed: int = 7) -> Net:
    """Train on windows x (n, WINDOW + tail) with classes y by Adam; a fixed seed makes it repeatable."""
    rng = np.random.default_rng(seed)
    wide = FILTERS * len(WIDTHS)
    net = Net(
        labels, rng.normal(0, 0.5, (256, EMBED)), {w: rng.normal(0, 0.35 / w**0.5, (w, EMBED, FILTERS)) for w in WIDTHS},
        np.zeros(wide), rng.normal(0, 0.2, (wide, len(labels))), np.zeros(len(labels)),
    )
    params = [net.embed, *net.filters.values(), net.bias, net.dense, net.out]
    moment, square, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    weight = len(y) / np.maximum(1, np.bincount(y, minlength=len(labels))) / len(labels)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), batch):
            part, target = x[order[at : at + batch]], y[order[at : at + batch]]
            rows = np.arange(len(target))
            first, third, second = net.tables()
            pairs = part[:, :-1].astype(np.int32) * 256 + part[:, 1:]
            conv = first[pairs[:, :WINDOW]]
            conv[:, :, FILTERS : 2 * FILTERS] += third[part[:, 2 : WINDOW + 2]]
            conv[:, :, 2 * FILTERS :] += second[pairs[:, 2 : WINDOW + 2]]
            place = conv.argmax(axis=1)
            raw = np.take_along_axis(conv, place[:, None, :], axis=1)[:, 0] + net.bias
            pooled = np.maximum(raw, 0)
            logits = pooled @ net.dense + net.out
            prob = np.exp(logits - logits.max(axis=1, keepdims=True))
            prob /= prob.sum(axis=1, keepdims=True)
            prob[rows, target] -= 1
            delta = prob * (weight[target] / len(target))[:, None]
            back = (delta @ net.dense.T) * (raw > 0)
            grads = [np.zeros_like(net.embed)]
            for k, w in enumerate(WIDTHS):  # only the place of the maximum passes the gradient on
                own = slice(k * FILTERS, (k + 1) * FILTERS)
                grad = np.zeros_like(net.filters[w])
                for j in range(w):
                    chosen = part[rows[:, None], place[:, own] + j]
                    table = np.zeros((256, FILTERS))
                    np.add.at(table, (chosen, np.arange(FILTERS)[None, :]), back[:, own])
                    grad[j] = net.embed.T @ table
                    grads[0] += table @ net.filters[w][j].T
                grads.append(grad)
            grads += [back.sum(axis=0), pooled.T @ delta, delta.sum(axis=0)]
            step += 1
            for p, g, m, s in zip(params, grads, moment, square):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return net


def sample(labelled: DataFrame, doc_id: str, text: str, lang: str, per_language: int) -> DataFrame:
    """(h, t, g): of each language about ``per_language`` texts or fewer, rows that repeat id and text once."""
    rows = labelled.select(
        F.xxhash64(F.col(doc_id).cast("string"), F.col(text).cast("string")).alias("h"), F.col(text).cast("string").alias("t"), F.col(lang).cast("string").alias("g")
    ).where("t is not null and g is not null")
    counts = {r.g: r["count"] for r in rows.groupBy("g").count().collect()}
    if not counts:
        return rows
    share = F.create_map(*[F.lit(v) for g, n in counts.items() for v in (g, min(1.0, 1.3 * per_language / n))])
    return rows.where(F.shiftrightunsigned("h", 11) / float(1 << 53) < share[F.col("g")]).dropDuplicates(["h", "g"])


def train(labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> Net | None:
    """Fit on at most ``per_language`` documents of each language, chosen by a hash of id and text, and
    PER_DOCUMENT windows of each, some cut short so that short texts are known too. Rows without language or
    letters are left out; rows that repeat id and text count once, whether they have an id or not. None if nothing is left. Only
    these windows reach the driver."""
    keep_batches_small(labelled.sparkSession)
    sampled = sample(labelled, doc_id, text, lang, per_language)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "t", 16 << 20):
            found = []
            for h, t, g in zip(batch.column("h").to_pylist(), utf8(batch.column("t")), batch.column("g").to_pylist()):
                if not has_letter(t):
                    continue
                rng = np.random.default_rng(h & (1 << 63) - 1)
                for k in range(PER_DOCUMENT):
                    at = int(rng.integers(0, max(1, len(t) - WINDOW // 2)))
                    size = WINDOW if k % 2 else int(rng.integers(8, WINDOW))
                    found.append((h, g, t[at : at + size]))
            columns = list(zip(*found)) if found else [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.binary())], names=["h", "g", "w"]
            )

    taken = sorted((r.g, r.h, bytes(r.w)) for r in sampled.mapInArrow(pick, "h long, g string, w binary").collect())
    labels = sorted({g for g, _, _ in taken})
    if not labels:
        return None
    x, y, seen = [], [], {}
    for g, _, w in taken:
        seen[g] = seen.get(g, 0) + 1
        if seen[g] <= per_language * PER_DOCUMENT:
            x.append(windows(w)[0])
            y.append(labels.index(g))
    return fit(np.stack(x), np.array(y), labels)


def predict_texts(net: Net | None, score, texts: list[bytes]) -> tuple[list[str], list[float]]:
    """Language and score per text: the mean class probability over its windows, weighted by their bytes."""
    names, scores, at, held = [UNKNOWN] * len(texts), [0.0] * len(texts), [], []

    def settle() -> None:
        if not held:
            return
        prob = score(np.concatenate(held))
        start = 0
        for i, part in zip(at, held):
            weights = np.full(len(part), float(WINDOW))
            weights[-1] = len(texts[i]) - WINDOW * (len(part) - 1)
            mean = weights @ prob[start : start + len(part)] / weights.sum()
            names[i], scores[i] = net.labels[int(mean.argmax())], float(min(1.0, mean.max()))
            start += len(part)
        at.clear(), held.clear()

    for i, t in enumerate(texts):
        if net and has_letter(t):
            at.append(i)
            held.append(windows(t))
            if sum(map(len, held)) > 4096:
                settle()
    settle()
    return names, scores


def identify(docs: DataFrame, net: Net | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) for every row from the text alone.

    A null text, one without a letter, or any text when nothing was learned is ``und`` with score 0; of equally
    likely languages the first in order wins; repeated rows give repeated results.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = net.scorer() if net else None
        for batch in small_batches(batches, "t", 8 << 20):
            names, scores = predict_texts(net, score, utf8(batch.column("t")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("d"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"]
            )

    keep_batches_small(docs.sparkSession)
    picked = docs.select(F.col(doc_id).cast("long").alias("d"), F.col(text).cast("string").alias("t"))
    return picked.mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, net: Net | None, text: str = "text", least: float = 0.4) -> DataFrame:
    """The rows, all columns as they are, whose language is known with a score of at least ``least``."""
    keep_batches_small(docs.sparkSession)
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = net.scorer() if net else None
        for batch in small_batches(batches, text, 2 << 20):
            names, scores = predict_texts(net, score, utf8(batch.column(text)))
            yield batch.filter(pa.array([n != UNKNOWN and s >= least for n, s in zip(names, scores)], pa.bool_()))
        pa.default_memory_pool().release_unused()  # the worker process lives on and may do other work next

    return docs.mapInArrow(run, schema)
