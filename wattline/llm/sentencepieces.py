"""Exact SentencePiece encoding from a table of each prefix's last piece, and decoding."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache
from itertools import chain

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import keep_batches_small, small_batches, strings

SPACE = "▁"
END = 2
_CHUNK = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n")
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6  # piece types of the model format
_CACHED, _TESTED = 600_000, 300_000  # words and pair tests a task remembers


class Pieces:
    """A BPE piece model with byte fallback, dummy prefix and no normalisation.

    Joining two neighbours is allowed when their concatenation is a piece; the best score goes first, the
    leftmost on ties. The encoding of a prefix minus its last piece is the encoding of the shorter prefix, and
    a sequence is an encoding exactly when every neighbouring pair is its own encoding. So the last
    piece of each prefix is the only match ending there that is compatible with the last piece before it.
    """

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        spec = model.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not (spec.add_dummy_prefix and spec.escape_whitespaces):
            raise ValueError("only models without normalisation, with a dummy prefix, are supported")
        self.rank, self.pieces, self.byte_id, self.out = {}, [], {}, []
        for i, piece in enumerate(model.pieces):
            self.pieces.append(piece.piece)
            if piece.type == _NORMAL:
                self.rank[piece.piece] = (-piece.score, i)
                if SPACE in piece.piece.lstrip(SPACE):
                    raise ValueError("a piece crosses a word start")
                self.out.append(piece.piece.replace(SPACE, " ").encode())
            elif piece.type == _BYTE:
                value = int(piece.piece[3:5], 16)
                self.byte_id[value] = i
                self.out.append(bytes([value]))
            else:
                self.out.append(" ⁇ ".encode() if piece.type == _UNKNOWN else b"")
        self.is_byte = set(self.byte_id.values())
        self.known = {c for p in self.rank for c in p}
        self.neighbours = {p[k : k + 2] for p in self.rank for k in range(len(p) - 1)}  # signs side by side in a piece
        if "\n" in self.known:
            raise ValueError("line ends are pieces; chunks must not be cut there")
        self.edges, self.automaton = {}, ahocorasick.Automaton()
        for piece, (_, i) in self.rank.items():
            steps = self._steps(piece)
            if steps is not None:
                self.edges[i] = steps
                self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        self.memo: dict[int, bool] = {}
        self.cache: dict[str, tuple[int, ...]] = {}

    def _steps(self, piece: str):
        """How a piece grows from its characters: per join, its cost and the first and last symbol after it.
        None if its characters never join to the whole piece."""
        symbols, steps, rank = list(piece), [(piece[0], piece[-1])], self.rank
        costs = []
        while len(symbols) > 1:
            best = min(((rank[a + b][0], k) for k, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in rank), default=None)
            if best is None:
                return None
            cost, k = best
            symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]
            costs.append((cost, k == len(symbols) - 1))
            steps.append((symbols[0], symbols[-1]))
        return costs, [s[0] for s in steps], [s[1] for s in steps]

    def compatible(self, left: int, right: int) -> bool:
        """Whether left followed by right is its own encoding: replay both growths in the order of
        costs and see whether the two symbols at the border would join first."""
        (lcost, _, lsym), (rcost, rsym, _) = self.edges[left], self.edges[right]
        rank, i, j = self.rank, 0, 0
        never = (float("inf"),)
        while True:
            nl = lcost[i][0] if i < len(lcost) else never[0]
            nr = rcost[j][0] if j < len(rcost) else never[0]
            across = rank.get(lsym[i] + rsym[j])
            # on ties the leftmost goes first: joins inside the left piece start left of the border symbol
            if across is not None and across[0] < nl and across[0] <= nr:
                return False
            if nl == nr == never[0]:
                return True
            if nl <= nr:
                i += 1
            else:
                j += 1

    def _known_run(self, run: str) -> list[int]:
        """Ids of a run of known characters: fill the prefix table, then read it backwards."""
        memo, size = self.memo, [0] * (len(run) + 1)
        last = [-1] * (len(run) + 1)
        for end, (token, length) in self.automaton.iter(run):
            end += 1
            if last[end] >= 0:
                continue
            start = end - length
            if start:
                key = last[start] << 20 | token
                fits = memo.get(key)
                if fits is None:
                    if len(memo) > _TESTED:
                        memo.clear()
                    fits = memo[key] = self.compatible(last[start], token)
                if not fits:
                    continue
            last[end], size[end] = token, length
        ids, at = [], len(run)
        while at:
            ids.append(last[at])
            at -= size[at]
        return ids[::-1]

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        if len(self.cache) >= _CACHED:
            self.cache.clear()
        if not self.known.issuperset(chunk):
            found = self._with_unknown(chunk)
        else:
            end = len(chunk)  # signs at the end that no piece holds behind the sign before them stand alone
            while end > 1 and chunk[end - 2 : end] not in self.neighbours:
                end -= 1
            body = chunk[:end]
            ids = (self.cache.get(body) if end < len(chunk) else None) or tuple(self._known_run(body))
            if end < len(chunk):
                self.cache[body] = ids
                ids += tuple(i for c in chunk[end:] for i in self._known_run(c))
            found = ids
        self.cache[chunk] = found
        return found

    def _with_unknown(self, chunk: str) -> tuple[int, ...]:
        ids, run = [], []
        for c in chunk:
            if c in self.known:
                run.append(c)
                continue
            if run:
                ids += self._known_run("".join(run))
                run = []
            ids += [self.byte_id[b] for b in c.encode()]
        if run:
            ids += self._known_run("".join(run))
        return tuple(ids)

    def encode(self, text: str) -> list[int]:
        """Ids without an end id. Words are independent since no piece crosses a word start or line end."""
        if not text:
            return []
        cached, fresh = self.cache.get, self._chunk
        chunks = _CHUNK.findall(SPACE + text.replace(" ", SPACE))
        return list(chain.from_iterable([cached(c) or fresh(c) for c in chunks]))

    def decode(self, ids: list[int]) -> str:
        """The text: pieces joined, word starts as spaces, the dummy one dropped, byte pieces as UTF-8."""
        joined = b"".join(map(self.out.__getitem__, ids))
        try:
            text = joined.decode()
        except UnicodeDecodeError:  # byte pieces that are no UTF-8: one replacement sign per bad byte
            text = self._repaired(ids)
        first = next((i for i in ids if self.out[i]), None)
        drops = first is not None and first not in self.is_byte and self.pieces[first].startswith(SPACE)
        return text[1:] if drops else text

    def _repaired(self, ids: list[int]) -> str:
        parts, raw = [], b""
        for i in [*ids, END]:
            if i in self.is_byte:
                raw += self.out[i]
                continue
            while raw:
                for n in (1, 2, 3, 4):
                    try:
                        parts.append(raw[:n].decode())
                        raw = raw[n:]
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    parts.append("�")
                    raw = raw[1:]
            parts.append(self.out[i].decode())
        return "".join(parts)


@cache
def load(path: str) -> Pieces:
    """One model per worker process and path."""
    return Pieces(path)


def encode(
    docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text", end_id: int | None = END,
    digests: bool = False,
) -> DataFrame:
    """Encode and decode every text: (doc_id, n_tokens, ids, decoded), or with ``digests`` the hashes
    ids_sha256 (decimal ids joined by one space) and decoded_sha256 in place of the values.

    One row per input row, repeated rows and null ids included; a null text is empty and holds the end id only.
    ``model`` is a path that every worker can open.
    """
    values = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model)
        written = [str(i) for i in range(len(pieces.pieces))]
        tail = [] if end_id is None else [end_id]
        for batch in small_batches(batches, "t", 4 << 20):
            counts, first, second = [], [], []
            for t in strings(batch.column("t")):
                ids = pieces.encode(t) + tail
                back = pieces.decode(ids)
                counts.append(len(ids))
                if digests:
                    first.append(hashlib.sha256(" ".join(map(written.__getitem__, ids)).encode()).hexdigest())
                    second.append(hashlib.sha256(back.encode()).hexdigest())
                else:
                    first.append(ids)
                    second.append(back)
            kind = pa.string() if digests else pa.list_(pa.int32())
            arrays = [batch.column("d"), pa.array(counts, pa.int64()), pa.array(first, kind), pa.array(second, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_tokens", *(c.split()[0] for c in values.split(", "))])
        # the worker process lives on and may do other work next
        pieces.cache.clear(), pieces.memo.clear()

    keep_batches_small(docs.sparkSession)
    picked = docs.select(F.col(doc_id).cast("long").alias("d"), F.col(text).cast("string").alias("t"))
    return picked.mapInArrow(run, f"doc_id long, n_tokens long, {values}")
