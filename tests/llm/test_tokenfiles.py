import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from wattline.llm import tokenfiles as tf

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(TOKENIZER)
    found.encode_special_tokens = True
    return found


def test_round_trip_of_ids():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 5, tf.BLOCK, tf.BLOCK + 1, 9000):
        for high in (1, 2, 3, 300, 50257, 2**32):
            ids = rng.integers(0, high, n, dtype=np.uint64).astype("<u4")
            assert (tf.unpack(tf.pack(ids)) == ids).all()
    repeated = np.tile(np.arange(40, dtype="<u4") * 1000, 500)
    assert (tf.unpack(tf.pack(repeated)) == repeated).all() and len(tf.pack(repeated)) < len(repeated) / 2
    assert len(tf.pack(repeated, 1 << 16)) < len(repeated) / 6


def test_blocks_stand_alone_and_are_checked():
    ids = np.random.default_rng(1).integers(0, 900, 3 * tf.BLOCK, dtype=np.uint64).astype("<u4")
    body = tf.pack(ids)
    assert tf.pack(ids[tf.BLOCK : 2 * tf.BLOCK])[tf.HEADER + 16 :] in body
    for at in (0, 40, len(body) // 2, len(body) - 3):
        with pytest.raises((ValueError, IndexError)):
            tf.unpack(body[:at] + bytes([body[at] ^ 1]) + body[at + 1 :])
    with pytest.raises((ValueError, Exception)):
        tf.unpack(body[:-1])


def test_encoder_equals_the_library(library):
    encoder = tf.Encoder(TOKENIZER)
    texts = ["", " ", "  a", "a  b\n\n c \n", "it's we'll 'S", "x\x1cy !\x1c\x1d z", "<|endoftext|> a", "日本 語　か", "a  b  c", "\t\tx  \n", "été 12 ³ Ⅷ½", "a\x85b \x0b c"]
    rng = np.random.default_rng(2)
    signs = " \n\t\x1c\x85 　ab'sé!1_<|>"
    texts += ["".join(rng.choice(list(signs), rng.integers(0, 20))) for _ in range(4000)]
    got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def plain(library, rows):
    out, start = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_documents_and_odd_rows(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    odd = [(None, "no id"), (-5, None), (-4, ""), (-3, " \n"), (-2, "word " * 30_000), (-1, "a"), (-1, "a"), (-1, "b"), (10**12, "last")]
    rows = [tuple(r) for r in docs.collect()] + odd
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6).selectExpr("*", "1 as part", "2 as d", "3 as t", "4 as first")
    got = tf.round_trip(frame, TOKENIZER, 2)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(plain(library, rows), key=str)


def test_ids_themselves(spark, library, tmp_path):
    frame = spark.createDataFrame([(2, "b c"), (1, "a")], "doc_id long, text string")
    tf.write_ids(frame, str(tmp_path / "ids"), TOKENIZER, 2)
    rows = tf.read_ids(spark, str(tmp_path / "ids")).orderBy("doc_id").collect()
    assert [r.ids for r in rows] == [[*library.encode(t).ids, 2] for t in ("a", "b c")] and [r.start for r in rows] == [0, 2]


def test_empty_table(spark):
    assert tf.round_trip(spark.createDataFrame([], "doc_id long, text string"), TOKENIZER, 2).count() == 0


def test_names_of_added_tokens_as_the_library_by_default(spark):
    library = Tokenizer.from_file(TOKENIZER)  # no setting changed
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>y z", "<|endoftext|", "a <|end oftext|> b", "é  <|endoftext|>\n c", "plain words, here."]
    rng = np.random.default_rng(3)
    texts += [" ".join(rng.choice(["<|endoftext|>", "a<|endoftext|>", "word", "it's", "<|", "|>", ""], rng.integers(1, 9))) for _ in range(500)]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert 50256 in want[0]
    got = tf.Encoder(TOKENIZER, names_are_text=False).encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == want
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, tf.round_trip(frame, TOKENIZER, 2).collect())) == plain(library, list(enumerate(texts)))


def test_each_new_word_is_looked_up_once_and_sign_runs_are_shared():
    encoder = tf.Encoder(TOKENIZER, names_are_text=False)
    looked_up = []
    learn = encoder._learn
    encoder._learn = lambda words: (looked_up.extend(words), learn(words))
    texts = ["wort wort*** wort\n", "wort***, ſtraße?! wort", "it's 7*** x'*** <|endoftext|> wort***"]
    assert encoder.encode(texts) == [encoder._plain(t) for t in texts]
    assert encoder.encode(texts) == [encoder._plain(t) for t in texts]
    assert len(looked_up) == len(set(looked_up))
    assert np.frombuffer(encoder.cache["***"], "<u4").tolist() == np.frombuffer(encoder._plain("***"), "<u4").tolist()
