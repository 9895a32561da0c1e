import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from wattline.llm import sentencepieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def pieces():
    return sentencepieces.load(MODEL)


def test_random_texts_equal_the_library(library, pieces):
    random.seed(3)
    signs = " abcdethinorsé▁\n\t  <s>0É€😀ﬀ'\".,;{}()=ſ\x00-_"
    for _ in range(5000):
        text = "".join(random.choice(signs) for _ in range(random.randint(0, 30)))
        ids = pieces.encode(text)
        assert ids == library.encode(text), repr(text)
        assert pieces.decode(ids) == library.decode(ids), repr(text)


def test_any_ids_decode_as_the_library(library, pieces):
    random.seed(4)
    for _ in range(5000):
        ids = [random.randrange(3, 259) if random.random() < 0.5 else random.randrange(32000) for _ in range(random.randint(0, 9))]
        assert pieces.decode(ids) == library.decode(ids), ids


def test_prefix_table_equals_plain_joining(pieces):
    """The table against joining the best pair again and again."""
    random.seed(5)
    for _ in range(500):
        text = "".join(random.choice("abcdethinors▁") for _ in range(12))
        symbols = list(text)
        while True:
            pairs = [(pieces.rank[a + b][0], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in pieces.rank]
            if not pairs:
                break
            i = min(pairs)[1]
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
        assert [pieces.pieces[i] for i in pieces._known_run(text)] == symbols


def test_documents_and_odd_rows(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(None, "x y"), (-1, None), (-2, ""), (-3, " "), (-4, "ab " * 40_000), (-2, "")], docs.schema)
    frame = docs.union(odd).selectExpr("*", "1 as t", "2 as d", "3 as ids")
    want = []
    for doc_id, text in docs.union(odd).collect():
        ids = library.encode(text or "") + [2]
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), library.decode(ids))]
        want.append((doc_id, len(ids), *sha))
    got = [tuple(r) for r in sentencepieces.encode(frame, MODEL, digests=True).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    full = sentencepieces.encode(frame, MODEL).where("doc_id = -3").first()
    assert full.ids == library.encode(" ") + [2] and full.decoded == " "


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sentencepieces.encode(empty, MODEL).count() == 0
