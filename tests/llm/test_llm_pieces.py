import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from oddlens.llm import pieces
from oddlens.llm.pieces import PieceCodec, decoded, encoded, piece_digests

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def own():
    with open(PATH, "rb") as file:
        return PieceCodec(file.read())


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aeinorst  ▁\n\tñ字é1.,'👍\x00<s>x0")), max_size=60))
def test_any_text(library, own, text):
    ids = library.encode(text)
    assert own.encode(text) == ids
    assert own.decode(ids) == library.decode(ids)


def test_blank_runs_and_long_words(library, own):
    rng = random.Random(3)
    for k in range(200):
        text = " " * k + "".join(rng.choice("abcdeinst") for _ in range(k)) + " " * (k % 37)
        assert own.encode(text) == library.encode(text)
    text = "".join(rng.choice("thean") for _ in range(5000))
    assert own.encode(text) == library.encode(text)


def test_any_ids(library, own):
    rng = random.Random(5)
    for _ in range(3000):
        ids = [rng.randrange(32000) if rng.random() < 0.5 else rng.randrange(260) for _ in range(rng.randint(0, 8))]
        assert own.decode(ids) == library.decode(ids)


def test_forgetting_changes_nothing(library, own, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    text = "one two three, four. one two three five six seven one"
    assert own.encode(text) == library.encode(text)


def test_tables(spark, library):
    rows = [(1, None, "x"), (2, "", "x"), (3, "a  b ", None), (3, "a  b ", None), (None, "字\n", "y"), (4, "word " * 30_000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    ids = encoded(df, PATH)
    assert sorted(map(tuple, ids.collect()), key=str) == sorted(((d, library.encode(t or "")) for d, t, _ in rows), key=str)
    assert sorted(map(tuple, decoded(ids, PATH).collect()), key=str) == sorted(((d, t or "") for d, t, _ in rows), key=str)
    expected = []
    for d, t, _ in rows:
        e = library.encode(t or "")
        expected.append((d, len(e), hashlib.sha256(",".join(map(str, e)).encode()).hexdigest(), hashlib.sha256(library.decode(e).encode()).hexdigest()))
    assert sorted(map(tuple, piece_digests(df, PATH).collect()), key=str) == sorted(expected, key=str)
    assert piece_digests(df.limit(0), PATH).collect() == []
