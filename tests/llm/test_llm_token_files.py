import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from oddlens.llm.common import chunks, documents, shared_path
from oddlens.llm.token_files import WordEncoder, read_token_files, token_file_rows, write_token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    with open(PATH) as file:
        return WordEncoder(file.read())


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([*"aeiS'  \n\t\x0b\x1c\u00a0\u0301éΣ字1.,<|>İ", "<|endoftext|>"]), max_size=40))
def test_any_text(library, own, parts):
    text = "".join(parts)
    found = np.frombuffer(own.encode([text])[0], own.dtype).tolist()
    assert found == library.encode(text, add_special_tokens=False).ids


def brute(library, rows):
    start, found = 0, []
    for d, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        found.append((d, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return found


def test_documents_round_trip(spark, library):
    docs = documents(spark, DATA)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = sorted(map(tuple, token_file_rows(docs, PATH, 2, 5).collect()))
    assert found == brute(library, rows)


def test_odd_rows(spark, library):
    rows = [(4, None), (2, ""), (9, "Word " * 30_000), (None, "null id"), (7, "same"), (7, "same")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, start int")
    found = sorted(map(tuple, token_file_rows(df, PATH, 2, 3).collect()), key=lambda r: r[1])
    assert found == brute(library, rows)
    assert token_file_rows(df.limit(0), PATH, 2).collect() == []


def test_files_hold_the_ids(spark, library):
    folder = shared_path(spark, "files")
    df = spark.createDataFrame([(k, f"text number {k}") for k in range(20)], "doc_id long, text string")
    manifest = write_token_files(df, PATH, 2, folder, 4)
    rows = sorted(manifest.collect())
    assert [r.base for r in rows] == [sum(x.n_tokens for x in rows[:k]) for k in range(len(rows))]
    local = folder.removeprefix("file:")
    ids = np.concatenate([np.fromfile(f"{local}/{r.shard:07d}.tokens", r.dtype) for r in rows]).tolist()
    assert ids == [i for k in range(20) for i in library.encode(f"text number {k}", add_special_tokens=False).ids + [2]]
    assert read_token_files(manifest, folder).count() == 20


def test_added_tokens_and_cases_equal_the_library():
    import random

    from tokenizers import Tokenizer

    from oddlens.llm.token_files import WordEncoder

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    with open(path) as file:
        own = WordEncoder(file.read())
    rng = random.Random(8)
    parts = ["<|endoftext|>", "<|ENDOFTEXT|>", "<|EndOfText|>", "<|startoftext|>", "<|STARTOFTEXT|>", "<|", "|>", "Word", "WORD", "it's", "A1B2", "É", "x!", " ", "  ", "\n", "<|endoftext|>.", "don't,"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " ", "\n"]) for _ in range(rng.randint(1, 9))) for _ in range(3000)]
    for text, found in zip(texts, own.encode(texts), strict=True):
        assert np.frombuffer(found, own.dtype).tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_a_column_looks_up_each_word_once(library):
    import pyarrow as pa

    class Counting(dict):
        looked = 0

        def get(self, key):
            Counting.looked += 1
            return super().get(key)

    with open(PATH) as file:
        encoder = WordEncoder(file.read())
    encoder.words = Counting()
    texts = ["Word word, WORD!? Été. été;\nEnd", None, "", "word\nend.", "word!!!! don't..."] * 400
    ids, sizes = encoder.encode_column(pa.array(texts))
    expected = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert sizes.tolist() == [len(e) for e in expected]
    assert ids.tolist() == [i for e in expected for i in e]
    # word, End, Été, été, "word!!!!" and "don't", the marks that close them, and no mark
    assert Counting.looked <= 15


def test_each_letter_before_closing_marks(library, own):
    letters = [chr(c) for c in range(0x41, 0x250) if chr(c).isalpha()]
    texts = [t for c in letters for t in (f"{c}!", f"a{c}.", f"{c}b,", f"{c}́;")] + [" ".join(f"x{c}y" for c in letters)]
    for text, found in zip(texts, own.encode(texts), strict=True):
        assert np.frombuffer(found, own.dtype).tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_chunks_and_generations_of_words(library, monkeypatch):
    import pyarrow as pa

    from oddlens.llm import token_files

    monkeypatch.setattr(token_files, "KNOWN", 5)
    texts = [" ".join(f"W{'abcdefghij'[(k * j) % 10]}é{'xyz'[k % 3]}" for j in range(k % 7)) or None for k in range(90)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(90)), pa.array(texts)], names=["doc_id", "text"])
    parts = list(chunks(batch.slice(3), 1, 40))
    assert [d for c in parts for d in c.column(0).to_pylist()] == list(range(3, 90)) and len(parts) > 40
    with open(PATH) as file:
        encoder = WordEncoder(file.read())
    found = [i for c in parts for i in encoder.encode_column(c.column(1))[0].tolist()]
    assert found == [i for t in texts[3:] for i in library.encode(t or "", add_special_tokens=False).ids]


def test_tasks_share_their_workers_encoder(spark):
    token_file_rows(documents(spark, DATA), PATH, 2, 12).collect()

    def encoders(batches):
        import pyarrow as pa

        from oddlens.llm import token_files

        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(token_files._encoders)])], names=["n"])

    found = spark.range(0, 12, 1, 12).mapInArrow(encoders, "n long").collect()
    assert max(r.n for r in found) == 1
