import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from oddlens.llm.alignment import aligned, segments
from oddlens.llm.csr import Csr

LEFT, RIGHT = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, chunk string, pairs long"
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def libraries():
    left = Tokenizer.from_file(LEFT)
    left.encode_special_tokens = True
    return left, sentencepiece.SentencePieceProcessor(model_file=RIGHT)


def left_bytes(token):
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
    return bytes(table[c] for c in token)


def right_bytes(library, i):
    piece = library.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if library.is_byte(i) else piece.replace("▁", " ").encode()


def ends(parts):
    return np.cumsum([len(p) for p in parts]).tolist()


def brute(rows, libraries):
    left, right = libraries
    docs, count = [], Counter()
    for doc_id, text, *_ in rows:
        links, groups, a, b = [], [], [], []
        if text:
            whole = (" " + text).encode()
            a = left.encode(" " + text, add_special_tokens=False).ids
            b = right.encode(text)
            x, y = [left_bytes(left.id_to_token(i)) for i in a], [right_bytes(right, i) for i in b]
            if b"".join(x) == whole == b"".join(y):
                p, q = [0, *ends(x)], [0, *ends(y)]
                links = [(a[i], b[j]) for i in range(len(a)) for j in range(len(b)) if p[i] < q[j + 1] and q[j] < p[i + 1]]
                cuts = sorted(set(p) & set(q))
                for s, t in zip(cuts, cuts[1:]):
                    mine = [",".join(str(ids[k]) for k in range(len(ids)) if s <= e[k] < t) for ids, e in ((a, p), (b, q))]
                    groups.append("|".join(mine))
            else:
                a, b = [], []
        count.update(links)
        docs.append((doc_id, a, b, groups, links))
    most = Counter()
    for (_, j), n in count.items():
        most[j] = max(most[j], n)
    return sorted(
        (
            (d, len(a), len(b), len(g), len(k), sum(count[p] == most[p[1]] for p in k), sum(count[p] for p in k), hashlib.sha256(";".join(g).encode()).hexdigest() if a else "")
            for d, a, b, g, k in docs
        ),
        key=str,
    )


def some_rows():
    rng = random.Random(9)
    alphabet = list("aeinorst") * 3 + list("  \n\tñ字é.,'!?0129") + ["👍", " ", "\x1c", " ", "the ", " and", "<|endoftext|>", "<s>", "́", "\x00", "Ünder", "don't", "\r\n", "　"]
    rows = [(k, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80))), "c", k) for k in range(150)]
    rows += [(200, None, "c", 1), (201, "", "c", 1), (202, " ", "c", 1), (203, "   a", "c", 1), (204, "a▁b", "c", 1), (205, "x▁ y", "c", 1), (206, "\n \n  z  ", "c", 1)]
    return rows + [(None, "again and again", "c", 1), rows[3], rows[3], (207, "long word " * 300 + "x" * 700, "c", 1), (208, "<0x41> <unk>", "c", 1)]


@pytest.mark.parametrize("chunk_bytes", [8_000_000, 500])
def test_rows_equal_brute_force(spark, libraries, chunk_bytes):
    rows = some_rows()
    found = aligned(spark.createDataFrame(rows, DOCS).repartition(3), LEFT, RIGHT, chunk_bytes)
    assert sorted(map(tuple, found.select(*COLUMNS).collect()), key=str) == brute(rows, libraries)


def test_shared_groups(spark, libraries):
    found = {r.doc_id: r for r in aligned(spark.createDataFrame([(1, "Ünder don't", "", 1), (2, "the", "", 1)], DOCS), LEFT, RIGHT).collect()}
    assert found[2].n_shared == found[2].n_links == 1
    assert found[1].n_shared >= found[1].n_links > 1


def test_empty_table(spark):
    assert aligned(spark.createDataFrame([], DOCS), LEFT, RIGHT).collect() == []


def test_segments_are_encoded_like_the_whole_text(libraries):
    left, right = libraries
    for _, text, *_ in some_rows():
        parts = segments(text) if text else []
        if parts and "▁" not in text:
            assert [i for p in parts for i in left.encode(" " + p, add_special_tokens=False).ids] == left.encode(" " + text, add_special_tokens=False).ids
            assert [i for p in parts for i in right.encode(p)] == right.encode(text)


def test_products_of_sparse_rows(monkeypatch):
    rng = np.random.default_rng(2)
    for terms in (3, 1000):
        monkeypatch.setattr("oddlens.llm.csr.TERMS", terms)
        for _ in range(60):
            n, m, k = rng.integers(1, 9, 3)
            dense = [rng.integers(0, 3, s) * rng.integers(0, 2, s) for s in ((n, m), (m, k))]
            sparse = [Csr.of_sizes((d != 0).sum(axis=1), np.nonzero(d)[1], d.shape[1], d[d != 0]) for d in dense]
            out = sparse[0].times(sparse[1])
            full = np.zeros((n, k), int)
            full[out.row_numbers(), out.columns] = out.data
            assert (full == dense[0] @ dense[1]).all() and len(set(zip(out.row_numbers(), out.columns))) == len(out.data)
            back = np.zeros((m, n), int)
            turned = sparse[0].transposed()
            back[turned.row_numbers(), turned.columns] = turned.data
            assert (back == dense[0].T).all()
