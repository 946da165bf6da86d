import random
import re

import numpy as np
import pytest

from oddlens.llm import near_dedup
from oddlens.llm.components import components
from oddlens.llm.near_dedup import HALVES, _WordHashes, half_keys, near_groups, shingles

DATA = "/root/testdata/sf0.001"


def brute_set(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(zip(*(words[k:] for k in range(4)), strict=False)) if len(words) >= 4 else frozenset([tuple(words)])


def brute(rows):
    sets = [brute_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for x in range(len(rows)):
        for y in range(x):
            if sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
                parent[find(x)] = find(y)
    least = {}
    for k, (d, _) in enumerate(rows):
        r = find(k)
        least[r] = min([v for v in (least.get(r), d) if v is not None], default=None)
    return sorted(((d, len(sets[k]), least[find(k)], d == least[find(k)]) for k, (d, _) in enumerate(rows)), key=str)


def found(df):
    return sorted((tuple(r) for r in near_groups(df).select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


def families(rng, n, words, edits):
    """Texts made from one text by replacing whole words, in chains and stars."""
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out, last = [], base
    for k in range(n):
        new = list(last if k % 3 else base)
        for _ in range(edits):
            new[rng.randrange(words)] = f"x{rng.randrange(5000)}"
        out.append(" ".join(new))
        last = new
    return out


@pytest.mark.parametrize("block", [256, 3])
def test_families_equal_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rng = random.Random(4)
    texts = []
    for edits in (0, 1, 2, 3, 4, 5):
        for words in (60, 150):
            texts += families(rng, 12, words, edits)
    shared = " ".join(f"s{k}" for k in range(60))
    texts += [f"{shared} " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(20 + k)) for k in range(40)]
    texts += ["one two three", "One  two\tthree", "one two", "", None, " \n", "lonely", "word " * 40_000]
    rng.shuffle(texts)
    rows = [(1000 - 3 * k, t) for k, t in enumerate(texts)]
    rows += [(5, rows[3][1]), (5, rows[3][1])]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, cid long, digest string").repartition(4)
    assert found(df) == brute(rows)


def test_documents_equal_brute_force(spark):
    df = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert found(df) == brute(rows)


def test_null_ids_and_empty_table(spark):
    schema = "doc_id long, text string"
    rows = [(None, "a b c d e"), (4, "a b c d e"), (None, "other words that stand alone"), (None, None)]
    assert found(spark.createDataFrame(rows, schema)) == sorted([(None, 2, 4, False), (4, 2, 4, True), (None, 2, None, True), (None, 0, None, True)], key=str)
    assert found(spark.createDataFrame([], schema)) == []


def test_table_keys_reach_the_stated_recall():
    rng = np.random.default_rng(1)
    hits = 0
    for _ in range(400):
        x = rng.integers(0, 1 << 63, 180, dtype=np.uint64)
        a, b = x[:162], np.concatenate([x[:144], x[162:]])  # 144 / 180
        same = half_keys(np.unique(a)) == half_keys(np.unique(b))
        hits += bool(same[:HALVES].any() and same[HALVES:].any())
    assert hits >= 399
    assert len(shingles("a b c d e f", _WordHashes())) == 3


def test_components_of_paths_and_stars(spark):
    rng = random.Random(2)
    links = [(k, k + 1) for k in range(60)] + [(100, 101 + k) for k in range(30)] + [(7, 7)]
    names = list(range(200))
    rng.shuffle(names)
    links = [(names[a], names[b]) for a, b in links]
    roots = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    path, star = {names[k] for k in range(61)}, {names[k] for k in range(100, 131)}
    assert roots == {k: min(path) for k in path - {min(path)}} | {k: min(star) for k in star - {min(star)}}


def test_words_of_a_shingle_are_an_argument(spark):
    # 45 words, one replaced: 4-word similarity 38/46, 5-word 36/46.
    words = [f"w{k}" for k in range(45)]
    other = [*words[:20], "x", *words[21:]]
    texts = " ".join(words), " ".join(other)
    for size, alike in ((4, True), (5, False)):
        x, y = (set(shingles(t, _WordHashes(), size).tolist()) for t in texts)
        assert (100 * len(x & y) >= 80 * len(x | y)) == alike
    import corpus_pipeline

    df = spark.createDataFrame(enumerate(texts), "doc_id long, text string")
    assert corpus_pipeline.near_dedup(spark, df, "").count() == 2
