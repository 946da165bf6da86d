import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from oddlens.llm.decontamination import WINDOW, build_index, contaminated, decontaminated
from oddlens.llm.fm_index import FmIndex, build, ranges, suffix_array

DOCS = "doc_id long, text string, spans string, shard long"
ITEMS = "item_id long, text string, block string"


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def brute(docs, items):
    windows = {}
    for item, text, *_ in items:
        own = words(text)
        for k in range(max(1, len(own) - WINDOW + 1)):
            if own:
                windows.setdefault(tuple(own[k : k + WINDOW]), set()).update({str(item)} - {"None"})
    found = []
    for doc_id, text, *_ in docs:
        own, hit, met = words(text), set(), set()
        for w, names in windows.items():
            for k in range(len(own) - len(w) + 1):
                if tuple(own[k : k + len(w)]) == w:
                    hit |= set(range(k, k + len(w)))
                    met |= names
        found.append((doc_id, len(own), len(hit), len(met), hashlib.sha256(",".join(sorted(met)).encode()).hexdigest(), bool(hit)))
    return sorted(found, key=str)


def columns(df):
    return sorted(map(tuple, df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()), key=str)


def some_tables(seed):
    rng = random.Random(seed)
    vocabulary = [*"abcdefgh", "Éa", "字", "x9"]
    text = lambda n: rng.choice([" ", ", "]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, text(rng.randint(10, 25)), "b") for k in range(12)] + [(50, "one Short item", ""), (50, "again short", ""), (None, "no name here", ""), (51, None, ""), (52, "?!", "")]
    docs = [(k, text(rng.randint(0, 60)), "s", k) for k in range(60)]
    docs += [(100 + k, f"{text(9)} {items[k][1].upper()}\n{text(5)}; ONE short-item", "s", 1) for k in range(12)]
    docs += [(200, None, "s", 1), (201, "", "s", 1), (202, "?", "s", 1), (None, "x. no name here", "s", 1), (100, "again SHORT again short", "s", 1)]
    docs += [docs[61]] * 20 + [(300, "no name here " * 3000 + text(3000), "s", 1)]
    return docs, items


@pytest.mark.parametrize("shard_words, block", [(1_000_000, 100_000), (150, 20)])
def test_hits_equal_brute_force(spark, shard_words, block):
    docs, items = some_tables(3)
    df = spark.createDataFrame(docs, DOCS).repartition(3)
    found = contaminated(df, spark.createDataFrame(items, ITEMS), shard_words=shard_words, block=block)
    assert columns(found) == brute(docs, items)


def test_spans_are_cut_out(spark):
    docs = [(1, "start A b, c d e f g h i j! end", "keep", 7), (2, "clean", "keep", 8), (2, "a b c d e f g h i j", "x", 8), (None, None, "y", 9), (3, "", "z", 1)]
    out = decontaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(1, "a b c d e f g h i j", "")], ITEMS))
    assert out.columns == ["doc_id", "text", "spans", "shard"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1, "start ! end", "keep", 7), (2, "clean", "keep", 8), (2, "", "x", 8), (None, None, "y", 9), (3, "", "z", 1)], key=str)


def test_empty_tables(spark):
    docs, items = some_tables(5)
    none, some = spark.createDataFrame([], DOCS), spark.createDataFrame(docs, DOCS)
    assert contaminated(none, spark.createDataFrame(items, ITEMS)).collect() == []
    assert columns(contaminated(some, spark.createDataFrame([], ITEMS))) == brute(docs, [])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), max_size=30), min_size=1, max_size=8))
def test_index_finds_every_occurrence(documents):
    sequence = np.array([s for d in documents for s in [*d, 0]], np.int32)
    n = len(sequence)
    ends = [sequence[k:].tolist().index(0) + k for k in range(n)]
    key = [[*sequence[k : e].tolist()] for k, e in enumerate(ends)]
    order = suffix_array(sequence).tolist()
    assert order == sorted(range(n), key=lambda k: ([(1, s) for s in key[k]] + [(0, ends[k])]))
    index = FmIndex(**build(sequence, 5))
    phrases = [(a, b, c)[:k] for a in range(1, 5) for b in range(1, 4) for c in range(1, 4) for k in (1, 2, 3)]
    table = np.array([[*p, *[0] * (3 - len(p))] for p in phrases])
    low, high = index.search(table, np.array([len(p) for p in phrases]))
    found = {k: [] for k in range(len(phrases))}
    for owner, rows in ranges(low, high, 7):
        for k, at in zip(owner.tolist(), index.locate(rows).tolist(), strict=True):
            found[k].append(at)
    for k, p in enumerate(phrases):
        assert sorted(found[k]) == [at for at in range(n) if tuple(sequence[at : at + len(p)].tolist()) == p]


def test_index_does_not_depend_on_a_benchmark(spark):
    docs, _ = some_tables(8)
    rows = build_index(spark.createDataFrame(docs, DOCS), 200).collect()
    assert sum(len(r.doc_ids) for r in rows) == len(docs) and len({r.shard for r in rows}) == len(rows)
