import math
import re
import types
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from oddlens.llm import language_model as lm
from oddlens.llm.language_model import LogBilinear, NceTrainer, class_logs, contexts, language_scores

DATA = "/root/testdata/sf0.01"


def plain(text):
    return re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def brute(rows):
    counts = Counter(w for d, t in rows if not held(d) for w in plain(t))
    n, v = counts.total(), len(counts)
    found = []
    for d, t in rows:
        words = plain(t)
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        found.append((d, held(d), len(words), sum(counts[w] > 0 for w in words), n, base))
    return sorted(found, key=str)


def check(found, rows):
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found), key=lambda r: str(r[:5]))
    expected = sorted(brute(rows), key=lambda r: str(r[:5]))
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    assert sorted(r[5] for r in got) == pytest.approx(sorted(r[5] for r in expected), rel=1e-9, abs=1e-9)


def test_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    found = language_scores(docs).collect()
    check(found, [(r.doc_id, r.text) for r in docs.collect()])
    for out in (True, False):  # the model is better than single words, also on texts that it hasn't seen
        part = [r for r in found if r.held_out == out]
        assert sum(r.score for r in part) > sum(r.base_score for r in part)


@pytest.fixture
def few_head_words(monkeypatch):
    monkeypatch.setattr(lm, "HEAD", 40)
    monkeypatch.setattr(lm, "OWN", 10)
    monkeypatch.setattr(lm, "ENDINGS", 5)


def test_odd_rows_and_rare_words(spark, few_head_words):
    rows = [(k, " ".join(f"W{(k * j) % 97}x" for j in range(k % 30))) for k in range(150)]
    rows += [(None, None), (500, ""), (500, ""), (501, "new words only é"), (502, "w1x " * 40_000), (7, "W1x\t\x0b b")]
    df = spark.createDataFrame([(*r, 1.0, 2) for r in rows], "doc_id long, text string, score double, key int").repartition(3)
    found = language_scores(df, rounds=1).collect()
    check(found, rows)
    assert all(r.score < 0 for r in found)
    assert language_scores(df.limit(0)).collect() == []
    only = [d for d in range(1000) if held(d)][:3]
    found = language_scores(spark.createDataFrame([(d, "a b", 1.0) for d in only], "doc_id long, text string, score double")).collect()
    assert len(found) == 3 and all(r.train_tokens == 0 and r.base_score == 0 and r.n_known == 0 for r in found)


def test_probabilities_of_a_context_sum_to_one(spark, few_head_words):
    counts = spark.createDataFrame([(b"", 30)] + [(f"{k}{'abcdefgh'[k % 8]}z"[-3 + k % 2 :].encode() + b"%d" % k, 1 + 40 // (k + 1)) for k in range(60)], "word binary, n long")
    voc = lm.fit_vocabulary(counts)
    rows = [(bytes(r.word), r.n) for r in counts.collect()]
    model = LogBilinear.new(voc.frequency)
    z, p_shared = lm.normalisers(spark, model, voc.shared)
    for two, before in ((0, 3), (len(voc.mass), len(voc.mass)), (5, 1)):
        total = 10 ** (p_shared[two, before] / math.log(10) + voc.unknown)
        for w, n in rows:
            k = voc.head[w][0] if w in voc.head else voc.tail_class(w)
            log_class = class_logs(model, z, *(np.array([x]) for x in (two, before, k)))[0]
            total += 10 ** (log_class - voc.mass[k]) * (n + 0.1)
        assert total == pytest.approx(1, abs=1e-4)


def test_contexts_do_not_cross_documents():
    two, before, w = contexts([np.array([1, 2, 3], np.uint16), np.array([4], np.uint16), np.array([5, 6], np.uint16)], 9)
    assert w.tolist() == [1, 2, 3, 4, 5, 6]
    assert before.tolist() == [9, 1, 2, 9, 9, 5] and two.tolist() == [9, 9, 1, 9, 9, 9]


def test_noise_contrastive_training_learns_a_bigram_rule():
    rng = np.random.default_rng(0)
    seq = [rng.integers(6)]
    for _ in range(30_000):
        seq.append((seq[-1] + 1) % 6 if rng.random() < 0.8 else rng.integers(6))
    two, before, w = contexts([np.array(seq, np.uint16)], 6)
    frequency = np.bincount(w, minlength=6) / len(w)
    model = LogBilinear.new(frequency)
    trainer = NceTrainer(model, frequency, 1)
    for _ in range(4):
        for a in range(0, len(w), 256):
            trainer.batch(two[a : a + 256], before[a : a + 256], w[a : a + 256])
    z = np.stack([model.log_normalisers(k, 3)[0] for k in range(7)])
    mean = class_logs(model, z, two, before, w).mean() * math.log(10)
    best = 0.8333 * math.log(0.8333) + 5 * 0.0333 * math.log(0.0333)
    assert mean > best - 0.12 and mean > -math.log(6) + 0.5


def test_rounds_use_every_training_row_once(spark):
    df = spark.range(100).withColumn("part", F.pmod(F.xxhash64("id"), F.lit(lm.ROUNDS)))
    assert sum(df.where(F.col("part") == k).count() for k in range(lm.ROUNDS)) == 100


def test_each_word_of_a_chunk_is_looked_up_once(monkeypatch):
    class Counting(dict):
        looked = 0

        def get(self, key):
            Counting.looked += 1
            return super().get(key)

    monkeypatch.setattr(lm, "TaskContext", types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 1)))
    head = Counting({b"": (0, 2.0), b"a": (1, 1.0)})
    vocabulary = lm.Vocabulary(1, 1, head, {b"zz": 2}, 3, np.zeros(4), -9.0, 2, np.full(4, 0.25))
    texts = ["A zz\ta b\x0b", None, " ", "zz ZZ\x1c\u00c9 zz"] * 300
    batch = pa.RecordBatch.from_arrays([pa.array(range(1200)), pa.array(texts), pa.array([True] * 1200)], names=["doc_id", "text", "held_out"])
    rows = [r for found in lm._encoded([batch.slice(4)], vocabulary) for r in found.to_pylist()]
    assert [r["doc_id"] for r in rows] == list(range(4, 1200)) and [r["key"] for r in rows] == list(range(1 << 40, (1 << 40) + 1196))
    expected = [([1, 2, 1, 3, 0], 3, 4.0, [[1], [3]]), ([0], 1, 2.0, []), ([0], 1, 2.0, []), ([2, 3, 2, 0], 1, 2.0, [[0, 2], [1]])]
    for row, (classes, n_head, log, at) in zip(rows, expected * 299, strict=True):
        assert np.frombuffer(row["classes"], np.uint16).tolist() == classes
        assert (row["n_tokens"], row["n_head"], row["head_log"]) == (len(classes), n_head, log)
        assert sorted(t["at"] for t in row["tail"]) == at
    assert rows[0]["tail"][0]["h"] in (lm._hash(b"zz"), lm._hash(b"b"))
    assert Counting.looked == 5  # a, zz, b, the end, "zz\x1c\u00c9"


def test_scored_parts_have_one_schema(monkeypatch):
    monkeypatch.setattr(lm, "TaskContext", types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 1)))
    vocabulary = lm.Vocabulary(1, 1, {b"": (0, 2.0), b"a": (1, 1.0)}, {b"zz": 2}, 3, np.zeros(4), -9.0, 2, np.full(4, 0.25))
    batches = []
    for texts in (["a zz zz b"], [""], ["a"], ["zz", None]):
        for held_out in (True, False):
            ids = pa.array([None] * len(texts), pa.int64())
            batches.append(pa.RecordBatch.from_arrays([ids, pa.array(texts), pa.array([held_out] * len(texts))], names=["doc_id", "text", "held_out"]))
    encoded = list(lm._encoded(batches, vocabulary))
    model, z = LogBilinear.new(vocabulary.frequency), np.ones((5, 5), np.float32)
    scored = list(lm._scored(encoded, model, z, -z, vocabulary.mass, vocabulary.unknown))
    assert len({str(b.schema) for b in encoded}) == len({str(b.schema) for b in scored}) == 1
    both = [t for b in scored[:2] for t in sum(b.column(7).to_pylist(), [])]
    assert [(t["n"], t["seen"] < 0, t["blind"] < 0) for t in both] == [(2, True, True), (1, True, True), (2, False, False), (1, False, False)]
