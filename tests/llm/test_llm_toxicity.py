import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from oddlens.llm.hashed_words import Terms, scans, slots_of, term_hashes
from oddlens.llm.linear import BITS, fit_in_tasks, fit_sparse, fraction
from oddlens.llm.toxicity import LISTS, Voters, _marks, fit_label_model, terms, toxicity_scores, words

DATA = "/root/testdata/sf0.01"


def test_label_model_finds_rates_and_a_correlated_pair():
    rng = np.random.default_rng(5)
    n, prior = 60_000, 0.2
    y = rng.random(n) < prior
    toxic, clean = np.array([0.8, 0.6, 0.7, 0.5, 0.65, 0.75, 0.6]), np.array([0.05, 0.02, 0.1, 0.01, 0.03, 0.04, 0.02])
    votes = rng.random((n, 7)) < np.where(y[:, None], toxic, clean)
    votes[:, 6] = np.where(rng.random(n) < 0.8, votes[:, 5], votes[:, 6])  # the last two depend on each other
    bits = votes.astype(np.int64)
    model = fit_label_model(n, (bits.T @ bits).astype(float), prior)
    assert np.allclose(model.toxic[:5], toxic[:5], atol=0.04) and np.allclose(model.clean[:5], clean[:5], atol=0.02)
    assert (6, 5) in model.correlated and (model.weight[5:] < 1).all() and (model.weight[:4] > 0.9).all()
    posterior = model.posterior(bits @ (1 << np.arange(7)))
    assert ((posterior >= 0.5) == y).mean() > 0.97


def test_silent_voters_do_no_harm():
    model = fit_label_model(0, np.zeros((4, 4)), 0.1)
    assert model.posterior(np.array([0, 15])) == pytest.approx([0.1, 0.1], abs=1e-3)


def test_patterns_and_lists():
    voters = Voters({"4 grum": 3})
    bit = {name: 1 << k for k, name in enumerate(voters.names)}
    assert voters.votes("you are such an IDIOT!", {}) == bit["written"] | bit["aimed"]
    assert voters.votes("1d10t", {}) == bit["digits"]
    assert voters.votes("an i d i o t here", {}) == bit["letters"]
    assert voters.votes("grumble, grumbles", {}) == bit["list 3"]
    assert voters.votes("what?!? no!!! never!!!", {}) == bit["shouting"]
    assert voters.votes(None, {}) == voters.votes("", {}) == voters.votes("a calm text", {}) == 0
    assert len(voters.names) == LISTS + 5


def test_sparse_fit_gives_noise_no_weight():
    rng = np.random.default_rng(0)
    rows = [np.concatenate([rng.integers(100, 1 << 18, 60), [7] if k % 5 == 0 else []]).astype(np.int32) for k in range(800)]
    w, offset = fit_sparse(rows, np.array([float(k % 5 == 0) for k in range(800)]), l1=5.0)
    assert w[7] + offset > 0 and np.abs(w[100:]).max() < 1 and fraction(10, 5) == 0.5


def test_held_out_documents(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    found = toxicity_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(found) > 60
    right = np.mean([r.predicted == r.toxic for r in found])
    assert right >= 0.9 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)


def test_labels_of_held_out_rows_change_nothing(spark):
    docs, labels = (spark.read.parquet(f"{DATA.replace('0.01', '0.001')}/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    flipped = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted(map(tuple, toxicity_scores(docs, x).collect())) for x in (labels, flipped))
    assert a == b


def test_odd_tables(spark):
    rng = random.Random(1)
    rows = [(k, " ".join(rng.choice(["mild", "calm", "grey"]) for _ in range(30)), 9.0) for k in range(30)]
    rows += [(None, None, 1.0), (50, "", 1.0), (50, "", 1.0), (51, "word " * 50_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, None, 0), (1, 1, 1), (None, 1, 1), (2, 0, 0)], "doc_id long, toxic int, text int")
    for marks in (labels, labels.limit(0)):
        found = toxicity_scores(docs, marks).collect()
        assert len(found) == 34 and all(0 <= r.score <= 1 for r in found)
        assert len({r.score for r in found if r.doc_id in (None, 50)}) == 1
    assert toxicity_scores(docs.limit(0), labels).collect() == []


def test_a_word_that_is_rare_in_each_task_gets_a_weight(spark):
    # Once or twice in each of eight tasks: below the L1 term in each, above it in their sum.
    rows = [([1000 + (37 * k) % 5000, *([7] if k % 60 == 0 else [])], int(k % 60 == 0)) for k in range(1200)]
    df = spark.createDataFrame(rows, "slots array<int>, mark long").repartition(8)
    w, offset = fit_in_tasks(df, lambda marks: marks.astype(float), 1 / 60, 5.0, 4)
    assert w.shape == (1 << BITS,) and w[7] > 0.5 and np.abs(w[1000:]).max() == 0


def test_fit_does_not_depend_on_partitions(spark):
    rng = np.random.default_rng(3)
    rows = [([int(s) for s in np.sort(rng.integers(0, 60, 12))] + ([70] if k % 6 == 0 else []), int(k % 6 == 0 or rng.random() < 0.1)) for k in range(600)]
    df = spark.createDataFrame(rows, "slots array<int>, mark long")
    fits = [fit_in_tasks(df.repartition(n), lambda marks: marks.astype(float), 0.25, 2.0, 40) for n in (1, 8, 32, 211)]
    assert all(np.abs(w - fits[0][0]).max() < 1e-6 and abs(o - fits[0][1]) < 1e-6 for w, o in fits) and fits[0][0][70] > 1
    # The conditions of a minimum of the loss with its L1 term.
    slope = np.zeros(1 << BITS)
    for s, y in rows:
        p = 1 / (1 + np.exp(-(fits[0][0][s].sum() + fits[0][1])))
        np.add.at(slope, s, p - y)
    w = fits[0][0]
    assert np.abs(slope[w != 0] + 2.0 * np.sign(w[w != 0])).max() < 0.5 and np.abs(slope[w == 0]).max() < 2.5


@pytest.mark.parametrize("parts", [1, 32])
def test_documents_score_alike_in_any_partitioning(spark, parts):
    docs, labels = (spark.read.parquet(f"{DATA.replace('0.01', '0.001')}/{t}.parquet") for t in ("documents", "labels"))
    whole = {r.doc_id: r.score for r in toxicity_scores(docs, labels).collect()}
    found = {r.doc_id: r.score for r in toxicity_scores(docs.repartition(parts), labels).collect()}
    assert found.keys() == whole.keys() and max(abs(found[k] - whole[k]) for k in whole) < 1e-6


def test_hashes_equal_the_definition():
    texts = ["Grumble 1a ÜBER-über x", None, "", "a b " * 40, "çé" * 9 + " ab", "x" * 50]
    for text, (sizes, found) in zip(texts, (slots_of([t]) for t in texts)):
        names = {t for w in words(text) for t in terms(w)}
        expected = np.unique((term_hashes(sorted(names)) & np.uint64((1 << BITS) - 1)).astype(np.int64))
        assert found.tolist() == expected.tolist() and sizes.tolist() == [len(expected)]
    known = Terms(np.sort(term_hashes(["grumble", "4 grum", "über", "4 xxxx"])))
    sizes, found = known.rows(scans([*texts, "grumble grumbling GRUMBLE"]), 7)
    assert sizes.tolist() == [3, 0, 0, 0, 0, 1, 3]


def test_list_votes_by_hash_equal_the_voters_own(spark):
    voters = Voters({"4 grum": 3, "idiot": 2, "5 stupi": 0})
    texts = ["you IDIOT", "1d10t asshol3 b!tch", "i d i o t", "what?! no!!! never!!! no???", "grumble stupid", None, "", "a b c d", "calm", "s.t.u.p.i.d x"] * 3
    found = _marks(texts, list(scans(texts)), voters, *voters.by_hash(), {})
    assert found.tolist() == [voters.votes(t, {}) for t in texts]


def test_long_texts_are_cut_at_blanks(monkeypatch):
    text = "some words of a text " * 50
    whole = slots_of([text, "b"])
    monkeypatch.setattr("oddlens.llm.hashed_words.BUFFER", 64)
    assert all((a == b).all() for a, b in zip(whole, slots_of([text, "b"])))
