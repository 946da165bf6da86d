import numpy as np
import pytest
from pyspark.sql import functions as F

from oddlens.llm import hashed_words
from oddlens.llm.linear import new_slots, text_slots
from oddlens.llm.mixing import _N, _P, RIDGE, fit_rates, mixed, mixing_rates

DATA = "/root/testdata/sf0.01"


def brute(p, n, goals, max_rate, step, steps=20_000):
    """Projected gradient with a vector of all rates."""
    rate = np.ones(len(n))
    for _ in range(steps):
        residual = ((rate * n) @ p - goals) / goals
        rate = np.clip(rate - step * (p @ residual + RIDGE * (rate - 1)), 0, max_rate)
    return rate


def test_replayed_steps_equal_a_vector_of_rates(spark):
    rng = np.random.default_rng(3)
    p = rng.dirichlet([0.4, 0.3, 0.2], 300)
    n = rng.integers(1, 500, 300)
    members = spark.createDataFrame([(k, p[k].tolist(), int(n[k])) for k in range(300)], f"k long, {_P} array<double>, {_N} long").repartition(3)
    goals = [float(n.sum() * s) for s in (0.3, 0.5, 0.2)]
    fit = fit_rates(members, goals, 4.0, steps=12)
    found = {r.k: r.r for r in members.select("k", fit.rate().alias("r")).collect()}
    rate = np.ones(300)
    for e in fit.path:
        residual = ((rate * n) @ p - goals) / np.array(goals)
        assert np.allclose(residual, e)
        rate = np.clip(rate - fit.step * (p @ residual + RIDGE * (rate - 1)), 0, 4)
    snapped = np.where(abs(rate - rate.round()) <= 0.02, rate.round(), rate)
    assert np.allclose([found[k] for k in range(300)], snapped)
    assert np.allclose(fit.totals, goals, rtol=0.03)
    best = brute(p, n, np.array(goals), 4.0, fit.step)
    assert np.allclose((best * n) @ p, goals, rtol=0.02)


@pytest.mark.parametrize("input_shares", [(0.3, 0.65, 0.05), (0.2, 0.75, 0.05), (0.33, 0.33, 0.34)])
@pytest.mark.parametrize("soft", [0.0, 0.1])
def test_skewed_inputs_reach_the_minimum(spark, input_shares, soft):
    rng = np.random.default_rng(4)
    kind = rng.choice(3, 400, p=input_shares)
    p = (1 - soft) * np.eye(3)[kind] + soft * rng.dirichlet([1, 1, 1], 400)
    n = rng.integers(50, 500, 400)
    members = spark.createDataFrame([(k, p[k].tolist(), int(n[k])) for k in range(400)], f"k long, {_P} array<double>, {_N} long").repartition(3)
    goals = np.array([0.85, 0.12, 0.03]) * n.sum()
    fit = fit_rates(members, goals.tolist(), 8.0)
    best = brute(p, n, goals, 8.0, fit.step)
    assert np.allclose(fit.totals, (best * n) @ p, rtol=0.02, atol=0.002 * n.sum())
    assert fit.totals[0] >= 0.97 * goals[0]
    rate = np.array([r.r for r in members.select("k", fit.rate().alias("r")).orderBy("k").collect()])
    assert ((rate * n) @ p)[0] == pytest.approx(fit.totals[0], rel=0.02)


def test_a_gap_that_bounds_leave_is_told(spark):
    members = spark.createDataFrame([([1.0, 0.0], 10), ([0.0, 1.0], 90)], f"{_P} array<double>, {_N} long")
    with pytest.warns(UserWarning, match="from their targets"):
        fit = fit_rates(members, [90.0, 10.0], 2.0)
    assert fit.gap == pytest.approx(70 / 90, abs=0.01) and fit.totals[1] == pytest.approx(10, rel=0.02)


def test_documents_reach_the_targets(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    shares = {"high": 0.7, "low": 0.2, "toxic": 0.1}
    rows = mixing_rates(docs, labels, shares).toPandas()
    assert len(rows) == 1000 and (rows.rate >= 0).all() and np.allclose(rows.p_high + rows.p_low + rows.p_toxic, 1)
    total = rows.n_tokens.sum()
    for d, share in shares.items():
        assert (rows.rate * rows.n_tokens * rows[f"p_{d}"]).sum() / total == pytest.approx(share, abs=0.02)
        assert (rows.copies * rows.n_tokens * rows[f"p_{d}"]).sum() / total == pytest.approx(share, abs=0.08)
    assert (rows.copies - rows.rate).abs().max() <= 1


def test_thinning_keeps_the_high_domain(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    found = mixed(docs, labels, {"high": 1.0, "low": 0.5, "toxic": 0.5})
    assert found.columns == docs.columns and found.count() == found.select("doc_id").distinct().count()
    kept = found.join(labels, "doc_id").groupBy("quality", "toxic").agg(F.count("*").alias("n")).collect()
    before = labels.groupBy("quality", "toxic").agg(F.count("*").alias("n")).collect()
    share = {(r.quality, r.toxic): r.n for r in kept}
    rate = {(r.quality, r.toxic): share.get((r.quality, r.toxic), 0) / r.n for r in before}
    assert rate[1, 0] > 0.97 and rate[0, 0] < 0.75


def test_odd_tables(spark):
    rows = [(k, f"some words number {k}", "a") for k in range(30)] + [(None, None, None), (40, "", "x"), (40, "", "x"), (41, "w " * 50_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rate string")
    labels = spark.createDataFrame([(k, k % 2, None) for k in range(20)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    shares = {"high": 0.5, "low": 0.4, "toxic": 0.1}
    for marks in (labels, labels.limit(0)):
        found = mixing_rates(docs, marks, shares).collect()
        assert len(found) == 34 and all(r.rate == 1 and r.copies == 1 for r in found if r.n_tokens == 0)
        assert mixed(docs, marks, {"high": 2.0, "low": 2.0, "toxic": 1.0}, max_rate=3.0).count() > 34
    assert mixing_rates(docs.limit(0), labels, shares).collect() == []
    assert mixed(docs.limit(0), labels, {"high": 1.0, "low": 1.0, "toxic": 1.0}).collect() == []


def test_token_features_of_a_buffer_equal_those_of_single_tokens(monkeypatch):
    texts = ["The end. The END, (the) end of übermäßig", None, "", " \n", "### -- word's word-s", "naïve naïvely, naïv", "long words again " * 40 + "and others"]
    sizes, found = hashed_words.token_slots(texts)
    assert sizes.tolist() == [len(text_slots(t, new_slots())) for t in texts] and sizes.sum() == len(found)
    rows = np.split(found, np.cumsum(sizes)[:-1])
    for text, row in zip(texts, rows, strict=True):
        assert hashed_words.token_slots([text])[1].tolist() == row.tolist()
    # The same word has the same slots in any text; a start of it is a feature of its own.
    (one, two) = (set(hashed_words.token_slots([t])[1].tolist()) for t in ("(Ending!)", "x ending"))
    assert one < two and len(one) == 3
    monkeypatch.setattr(hashed_words, "BUFFER", 50)
    cut = hashed_words.token_slots(texts)
    assert cut[0].tolist() == sizes.tolist() and cut[1].tolist() == found.tolist()
