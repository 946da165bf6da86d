import math

import numpy as np

from oddlens.llm.linear import BITS
from oddlens.llm.quality import BINS, _limits, _packed, _slot, _text_sums, co_train, content_slots, page_features, quality_scores, share_slots

DATA = "/root/testdata/sf0.01"


def test_pseudo_labels_help_the_view_with_few_labels():
    rng = np.random.default_rng(2)
    n = 1200
    y = (rng.random(n) < 0.5).astype(float)
    # Which word tells the class differs between documents; the page view tells it always.
    slots = [np.array([10 + int(y[k]) * 50 + int(rng.integers(50)), *rng.integers(1000, 200_000, 8)], np.int32) for k in range(n)]
    pages = np.column_stack([y + rng.normal(0, 0.25, n), rng.normal(0, 1, n)])
    labels = np.where(np.arange(n) < 60, y, np.nan)
    held = slice(600, n)
    alone, together = (co_train(slots, pages, labels, rounds=r) for r in (0, 6))
    right = [((m.views(slots[held], pages[held])[0] > 0) == y[held]).mean() for m in (alone, together)]
    assert right[1] > right[0] + 0.03
    final = together.score(*together.views(slots[held], pages[held]))
    assert ((final > 0.5) == y[held]).mean() > 0.9


def test_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    found = quality_scores(docs, labels)
    assert found.count() == docs.count()
    rows = found.join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.kept == (r.quality == 1) for r in rows]) > 0.9


def test_odd_tables(spark):
    rows = [(k, f"text {k} of some words", "en", "a", 20, 0.0) for k in range(20)]
    rows += [(None, None, None, None, None, 0.0), (50, "", "en", "", -4, 0.0), (50, "", "en", "", -4, 0.0), (51, "w " * 60_000, "", None, 1, 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double")
    labels = spark.createDataFrame([(1, 1), (None, 0), (2, None)], "doc_id long, quality int")
    for marks, share in ((labels, 1.0), (labels.limit(0), 0.5)):
        found = quality_scores(docs, marks).collect()
        assert len(found) == 24 and {r.score for r in found} == {share}
    many = spark.createDataFrame([(k, k % 2) for k in range(20)], "doc_id long, quality int")
    found = quality_scores(docs, many).collect()
    assert len(found) == 24 and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id == 50}) == 1
    assert quality_scores(docs.limit(0), labels).collect() == []
    assert len(page_features(None, None, None, None)) == len(page_features("a\n\nb", "en", "x", 4)) and len(content_slots(None)) == 28


def test_the_commonest_word_is_seen_wherever_it_is():
    words = [f"w{k}" for k in range(1000)]
    for k in range(7, 1000, 6):
        words[k] = "spam"
    assert all("spam" != w for w in words[::200])
    share = words.count("spam") / 1000
    for text in (" ".join(words), " ".join(["first", *words])):
        assert _slot(f" common {int(20 * share)}") in share_slots(text)


def test_the_result_does_not_depend_on_partitions(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    one, other = ({r.doc_id: r.score for r in quality_scores(docs.repartition(n), labels).collect()} for n in (1, 32))
    assert len(one) == docs.count() and all(abs(one[k] - other[k]) < 1e-6 for k in one)


def test_limits_give_a_share_or_stay_certain():
    sure = math.log(9)
    counts = np.zeros((2, BINS))
    counts[0, [0, 100, -1]] = 40, 930, 30  # log-odds -12, -7, 12
    counts[1, BINS // 2] = 1000
    (low, high), (least, most) = _limits(counts.ravel(), 0.05)
    assert -7 < low < -6.9 and high == sure  # 5 % are below bin 101; above, fewer than 5 % are certain
    assert (least, most) == (-sure, sure)


def test_sums_of_parts_are_the_sum_of_all():
    rng = np.random.default_rng(4)
    slots = [rng.integers(0, 500, rng.integers(0, 9)).astype(np.int32) for _ in range(90)]
    pages, marks = rng.normal(size=(90, 3)), rng.integers(-1, 2, 90)
    weights = np.zeros(1 << BITS)
    weights[:500] = rng.normal(size=500)
    whole = _text_sums(_packed(slots, pages), marks, weights, 0.3)
    parts = [_text_sums(_packed(slots[a : a + 20], pages[a : a + 20]), marks[a : a + 20], weights, 0.3) for a in range(0, 90, 20)]
    assert (whole == sum(parts)).all()
    used = [k for k in range(90) if marks[k] >= 0]
    error = {k: 1 / (1 + math.exp(-0.3 - weights[slots[k]].sum())) - marks[k] for k in used}
    slope = np.zeros(1 << BITS)
    for k in used:
        np.add.at(slope, slots[k], error[k])
    assert np.allclose(whole[1 : 1 + (1 << BITS)] / (1 << 24), slope, atol=1e-5)
