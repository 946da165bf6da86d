import random
import re

import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from corpus_pipeline import PIECE_MODEL, STAGES, run
from oddlens.llm.common import written

DATA = "/root/testdata/sf0.001"


def staged(spark, docs, folder):
    found = {}
    for name, stage in STAGES:
        docs = written(stage(spark, docs, folder), "test")
        found[name] = docs
    return found


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    found = staged(spark, docs, DATA)
    for name, table in list(found.items())[:-1]:
        assert table.columns == docs.columns, name
    ids = {name: {r.doc_id for r in t.select("doc_id").collect()} for name, t in found.items()}
    order = [name for name, _ in STAGES]
    assert all(ids[b] <= ids[a] for a, b in zip(order, order[1:], strict=False))
    texts = {r.doc_id: r.text for r in docs.collect()}
    # Exact copies, against a plain dictionary.
    groups = {}
    for d in ids["toxicity"]:
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", texts[d]), []).append((-len(texts[d]), d))
    assert ids["exact dedup"] == {min(g)[1] for g in groups.values()}
    # Labels that no classifier may contradict much.
    labels = {r.doc_id: r for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    good = [d for d in ids["near dedup"] if d in labels and labels[d].quality == 1 and labels[d].toxic == 0]
    assert sum(d in ids["mixing"] for d in good) >= 0.95 * len(good)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    last = {r.doc_id: r.n_tokens for r in found["sentencepiece"].collect()}
    assert last == {d: len(library.encode(texts[d])) for d in ids["mixing"]}
    assert {r.doc_id for r in run(spark, DATA).collect()} == set(last)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, __x string, cid long"


def test_odd_rows_and_clashing_names(spark):
    rng = random.Random(8)
    text = " ".join(f"w{rng.randrange(4000)}" for _ in range(200))
    near = text.replace(text.split()[100], "changed", 1)
    rows = [(1, text), (2, text + " "), (3, near), (4, None), (4, None), (5, ""), (6, "lone words here"), (6, "other words of the same id"), (None, "no id"), (None, "no id"), (7, "long " * 50_000)]
    docs = spark.createDataFrame([(*r, None, None, None, 1.0, "x", 7) for r in rows], SCHEMA)
    found = staged(spark, docs, DATA)
    assert found["mixing"].columns == docs.columns
    kept = sorted(((r.doc_id, r.text) for r in found["exact dedup"].collect()), key=str)
    assert kept == sorted([(2, text + " "), (3, near), (4, None), (6, "lone words here"), (6, "other words of the same id"), (None, "no id"), (7, "long " * 50_000)], key=str)
    kept = {r.doc_id for r in found["near dedup"].collect()}
    assert kept == {2, 4, 6, None, 7}
    empty = staged(spark, docs.limit(0), DATA)
    assert all(t.count() == 0 for t in empty.values())


def test_a_toxic_text_goes(spark):
    docs = spark.read.parquet(f"{DATA.replace('0.001', '0.01')}/documents.parquet")
    labels = spark.read.parquet(f"{DATA.replace('0.001', '0.01')}/labels.parquet")
    left = corpus_pipeline.toxicity(spark, docs, DATA.replace("0.001", "0.01"))
    rates = labels.join(left.select("doc_id").withColumn("kept", F.lit(1)), "doc_id", "left").groupBy("toxic").agg(F.avg(F.coalesce("kept", F.lit(0))).alias("kept"))
    rates = {r.toxic: r.kept for r in rates.collect()}
    assert rates[0] > 0.93 and rates[1] < 0.4


@pytest.mark.parametrize("name", [n for n, _ in STAGES])
def test_names_are_short(name):
    assert len(name) <= 40
