"""Quality classifier by co-training.

Two views of a document are kept apart: its words (which words, and what share of the
text has which form) and the data about its page (language, source, stated length, and
the layout of its lines). Each view has its own classifier: an L1 logistic model over hashed
words, a linear discriminant of the page data. Both are fitted from sums, so they learn from
any number of rows in tasks. They start from the labelled documents; in each round both score
every unlabelled training document, a histogram of the scores shows above which certainty
a share of them lies, and the documents beyond it are pseudo-labels that train the other
view. Each view is calibrated on labelled documents that trained neither, and at last
their log-odds are combined by a small logistic model.

The labelled documents are a bounded sample (``LABELLED`` expected rows); all unlabelled
training documents take part, and every whole document is scored. Their features are
written once. Labels are read only for documents whose crc32(doc_id) modulo 4 is not 2.
Sums do not depend on how the rows are partitioned, but for the rounding of page data.

Defined results: null text counts as empty, other nulls as unknown; rows are scored one
by one, so repeated rows get equal scores; several labels of a document count as good
only if all are; with labels of one kind or none every score is the share of good labels
(0.5 without labels); an empty table gives an empty result; columns other than doc_id,
text, lang, source and n_chars are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddlens.llm.common import remainder, slices, text_bytes, written
from oddlens.llm.linear import BITS, fit_dense, hash_sample, logit, minimise, sigmoid

LABELLED = 8_000
ROUNDS = 4
#: Pseudo-labels a view gives by each further round and class, as a share of all unlabelled documents,
#: and the least certainty.
GIVEN, CERTAIN = 0.05, 0.9
#: The text view's L1 term in standard deviations of what chance adds to a slope, and passes of its fit.
L1, PASSES = 0.07, 6
#: Variance that page data have in any case.
RIDGE = 1e-3
#: Calibrated log-odds end here; bins of their histogram.
LIMIT, BINS = 12.0, 480
#: Weight of a pseudo-label against a label.
PSEUDO = 0.5
KEEP = 0.5
_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_SYMBOLS = b"#*$%&|<>!?"
_SOURCES = 16


def _share(data: bytes, chosen: bytes, n: int) -> float:
    return (len(data) - len(data.translate(None, chosen))) / n


_MASK = (1 << BITS) - 1


def _slot(name: str) -> int:
    return zlib.crc32(name.encode()) & _MASK


def _shares(data: bytes, words: list[bytes], distinct: set[bytes]) -> list[int]:
    n = max(1, len(data))
    shares = {
        "upper": _share(data, _UPPER, n),
        "digit": _share(data, _DIGITS, n),
        "symbol": _share(data, _SYMBOLS, n),
        "variety": len(distinct) / max(1, math.sqrt(len(words))) / 20,
        "common": max(Counter(words).values(), default=0) / max(1, len(words)),
        "word": sum(map(len, words)) / max(1, len(words)) / 20,
    }
    steps = [_slot(f" {k} {min(20, int(20 * v))}") for k, v in shares.items()]
    # Each step counts several times, as it sums up the whole text.
    return [*steps, _slot(f" words {len(words).bit_length()}")] * 4


def share_slots(text: str | None) -> list[int]:
    """Hashed features: steps of the shares of character kinds and of repetition in a text."""
    data = text_bytes(text)
    words = data.lower().split()
    return _shares(data, words, set(words))


def content_slots(text: str | None) -> list[int]:
    """Hashed features of the words: the distinct words, and ``share_slots``."""
    data = text_bytes(text)
    words = data.lower().split()
    distinct = set(words)
    return [zlib.crc32(w) & _MASK for w in distinct] + _shares(data, words, distinct)


def page_features(text: str | None, lang: str | None, source: str | None, n_chars: int | None) -> list[float]:
    """Dense features of the page: length, lines, language, source."""
    lines = (text or "").split("\n")
    full = [x for x in lines if x.strip()]
    lengths = np.array([len(x) for x in full] or [0], float)
    stated = 0 if n_chars is None else max(0, n_chars)
    langs, sources = [0.0] * 8, [0.0] * _SOURCES
    langs[zlib.crc32((lang or "").encode()) % 8] = 1.0
    sources[zlib.crc32((source or "").encode()) % _SOURCES] = 1.0
    marks = sum((text or "").count(m) for m in (". ", ".\n", ", "))
    return [
        math.log1p(stated) / 10,
        math.log1p(len(full)) / 5,
        math.log1p(float(lengths.mean())) / 8,
        math.log1p(float(lengths.max())) / 10,
        float((lengths < 30).mean()),
        1 - len(set(full)) / max(1, len(full)),
        1 - len(full) / len(lines),
        min(1.0, 20 * marks / max(1, len(text or ""))),
        float(stated == len(text or "")),
        *langs,
        *sources,
    ]


#: Some documents: numbers of slots, all slots, page data.
_Docs = tuple[np.ndarray, np.ndarray, np.ndarray]


def _packed(slots: list[np.ndarray], pages: np.ndarray) -> _Docs:
    return np.array([len(x) for x in slots], np.int64), np.concatenate([np.empty(0, np.int32), *slots]), pages


def _text_logits(weights: np.ndarray, offset: float, sizes: np.ndarray, found: np.ndarray) -> np.ndarray:
    raw = np.full(len(sizes), offset)
    filled = np.flatnonzero(sizes)
    if len(filled):
        raw[filled] += np.add.reduceat(weights[found], (np.cumsum(sizes) - sizes)[filled])
    return raw


@dataclass(frozen=True)
class Views:
    """Both classifiers and their calibrations (slope and offset of the log-odds)."""

    weights: np.ndarray
    offset: float
    page: np.ndarray
    text_scale: np.ndarray
    page_scale: np.ndarray

    def raw(self, docs: _Docs) -> np.ndarray:
        sizes, found, pages = docs
        return np.stack([_text_logits(self.weights, self.offset, sizes, found), pages @ self.page[:-1] + self.page[-1]])

    def logits(self, docs: _Docs) -> np.ndarray:
        """Calibrated log-odds: one row for each view."""
        text, page = self.raw(docs)
        return np.clip([text * self.text_scale[0] + self.text_scale[1], page * self.page_scale[0] + self.page_scale[1]], -LIMIT, LIMIT)


@dataclass(frozen=True)
class QualityModel:
    both: Views
    combined: np.ndarray

    def views(self, slots: list[np.ndarray], pages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Calibrated logits of both views."""
        text, page = self.both.logits(_packed(slots, pages))
        return text, page

    def score(self, text: np.ndarray, page: np.ndarray) -> np.ndarray:
        return sigmoid(text * self.combined[0] + page * self.combined[1] + self.combined[2])


#: Grain of the text view's sums: whole numbers add up alike in any order.
_GRAIN = float(1 << 24)


def _text_sums(docs: _Docs, marks: np.ndarray, weights: np.ndarray, offset: float, chosen: np.ndarray | None = None) -> np.ndarray:
    """Loss, slopes and curvatures (slots, then the offset) of the text view over documents marked
    0 or 1; slots that are not chosen give zeros."""
    taught = marks >= 0
    sizes, found, y = docs[0][taught], docs[1][np.repeat(taught, docs[0])], marks[taught]
    raw = _text_logits(weights, offset, sizes, found)
    p = sigmoid(raw)
    # Slots of a document move together, so each one's curvature counts with their number.
    parts = [np.rint(_GRAIN * (p - y)), np.rint(_GRAIN * p * (1 - p) * (sizes + 1))]
    kept = np.ones(1 << BITS, bool)
    if chosen is not None:
        kept[:] = False
        kept[chosen] = True
    spread = [[np.bincount(found, weights=np.repeat(v, sizes), minlength=1 << BITS) * kept, [v.sum()]] for v in parts]
    return np.concatenate([[np.rint(_GRAIN * (np.logaddexp(0, raw) - y * raw)).sum()], *(x for part in spread for x in part)])


def _page_sums(docs: _Docs, for_text: np.ndarray, for_page: np.ndarray) -> np.ndarray:
    """Numbers of documents marked 0 and 1 for the text view; number and sum of the page data of
    those marked for the page view, and their products."""
    rows = [docs[2][for_page == c] for c in (0, 1)]
    taught = np.concatenate(rows)
    counts = [(for_text == c).sum() for c in (0, 1)]
    return np.concatenate([counts, [len(r) for r in rows], *(r.sum(axis=0) for r in rows), (taught.T @ taught).ravel()]).astype(float)


def _fit(total: np.ndarray, text_sums: Callable[[np.ndarray, float, np.ndarray | None], np.ndarray], held: _Docs, labels: np.ndarray) -> Views:
    """Both views from their sums, calibrated on the held documents. One pass over all slots shows
    which ones the L1 term lets move; later passes return the sums of these only."""
    width = held[2].shape[1]
    n, m, means, products = total[:2], total[2:4], total[4 : 4 + 2 * width].reshape(2, -1) / total[2:4, None], total[4 + 2 * width :]

    def sums(weights: np.ndarray, offset: float, chosen: np.ndarray | None) -> tuple[float, np.ndarray, np.ndarray]:
        found = text_sums(weights, offset, chosen) / _GRAIN
        return float(found[0]), *found[1:].reshape(2, -1)

    share = float(n[1] / n.sum())
    weights, offset = minimise(sums, share, L1 * float(np.sqrt(n.sum() * share * (1 - share))), PASSES, rounds=1)
    spread = (products.reshape(width, width) - (means * m[:, None]).T @ means) / m.sum() + RIDGE * np.eye(width)
    slope = np.linalg.solve(spread, means[1] - means[0])
    page = np.append(slope, np.log(m[1] / m[0]) - means.mean(axis=0) @ slope)
    views = Views(weights, offset, page, np.array([1.0, 0.0]), np.array([1.0, 0.0]))
    scales = [fit_dense(x[:, None], labels, ridge=0.1) for x in views.raw(held)]
    return Views(weights, offset, page, *scales)


def _histogram(views: Views, docs: _Docs) -> np.ndarray:
    bins = np.minimum(((views.logits(docs) + LIMIT) * (BINS / (2 * LIMIT))).astype(int), BINS - 1)
    return np.concatenate([np.bincount(b, minlength=BINS) for b in bins]).astype(float)


def _limits(histogram: np.ndarray, share: float) -> np.ndarray:
    """Per view the log-odds up to which documents are surely low, and from which on surely good."""
    edges = np.linspace(-LIMIT, LIMIT, BINS + 1)
    sure = float(logit(CERTAIN))
    limits = []
    for counts in histogram.reshape(2, BINS):
        asked = share * counts.sum()
        low, high = np.searchsorted(counts.cumsum(), asked), np.searchsorted(counts[::-1].cumsum(), asked)
        limits.append((min(-sure, edges[min(low + 1, BINS)]), max(sure, edges[max(BINS - 1 - high, 0)])))
    return np.array(limits)


def _marks(views: Views, limits: np.ndarray, docs: _Docs) -> np.ndarray:
    """Per view, 1 or 0 where it is sure of a document, else -1."""
    return np.array([np.where(x >= high, 1, np.where(x < low, 0, -1)) for x, (low, high) in zip(views.logits(docs), limits, strict=True)])


def _pseudo_page(views: Views, limits: np.ndarray, docs: _Docs) -> np.ndarray:
    by_text, by_page = _marks(views, limits, docs)
    return _page_sums(docs, by_page, by_text)


def _pseudo_text(views: Views, limits: np.ndarray, weights: np.ndarray, offset: float, chosen: np.ndarray | None, docs: _Docs) -> np.ndarray:
    return _text_sums(docs, _marks(views, limits, docs)[1], weights, offset, chosen)


#: Adds up a function's vectors, of the given length, over all unlabelled documents.
_Gather = Callable[[Callable[[_Docs], np.ndarray], int], np.ndarray]


def _train(base: _Docs, labels: np.ndarray, held: _Docs, held_labels: np.ndarray, gather: _Gather, rounds: int) -> QualityModel:
    own = _page_sums(base, labels, labels)
    views = _fit(own, partial(_text_sums, base, labels), held, held_labels)
    for k in range(rounds):
        last, limits = views, _limits(gather(partial(_histogram, views), 2 * BINS), GIVEN * (k + 1))

        def text_sums(weights: np.ndarray, offset: float, chosen: np.ndarray | None, last: Views = last, limits: np.ndarray = limits) -> np.ndarray:
            more = gather(partial(_pseudo_text, last, limits, weights, offset, chosen), 2 * (1 << BITS) + 3)
            return _text_sums(base, labels, weights, offset, chosen) + PSEUDO * more

        views = _fit(own + PSEUDO * gather(partial(_pseudo_page, last, limits), len(own)), text_sums, held, held_labels)
    return QualityModel(views, fit_dense(views.logits(held).T, held_labels, ridge=0.1))


def co_train(slots: list[np.ndarray], pages: np.ndarray, labels: np.ndarray, rounds: int = ROUNDS) -> QualityModel:
    """The model of documents in memory. ``labels``: 1, 0 or nan (unlabelled). A fifth of the
    labelled rows only calibrates."""

    def part(at: np.ndarray) -> _Docs:
        return _packed([slots[i] for i in at], pages[at])

    known = np.flatnonzero(~np.isnan(labels))
    held = known[::5]
    base = np.setdiff1d(known, held)
    pool = part(np.flatnonzero(np.isnan(labels)))
    return _train(part(base), labels[base], part(held), labels[held], lambda task, size: task(pool), rounds)


def _arrays(batch: pa.RecordBatch | pa.Table) -> _Docs:
    slots, page = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (batch.column("slots"), batch.column("page")))
    sizes = np.diff(slots.offsets.to_numpy()).astype(np.int64)
    return sizes, slots.flatten().to_numpy(), page.flatten().to_numpy().reshape(len(sizes), -1 if len(sizes) else len(page_features(None, None, None, None)))


def _gather_rows(pool: DataFrame) -> _Gather:
    session = pool.sparkSession
    few = pool.select("slots", "page").coalesce(max(1, session.sparkContext.defaultParallelism))  # fewer partial sums to move

    def gather(task: Callable[[_Docs], np.ndarray], size: int) -> np.ndarray:
        shared = session.sparkContext.broadcast(task)

        def one(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for batch in batches:
                if batch.num_rows:
                    total += shared.value(_arrays(batch))
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["place", "total"])

        found = few.mapInArrow(one, "place long, total double").groupBy("place").agg(F.sum("total").alias("total")).toArrow()
        shared.unpersist()
        sums = np.zeros(size)
        sums[found.column("place").to_numpy()] = found.column("total").to_numpy()
        return sums

    return gather


def _features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for texts, langs, sources, sizes, marks, helds in (part for batch in batches for part in slices(batch)):
        slots = [np.array(content_slots(t), np.int32) for t in texts]
        pages = [page_features(*row) for row in zip(texts, langs, sources, sizes, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(slots, pa.list_(pa.int32())), pa.array(pages, pa.list_(pa.float64())), pa.array(marks, pa.float64()), pa.array(helds, pa.bool_())],
            names=["slots", "page", "label", "held"],
        )


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.col(c).cast(t).alias(c) for c, t in (("doc_id", "long"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "long"))))


def fit_quality(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> tuple[QualityModel | None, float]:
    """The model (None with labels of one kind only) and the share of good labels."""
    known = labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.min("quality") > 0).cast("double").alias("label"))
    known = known.where(remainder("doc_id", 4) != 2)
    chosen = hash_sample(known, "doc_id", labelled).withColumn("held", F.pmod(F.xxhash64("doc_id", F.lit(31)), F.lit(5)) == 0)
    # The chosen labels are of bounded size. Documents with another label count as unlabelled.
    marked = _columns(docs).where(remainder("doc_id", 4) != 2).join(F.broadcast(chosen), "doc_id", "left")
    read = marked.select("text", "lang", "source", "n_chars", "label", "held")
    features = written(read.mapInArrow(_features, "slots array<int>, page array<double>, label double, held boolean"), "quality-features")
    found = features.where("label is not null").toArrow()
    label, held = (np.array(found.column(c).to_pylist(), float) for c in ("label", "held"))
    parts = [np.flatnonzero(held == h) for h in (0, 1)]
    share = float(label.mean()) if len(label) else 0.5
    if any(len(np.unique(label[at])) < 2 for at in parts):
        return None, share
    (base, base_labels), (apart, apart_labels) = ((_arrays(found.take(pa.array(at))), label[at]) for at in parts)
    return _train(base, base_labels, apart, apart_labels, _gather_rows(features.where("label is null")), ROUNDS), share


def quality_scores(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """doc_id, held_out, text_score, page_score, score and kept (score >= KEEP) of every document."""
    model, share = fit_quality(docs, labels, labelled)
    shared = docs.sparkSession.sparkContext.broadcast((model, share))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, rate = shared.value
        for ids, texts, langs, sources, sizes in (part for batch in batches for part in slices(batch)):
            if own is None:
                text = page = final = np.full(len(ids), rate)
            else:
                pages = np.array([page_features(*row) for row in zip(texts, langs, sources, sizes, strict=True)])
                a, b = own.views([np.array(content_slots(t), np.int32) for t in texts], pages)
                text, page, final = sigmoid(a), sigmoid(b), own.score(a, b)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *(pa.array(x, pa.float64()) for x in (text, page, final))], names=["doc_id", "text_score", "page_score", "score"]
            )

    scored = _columns(docs).mapInArrow(score, "doc_id long, text_score double, page_score double, score double")
    return scored.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "text_score", "page_score", "score", (F.col("score") >= KEEP).alias("kept"))
