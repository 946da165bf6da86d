"""Language-model scores: a log-bilinear model trained by noise-contrastive estimation.

Tokens are the words ``[^\\x20\\x09-\\x0D]+`` of a text with A-Z in lower case, and one end.

1. All training documents are counted: N tokens, V distinct ones, c of each. A word's
   base probability is (c + 0.1) / (N + 0.1 (V + 1)); the missing type is "unknown".
2. The model predicts classes: each of the ``OWN`` most frequent tokens is a class, the
   others share classes by their last two bytes (the ``ENDINGS`` heaviest endings, and one
   class for the rest). P(word | context) = P(class | context) * (c + 0.1) / mass of the
   class. The unknown type has a part of every shared class, 0.1 in proportion to their
   masses; its probability is the sum of these parts, so all of a context sum to 1.
3. P(class | two classes before) is log-bilinear: the context vector is the sum of the two
   classes' vectors, each scaled for its place; its product with the class's target
   vector plus a bias is the unnormalised log-probability. Training is numpy in the
   tasks: noise-contrastive estimation against the class frequencies. ``ROUNDS`` rounds
   read a disjoint part of the documents each, all of them together; after a round the
   tasks' parameters are averaged, weighted by their tokens.
4. The normalisers of all context pairs are computed once, by matrix products in tasks
   (a table of classes squared). Scoring is then a product of gathered rows per token.

Counts of the ``HEAD`` most frequent words (a bounded table) are sent to the tasks; rarer
words meet their counts in a join on a 64-bit hash of the word, summed up by document.

Defined results: null text counts as empty and is scored as one end token; repeated rows
are scored alike (and both are trained on, if in training); without training documents N
and V are 0 and every word is unknown; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oddlens.llm.common import chunks, remainder, slices, written

OWN, ENDINGS, HEAD = 700, 200, 1 << 17
WIDTH, NOISE, BATCH, ROUNDS, RATE = 24, 48, 1024, 3, 0.15
#: UTF-8 bytes of texts that are split at once (one text at least).
CHUNK_BYTES = 4_000_000
#: The end token: no word is empty.
END = b""


def _split(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Different tokens of some texts, the number of the token at each place, and each text's first place (and the end)."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    coded = words.flatten().dictionary_encode()
    names = coded.dictionary.cast(pa.binary()).to_pylist()
    # White space around a text leaves empty words, which are no tokens; the end takes their number.
    if END not in names:
        names.append(END)
    end, codes = names.index(END), coded.indices.to_numpy()
    bounds = words.offsets.to_numpy() - words.offsets[0].as_py()
    bounds = np.concatenate([[0], np.cumsum(codes != end)])[bounds]
    codes = np.insert(codes[codes != end], bounds[1:], end)
    return names, codes, bounds + np.arange(len(bounds))


def _hash(word: bytes) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(word)).view(np.int64))


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())], names=["word", "n"])

    for part in (part for batch in batches for part in chunks(batch, 0, CHUNK_BYTES)):
        names, codes, _ = _split(part.column(0))
        seen.update(dict(zip(names, np.bincount(codes, minlength=len(names)).tolist(), strict=True)))
        if len(seen) > 500_000:
            yield flush()
            seen.clear()
    yield flush()


@dataclass
class Vocabulary:
    """Counts and classes; ``head`` maps a frequent word to (class, log10(c + 0.1))."""

    n: int
    v: int
    head: dict[bytes, tuple[int, float]]
    endings: dict[bytes, int]
    rest: int
    #: log10 of each class's mass, and of the unknown type's part of each shared class.
    mass: np.ndarray
    unknown: float
    #: Classes from here on are shared.
    shared: int
    frequency: np.ndarray

    @property
    def classes(self) -> int:
        return len(self.mass)

    def tail_class(self, word: bytes) -> int:
        return self.endings.get(word[-2:], self.rest)


def fit_vocabulary(counts: DataFrame) -> Vocabulary:
    """``counts``: (word, n) of all training tokens."""
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    head = counts.orderBy(F.col("n").desc(), "word").limit(HEAD).toArrow().to_pydict()  # of bounded size
    words, sizes = [bytes(w) for w in head["word"]], head["n"]
    own = words[:OWN]
    # Mass of each ending without the words that are classes themselves.
    ending = F.when(F.octet_length("word") > 1, F.substring("word", -2, 2)).otherwise(F.col("word"))
    heavy = counts.groupBy(ending.alias("ending")).agg(F.sum(F.col("n") + 0.1).alias("m")).orderBy(F.col("m").desc(), "ending").limit(ENDINGS + OWN).toArrow().to_pydict()
    mass = {bytes(e): m for e, m in zip(heavy["ending"], heavy["m"], strict=True)}
    for w, c in zip(own, sizes, strict=False):
        if w[-2:] in mass:
            mass[w[-2:]] -= c + 0.1
    chosen = sorted((e for e in mass if mass[e] > 0.05), key=lambda e: (-mass[e], e))[:ENDINGS]
    endings = {e: len(own) + k for k, e in enumerate(chosen)}
    rest = len(own) + len(chosen)
    total = n + 0.1 * (v + 1)
    each = np.array([c + 0.1 for c in sizes[: len(own)]] + [mass[e] for e in chosen] + [0.0])
    each[rest] = max(total - 0.1 - each.sum(), 1e-3)  # of all other words
    share = np.zeros(len(each))
    share[len(own) :] = 0.1 * each[len(own) :] / each[len(own) :].sum()
    each += share
    part = 0.1 / each[len(own) :].sum()
    found = Vocabulary(n, v, {}, endings, rest, np.log10(each), float(np.log10(part)), len(own), each / each.sum())
    for k, (w, c) in enumerate(zip(words, sizes, strict=True)):
        found.head[w] = (k if k < len(own) else found.tail_class(w), float(np.log10(c + 0.1)))
    return found


ENCODED = "key long, doc_id long, held_out boolean, n_tokens long, n_head long, head_log double, classes binary, tail array<struct<h:long,at:array<int>>>"


def _encoded(batches: Iterable[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[pa.RecordBatch]:
    """Classes of each text's tokens; sums of the frequent words; the rarer words by hash."""
    key = TaskContext.get().partitionId() << 40
    head = vocabulary.head
    names = [x.split()[0] for x in ENCODED.split(", ")]
    for part in (part for batch in batches for part in chunks(batch, 1, CHUNK_BYTES)):
        tokens, codes, bounds = _split(part.column(1))
        found = [head.get(w) for w in tokens]
        rare = np.array([f is None for f in found])
        hashes = np.array([_hash(w) if f is None else 0 for w, f in zip(tokens, found, strict=True)], np.int64)
        classes = np.array([vocabulary.tail_class(w) if f is None else f[0] for w, f in zip(tokens, found, strict=True)], np.uint16)
        logs = np.array([0.0 if f is None else f[1] for f in found])
        firsts, n_tokens = bounds[:-1], np.diff(bounds)  # each text has its end at least
        n_head = np.add.reduceat(~rare[codes], firsts, dtype=np.int64)
        # Places of the rarer words, by text and word.
        at = np.flatnonzero(rare[codes])
        text = np.repeat(np.arange(len(firsts)), n_tokens)[at]
        word = text * len(tokens) + codes[at]
        order = np.argsort(word, kind="stable")
        at, text, word = at[order], text[order], word[order]
        new = np.flatnonzero(np.diff(word, prepend=-1))
        places = _lists(np.append(new, len(at)), pa.array((at - firsts[text]).astype(np.int32)))
        entries = pa.StructArray.from_arrays([pa.array(hashes[codes[at[new]]]), places], names=["h", "at"])
        tail = _lists(np.searchsorted(text[new], np.arange(len(bounds))), entries)
        data = [None, pa.py_buffer((2 * bounds).astype(np.int32)), pa.py_buffer(classes[codes].tobytes())]
        columns = [pa.array(key + np.arange(len(firsts))), part.column(0), part.column(2), pa.array(n_tokens), pa.array(n_head), pa.array(np.add.reduceat(logs[codes], firsts))]
        yield pa.RecordBatch.from_arrays([*columns, pa.Array.from_buffers(pa.binary(), len(firsts), data), tail], names=names)
        key += len(firsts)


def _lists(offsets: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


@dataclass
class LogBilinear:
    """Context vectors (one row more than classes: the start), target vectors, biases."""

    context: np.ndarray
    near: np.ndarray
    far: np.ndarray
    target: np.ndarray
    bias: np.ndarray

    @classmethod
    def new(cls, frequency: np.ndarray, width: int = WIDTH, seed: int = 5) -> LogBilinear:
        rng = np.random.default_rng(seed)
        c = len(frequency)
        return cls(
            rng.normal(0, 0.1, (c + 1, width)).astype(np.float32),
            np.ones(width, np.float32),
            np.full(width, 0.5, np.float32),
            rng.normal(0, 0.1, (c, width)).astype(np.float32),
            np.log(frequency).astype(np.float32),
        )

    def arrays(self) -> list[np.ndarray]:
        return [self.context, self.near, self.far, self.target, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.arrays()])

    def filled(self, flat: np.ndarray) -> LogBilinear:
        parts, at = [], 0
        for a in self.arrays():
            parts.append(flat[at : at + a.size].reshape(a.shape).astype(np.float32))
            at += a.size
        return LogBilinear(*parts)

    def log_normalisers(self, first: int, shared: int) -> tuple[np.ndarray, np.ndarray]:
        """Natural logs after classes (first, x), for every x: of the normaliser, and of the
        probability that one of the classes from ``shared`` on follows."""
        q = self.context * self.near + self.context[first] * self.far
        s = q @ self.target.T + self.bias
        top = s.max(axis=1)
        e = np.exp(s - top[:, None])
        whole = e.sum(axis=1)
        return top + np.log(whole), np.log(e[:, shared:].sum(axis=1) / whole)


def contexts(classes: list[np.ndarray], start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class two before, class before, class) of every token of some documents."""
    w = np.concatenate(classes).astype(np.int64)
    before, two = np.roll(w, 1), np.roll(w, 2)
    firsts = np.cumsum([0, *(len(c) for c in classes[:-1])])
    before[firsts] = two[firsts] = start
    seconds = firsts[[len(c) > 1 for c in classes]] + 1
    two[seconds] = start
    return two, before, w


def _summed(rows: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct places of ``at`` and the sums of their rows."""
    order = np.argsort(at, kind="stable")
    places, starts = np.unique(at[order], return_index=True)
    return places, np.add.reduceat(rows[order], starts, axis=0)


class NceTrainer:
    """Noise-contrastive estimation with AdaGrad; a batch shares its noise classes."""

    def __init__(self, model: LogBilinear, frequency: np.ndarray, seed: int):
        self.model = model
        self.log_noise = np.log(NOISE * frequency).astype(np.float32)
        self.cumulated = np.cumsum(frequency) / frequency.sum()
        self.rng = np.random.default_rng(seed)
        self.squares = [np.full(a.shape, 1e-2, np.float32) for a in model.arrays()]

    def _step(self, k: int, gradient: np.ndarray, places: np.ndarray | None = None) -> None:
        array, square = self.model.arrays()[k], self.squares[k]
        if places is None:
            square += gradient * gradient
            array -= RATE * gradient / np.sqrt(square)
        else:
            square[places] += gradient * gradient
            array[places] -= RATE * gradient / np.sqrt(square[places])

    def batch(self, two: np.ndarray, before: np.ndarray, w: np.ndarray) -> None:
        m = self.model
        noise = np.minimum(np.searchsorted(self.cumulated, self.rng.random(NOISE)), len(m.bias) - 1)
        a, b = m.context[before], m.context[two]
        q = a * m.near + b * m.far
        t, tn = m.target[w], m.target[noise]
        real = np.einsum("ij,ij->i", q, t) + m.bias[w] - self.log_noise[w]
        fake = q @ tn.T + (m.bias[noise] - self.log_noise[noise])
        n = np.float32(len(w))
        gr = (-1 / (1 + np.exp(np.clip(real, -30, 30)))) / n
        gf = (1 / (1 + np.exp(-np.clip(fake, -30, 30)))) / n
        gq = gr[:, None] * t + gf @ tn
        at = np.concatenate([w, noise])
        places, rows = _summed(np.concatenate([gr[:, None] * q, gf.T @ q]), at)
        _, bias = _summed(np.concatenate([gr, gf.sum(axis=0)])[:, None], at)
        around, context = _summed(np.concatenate([gq * m.near, gq * m.far]), np.concatenate([before, two]))
        near, far = (gq * a).sum(axis=0), (gq * b).sum(axis=0)
        self._step(3, rows, places)
        self._step(4, bias[:, 0], places)
        self._step(0, context, around)
        self._step(1, near)
        self._step(2, far)


def _trained(batches: Iterable[pa.RecordBatch], flat: np.ndarray, frequency: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Parameters after one task's documents, times its tokens; slot -1 holds the tokens."""
    model = LogBilinear.new(frequency).filled(flat)
    trainer = NceTrainer(model, frequency, 11 + TaskContext.get().partitionId())
    n = 0
    for (part,) in (part for batch in batches for part in slices(batch)):
        docs = [np.frombuffer(c, np.uint16) for c in part]
        two, before, w = contexts(docs, len(frequency))
        order = trainer.rng.permutation(len(w))
        for a in range(0, len(w), BATCH):
            at = order[a : a + BATCH]
            trainer.batch(two[at], before[at], w[at])
        n += len(w)
    if n:
        values = np.concatenate([[1.0], model.flat()]) * n
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(values) - 1, dtype=np.int32)), pa.array(values)], names=["slot", "value"])


def train(encoded: DataFrame, frequency: np.ndarray, rounds: int = ROUNDS) -> LogBilinear:
    """Train on all rows of ``encoded`` that are not held out, a disjoint part in each round."""
    model = LogBilinear.new(frequency)
    context = encoded.sparkSession.sparkContext
    for k in range(rounds):
        shared = context.broadcast((model.flat(), frequency))
        part = encoded.where(~F.col("held_out") & (F.pmod(F.xxhash64("key"), F.lit(rounds)) == k)).select("classes")
        rows = part.mapInArrow(lambda b, s=shared: _trained(b, *s.value), "slot int, value double")
        found = rows.groupBy("slot").agg(F.sum("value").alias("value")).toArrow()  # one row per parameter
        if found.num_rows:
            values = np.empty(found.num_rows)
            values[found.column("slot").to_numpy() + 1] = found.column("value").to_numpy()
            model = model.filled(values[1:] / values[0])
    return model


def normalisers(spark: SparkSession, model: LogBilinear, shared: int) -> tuple[np.ndarray, np.ndarray]:
    """``log_normalisers`` of all (two before, before) class pairs, by tasks."""
    sent = spark.sparkContext.broadcast(model)
    size = len(model.context)

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in batch.column(0).to_pylist():
                z, p = (x.astype(np.float32).tobytes() for x in sent.value.log_normalisers(first, shared))
                yield pa.RecordBatch.from_arrays([pa.array([first], pa.int64()), pa.array([z], pa.binary()), pa.array([p], pa.binary())], names=["first", "z", "p"])

    found = spark.range(size).repartition(12).mapInArrow(rows, "first long, z binary, p binary").toArrow()
    tables = np.empty((2, size, size), np.float32)
    for first, *both in zip(*(c.to_pylist() for c in found.columns), strict=True):
        for k, part in enumerate(both):
            tables[k, first] = np.frombuffer(part, np.float32)
    return tables[0], tables[1]


def class_logs(model: LogBilinear, z: np.ndarray, two: np.ndarray, before: np.ndarray, w: np.ndarray) -> np.ndarray:
    """log10 P(class | two classes before) of each token."""
    q = model.context[before] * model.near + model.context[two] * model.far
    s = np.einsum("ij,ij->i", q, model.target[w]) + model.bias[w] - z[two, before]
    return s.astype(np.float64) / np.log(10)


SCORED = "key long, doc_id long, held_out boolean, n_tokens long, n_head long, head_log double, class_log double, tail array<struct<h:long,n:int,seen:double,blind:double>>"


def _scored(
    batches: Iterable[pa.RecordBatch], model: LogBilinear, z: np.ndarray, p_shared: np.ndarray, mass: np.ndarray, unknown: float
) -> Iterator[pa.RecordBatch]:
    """Sum of the classes' log-probabilities over their masses, for each text.

    A rarer word of a held-out text may be unknown, which its count will tell: both of its
    sums stand beside it (``seen`` as a member of its class, ``blind`` as the unknown type).
    """
    names = [x.split()[0] for x in SCORED.split(", ")]
    for part in (batch.slice(a, 256) for batch in batches for a in range(0, batch.num_rows, 256)):
        *same, packed, tails = part.columns
        classes = [np.frombuffer(c, np.uint16) for c in packed.to_pylist()]
        two, before, w = contexts(classes, len(mass))
        each = class_logs(model, z, two, before, w) - mass[w]
        starts = np.cumsum([0, *(len(c) for c in classes[:-1])])
        # Entries of the lists, and places of each entry's word.
        hashes, places = tails.flatten().flatten()
        bounds, n = tails.offsets.to_numpy(), np.diff(places.offsets.to_numpy())
        text = np.repeat(np.arange(len(starts)), np.diff(bounds))
        entry = np.repeat(np.arange(len(n)), n)
        at = starts[text][entry] + places.flatten().to_numpy()
        out = part.column(2).to_numpy(zero_copy_only=False)[text][entry]
        entry, at = entry[out], at[out]
        seen = np.bincount(entry, each[at], len(n))
        blind = np.bincount(entry, p_shared[two[at], before[at]] / np.log(10) + unknown, len(n))
        each[at] = 0.0
        # Without a held-out text bincount has nothing to add up and gives whole numbers.
        sums = [hashes, pa.array(n, pa.int32()), *(pa.array(x.astype(np.float64)) for x in (seen, blind))]
        tail = _lists(bounds - bounds[0], pa.StructArray.from_arrays(sums, names=["h", "n", "seen", "blind"]))
        yield pa.RecordBatch.from_arrays([*same, pa.array(np.add.reduceat(each, starts)), tail], names=names)


def language_scores(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    spark = docs.sparkSession
    held = remainder("doc_id", 10) == 0
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("held_out", held)
    counts = written(rows.where("not held_out").select("text").mapInArrow(_counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "lm-counts")
    vocabulary = fit_vocabulary(counts)
    words = spark.sparkContext.broadcast(vocabulary)  # HEAD words at most
    encoded = written(rows.select("doc_id", "text", "held_out").mapInArrow(lambda b: _encoded(b, words.value), ENCODED), "lm-encoded")
    model = train(encoded, vocabulary.frequency, rounds)
    shared = spark.sparkContext.broadcast((model, *normalisers(spark, model, vocabulary.shared), vocabulary.mass, vocabulary.unknown))
    scored = written(encoded.mapInArrow(lambda b: _scored(b, *shared.value), SCORED), "lm-scored")  # read twice below

    # Rarer words: their counts, or none; summed up for each document.
    hashed = counts.mapInArrow(_hashed, "h long, c long")
    tail = scored.select("key", F.explode("tail").alias("t")).select("key", "t.h", "t.n", "t.seen", "t.blind")
    met = tail.join(hashed, "h", "left")
    known = F.col("n") * F.log10(F.col("c") + 0.1)
    sums = met.groupBy("key").agg(
        F.sum(F.coalesce(known, -F.col("n").cast("double"))).alias("base_tail"),
        F.sum(F.coalesce(known + F.col("seen"), F.col("blind"))).alias("tail_log"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("n"))).alias("n_tail"),
    )
    total = float(np.log10(vocabulary.n + 0.1 * (vocabulary.v + 1)))
    joined = scored.drop("tail").join(sums, "key", "left").na.fill(0, ["base_tail", "tail_log", "n_tail"])
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_head") + F.col("n_tail")).alias("n_known"),
        F.lit(vocabulary.n).cast("long").alias("train_tokens"),
        (F.col("head_log") + F.col("base_tail") - F.col("n_tokens") * total).alias("base_score"),
        (F.col("head_log") + F.col("tail_log") + F.col("class_log")).alias("score"),
    )


def _hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column(0).to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([_hash(w) for w in words], pa.int64()), batch.column(1)], names=["h", "c"])
