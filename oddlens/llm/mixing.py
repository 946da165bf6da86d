"""Mixing documents to target weights of domains, with soft membership.

A classifier trained on the labelled table gives each document a posterior over domains.
Nonnegative rates (expected copies) of all documents are fitted so that the expected
tokens of each domain, the sum of rate * tokens * posterior, match the targets:

    sum_k (tokens_k(rates) - target_k)^2 / (2 target_k total)
      + RIDGE / 2 * sum_d tokens_d / total * (rate_d - 1)^2,   0 <= rate_d <= max_rate.

Projected gradient, distributed: a step needs only the domains' totals and two sums of
squares, one row from an aggregation over all documents. The path of totals so far, with
the length of each step, is the whole state: each task replays it for its own rows, so
nothing is kept per document between the steps and a lost executor loses nothing.
The first ``STEPS`` steps have the length that is safe for any rates. If they do not bring
the totals ``CLOSE`` to their targets, each further step is as long as the change of the
gradient over the last one allows (Barzilai and Borwein), shortened where the objective
would rise above its last ``BACK`` values. It ends when the totals are close or the rates no
longer move (bounds of the rates keep a domain from its target); ``Fit.gap`` is the distance
that remains, with a warning if it is not close. The document's copies are the whole part of its rate, and one more with
the probability of the rest, decided by a hash of the document.

Defined results: null and empty texts have no tokens and rate 1; repeated rows have
equal rates and copies; several labels of a document give the toxic domain if one is
toxic, else the low one if one is low; a domain without documents has no share and the
others' targets are scaled up; without labels all documents are of the domain "high"; an
empty table gives an empty result; other columns are kept by ``mixed`` and not read.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oddlens.llm.common import slices, written
from oddlens.llm.hashed_words import summed, token_slots
from oddlens.llm.linear import BITS, fit_sparse, hash_sample, sigmoid
from oddlens.llm.quality import share_slots

DOMAINS = ("high", "low", "toxic")
#: Expected bound of the labelled rows that the classifier is fitted on.
LABELLED = 8_000
RIDGE = 0.005
#: First steps, and the relative distance of a domain's tokens from its goal that ends the fit.
STEPS, CLOSE = 3, 0.01
#: Further steps at most, and values of the objective that a new one is held against.
FURTHER, BACK = 200, 6
#: Mean move of a rate that counts as none.
STILL = 1e-4
#: Rates this near to a whole number are that number: fewer copies left to chance.
SNAP = 0.02

_P, _N = "__mix_posterior", "__mix_tokens"


@dataclass(frozen=True)
class DomainModel:
    """One linear classifier per domain over words, word starts and shares of the text."""

    domains: tuple[str, ...]
    places: np.ndarray
    values: np.ndarray
    offsets: np.ndarray


def _both(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots of the tokens and their starts of each text (their numbers, and all slots), and those of its shares."""
    return *token_slots(texts), np.array([share_slots(t) for t in texts], np.int32)


def domain_labels(labels: DataFrame) -> DataFrame:
    marks = labels.where("doc_id is not null and (quality is not null or toxic is not null)")
    each = marks.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("t"), F.min("quality").alias("q"))
    return each.select("doc_id", F.when(F.col("t") > 0, 2).when(F.col("q") <= 0, 1).otherwise(0).alias("domain"))


def fit_domains(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> DomainModel:
    chosen = hash_sample(domain_labels(labels), "doc_id", labelled)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, domains in (part for batch in batches for part in slices(batch)):
            sizes, found, shares = _both(texts)
            rows = [np.concatenate(x) for x in zip(np.split(found, np.cumsum(sizes)[:-1]), shares, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int32())), pa.array(domains, pa.int32())], names=["slots", "domain"])

    marked = rows.join(F.broadcast(chosen), "doc_id").select("text", "domain")  # of bounded size
    found = marked.mapInArrow(features, "slots array<int>, domain int").toArrow()
    domain = found.column("domain").to_numpy()
    present = sorted(set(domain.tolist())) or [0]
    if len(present) == 1:
        return DomainModel((DOMAINS[present[0]],), np.empty(0, np.int64), np.empty((1, 0)), np.zeros(1))
    slots = [np.asarray(x.values) for x in found.column("slots")]
    fits = [fit_sparse(slots, (domain == k).astype(float), l1=3.0, epochs=3) for k in present]
    weights = np.stack([w for w, _ in fits])
    places = np.flatnonzero(weights.any(axis=0))
    return DomainModel(tuple(DOMAINS[k] for k in present), places, weights[:, places], np.array([o for _, o in fits]))


def with_posteriors(docs: DataFrame, model: DomainModel) -> DataFrame:
    """``docs`` with the posterior of each domain and the number of tokens (words)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(f"{_P} array<double>, {_N} long")
    def member(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        weights = np.zeros((len(own.domains), 1 << BITS))
        weights[:, own.places] = own.values
        for texts in batches:
            posteriors: list[np.ndarray] = []
            for part in (texts.iloc[a : a + 256].tolist() for a in range(0, len(texts), 256)):
                p = np.ones((1, len(part)))
                if len(own.domains) > 1:
                    sizes, found, shares = _both(part)
                    p = sigmoid(summed(weights, sizes, found) + weights[:, shares].sum(axis=2) + own.offsets[:, None])
                posteriors += list((p / p.sum(axis=0)).T)
            yield pd.DataFrame({_P: posteriors, _N: [len((t or "").split()) for t in texts]})

    return docs.withColumn("__mix", member(F.col("text").cast("string"))).select("*", f"__mix.{_P}", f"__mix.{_N}").drop("__mix")


def _move(rate: Column, step: Column, residual: Column, max_rate: float) -> Column:
    slope = F.aggregate(F.zip_with(F.col(_P), residual, lambda p, e: p * e), F.lit(0.0), lambda s, x: s + x)
    return F.greatest(F.lit(0.0), F.least(F.lit(float(max_rate)), rate - step * (slope + F.lit(RIDGE) * (rate - 1.0))))


def _rate(path: list[tuple[float, list[float]]], max_rate: float) -> Column:
    """Rate of a row after the steps of ``path``: their lengths and the scaled residuals of the domains."""
    if not path:
        return F.lit(1.0)
    steps = F.array(*(F.struct(F.lit(float(length)).alias("s"), F.array(*(F.lit(float(x)) for x in e)).alias("e")) for length, e in path))
    return F.when(F.col(_N) > 0, F.aggregate(steps, F.lit(1.0), lambda rate, x: _move(rate, x.s, x.e, max_rate))).otherwise(1.0)


@dataclass(frozen=True)
class Fit:
    #: Residuals before each of the first steps, and their common length.
    path: list[list[float]]
    step: float
    max_rate: float
    totals: list[float]
    goals: list[float]
    #: Length and residuals of the further steps.
    further: list[tuple[float, list[float]]]

    def rate(self) -> Column:
        raw = _rate([(self.step, e) for e in self.path] + self.further, self.max_rate)
        return F.when(F.abs(raw - F.round(raw)) <= SNAP, F.round(raw)).otherwise(raw)

    @property
    def gap(self) -> float:
        """Largest distance of a domain's tokens from its goal, as a share of the goal."""
        return max(abs(t - g) / max(g, 1.0) for t, g in zip(self.totals, self.goals, strict=True))


def _close(totals: list[float], goals: list[float], size: float) -> bool:
    return all(abs(t - g) <= CLOSE * (g + 0.01 * size) for t, g in zip(totals, goals, strict=True))


def _step_sums(members: DataFrame, path: list[tuple[float, list[float]]], max_rate: float) -> tuple[np.ndarray, float, float]:
    """After the last step of ``path``: the domains' tokens, the squared distance of the rates
    from 1, and the squared move of the last step, both weighted by tokens."""
    (step, residual), n = path[-1], len(path[-1][1])
    last = F.array(*(F.lit(float(x)) for x in residual))
    rows = members.where(F.col(_N) > 0).select(_P, _N, _rate(path[:-1], max_rate).alias("__from"))
    rows = rows.withColumn("__to", _move(F.col("__from"), F.lit(float(step)), last, max_rate))
    weight, moved, away = F.col(_N), F.col("__to") - F.col("__from"), F.col("__to") - 1.0
    row = rows.agg(*[F.sum(F.col("__to") * weight * F.get(_P, F.lit(i))) for i in range(n)], F.sum(weight * away * away), F.sum(weight * moved * moved)).first()
    return np.array([x or 0.0 for x in row[:n]]), row[n] or 0.0, row[n + 1] or 0.0


def _further(members: DataFrame, path: list[tuple[float, list[float]]], totals: list[float], goals: list[float], scale: list[float], max_rate: float, size: float) -> tuple[list[tuple[float, list[float]]], list[float]]:
    """Steps of fitted lengths until the totals are close or the rates stand; the steps, and the totals."""
    by, goal = np.array(scale), np.array(goals)
    first, length, found = len(path), path[0][0] if path else 1.0, np.array(totals)
    safe, seen = length, []
    for _ in range(FURTHER):
        residual = (found - goal) / by
        for _ in range(20):
            tried = [*path, (length, residual.tolist())]
            new, away, moved = _step_sums(members, tried, max_rate)
            value = float(((new - goal) ** 2 / (2 * by)).sum() + RIDGE / 2 * away)
            if not seen or value <= max(seen[-BACK:]) * (1 + 1e-12):
                break
            length = max(safe, length / 4) if length > safe else length / 2
        path, seen, change, found = tried, [*seen, value], (new - found) / by, new
        if _close(found.tolist(), goals, size) or moved <= STILL**2 * size:
            break
        length = min(1 / RIDGE, max(safe, moved / float((by * change * change).sum() + RIDGE * moved)))
    return path[first:], found.tolist()


def fit_rates(members: DataFrame, goals: list[float], max_rate: float, steps: int = STEPS) -> Fit:
    """Fit the rates over ``members`` (posterior and tokens of every document). ``goals`` are
    expected tokens of each domain; ``totals`` and ``gap`` of the fit are those of
    its rates before they are snapped to whole numbers."""
    totals = domain_tokens(members, F.lit(1.0), len(goals))
    size = max(1.0, sum(totals))
    scale = [max(g, 1e-3 * size) for g in goals]
    # No row of the second derivative exceeds a domain's tokens over its goal.
    step = 1 / (max(t / c for t, c in zip(totals, scale, strict=True)) + RIDGE)
    path: list[list[float]] = []
    for _ in range(steps):
        if _close(totals, goals, size):
            break
        path.append([(t - g) / c for t, g, c in zip(totals, goals, scale, strict=True)])
        totals = domain_tokens(members, _rate([(step, e) for e in path], max_rate), len(goals))
    further: list[tuple[float, list[float]]] = []
    if not _close(totals, goals, size):
        further, totals = _further(members, [(step, e) for e in path], totals, goals, scale, max_rate, size)
    fit = Fit(path, step, max_rate, totals, goals, further)
    if not _close(totals, goals, size):
        warnings.warn(f"mixing: rates of 0 to {max_rate} leave the domains' tokens {fit.gap:.1%} from their targets", stacklevel=2)
    return fit


def domain_tokens(members: DataFrame, rate: Column, n: int) -> list[float]:
    """Expected tokens of each domain at a rate."""
    row = members.agg(*[F.sum(rate * F.col(_N) * F.get(_P, F.lit(i))).alias(f"a{i}") for i in range(n)]).first()
    return [row[i] or 0.0 for i in range(n)]


def domain_goals(members: DataFrame, domains: tuple[str, ...], shares: dict[str, float] | None, factors: dict[str, float] | None) -> list[float]:
    """Tokens aimed at: ``shares`` of the present total, or ``factors`` of each domain's tokens."""
    masses = domain_tokens(members, F.lit(1.0), len(domains))
    if factors is not None:
        return [m * factors[d] for m, d in zip(masses, domains, strict=True)]
    whole = sum(shares[d] for d in domains)
    return [sum(masses) * shares[d] / whole for d in domains]


def _chance() -> Column:
    """A number of [0, 1) that depends on the document only."""
    return F.pmod(F.xxhash64("doc_id", "text", F.lit(41)), F.lit(1 << 30)) / F.lit(float(1 << 30))


def _copies(rate: Column, chance: Column) -> Column:
    return F.floor(rate + chance).cast("int")


def mixing_rates(docs: DataFrame, labels: DataFrame, shares: dict[str, float], max_rate: float = 8.0) -> DataFrame:
    """doc_id, n_tokens, p_high, p_low, p_toxic, rate and copies of every document, so that
    the domains' expected tokens are ``shares`` of the table's tokens."""
    model = fit_domains(docs, labels)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    members = written(with_posteriors(rows, model).withColumn("__mix_chance", _chance()).drop("text"), "mix-members")
    fit = fit_rates(members, domain_goals(members, model.domains, shares, None), max_rate)
    named = {d: F.get(_P, F.lit(model.domains.index(d))) if d in model.domains else F.lit(0.0) for d in DOMAINS}
    rated = members.withColumn("rate", fit.rate())
    return rated.select(
        "doc_id", F.col(_N).alias("n_tokens"), *(c.alias(f"p_{d}") for d, c in named.items()), "rate", _copies(F.col("rate"), F.col("__mix_chance")).alias("copies")
    )


def mixed(docs: DataFrame, labels: DataFrame, factors: dict[str, float], max_rate: float = 1.0) -> DataFrame:
    """The rows of ``docs``, each as often as its copies say, so that each domain's expected
    tokens are ``factors`` of what they are. With ``max_rate`` 1 no row is repeated."""
    model = fit_domains(docs, labels)
    # Scored once: the fit reads only the posteriors of the written rows.
    scored = written(with_posteriors(docs, model), "mix-scored")
    members = scored.select(_P, _N)
    fit = fit_rates(members, domain_goals(members, model.domains, None, factors), max_rate)
    copied = scored.withColumn("__mix_copies", _copies(fit.rate(), _chance())).where("__mix_copies > 0")
    if max_rate > 1:
        copied = copied.withColumn("__mix_copy", F.explode(F.sequence(F.lit(1), F.col("__mix_copies"))))
    return copied.select(*(F.col(f"`{c}`") for c in docs.columns))
