"""URL filter: written rules first, else the ratio of two character language models.

A rule names a host (with all its subdomains) and the start of a path; the longest
fitting rule decides. The addresses that rules allow or block train two variable-order
Markov models over bytes: the longest context that was seen gives the next byte, with
Witten-Bell smoothing into shorter contexts down to a uniform distribution. The
difference of the two log-likelihoods, divided by the length, is turned into a
probability on a fifth of the ruled addresses that trained neither model; an address
without a rule is allowed at 0.5 or more.

Scale: contexts are counted by Spark from a sample of expected ``SAMPLE`` addresses of
each verdict (chosen by hash, all of them if there are fewer), so the collected model is
bounded; the calibration is fitted on a histogram; every address is judged.

Defined results: a null address has empty host and path, fits no rule and is judged as
the empty text; if no rule blocks or none allows any address, there is nothing to
compare and all without a rule are allowed with score 0.5; repeated rows are judged
alike; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oddlens.llm.common import remainder, slices, text_bytes

#: (verdict, host, start of the path)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
ORDER = 5
SAMPLE = 50_000
#: Contexts of three bytes and more are kept when they were seen so often.
LEAST_SEEN = 2
#: Every so manieth ruled address is kept for the calibration.
HELD = 5
_END = 256
#: Histogram of the normalised log ratio: cells per unit, and its bounds.
_CELLS, _BOUND = 200, 10

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def with_rules(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, url, host, path, rule (text, null if none fits) and ruled (its verdict)."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        url.alias("url"),
        F.translate(F.regexp_extract(url, _PARTS, 1), _UPPER, _UPPER.lower()).alias("host"),
        F.regexp_extract(url, _PARTS, 2).alias("path"),
    )

    def first(value) -> Column:
        fits = [
            (((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path), value(verdict, host + path))
            for verdict, host, path in sorted(rules, key=lambda r: -len(r[1] + r[2]))
        ]
        return F.coalesce(*(F.when(fit, F.lit(v)) for fit, v in fits), F.lit(None).cast("string"))

    return rows.withColumn("rule", first(lambda _, text: text)).withColumn("ruled", first(lambda verdict, _: verdict))


def _symbols(url: str) -> list[int]:
    return [*text_bytes(url), _END]


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (verdict, context, next symbol) for contexts of 0 to ORDER bytes."""

    def flush() -> pa.RecordBatch:
        columns = list(zip(*seen, strict=True)) or [(), (), ()]
        kinds = (pa.string(), pa.binary(), pa.int32())
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(seen.values(), pa.int64())], names=["ruled", "context", "symbol", "n"])

    seen: Counter = Counter()
    for urls, verdicts in (part for batch in batches for part in slices(batch)):
        for url, verdict in zip(urls, verdicts, strict=True):
            text = text_bytes(url)
            for at, symbol in enumerate(_symbols(url)):
                for k in range(min(ORDER, at) + 1):
                    seen[verdict, text[at - k : at], symbol] += 1
        if len(seen) > 300_000:
            yield flush()
            seen.clear()
    yield flush()


class Markov:
    """Variable-order model from rows (context, symbol, n)."""

    def __init__(self, rows: Iterable[tuple[bytes, int, int]]):
        self.followers: dict[bytes, dict[int, int]] = {}
        for context, symbol, n in rows:
            self.followers.setdefault(context, {})[symbol] = n
        self.totals = {context: sum(f.values()) for context, f in self.followers.items()}

    def probability(self, context: bytes, symbol: int) -> float:
        p = 1 / 257
        for k in range(len(context) + 1):
            f = self.followers.get(context[len(context) - k :])
            if f is None:
                break
            p = (f.get(symbol, 0) + len(f) * p) / (self.totals[context[len(context) - k :]] + len(f))
        return p

    def log_likelihood(self, url: str) -> float:
        text = text_bytes(url)
        return sum(math.log(self.probability(text[max(0, at - ORDER) : at], s)) for at, s in enumerate(_symbols(url)))


def fit_models(ruled: DataFrame, sample: int = SAMPLE) -> dict[str, Markov]:
    """A model for each verdict that rules gave to any address of ``ruled`` (url, ruled)."""
    sizes = {r.ruled: r.n for r in ruled.groupBy("ruled").agg(F.count("*").alias("n")).collect()}
    grain = 1 << 30
    chosen = [(F.col("ruled") == v) & (F.pmod(F.xxhash64("url"), F.lit(grain)) < math.ceil(grain * min(1, sample / n))) for v, n in sizes.items()]
    if not chosen:
        return {}
    counted = ruled.where(reduce(lambda a, b: a | b, chosen)).select("url", "ruled").mapInArrow(_counted, "ruled string, context binary, symbol int, n long")
    summed = counted.groupBy("ruled", "context", "symbol").agg(F.sum("n").alias("n"))
    rows = summed.where((F.octet_length("context") < 3) | (F.col("n") >= LEAST_SEEN)).toArrow().to_pydict()
    by: dict[str, list] = {v: [] for v in sizes}
    for verdict, *row in zip(rows["ruled"], rows["context"], rows["symbol"], rows["n"], strict=True):
        by[verdict].append(tuple(row))
    return {v: Markov(r) for v, r in by.items()}


def _ratios(df: DataFrame, models: dict[str, Markov]) -> DataFrame:
    """Adds ``ratio``: difference of the log-likelihoods per symbol."""
    shared = df.sparkSession.sparkContext.broadcast(models)  # of bounded size: see SAMPLE
    at = df.columns.index("url")

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        allow, block = shared.value["allow"], shared.value["block"]
        for batch in batches:
            ratios = [(allow.log_likelihood(u) - block.log_likelihood(u)) / len(_symbols(u)) for u in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ratios, pa.float64())], names=[*batch.schema.names, "ratio"])

    return df.mapInArrow(score, df.withColumn("ratio", F.lit(0.0)).schema)


def fit_logistic(x: np.ndarray, positive: np.ndarray, negative: np.ndarray) -> tuple[float, float]:
    """Slope and offset of P(positive | x) from counts, by Newton's method with a weak prior."""
    w = np.zeros(2)
    design = np.stack([x, np.ones_like(x)], axis=1)
    total = positive + negative
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (positive - total * p) - 1e-2 * w
        hessian = (design * (total * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def judged_pages(pages: DataFrame, rules=RULES, sample: int = SAMPLE) -> DataFrame:
    """page_id, host, path, rule, verdict and score (probability of allow by the models)."""
    rows = with_rules(pages, rules)
    held = remainder("url", HELD) == 0
    ruled = rows.where("ruled is not null")
    models = fit_models(ruled.where(~held).select("url", "ruled"), sample)
    if set(models) < {"allow", "block"}:
        scored = rows.withColumn("score", F.lit(0.5))
    else:
        cell = F.round(F.greatest(F.lit(-_BOUND), F.least(F.lit(_BOUND), F.col("ratio"))) * _CELLS)
        histogram = (
            _ratios(ruled.where(held).select("url", "ruled"), models)
            .groupBy(cell.alias("cell"))
            .agg(F.count_if(F.col("ruled") == "allow").alias("allow"), F.count_if(F.col("ruled") == "block").alias("block"))
            .toPandas()
        )
        slope, offset = fit_logistic(*(histogram[c].to_numpy(float) / (_CELLS if c == "cell" else 1) for c in ("cell", "allow", "block")))
        p = 1 / (1 + F.exp(-(F.col("ratio") * slope + offset)))
        scored = _ratios(rows, models).withColumn("score", p)
    verdict = F.coalesce("ruled", F.when(F.col("score") >= 0.5, "allow").otherwise("block"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
