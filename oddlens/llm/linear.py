"""Linear text classifiers on hashed word features, fitted from bounded samples or, in tasks, from all rows."""

from __future__ import annotations

import string
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 18
#: Starts of words that are features beside the whole word.
PREFIXES = (4, 5, 6)
#: Words whose features one task remembers at most.
REMEMBERED = 300_000


_MASK = (1 << BITS) - 1
_PUNCTUATION = string.punctuation + "«»“”„…–—¡¿‚‘’"


def tokens(text: str | None) -> set[str]:
    """Distinct white-space separated tokens of a text, in lower case."""
    return set((text or "").lower().split())


def terms(token: str) -> list[str]:
    """A token without the punctuation around it, and its starts; a start carries its
    length, so it differs from a word. A token of punctuation only is a term itself."""
    word = token.strip(_PUNCTUATION) or token
    return [word, *(f"{k} {word[:k]}" for k in PREFIXES if len(word) > k)]


def slots(token: str) -> list[int]:
    return [zlib.crc32(t.encode("utf-8", "surrogatepass")) & _MASK for t in terms(token)]


class _Slots(dict):
    def __missing__(self, word: str) -> list[int]:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = slots(word)
        return found


def text_slots(text: str | None, known: dict[str, list[int]]) -> np.ndarray:
    """Hashed features of a text: one entry for each distinct token and each of its starts."""
    return np.fromiter((s for w in tokens(text) for s in known[w]), np.int32)


def new_slots() -> dict[str, list[int]]:
    return _Slots()


def fraction(n: int, bound: int) -> float:
    return 1.0 if n <= bound else bound / n


def hash_sample(df: DataFrame, column: str, bound: int) -> DataFrame:
    """Rows chosen by a hash of ``column``: an expected ``bound`` of them, all if there are fewer."""
    share = fraction(df.count(), bound)
    grain = 1 << 30
    return df if share == 1.0 else df.where(F.pmod(F.xxhash64(column, F.lit(17)), F.lit(grain)) < int(grain * share))


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit_sparse(rows: list[np.ndarray], targets: np.ndarray, weights: np.ndarray | None = None, l1: float = 1.0, epochs: int = 4, seed: int = 3) -> tuple[np.ndarray, float]:
    """Logistic weights and offset for targets in 0 to 1, by FTRL-proximal steps with an L1
    term, so that features without evidence weigh exactly nothing."""
    size = 1 << BITS
    z, n, w = np.zeros(size), np.zeros(size), np.zeros(size, np.float64)
    mean = float(np.average(targets, weights=weights)) if len(targets) else 0.5
    offset = float(np.log((mean + 1e-4) / (1 - mean + 1e-4)))
    square = 1.0
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            at, count = np.unique(rows[k], return_counts=True)
            p = sigmoid(w[at] @ count + offset)
            g = (p - targets[k]) * (1.0 if weights is None else weights[k])
            if abs(g) < 1e-7:
                continue
            square += g * g
            offset -= 0.1 * g / np.sqrt(square)
            own = g * count
            step = (np.sqrt(n[at] + own * own) - np.sqrt(n[at])) / 0.2
            z[at] += own - step * w[at]
            n[at] += own * own
            w[at] = np.where(np.abs(z[at]) <= l1, 0.0, -(z[at] - np.sign(z[at]) * l1) / ((1 + np.sqrt(n[at])) / 0.2))
    return w, offset


#: Grain of the sums that tasks return: whole numbers add up alike in any order.
_GRAIN = float(1 << 24)
_SUMS = "slot int, total long, curve long"
#: Slots that stand for the offset's slope and for the loss.
_OFFSET, _LOSS = -1, -2
#: Pairs of steps that the quasi-Newton direction remembers, and rounds of choosing the slots that may move.
_MEMORY, _ROUNDS = 8, 2
#: Relative fall of the objective that ends a round.
_STILL = 1e-5


def _row_sums(batches: Iterable[pa.RecordBatch], target: Callable[[np.ndarray], np.ndarray], w: np.ndarray, offset: float, chosen: np.ndarray | None) -> pa.RecordBatch:
    """One task's sums over its rows (slots, mark): of the loss, its slopes and their curvature."""
    slope, curve = np.zeros(1 << BITS), np.zeros(1 << BITS)
    totals, offset_curve = {_OFFSET: 0, _LOSS: 0}, 0
    for batch in batches:
        lists = batch.column(0)
        sizes, found = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy()
        filled = np.flatnonzero(sizes)
        raw = np.full(len(sizes), offset)
        if len(filled):
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])[filled].astype(np.int64)
            raw[filled] += np.add.reduceat(w[found], starts)
        y = target(batch.column(1).to_numpy())
        p = sigmoid(raw)
        # Slots of a row move together, so each one's curvature counts with the row's number of slots.
        error, bend = np.rint(_GRAIN * (p - y)), np.rint(_GRAIN * p * (1 - p) * (sizes + 1))
        offset_curve += int(bend.sum())
        totals[_OFFSET] += int(error.sum())
        totals[_LOSS] += int(np.rint(_GRAIN * (np.logaddexp(0, raw) - y * raw)).sum())
        slope += np.bincount(found, weights=np.repeat(error, sizes), minlength=1 << BITS)
        curve += np.bincount(found, weights=np.repeat(bend, sizes), minlength=1 << BITS)
    at = np.flatnonzero(curve.astype(bool) | slope.astype(bool))
    at = at if chosen is None else np.intersect1d(at, chosen, assume_unique=True)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([*totals, *at.tolist()], pa.int32()),
            pa.array([*totals.values(), *np.rint(slope[at]).astype(np.int64).tolist()], pa.int64()),
            pa.array([offset_curve, 0, *np.rint(curve[at]).astype(np.int64).tolist()], pa.int64()),
        ],
        names=["slot", "total", "curve"],
    )


def _dot(a: np.ndarray, b: np.ndarray) -> float:
    """A product whose order of addition does not depend on threads or on places in memory."""
    return float(np.sum(a * b))


def _direction(slope: np.ndarray, steps: list[tuple[np.ndarray, np.ndarray]], curve: np.ndarray) -> np.ndarray:
    """Minus the slope times the inverse of the curvature that the last steps showed, from its diagonal on."""
    q, parts = slope.copy(), []
    for s, y in reversed(steps):
        part = _dot(s, q) / _dot(s, y)
        parts.append(part)
        q -= part * y
    q /= curve
    if steps:
        s, y = steps[-1]
        q *= _dot(s, y) / _dot(y, y / curve)
    for (s, y), part in zip(steps, reversed(parts), strict=True):
        q += (part - _dot(y, q) / _dot(s, y)) * s
    return -q


def fit_in_tasks(rows: DataFrame, target: Callable[[np.ndarray], np.ndarray], mean: float, l1: float, passes: int) -> tuple[np.ndarray, float]:
    """Logistic weights with an L1 term, and the offset, from all ``rows`` (slots, mark); ``target``
    gives the soft labels of marks.

    Each pass sums the loss and its slopes over all rows at one common state; the driver, which
    holds one number for each slot, makes a quasi-Newton step that keeps signs (orthant-wise),
    halved until the objective falls. Sums are whole numbers, so the result does not depend (but for the rounding of a row) on
    how the rows are partitioned. A first pass shows which slots the L1 term lets move at all;
    only their slopes are returned by the ``passes`` passes that follow, and further passes over
    all slots add those that have to move after these.
    """
    session = rows.sparkSession
    narrow = rows.select("slots", "mark")
    few = narrow.coalesce(max(1, session.sparkContext.defaultParallelism))  # fewer partial sums to move

    def sums(w: np.ndarray, offset: float, chosen: np.ndarray | None) -> tuple[float, np.ndarray, np.ndarray]:
        """The loss, and slopes and curvatures of all slots and, last, of the offset."""
        shared = session.sparkContext.broadcast((w, offset, chosen))

        def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield _row_sums(batches, target, *shared.value)

        found = few.mapInArrow(one, _SUMS).groupBy("slot").agg(F.sum("total").alias("total"), F.sum("curve").alias("curve")).toArrow()
        shared.unpersist()
        slot, *columns = (found.column(c).to_numpy() for c in ("slot", "total", "curve"))
        loss = int(columns[0][slot == _LOSS].sum()) / _GRAIN
        kept = slot != _LOSS
        out = np.zeros((2, (1 << BITS) + 1))
        out[:, np.where(slot[kept] == _OFFSET, 1 << BITS, slot[kept])] = np.array([c[kept] for c in columns]) / _GRAIN
        return loss, out[0], out[1]

    return minimise(sums, mean, l1, passes)


#: The loss, and slopes and curvatures of all slots and, last, of the offset, at weights and an offset;
#: where slots are given, only theirs need be right.
Sums = Callable[[np.ndarray, float, np.ndarray | None], tuple[float, np.ndarray, np.ndarray]]


def minimise(sums: Sums, mean: float, l1: float, passes: int, rounds: int = _ROUNDS) -> tuple[np.ndarray, float]:
    """Weights and offset of least loss with an L1 term, from its sums; see ``fit_in_tasks``."""
    w, offset = np.zeros(1 << BITS), float(logit(mean))
    chosen = np.empty(0, np.int64)
    for _ in range(rounds):
        loss, slope, curve = sums(w, offset, None)
        moved = np.flatnonzero((w != 0) | (np.abs(slope[:-1]) > l1 * (1 + 1e-9)))
        if len(np.setdiff1d(moved, chosen, assume_unique=True)) == 0:
            break
        chosen = np.union1d(chosen, moved)
        places = np.append(chosen, 1 << BITS)
        x, g, bend = np.append(w[chosen], offset), slope[places], curve[places] + 1.0
        term = np.append(np.full(len(chosen), l1), 0.0)  # the offset has no L1 term
        value, steps = loss + _dot(term, np.abs(x)), []
        for _ in range(passes):
            pull = np.where(x != 0, g + term * np.sign(x), np.sign(g) * np.maximum(np.abs(g) - term, 0))
            move = _direction(pull, steps, bend)
            move[move * pull >= 0] = 0
            if not move.any():
                break
            side = np.where(x != 0, np.sign(x), -np.sign(pull))
            part = min(1.0, 2 / np.abs(move).max())  # no weight moves by more than two at once
            for _ in range(20):
                new = x + part * move
                new[:-1] = np.where(new[:-1] * side[:-1] > 0, new[:-1], 0.0)
                w_new = np.zeros(1 << BITS)
                w_new[chosen] = new[:-1]
                loss, slope, curve = sums(w_new, float(new[-1]), chosen)
                found = loss + _dot(term, np.abs(new))
                if found <= value + 1e-4 * _dot(pull, new - x):
                    break
                part /= 2
            else:
                break
            g_new, bend = slope[places], curve[places] + 1.0
            if _dot(new - x, g_new - g) > 1e-12:
                steps = [*steps, (new - x, g_new - g)][-_MEMORY:]
            still = value - found <= _STILL * abs(value)
            x, g, value = new, g_new, found
            if still:
                break
        w = np.zeros(1 << BITS)
        w[chosen], offset = x[:-1], float(x[-1])
    return w, offset


def fit_dense(x: np.ndarray, targets: np.ndarray, weights: np.ndarray | None = None, ridge: float = 1.0) -> np.ndarray:
    """Logistic weights (the last is the offset) for soft targets, by Newton's method."""
    design = np.column_stack([x, np.ones(len(x))])
    weights = np.ones(len(x)) if weights is None else weights
    w = np.zeros(design.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-3
    for _ in range(40):
        p = sigmoid(design @ w)
        gradient = design.T @ (weights * (targets - p)) - penalty * w
        hessian = (design * (weights * p * (1 - p))[:, None]).T @ design + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return w


def logit(p):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


class WordWeights(dict):
    """Sums of the weights of a text's tokens.

    Maps a token to the row of its weights, 0 if none of its features has a weight; tokens
    are remembered, so that most of a text is looked up without a step of Python for each.
    """

    def __init__(self, weights: np.ndarray):
        """``weights``: one row for each output, over the hashed features."""
        super().__init__()
        self.weights = weights
        self.active = set(np.flatnonzero(weights.any(axis=0)).tolist())
        self.rows = [np.zeros(len(weights))]

    def __missing__(self, token: str) -> int:
        active = self.active
        found = [s for s in slots(token) if s in active]
        row = 0
        if found:
            row = len(self.rows)
            self.rows.append(self.weights[:, found].sum(axis=1))
        self[token] = row
        return row

    def score(self, words: Iterable[str]) -> np.ndarray:
        if len(self) > 2 * REMEMBERED:
            self.clear()
            del self.rows[1:]
        hits = [row for row in map(self.__getitem__, words) if row]
        return sum((self.rows[row] for row in hits), self.rows[0])
